"""Source mixing against exact fractions and a plain tree of pivotal steps."""

import math
import random
import re
import struct
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({n: F.lit("x") for n in ("size", "rank", "target", "class", "group", "n", "unit", "weight")})


def corpus(seed, sources, docs):
    rng = random.Random(seed)
    rows = []
    for s in range(sources):
        name = None if s == 3 else f"é{s}" if s == 4 else f"s{s}"
        for _ in range(docs if s else docs * 6):
            n = int(rng.lognormvariate(3, 1.5))
            rows.append((len(rows), name, " \t".join(["wörd"] * n)))
    return rows


def words(text):
    return len(re.findall(mixing.WORD, text or ""))


def exact_targets(rows, weights=(1, 2, 3), most=3):
    """Shares by rounds: what is over a cap is shared again among the others."""
    size = Counter()
    for _, source, text in rows:
        size[source] += words(text)
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(size.values()) - sum(most * size[s] for s in capped)
        sharing = sum(weight[s] for s in names if s not in capped)
        target = {s: Fraction(weight[s] * left, sharing) if s not in capped else Fraction(most * size[s]) for s in names}
        over = {s for s in names if s not in capped and target[s] > most * size[s]}
        if not over:
            return size, target
        capped |= over


def hashed(seed, *values):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def plain_mix(rows, most=3, fan_in=128, seed=7):
    """Copies by (doc_id, number among equal rows), one step after another."""
    size, target = exact_targets(rows)
    seen, units, copies = Counter(), defaultdict(list), {}
    base = {s: math.floor(float(target[s]) / max(size[s], 1)) for s in size}
    for doc_id, source, text in rows:
        n = words(text)
        nth = seen[doc_id, source, n]
        seen[doc_id, source, n] += 1
        part = float(target[source]) / max(size[source], 1) - base[source]
        copies[doc_id, source, n, nth] = base[source]
        if n and part > 0:
            units[source, n.bit_length()].append((doc_id, nth, n, part * n))
    last = defaultdict(list)
    for (source, kind), members in units.items():
        groups = -(-len(members) // fan_in)
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        level = defaultdict(list)
        for u in members:
            h = hashed(seed, u[0], u[1])
            level[signed(h) % groups].append((signed(h), u))
        while True:
            left = {}
            for group, own in level.items():
                carry = None
                for _, u in sorted(own):
                    if carry is None:
                        carry = u
                        continue
                    give, get = min(carry[3], u[2] - u[3]), min(carry[2] - carry[3], u[3])
                    up = (hashed(seed, carry[0], carry[1], u[0], u[1]) >> 11) * 2.0**-53 * (give + get) < get
                    ends = carry[3] <= u[2] - u[3] if up else u[3] > carry[2] - carry[3]
                    extra = int(ends != up)
                    gone, stays = (carry, u) if ends else (u, carry)
                    copies[gone[0], source, gone[2], gone[1]] += extra
                    mass = carry[3] + u[3] - extra * gone[2]
                    carry = (*stays[:3], max(0.0, min(mass, float(stays[2]))))
                left[group] = carry
            if groups == 1:
                break
            groups = -(-groups // fan_in)
            level = defaultdict(list)
            for group, u in left.items():
                level[group // fan_in].append((group, u))
        last[source].append((kind, left[0]))
    for source, own in last.items():
        own = [u for _, u in sorted(own, reverse=True)]
        owed = room = 0.0
        for u in own:
            owed += u[3]
            room += u[2]
        b = base[source]
        for doc_id, nth, n, _ in own:
            rest = room - n
            low, high = math.ceil((owed - (most - b) * rest) / n), math.floor((owed + b * rest) / n)
            share = owed / max(room, n)
            e = math.floor(share) + int((hashed(seed, doc_id, nth) >> 11) * 2.0**-53 < share - math.floor(share))
            e = max(low, min(e, high)) if low <= high else e
            e = max(-b, min(e, most - b))
            copies[doc_id, source, n, nth] += e
            owed, room = owed - e * n, room - n
    return copies


@pytest.mark.parametrize("fan_in", [4, 128])
def test_mix_is_that_of_plain_steps(spark, fan_in):
    rows = corpus(1, 8, 40)
    rows += [(9, "s1", None), (9, "s1", "a b"), (9, "s1", "a c"), (9, "s1", "c d"), (10_000, "z", ""), (10_001, "z", None)]
    size, target = exact_targets(rows)
    got = mixing.mix_sources(frame(spark, rows), fan_in=fan_in).collect()
    want = plain_mix(rows, fan_in=fan_in)
    source = {r[0]: r[1] for r in rows}
    assert Counter((r.doc_id, r["size"], r.copies) for r in got) == Counter((d, n, c) for (d, _, n, _), c in want.items())
    for r in got:
        own = source[r.doc_id]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        if r.doc_id != 9:
            assert r.source_size == size[own] and r.target == pytest.approx(float(target[own]), rel=1e-12)


def test_sources_come_near_their_targets(spark):
    rows = corpus(2, 12, 60)
    got = mixing.mix_sources(frame(spark, rows)).toPandas()
    for (_, target), own in got.groupby(["source_size", "target"]):
        assert abs(own.taken.sum() - target) <= 0.03 * target
    again = mixing.mix_sources(frame(spark, rows).repartition(7)).toPandas()
    by_id = [x.sort_values("doc_id").reset_index(drop=True) for x in (got, again)]
    assert by_id[0].equals(by_id[1])
    others = [mixing.mix_sources(frame(spark, rows), seed=s).toPandas() for s in range(3)]
    assert len({tuple(o.sort_values("doc_id").copies) for o in others}) == 3


def test_caps_are_shared_again(spark):
    names = ["a", "b", "c", "d", None]
    rows = [(i, names[i % 5], "w " * (1 if i % 5 < 2 else 40)) for i in range(50)]
    size, target = exact_targets(rows)
    assert sum(target[s] == 3 * size[s] for s in target) >= 2
    got = mixing.source_targets(spark.createDataFrame(list(size.items()), "source string, source_size long")).collect()
    for r in got:
        assert r.target == pytest.approx(float(target[r.source]), rel=1e-12)
    assert [r.source for r in sorted(got, key=lambda r: r["rank"])] == names


def test_expected_copies(spark):
    """Over many documents of one size class, copies of each half of a source agree with its rate."""
    rng = random.Random(4)
    rows = [(i, "a" if i % 3 else "b", "w " * rng.randint(64, 127)) for i in range(6000)]
    got = mixing.mix_sources(frame(spark, rows)).toPandas()
    for (size, target), own in got.groupby(["source_size", "target"]):
        for half in (own[own.doc_id % 2 == 0], own[own.doc_id % 2 == 1]):
            assert half.taken.sum() / half["size"].sum() == pytest.approx(target / size, abs=0.05)


def test_hot_row_and_tables_without_words(spark):
    rows = [(1, "a", "one two")] * 9000 + [(None, None, "x")] * 50 + [(2, "b", " ".join("w" * 1_000_000))]
    got = mixing.mix_sources(frame(spark, rows)).toPandas()
    size, target = exact_targets(rows)
    assert len(got) == len(rows) and (got.source_size.isin(size.values())).all()
    assert abs(got[got.doc_id == 1].taken.sum() - float(target["a"])) <= 2
    none = mixing.mix_sources(frame(spark, [(1, "a", None), (2, None, " \n")])).collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in none) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix_sources(frame(spark, [])).count() == 0


def test_running_sums_over_ranges(spark):
    rng = random.Random(0)
    values = [(rng.randrange(1000), rng.randrange(50)) for _ in range(500)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], "i long, a long, b long")
    got = mixing.running_sums(df, ["a", "i"], {"s": F.col("b"), "n": F.lit(1)}).orderBy("a", "i").collect()
    total = 0
    for place, r in enumerate(got, 1):
        total += r.b
        assert (r.s, r.n) == (total, place)
