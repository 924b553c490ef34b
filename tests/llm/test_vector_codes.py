"""Vector codes against exhaustive search in Python's integers."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({n: F.lit("x") for n in ("vector", "code", "error", "of", "slot", "label_error")})


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    least = {}
    for i, v, _ in kept:
        if i is not None and v and len(v) % parts == 0:
            least[i] = min(least.get(i, v), v)
    width = len(least[min(least)]) // parts
    whole = lambda x: math.floor(x * 4096) if abs(x) < 2**60 else int(x) * 4096
    cut = lambda v: [[whole(x) for x in v[p * width : (p + 1) * width]] for p in range(parts)]
    alike = sorted({i for i, v, _ in kept if i is not None and len(v) == width * parts})[:entries]
    starts = [min(v for i, v, _ in kept if i == a and len(v) == width * parts) for a in alike]
    books = [[cut(v)[p] for v in starts] for p in range(parts)]
    points = [cut(r[1]) if len(r[1]) == width * parts else None for r in kept]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for x in points:
                if x:
                    own[near(p, x[p])[1]].append(x[p])
            books[p] = [
                [sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)
            ]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, totals = [], Counter()
    for (i, _, label), x in zip(kept, points, strict=True):
        found = [near(p, x[p]) for p in range(parts)] if x else None
        error = min(sum(d for d, _ in found), 2**63 - 1) if x else None
        totals[label] += error or 0
        out.append((i, "".join(f"{k:02x}" for _, k in found) if x else None, error, label))
    with_error = {label for _, _, e, label in out if e is not None}
    return Counter(
        (i, c, e, min(totals[label], 2**63 - 1) if label in with_error else None, sha) for i, c, e, label in out
    )


def found(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("spread", [3, 40, 10**6, 10**12])
def test_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    for k, width in ((1, 1), (5, 3), (16, 8), (40, 2)):
        book = rng.integers(-spread, spread, (k, width))
        points = np.concatenate([rng.integers(-spread, spread, (300, width)), book])
        index, distance = vector_codes.nearest(points, book)
        for x, i, d in zip(points.tolist(), index, distance, strict=True):
            plain = min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book.tolist()))
            assert (int(d), int(i)) == plain


def test_codes(spark):
    rng = random.Random(3)
    rows = [(i * 3 + 7, [rng.gauss(0, 0.4) for _ in range(16)], rng.choice([0, 1, 2, None])) for i in range(200)]
    rows += [(5000 + i, [round(x, 1) for x in rows[0][1]], 9) for i in range(150)]  # a hot value
    rows += [(6000, None, 1), (6001, [None] * 16, 1), (6002, [math.nan] * 16, 1), (6003, [math.inf] * 16, None)]
    rows += [(6004, [], 1), (6005, [0.5] * 8, 77), (6006, [0.5] * 15, 0), (None, [-0.0] * 16, None), (None, [0.1] * 16, 3)]
    rows += [rows[3], (rows[3][0], [-9.0] * 16, 5)]
    assert found(vector_codes.compress_vectors(frame(spark, rows))) == brute(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1e30, -3e25, 0.3, 7e4, 1.7e38]) * rng.random() for _ in range(8)], i % 2) for i in range(60)]
    assert found(vector_codes.compress_vectors(frame(spark, rows))) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = [(3, [0.25] * 8, None), (1, [-0.25] * 8, None)]
    assert found(vector_codes.compress_vectors(frame(spark, rows))) == brute(rows)
    assert vector_codes.compress_vectors(frame(spark, [])).count() == 0
    only = vector_codes.compress_vectors(frame(spark, [(None, [0.5] * 8, 1)])).collect()
    assert [(r.code, r.error, r.label_error) for r in only] == [(None, None, None)]


def test_labels_of_another_type(spark):
    df = spark.createDataFrame([(i, [0.1 * i] * 8, "ab"[i % 2]) for i in range(30)], "vec_id long, embedding array<float>, label string")
    got = vector_codes.compress_vectors(df, parts=4, entries=3, rounds=2).toPandas()
    assert got.label_error.nunique() == 2 and got.code.str.len().eq(8).all()
