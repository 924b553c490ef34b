"""Mixing sources to target weights by pivotal dependent rounding.

Sources are numbered by code point and share the words of the corpus by weight; a share
stops at a multiple of the source's own words, and what is over is shared again by weight.
A document then has an expected number of copies, the same for all of its source. The whole
copies are certain. The rest, a fraction, is rounded in dependence: of two documents one
passes words to the other, at random which and so that expectations stay, until one of them
has none or all of its words; that one is settled and the other meets the next. The words of
a source thus stay what they are while documents become whole.

Documents meet those of their source and of like size (the power of two below it), in
groups dealt by a hash. Each group leaves one unsettled document, and a reduction tree
joins those, ``fan_in`` at a time, until one is left of each size. These few are rounded
from the longest down, each by the share that the source is still owed and so that the
shorter ones can make up for it, so that what remains falls to the shortest. Draws are hashes of the documents that meet, so reruns agree.

The pass over the texts keeps ids and sizes only. Equal rows are counted before they are
shuffled and dealt out again one by one; no group holds more than about ``fan_in`` documents,
however large its source. Ranks and shares of sources are running sums in ranges of the
order, then over ranges.

Null texts have no words, as have empty ones: nothing is taken of them. Rows that repeat an
id are documents of their own, rows without id too. A null source is a source, the last. Of
an empty table there are no rows, and if no text has words all targets are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.let import let
from rivulet.llm import common

WORD = r"[^\x20\x09-\x0D]+"
#: Copies of one row that one chunk holds while they are dealt out.
_CHUNK = 4096
_UNIT = "struct<doc_id:bigint,nth:bigint,size:bigint,mass:double>"
_SETTLED = "struct<doc_id:bigint,size:bigint,extra:int>"
_ABOUT = ("source_size", "target", "base")


def running_sums(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with sums of columns over all rows up to each in ``order``.

    Ranges of the order are summed in parallel; what comes before a range is a sum over
    ranges, of which there are as many as shuffle partitions.
    """
    ranged = df.repartitionByRange(common.partitions(df.sparkSession), *order)
    ranged = common.written(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(*(F.sum(v).alias(f"{k}_all") for k, v in sums.items()))
    totals = totals.select("range", *(F.coalesce(F.sum(f"{k}_all").over(before), F.lit(0)).alias(f"{k}_all") for k in sums))
    local = ranged.withColumns({k: F.sum(v).over(inside) for k, v in sums.items()})
    return (
        local.join(F.broadcast(totals), "range")
        .withColumns({k: F.col(k) + F.col(f"{k}_all") for k in sums})
        .drop("range", *(f"{k}_all" for k in sums))
    )


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``rank``, ``source``, ``source_size`` and ``target`` for rows of the first two (a source's words).

    Filling every source to the level at which one reaches its cap tells whether that one
    is capped; the others share what the capped ones leave.
    """
    ordered = sources.withColumn("last", F.col("source").isNull())
    ranked = running_sums(ordered, ["last", "source"], {"rank": F.lit(1)}).drop("last")
    common_weight = math.lcm(*weights)
    place = ((F.col("rank") - 1) % len(weights) + 1).cast("int")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), place))
    ranked = ranked.withColumn("level", F.expr(f"source_size * {common_weight}L div weight"))
    filled = running_sums(
        ranked, ["level", "rank"], {"sizes": F.col("source_size"), "weights": F.col("weight").cast("long")}
    )
    filled = common.written(filled, "filled")
    total = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if total.size is None:
        return filled.select("rank", "source", "source_size", F.lit(0.0).alias("target"))
    whole, weight = F.lit(total.size), F.lit(total.weight)
    at_level = _wide(F.col("sizes")) * F.lit(most * common_weight) + _wide(F.col("level") * most) * _wide(
        weight - F.col("weights")
    )
    filled = filled.withColumn("capped", at_level <= _wide(whole) * F.lit(common_weight))
    gone = filled.where("capped").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left, sharing = total.size - most * (gone.size or 0), total.weight - (gone.weight or 0)
    shares = F.array(*(F.lit(w * left / sharing if sharing else 0.0) for w in weights))
    target = F.when(F.col("capped"), (F.col("source_size") * most).cast("double")).otherwise(
        F.element_at(shares, place)
    )
    return filled.select("rank", "source", "source_size", target.alias("target"))


def _draw(seed: int, *values: Column) -> Column:
    """A number from 0 to below 1 by a hash of the values."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *values), 11) * F.lit(2.0**-53)


def _meet(carry: Column, unit: Column, seed: int) -> Column:
    """The pivotal step: the settled one of two units, and the other with the words left to it."""
    draw = _draw(seed, carry.doc_id, carry.nth, unit.doc_id, unit.nth)

    def passed(words: Column) -> Column:
        def settled(up: Column) -> Column:
            carried_ends = F.when(up, carry.mass <= unit.size - unit.mass).otherwise(unit.mass > carry.size - carry.mass)

            def other(ends: Column) -> Column:
                extra = F.when(ends == up, 0).otherwise(1)
                gone = F.when(ends, carry).otherwise(unit)
                stays = F.when(ends, unit).otherwise(carry)
                mass = carry.mass + unit.mass - extra * gone.size
                mass = F.greatest(F.lit(0.0), F.least(mass, stays.size.cast("double")))
                return F.struct(
                    F.struct(stays.doc_id, stays.nth, stays.size, mass.alias("mass")).cast(_UNIT).alias("carry"),
                    F.struct(gone.doc_id, gone.size, extra).cast(_SETTLED).alias("settled"),
                )

            return let(carried_ends, other)

        return let(draw * (words.give + words.get) < words.get, settled)

    give = F.least(carry.mass, unit.size - unit.mass)
    get = F.least(carry.size - carry.mass, unit.mass)
    return let(F.struct(give.alias("give"), get.alias("get")), passed)


def _reduced(units: Column, seed: int) -> Column:
    """Units of one group, one after another: those settled, and the one that is left."""
    none = F.struct(F.lit(None).cast(_UNIT).alias("carry"), F.array().cast(f"array<{_SETTLED}>").alias("settled"))

    def step(state: Column, unit: Column) -> Column:
        met = let(
            _meet(state.carry, unit, seed),
            lambda m: F.struct(m.carry.alias("carry"), F.concat(state.settled, F.array(m.settled)).alias("settled")),
        )
        first = F.struct(unit.cast(_UNIT).alias("carry"), state.settled.alias("settled"))
        return F.when(state.carry.isNull(), first).otherwise(met)

    return F.aggregate(units, none, step)


def _last_ones(units: Column, base: Column, most: int, seed: int) -> Column:
    """The units that are left of a source, longest first, rounded by what it is still owed.

    A draw that the shorter ones could not make up for is not taken.
    """
    kind = f"struct<owed:double,room:double,settled:array<{_SETTLED}>>"
    start = F.struct(
        F.aggregate(units, F.lit(0.0), lambda s, u: s + u.mass),
        F.aggregate(units, F.lit(0.0), lambda s, u: s + u.size),
        F.array().cast(f"array<{_SETTLED}>"),
    ).cast(kind)

    def step(state: Column, unit: Column) -> Column:
        rest = state.room - unit.size
        least, greatest = (F.ceil((state.owed - (most - base) * rest) / unit.size), F.floor((state.owed + base * rest) / unit.size))

        def copies(share: Column) -> Column:
            more = F.when(_draw(seed, unit.doc_id, unit.nth) < share - F.floor(share), 1).otherwise(0)
            drawn = F.floor(share) + more
            within = F.when(least <= greatest, F.greatest(least, F.least(drawn, greatest))).otherwise(drawn)
            extra = F.greatest(-base, F.least(within, most - base)).cast("int")
            return let(
                extra,
                lambda e: F.struct(
                    state.owed - e * unit.size,
                    state.room - unit.size,
                    F.concat(state.settled, F.array(F.struct(unit.doc_id, unit.size, e).cast(_SETTLED))),
                ).cast(kind),
            )

        return let(state.owed / F.greatest(state.room, unit.size.cast("double")), copies)

    return F.aggregate(units, start, step, lambda state: state.settled)


def mix_sources(
    documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, fan_in: int = 128, seed: int = 7
) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target`` (of its source), ``copies`` and ``taken``."""
    units = common.written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("source", "doc_id", "size")
        .agg(F.count("*").alias("n")),
        "units",
    )
    units = units.withColumn("class", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0))
    sizes = common.written(
        units.groupBy("source", "class").agg(F.sum("n").alias("rows"), F.sum(F.col("size") * F.col("n")).alias("words")),
        "sizes",
    )
    targets = source_targets(sizes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    copies = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    targets = targets.withColumn("base", F.floor(copies).cast("int")).withColumn("part", copies - F.col("base"))
    groups = F.ceil(F.col("rows") / fan_in).cast("long")
    classes = (
        targets.withColumnRenamed("source", "of")
        .join(sizes.drop("words"), F.col("of").eqNullSafe(F.col("source")))
        .select("of", F.col("class").alias("of_class"), "rank", *_ABOUT, "part", groups.alias("groups"))
    )
    classes = common.written(classes, "classes")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_CHUNK}")))
    first = F.col("chunk") * _CHUNK
    each = (
        units.join(classes, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("of_class")))
        .select("doc_id", "size", "class", "rank", *_ABOUT, "part", "groups", "n", chunk.alias("chunk"))
        .withColumn("nth", F.explode(F.sequence(first, F.least(F.col("n"), first + _CHUNK) - 1)))
    )
    drawn = (F.col("size") > 0) & (F.col("part") > 0)
    plain = each.where(~drawn).select("doc_id", "size", *_ABOUT, F.lit(0).alias("extra"))
    hashed = F.xxhash64(F.lit(seed), "doc_id", "nth")
    unit = F.struct("doc_id", "nth", "size", (F.col("part") * F.col("size")).alias("mass"))
    level = (
        each.where(drawn)
        .select("rank", "class", F.pmod(hashed, F.col("groups")).alias("group"), "groups", *_ABOUT, hashed.alias("h"), unit.alias("unit"))
        .groupBy("rank", "class", "group", "groups", *_ABOUT)
        .agg(F.sort_array(F.collect_list(F.struct("h", "unit"))).alias("units"))
    )
    most_groups = classes.where("part > 0").agg(F.max("groups")).first()[0] or 1
    results = [plain]
    while True:
        state = _reduced(F.transform("units", lambda x: x.unit), seed)
        level = common.written(level.withColumn("state", state).drop("units"), "level")
        gone = level.select(*_ABOUT, F.explode("state.settled").alias("s"))
        results.append(gone.select("s.doc_id", "s.size", *_ABOUT, "s.extra"))
        left = level.select("rank", "class", "group", "groups", *_ABOUT, F.col("state.carry").alias("unit"))
        if most_groups == 1:
            break
        most_groups = -(-most_groups // fan_in)
        level = (
            left.select("rank", "class", F.expr(f"`group` div {fan_in}").alias("group"), *_ABOUT, F.col("group").alias("h"), "unit")
            .groupBy("rank", "class", "group", *_ABOUT)
            .agg(F.sort_array(F.collect_list(F.struct("h", "unit"))).alias("units"))
            .withColumn("groups", F.lit(most_groups))
        )
    longest = F.sort_array(F.collect_list(F.struct("class", "unit")), asc=False)
    last = left.groupBy("rank", *_ABOUT).agg(longest.alias("units"))
    last = last.withColumn("s", F.explode(_last_ones(F.transform("units", lambda x: x.unit), F.col("base"), most, seed)))
    results.append(last.select("s.doc_id", "s.size", *_ABOUT, "s.extra"))
    mixed = results[0]
    for result in results[1:]:
        mixed = mixed.unionByName(result)
    copies = F.col("base") + F.col("extra")
    return mixed.select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
