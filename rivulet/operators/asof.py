"""As-of lookup: the latest earlier value per key, for every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.skew import BUCKET_SECONDS, bucket_of, bucket_start

_BUCKET, _SIDE, _TIE = "__bucket", "__side", "__tie"
# Order of rows with equal times: carried state, probes, then new values. A
# value with the time of the probe is therefore not seen by it.
_CARRY, _LEFT, _RIGHT = -1, 0, 1


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    on: str = "timestamp",
    tie: str | None = None,
    known: dict[str, str] | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """For every row of ``left``, the last non-null value of each of ``values``
    in ``right`` with the same ``by`` and a strictly earlier ``on``.

    Among right rows with equal time the highest ``tie`` wins. ``known`` maps a
    value column to the name of a flag column that says whether the key has any
    such value at any time. Left rows without a match stay.

    Both sides are unioned, so one shuffle and one sort by time serve all
    values. Keys are cut into time buckets of ``bucket_seconds``, each of which
    starts with a row that carries the values known before it.
    """
    by, values, known = list(by), list(values), known or {}
    value_names = {v: f"__value_{v}" for v in values}
    flag_names = {v: f"__known_{v}" for v in known}

    probes = left.withColumn(_SIDE, F.lit(_LEFT))
    news = right.select(
        *by,
        on,
        F.lit(_RIGHT).alias(_SIDE),
        (F.col(tie) if tie else F.lit(0)).alias(_TIE),
        *(F.col(v).alias(name) for v, name in value_names.items()),
        *(F.when(F.col(v).isNotNull(), True).alias(name) for v, name in flag_names.items()),
    )
    partition = [*by, _BUCKET]
    probes = probes.withColumn(_BUCKET, bucket_of(on, bucket_seconds))
    news = news.withColumn(_BUCKET, bucket_of(on, bucket_seconds))
    carried = _carry_rows(probes, news, by, on, bucket_seconds, value_names, flag_names)
    news = news.unionByName(carried, allowMissingColumns=True)

    rows = probes.unionByName(news, allowMissingColumns=True)
    before = (
        Window.partitionBy(*partition)
        .orderBy(F.col(on), F.col(_SIDE), F.col(_TIE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*partition)
    out = rows.select(
        *left.columns,
        _BUCKET,
        _SIDE,
        *(F.last(name, ignorenulls=True).over(before).alias(v) for v, name in value_names.items()),
        *flag_names.values(),
    )
    if known:
        out = out.withColumns(
            {known[v]: F.coalesce(F.max(name).over(whole), F.lit(False)) for v, name in flag_names.items()}
        )
    return out.where(F.col(_SIDE) == _LEFT).select(*left.columns, *values, *known.values())


def _carry_rows(
    probes: DataFrame,
    news: DataFrame,
    by: list[str],
    on: str,
    seconds: int,
    value_names: dict[str, str],
    flag_names: dict[str, str],
) -> DataFrame:
    """One row per key and bucket that has probes, with the values known before the bucket.

    Both sides are aggregated in one pass. The window below sees one row per
    bucket, so its groups grow with the time range and not with the number of rows.
    """
    names = list(value_names.values())
    flags = list(flag_names.values())
    group = [*by, _BUCKET]

    def last_in_bucket(name: str):
        order = F.when(F.col(name).isNotNull(), F.struct(on, _TIE))
        return F.max_by(name, order).alias(name)

    marks = (
        probes.select(*group, on, _SIDE)
        .unionByName(news, allowMissingColumns=True)
        .groupBy(*group)
        .agg(
            *(last_in_bucket(n) for n in names),
            *(F.max(f).alias(f) for f in flags),
            F.min(_SIDE).alias(_SIDE),
        )
    )
    earlier = (
        Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    ever = Window.partitionBy(*by)
    return (
        marks.select(
            *group,
            bucket_start(_BUCKET, seconds).cast(news.schema[on].dataType).alias(on),
            F.col(_SIDE).alias("__probed"),
            *(F.last(n, ignorenulls=True).over(earlier).alias(n) for n in names),
            *(F.max(f).over(ever).alias(f) for f in flags),
        )
        .where(F.col("__probed") == _LEFT)
        .drop("__probed")
        .withColumn(_SIDE, F.lit(_CARRY))
    )
