"""Deviation of a reading from the mean of its grid cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.skew import BUCKET_SECONDS, bucket_of
from rivulet.schemas import UNCONVERTED, UNKNOWN_CELL

# Running sums add and remove values for as long as a cell exists. They are kept
# as decimals, which do not drift: ten digits after the point, and room for the
# sum of a billion values below the bound.
EXACT = "decimal(38,10)"
BOUND = 1e18
# A value below the bound. Differences of wider decimals would lose their last digit.
VALUE = "decimal(28,10)"
_BUCKET, _CARRY = "__bucket", "__carry"


def comparable_readings(readings: DataFrame, include_unconverted: bool = False) -> DataFrame:
    """Readings that can take part in a neighbourhood.

    Readings without a converted value or without a cell are left out, as all
    unlocated sensors would otherwise form one neighbourhood.
    """
    rows = readings.where(F.col("conValue").isNotNull() & F.col("gridCell").isNotNull())
    if include_unconverted:
        return rows
    return rows.where((F.col("conValue") != UNCONVERTED) & (F.col("gridCell") != UNKNOWN_CELL))


def fits() -> Column:
    """Whether a value can be summed exactly: not NaN, not infinite, below the bound."""
    return ~F.isnan("conValue") & (F.abs("conValue") < BOUND)


def exact_value() -> Column:
    return F.when(fits(), F.col("conValue").cast(EXACT))


def cell_latest(readings: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest value of every sensor, in the cell it was last seen in."""
    order = F.struct("timestamp", tie) if tie else F.col("timestamp")
    return (
        readings.groupBy("sensorid")
        .agg(F.max_by(F.struct("gridCell", "timestamp", "conValue"), order).alias("latest"))
        .select("sensorid", "latest.*")
    )


def _with_previous(rows: DataFrame, order: list[Column], seconds: int) -> DataFrame:
    """Add ``__prev``: cell and value of the sensor's reading before this one."""
    current = F.struct(F.col("gridCell").alias("cell"), F.col("__value").alias("value"))
    rows = rows.withColumns({"__now": current, _CARRY: F.lit(False), _BUCKET: bucket_of("timestamp", seconds)})
    last = rows.groupBy("sensorid", _BUCKET).agg(F.max_by("__now", F.struct(*order)).alias("__now"))
    earlier = Window.partitionBy("sensorid").orderBy(_BUCKET)
    carried = last.select(
        "sensorid",
        _BUCKET,
        F.lag("__now").over(earlier).alias("__now"),
        F.lit(True).alias(_CARRY),
    ).where(F.col("__now").isNotNull())
    rows = rows.unionByName(carried, allowMissingColumns=True)
    by_time = Window.partitionBy("sensorid", _BUCKET).orderBy(F.col(_CARRY).desc(), *order)
    rows = rows.withColumn("__prev", F.lag("__now").over(by_time))
    return rows.where(~F.col(_CARRY)).drop(_BUCKET, "__now", _CARRY)


def neighbor_mean(
    readings: DataFrame,
    include_self: bool = True,
    include_unconverted: bool = False,
    tie: str | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Readings with ``cellMean``: the mean over the latest value of every sensor
    in the cell at the time of the reading.

    Each reading changes the sum of its cell by the difference to the sensor's
    previous value, so a running sum of differences gives the mean as of every
    reading. A sensor that moves is taken out of its old cell. ``tie`` orders
    readings of equal time. Without ``include_self`` the sensor's own value is
    left out, and the mean is NULL where it is alone. Values that cannot be
    summed exactly (see ``fits``) take no part and come out with a NULL mean.
    """
    every = comparable_readings(readings, include_unconverted)
    odd = every.where(~fits()).select(*readings.columns, F.lit(None).cast("double").alias("cellMean"))
    rows = every.where(fits())
    order = [F.col("timestamp"), *([F.col(tie)] if tie else []), F.col("sensorid")]

    rows = rows.withColumn("__value", F.col("conValue").cast(VALUE))
    rows = _with_previous(rows, order, bucket_seconds)

    prev = F.col("__prev")
    stays = prev["cell"] == F.col("gridCell")
    here = F.struct(
        F.col("gridCell").alias("cell"),
        (F.col("__value") - F.when(stays, prev["value"]).otherwise(F.lit(0))).cast(EXACT).alias("delta"),
        F.when(stays, 0).otherwise(1).cast("bigint").alias("step"),
        F.lit(True).alias("probe"),
    )
    left_behind = F.struct(
        prev["cell"].alias("cell"),
        (-prev["value"]).cast(EXACT).alias("delta"),
        F.lit(-1).cast("bigint").alias("step"),
        F.lit(False).alias("probe"),
    )
    moved = prev.isNotNull() & ~stays
    changes = rows.withColumn(
        "__change", F.explode(F.when(moved, F.array(here, left_behind)).otherwise(F.array(here)))
    ).withColumns({f"__{f}": F.col("__change")[f] for f in ("cell", "delta", "step", "probe")})
    changes = changes.drop("__change", "__prev").withColumn(_CARRY, F.lit(False))

    changes = changes.withColumn(_BUCKET, bucket_of("timestamp", bucket_seconds))
    per_bucket = changes.groupBy("__cell", _BUCKET).agg(
        F.sum("__delta").alias("__delta"), F.sum("__step").alias("__step")
    )
    earlier = Window.partitionBy("__cell").orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        "__cell",
        _BUCKET,
        F.sum("__delta").over(earlier).cast(EXACT).alias("__delta"),
        F.sum("__step").over(earlier).alias("__step"),
        F.lit(False).alias("__probe"),
        F.lit(True).alias(_CARRY),
    ).where(F.col("__step").isNotNull())
    changes = changes.unionByName(carried, allowMissingColumns=True)

    running = (
        Window.partitionBy("__cell", _BUCKET)
        .orderBy(F.col(_CARRY).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.sum("__delta").over(running)
    count = F.sum("__step").over(running)
    summed = changes.withColumns({"__total": total, "__count": count}).where("__probe")
    total, count = F.col("__total"), F.col("__count")
    if not include_self:
        total, count = total - F.col("__value"), count - 1
    mean = F.try_divide(total.cast("double"), count)
    return summed.select(*readings.columns, mean.alias("cellMean")).unionByName(odd)


def neighbor_alerts(
    readings: DataFrame,
    threshold: float = 10.0,
    include_self: bool = True,
    include_unconverted: bool = False,
    tie: str | None = None,
    keep: Sequence[str] = (),
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Alerts for readings further than ``threshold`` from the mean of their cell."""
    means = neighbor_mean(readings, include_self, include_unconverted, tie, bucket_seconds)
    return deviation_alerts(means, threshold, keep)


def deviation_alerts(means: DataFrame, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """Alert rows of readings that carry a ``cellMean``."""
    mean, value = F.col("cellMean"), F.col("conValue")
    return means.where(F.abs(mean - value) > threshold).select(
        *keep,
        "sensorid",
        "timestamp",
        value.alias("value"),
        (mean - threshold).alias("lower"),
        (mean + threshold).alias("upper"),
    )


def neighbor_snapshot(
    readings: DataFrame,
    include_self: bool = False,
    include_unconverted: bool = False,
    tie: str | None = None,
) -> DataFrame:
    """Current deviation of every sensor from its surrounding sensors.

    Sums per cell are aggregated before the shuffle and joined back, so a cell
    with very many sensors does not have to fit in one task.
    """
    latest = cell_latest(comparable_readings(readings, include_unconverted), tie)
    exact = exact_value()
    cells = latest.groupBy("gridCell").agg(
        F.sum(exact).alias("__total"), F.count(exact).alias("__count")
    )
    total, count = F.col("__total"), F.col("__count")
    if not include_self:
        total, count = total - exact, count - 1
    mean = F.try_divide(total.cast("double"), count)
    return (
        latest.join(cells, "gridCell")
        .withColumn("cellMean", mean)
        .select(
            "sensorid",
            "gridCell",
            "timestamp",
            "conValue",
            "cellMean",
            (F.col("conValue") - F.col("cellMean")).alias("deviation"),
        )
    )
