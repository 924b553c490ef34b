"""One-step ARIMA(1,1,1) forecast of the last reading of every sliding window.

The estimator (Hannan-Rissanen, two least-squares stages) needs only sums of
squares and lag products of the differences d of consecutive readings, and a
few values at both ends of the window. All of them are plain aggregates, so no
window is collected or sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.windows import Sliding
from rivulet.schemas import UNCONVERTED

# A forecast needs this many readings before the last one.
MIN_HISTORY = 6
# Regressors closer to collinear than this give no forecast.
MIN_RELATIVE_DETERMINANT = 1e-6
COEFFICIENT_LIMIT = 0.99
INTERVAL_Z = 1.96

# What an estimate needs of a window: its number of readings, the first three
# values, the last five (t1 is the newest, the one to forecast), and the sums of
# d*d, d*d[-1] and d*d[-2] over the readings before the newest one.
_FIRST = ("h1", "h2", "h3")
_LAST = ("t1", "t2", "t3", "t4", "t5")
_SUMS = ("a", "b", "c")
MOMENTS = ("rows", *_FIRST, *_LAST, *_SUMS)


def forecastable(readings: DataFrame, value: str = "conValue", include_unconverted: bool = False) -> DataFrame:
    """Readings with a usable value."""
    rows = readings.where(F.col(value).isNotNull() & (F.abs(F.col(value)) < float("inf")))
    return rows if include_unconverted else rows.where(F.col(value) != UNCONVERTED)


def _lag_products(y: Column, y1: Column, y2: Column, y3: Column) -> list[Column]:
    """d*d, d*d[-1] and d*d[-2] for a value and the three before it."""
    d = y - y1
    return [d * d, d * (y1 - y2), d * (y2 - y3)]


def window_moments(
    readings: DataFrame, windows: Sliding, key: str, value: str, tie: str | None = None
) -> DataFrame:
    """Moments of every window, with columns ``key``, ``end``, ``timestamp`` (of
    the newest reading) and those of ``MOMENTS``.

    A pane is in a window as a whole, so readings whose terms stay inside their
    pane are summed per pane. Only the edge readings of a pane, at most four,
    are put into each window on their own; which of their terms count depends
    on where the window begins and ends.
    """
    order = [F.col("timestamp"), *([F.col(tie)] if tie else []), F.col("y")]
    rows = readings.select(
        key,
        windows.pane_of().alias("pane"),
        "timestamp",
        F.col(value).cast("double").alias("y"),
        *([tie] if tie else []),
    )
    in_pane = Window.partitionBy(key, "pane").orderBy(*order)
    ranked = rows.select(
        key,
        "pane",
        "timestamp",
        *([tie] if tie else []),
        "y",
        F.row_number().over(in_pane).alias("rank"),
        *(F.lag("y", i).over(in_pane).alias(f"y{i}") for i in range(1, 4)),
        F.lead("pane", 1).over(in_pane).isNull().alias("ends_pane"),
        F.lead("pane", 5).over(in_pane).isNull().alias("near_end"),
    )
    # Rows 4 and later of a pane, but for the newest, have all their terms inside it.
    inner = F.col("rank") > 3
    before = in_pane.rowsBetween(Window.unboundedPreceding, -1)
    products = _lag_products(*(F.col(c) for c in ("y", "y1", "y2", "y3")))
    edges = ranked.select(
        key,
        "pane",
        "timestamp",
        "y",
        "rank",
        "ends_pane",
        "near_end",
        F.count(F.when(inner, True)).over(before).alias("inner_rows"),
        *(
            F.sum(F.when(inner, product)).over(before).alias(f"inner_{name}")
            for name, product in zip(_SUMS, products, strict=True)
        ),
    ).where((F.col("rank") <= 3) | F.col("near_end"))

    # What remains is at most eight rows per pane, whatever the number of readings.
    in_sensor = Window.partitionBy(key).orderBy("pane", "rank")
    linked = edges.select(
        key,
        "pane",
        "timestamp",
        "y",
        "rank",
        "ends_pane",
        *(F.when(F.col("ends_pane"), F.col(f"inner_{n}")).alias(f"inner_{n}") for n in ("rows", *_SUMS)),
        *(F.lag("y", i).over(in_sensor).alias(f"y{i}") for i in range(1, 5)),
        *(F.lag("pane", i).over(in_sensor).alias(f"pane{i}") for i in range(1, 4)),
        F.lead("pane").over(in_sensor).alias("next_pane"),
    ).where((F.col("rank") <= 3) | F.col("ends_pane"))
    spread = linked.withColumn("end", F.explode(windows.ends("pane"))).where(windows.aligned())

    first_pane = f"(end - {windows.panes - 1})"
    flagged = spread.selectExpr(
        "*",
        *(f"coalesce(pane{i} >= {first_pane}, false) as has{i}" for i in (1, 2, 3)),
        "coalesce(next_pane > end, true) as newest",
    )
    products = ("(y - y1) * (y - y1)", "(y - y1) * (y1 - y2)", "(y - y1) * (y2 - y3)")
    aggregates = (
        "max(timestamp) as timestamp",
        "sum(coalesce(inner_rows, 0) + 1) as rows",
        "max(case when not has1 then y end) as h1",
        "max(case when has1 and not has2 then y end) as h2",
        "max(case when has2 and not has3 then y end) as h3",
        *(
            f"max(case when newest then {c} end) as {t}"
            for t, c in zip(_LAST, ("y", "y1", "y2", "y3", "y4"), strict=True)
        ),
        *(
            f"sum(case when has{i} and not newest then {product} else 0 end"
            f" + coalesce(inner_{name}, 0)) as {name}"
            for i, name, product in zip((1, 2, 3), _SUMS, products, strict=True)
        ),
    )
    return flagged.groupBy(key, "end").agg(*map(F.expr, aggregates))


def _barrier(row: Column) -> Column:
    """The fields of a struct as columns, through a generator.

    Filters do not move below a generator, so a filter on a result does not
    evaluate the expressions behind it a second time.
    """
    return F.inline(F.array(row))


def estimate(df: DataFrame) -> DataFrame:
    """Add ``last``, ``forecast``, ``lower`` and ``upper`` to rows with ``MOMENTS``.

    Differences are centred on their mean. Stage 1 regresses a difference on the
    one before it, stage 2 on the one before it and that one's stage-1 residual.
    Rows with collinear regressors are dropped.
    """
    keep = [c for c in df.columns if c not in MOMENTS]
    limit = COEFFICIENT_LIMIT
    stages = (
        # m differences of the history, their sum and mean.
        ("cast(rows - 2 as double) as m", "t2 - h1 as s1", "(t2 - h1) / (rows - 2) as mu"),
        # Centred differences: the first two, and the last three from the newest.
        (
            "h2 - h1 - mu as u1",
            "h3 - h2 - mu as u2",
            "t2 - t3 - mu as p1",
            "t3 - t4 - mu as p2",
            "t4 - t5 - mu as p3",
            "a - mu * s1 as c0",
        ),
        # Sums of centred products over all pairs one and two differences apart.
        (
            "b - mu * (2 * s1 - u1 - p1 - 2 * mu) + (m - 1) * mu * mu as c1",
            "c - mu * (2 * s1 - u1 - u2 - p1 - p2 - 4 * mu) + (m - 2) * mu * mu as c2",
        ),
        # Stage 1, and the sums of stage 2 that do not depend on it. Stage 2 runs
        # over the third to the last difference.
        (
            "try_divide(c1, c0 - p1 * p1) as ar",
            "c0 - u1 * u1 - u2 * u2 as yy",
            "c0 - u1 * u1 - p1 * p1 as xx",
            "c0 - p1 * p1 - p2 * p2 as older",
            "c1 - p1 * p2 as x_older",
            "c1 - u1 * u2 as xy",
        ),
        (
            "xx - ar * x_older as xe",
            "xx - 2 * ar * x_older + ar * ar * older as ee",
            "xy - ar * c2 as ey",
        ),
        ("xx * ee - xe * xe as det",),
        (f"det > 0 and det > {MIN_RELATIVE_DETERMINANT} * xx * ee as solvable",),
        tuple(
            f"case when solvable then greatest(-{limit}D, least({limit}D, ({top}) / det)) end as {name}"
            for name, top in (("phi", "xy * ee - ey * xe"), ("theta", "ey * xx - xy * xe"))
        ),
        (
            "t2 + mu + phi * p1 + theta * (p1 - phi * p2 - theta * (p2 - ar * p3)) as forecast",
            "yy - 2 * phi * xy - 2 * theta * ey + phi * phi * xx + 2 * phi * theta * xe"
            " + theta * theta * ee as squares",
        ),
        (f"{INTERVAL_Z} * sqrt(greatest(squares, 0D) / (m - 4)) as half",),
    )
    for stage in stages:
        df = df.selectExpr("*", *stage)
    result = F.expr(
        "struct(t1 as last, forecast, forecast - half as lower, forecast + half as upper)"
    )
    return df.select(*keep, _barrier(result)).where("forecast is not null")


def arima_forecast(
    readings: DataFrame,
    size: str = "2 hours",
    slide: str = "5 minutes",
    key: str = "sensorid",
    value: str = "conValue",
    tie: str | None = None,
    include_unconverted: bool = False,
) -> DataFrame:
    """Forecast of the last reading of every window from the ones before it."""
    windows = Sliding(size, slide)
    moments = window_moments(
        forecastable(readings, value, include_unconverted), windows, key, value, tie
    ).where(F.col("rows") > MIN_HISTORY)
    timed = moments.select(
        key,
        windows.start().alias("window_start"),
        windows.finish().alias("window_end"),
        "timestamp",
        F.col("rows").alias("n"),
        *MOMENTS,
    )
    return estimate(timed)


def interval_alerts(forecasts: DataFrame, key: str = "sensorid", keep: Sequence[str] = ()) -> DataFrame:
    """Alerts for windows whose last reading left the forecast interval."""
    last = F.col("last")
    return forecasts.where((last < F.col("lower")) | (last > F.col("upper"))).select(
        *keep, F.col(key).alias("sensorid"), "timestamp", last.alias("value"), "lower", "upper"
    )


def forecast_alerts(
    readings: DataFrame,
    size: str = "2 hours",
    slide: str = "5 minutes",
    key: str = "sensorid",
    value: str = "conValue",
    tie: str | None = None,
    include_unconverted: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Batch form of the forecast job: readings in, alerts out."""
    forecasts = arima_forecast(readings, size, slide, key, value, tie, include_unconverted)
    return interval_alerts(forecasts, key, keep)
