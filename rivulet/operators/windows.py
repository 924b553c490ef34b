"""Sliding event-time windows per sensor, assembled from panes.

A pane is the largest time slice that no window boundary cuts. Readings are
reduced to one row per sensor and pane first; windows are then put together
from pane rows. A reading is thus shuffled once, however many windows it is
in, and a busy sensor spreads over as many groups as it has panes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Seconds per unit of a duration text.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_seconds(text: str) -> int:
    """Seconds of a duration like ``"5 minutes"``."""
    number, unit = text.split()
    return int(number) * UNIT_SECONDS[unit.lower().rstrip("s")]


class Sliding:
    """Windows [start, start + size) every ``slide``, aligned to the epoch."""

    def __init__(self, size: str = "2 hours", slide: str = "5 minutes"):
        self.size = duration_seconds(size)
        self.slide = duration_seconds(slide)
        self.pane = math.gcd(self.size, self.slide)
        self.panes = self.size // self.pane
        self.step = self.slide // self.pane

    def pane_of(self, time: str = "timestamp") -> Column:
        return F.floor(F.unix_seconds(time) / self.pane)

    def ends(self, pane: str) -> Column:
        """Array of the last panes of all windows that hold ``pane``."""
        return F.sequence(F.col(pane), F.col(pane) + (self.panes - 1))

    def frames(self, panes: DataFrame, key: str = "sensorid") -> DataFrame:
        """Pane rows plus one row for every later window end that still reaches a
        pane, with ``end`` = the last pane of the window.

        Added rows have ``real`` = false, and their columns must not be counted.
        Every window with at least one reading appears exactly once.
        """
        following = F.lead("pane").over(Window.partitionBy(key).orderBy("pane"))
        reach = F.col("pane") + (self.panes - 1)
        until = F.least(reach, F.coalesce(F.col("next") - 1, reach))
        return (
            panes.withColumn("next", following)
            .withColumn("end", F.explode(F.sequence(F.col("pane"), until)))
            .withColumn("real", F.col("end") == F.col("pane"))
            .drop("next")
        )

    def over(self, key: str = "sensorid") -> WindowSpec:
        """Frame of the panes of the window that ends with pane ``end``."""
        return Window.partitionBy(key).orderBy("end").rangeBetween(-(self.panes - 1), 0)

    def aligned(self) -> Column:
        """True where ``end`` closes a window (always, if size is a multiple of slide)."""
        if self.step == 1:
            return F.lit(True)
        return F.pmod(F.col("end") - (self.panes - 1), F.lit(self.step)) == 0

    def start(self) -> Column:
        return F.timestamp_seconds((F.col("end") - (self.panes - 1)) * self.pane)

    def finish(self) -> Column:
        return F.timestamp_seconds((F.col("end") + 1) * self.pane)


def sliding_counts(
    readings: DataFrame, size: str = "2 hours", slide: str = "5 minutes", key: str = "sensorid"
) -> DataFrame:
    """Number of readings per sensor and window, for windows that hold any."""
    windows = Sliding(size, slide)
    panes = readings.groupBy(key, windows.pane_of().alias("pane")).agg(F.count(F.lit(1)).alias("n"))
    counted = F.sum(F.when(F.col("real"), F.col("n")).otherwise(F.lit(0))).over(windows.over(key))
    return (
        windows.frames(panes, key)
        .withColumn("n", counted)
        .where(windows.aligned())
        .select(key, windows.start().alias("window_start"), windows.finish().alias("window_end"), "n")
    )


def window_history_last(
    readings: DataFrame,
    size: str = "2 hours",
    slide: str = "5 minutes",
    key: str = "sensorid",
    value: str = "conValue",
    tie: str | None = None,
) -> DataFrame:
    """Ordered contents of every window with more than one reading.

    One row per window and reading with its ``position`` (1-based, by event
    time), the window's size ``n`` and ``is_last``; the others are the history.
    Positions follow from the order inside a pane and the sizes of the panes
    before it, so no window is collected or sorted as a whole.
    """
    windows = Sliding(size, slide)
    order = [F.col("timestamp"), *([F.col(tie)] if tie else []), F.col(value)]
    in_pane = Window.partitionBy(key, "pane")
    ranked = (
        readings.select(key, "timestamp", value, *([tie] if tie else []), windows.pane_of().alias("pane"))
        .withColumn("rank", F.row_number().over(in_pane.orderBy(*order)))
    )
    panes = readings.groupBy(key, windows.pane_of().alias("pane")).agg(F.count(F.lit(1)).alias("size"))
    # "seen": readings of the sensor before the pane.
    earlier = Window.partitionBy(key).orderBy("pane").rowsBetween(Window.unboundedPreceding, -1)
    panes = panes.withColumn("seen", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    real = F.col("real")
    over = windows.over(key)
    layout = (
        windows.frames(panes, key)
        .select(
            key,
            "end",
            F.sum(F.when(real, F.col("size")).otherwise(F.lit(0))).over(over).alias("n"),
            F.min(F.when(real, F.col("seen"))).over(over).alias("seen_first"),
            # At most one entry per pane of the window.
            F.collect_list(F.when(real, F.struct("pane", "seen"))).over(over).alias("contents"),
        )
        .where(windows.aligned() & (F.col("n") > 1))
        .select(key, "end", "n", "seen_first", F.inline("contents"))
    )
    position = F.col("seen") - F.col("seen_first") + F.col("rank")
    return ranked.join(layout, [key, "pane"]).select(
        key,
        windows.start().alias("window_start"),
        windows.finish().alias("window_end"),
        *([tie] if tie else []),
        "timestamp",
        F.col(value).alias("value"),
        position.cast("bigint").alias("position"),
        "n",
        (position == F.col("n")).alias("is_last"),
    )
