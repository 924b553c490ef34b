"""Calibration curves: text to points, and piecewise-linear conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.let import let

# Fixed value: one "(x,y)" pair of a curve text, one group for each number.
POINT_PATTERN = r"(-?\d+\.*\d*),\s*(-?\d+\.*\d*)"


def parse_curve(text: Column) -> Column:
    """Points of a curve text as ``array<struct<x, y>>`` in text order.

    NULL when the curve cannot be used: fewer than two points, a number that
    does not parse, or x values that are not strictly increasing.
    """
    pattern = F.lit(POINT_PATTERN)
    xs = F.regexp_extract_all(text, pattern, F.lit(1))
    ys = F.regexp_extract_all(text, pattern, F.lit(2))
    points = F.zip_with(
        xs,
        ys,
        lambda x, y: F.struct(x.try_cast("double").alias("x"), y.try_cast("double").alias("y")),
    )

    def usable(p: Column) -> Column:
        x_values = F.transform(p, lambda point: point["x"])
        return (
            (F.size(p) >= 2)
            & F.forall(p, lambda point: point["x"].isNotNull() & point["y"].isNotNull())
            & (F.array_sort(F.array_distinct(x_values)) == x_values)
        )

    return let(points, lambda p: F.when(usable(p), p))


def interpolate(points: Column, x: Column) -> Column:
    """Value of the piecewise-linear curve at ``x``; NULL outside its closed range."""

    def between(ends: Column) -> Column:
        left, right = ends["left"], ends["right"]
        slope = (right["y"] - left["y"]) / (right["x"] - left["x"])
        return F.when(left["x"] == x, left["y"]).when(
            left.isNotNull() & right.isNotNull(), left["y"] + (x - left["x"]) * slope
        )

    def ends(at_or_below: Column) -> Column:
        # get() is zero-based: the last point at or below x, and the one after it.
        return F.struct(
            F.get(points, at_or_below - 1).alias("left"), F.get(points, at_or_below).alias("right")
        )

    at_or_below = F.size(F.filter(points, lambda p: p["x"] <= x))
    inside = let(let(at_or_below, ends), between)
    return F.when(points.isNotNull() & x.isNotNull(), inside)
