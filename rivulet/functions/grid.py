"""Hexagonal cells computed with column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.let import let

EARTH_RADIUS_M = 6371008.8
# Edge length in metres of a cell at resolution 9; each level up is sqrt(7) times longer.
EDGE_AT_RESOLUTION_9_M = 200.0


def hex_cell(lat: Column, lon: Column, resolution: int = 9, lat0: float = 52.5) -> Column:
    """Id of the pointy-top hexagon that holds a point, as BIGINT.

    Points are projected with an equirectangular projection that is true to
    scale at latitude ``lat0``. NULL when the point is not a valid position.
    """
    edge = EDGE_AT_RESOLUTION_9_M * math.sqrt(7.0) ** (9 - resolution)
    x = F.lit(EARTH_RADIUS_M) * F.radians(lon) * F.lit(math.cos(math.radians(lat0)))
    y = F.lit(EARTH_RADIUS_M) * F.radians(lat)
    # Axial hexagon coordinates; a third one makes the sum zero.
    axial = F.struct(
        ((F.lit(math.sqrt(3.0) / 3.0) * x - y / 3.0) / F.lit(edge)).alias("q"),
        ((F.lit(2.0 / 3.0) * y) / F.lit(edge)).alias("r"),
    )
    cell = let(let(axial, _rounded), _nearest)
    valid = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(valid, cell)


def _rounded(axial: Column) -> Column:
    """Each coordinate rounded, with its rounding error."""
    coordinates = {"q": axial["q"], "r": axial["r"], "s": -axial["q"] - axial["r"]}
    return F.struct(
        *(F.floor(v + 0.5).alias(name) for name, v in coordinates.items()),
        *(F.abs(F.floor(v + 0.5) - v).alias(f"d{name}") for name, v in coordinates.items()),
    )


def _nearest(c: Column) -> Column:
    """Cell id; the coordinate with the largest error follows from the other two."""
    fix_q = (c["dq"] > c["dr"]) & (c["dq"] > c["ds"])
    fix_r = ~fix_q & (c["dr"] > c["ds"])
    q = F.when(fix_q, -c["r"] - c["s"]).otherwise(c["q"])
    r = F.when(fix_r, -c["q"] - c["s"]).otherwise(c["r"])
    offset = F.lit(1 << 30)
    return ((q + offset) * F.lit(1 << 31) + (r + offset)).cast("bigint")


def geolocation_cell(text: Column, resolution: int = 9, lat0: float = 52.5) -> Column:
    """Cell of a ``"lat,lon"`` text, NULL when it does not parse."""
    def position(parts: Column) -> Column:
        return F.struct(
            F.get(parts, F.lit(0)).try_cast("double").alias("lat"),
            F.get(parts, F.lit(1)).try_cast("double").alias("lon"),
        )

    parsed = let(F.split(text, ","), position)
    return let(parsed, lambda p: hex_cell(p["lat"], p["lon"], resolution, lat0))
