import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions.alerts import alert_message, severity
from rivulet.functions.curves import interpolate, parse_curve
from rivulet.functions.grid import EARTH_RADIUS_M, geolocation_cell, hex_cell

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "points"),
    [
        ("[(0,0),(10,100)]", [(0, 0), (10, 100)]),
        ("[(-1.5, -2),(0,\t3.25)]", [(-1.5, -2), (0, 3.25)]),
        ("(1,2) and (3,4), then (5,6)", [(1, 2), (3, 4), (5, 6)]),
        ("[(0,0)]", None),
        ("nothing", None),
        ("[(0,0),(0,1)]", None),
        ("[(2,0),(1,1)]", None),
        ("[(0,0),(1..5,1)]", None),
    ],
)
def test_parse_curve(spark, text, points):
    got = one(spark, parse_curve(F.col("t")), t=text)
    assert (got and [tuple(p) for p in got]) == points


@pytest.mark.parametrize(("x", "y"), [(0.0, 1.0), (10.0, 5.0), (5.0, 3.0), (12.0, 6.0), (14.0, 7.0)])
def test_interpolate_inside(spark, x, y):
    assert one(spark, interpolate(parse_curve(F.col("t")), F.col("x")), t="(0,1),(10,5),(14,7)", x=x) == y


@pytest.mark.parametrize("x", [-0.001, 14.001, math.nan, math.inf])
def test_interpolate_outside(spark, x):
    assert one(spark, interpolate(parse_curve(F.col("t")), F.col("x")), t="(0,1),(10,5),(14,7)", x=x) is None


@SLOW
@given(
    xs=st.lists(st.integers(-50, 50), min_size=2, max_size=8, unique=True).map(sorted),
    data=st.data(),
)
def test_interpolate_equals_numpy(spark, xs, data):
    ys = data.draw(st.lists(st.integers(-100, 100), min_size=len(xs), max_size=len(xs)))
    probes = data.draw(st.lists(st.floats(xs[0], xs[-1]), min_size=1, max_size=20))
    text = "[" + ",".join(f"({x},{y})" for x, y in zip(xs, ys, strict=True)) + "]"
    df = spark.createDataFrame([(text, p) for p in probes], "t string, x double").coalesce(1)
    got = [r[0] for r in df.select(interpolate(parse_curve(F.col("t")), F.col("x"))).collect()]
    assert np.allclose(got, np.interp(probes, xs, ys))


def test_cells_group_near_points(spark):
    """A cell holds points within one edge of its centre, and neighbours differ."""
    rng = np.random.default_rng(1)
    points = [(float(52.5 + a), float(13.4 + b)) for a, b in rng.uniform(-0.02, 0.02, (600, 2))]
    df = spark.createDataFrame(points, "lat double, lon double")
    rows = df.select("lat", "lon", hex_cell(F.col("lat"), F.col("lon")).alias("cell")).collect()
    scale = EARTH_RADIUS_M * math.pi / 180
    groups = {}
    for lat, lon, cell in rows:
        groups.setdefault(cell, []).append((lon * scale * math.cos(math.radians(52.5)), lat * scale))
    assert len(groups) > 100
    for members in groups.values():
        for a in members:
            for b in members:
                assert math.dist(a, b) <= 400.001


def test_coarser_resolution_has_fewer_cells(spark):
    df = spark.range(500).selectExpr("52.5 + id / 10000 as lat", "13.4 + (id * 7 % 500) / 10000 as lon")
    fine, coarse = (
        df.select(hex_cell(F.col("lat"), F.col("lon"), level)).distinct().count() for level in (9, 7)
    )
    assert fine > 4 * coarse


@pytest.mark.parametrize("text", ["nowhere", "52.5", "", "95,13", "52,181", "a,b", "NaN,13"])
def test_bad_geolocation(spark, text):
    assert one(spark, geolocation_cell(F.col("t")), t=text) is None


def test_geolocation_ignores_blanks_and_more_parts(spark):
    plain = one(spark, geolocation_cell(F.col("t")), t="52.5,13.4")
    assert plain is not None
    assert one(spark, geolocation_cell(F.col("t")), t=" 52.5, 13.4,80") == plain


@pytest.mark.parametrize(
    ("v", "lo", "hi", "expected"),
    [(0.0, 10.0, 20.0, 1.0), (25.0, 10.0, 20.0, 0.5), (15.0, 10.0, 20.0, -0.5), (5.0, 3.0, 3.0, None)],
)
def test_severity(spark, v, lo, hi, expected):
    assert one(spark, severity(F.col("v"), F.col("lo"), F.col("hi")), v=v, lo=lo, hi=hi) == expected


def test_message(spark):
    message = alert_message(F.col("v"), F.col("lo"), F.col("hi"))
    assert one(spark, message, v=25.0, lo=10.0, hi=20.0) == "Value 25.0 outside of confidence interval by 0.5"
