"""Scalar and geometry functions, and the projection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strideway.functions import geometry as G
from strideway.functions import mapping as M
from strideway.functions import projection as P


def one(spark, column, **values):
    row = spark.range(1)
    for k, (v, t) in values.items():
        row = row.withColumn(k, F.lit(v).cast(t))
    return row.select(column.alias("out")).first()["out"]


def line(points, fields=("lon", "lat")):
    return F.array(*[G.point(F.lit(float(x)), F.lit(float(y)), fields) for x, y in points])


def each(spark, f, values, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r["out"] for r in df.select("k", f(F.col("v")).alias("out")).orderBy("k").collect()]


def test_edge_classes(spark):
    rows = [("footway", None, "no"), ("footway", "sidewalk", "marked"), ("footway", "sidewalk", None), ("steps", None, None), ("path", "crossing", None), ("cycleway", None, None), ("footway|steps", None, None), ("Residential", None, None), (None, None, None), ("footway", "nan", "nan")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, h string, f string, c string")
    got = [r.out for r in df.select("k", M.classify_edge(F.col("h"), F.col("f"), F.col("c")).alias("out")).orderBy("k").collect()]
    assert got == ["footway", "crossing", "sidewalk", "footway", "crossing", None, "footway", "street", None, "footway"]


def test_enums_casts_and_names(spark):
    assert each(spark, M.surface, ["Asphalt", "sett", "lava", None, "tarmac|dirt"]) == ["asphalt", "paving_stones", None, None, "asphalt"]
    assert each(spark, M.crossing_markings, ["uncontrolled", "ZEBRA", "x", None]) == ["zebra", "zebra", None, None]
    assert each(spark, M.repair_surface, ["unpaved", "odd", None]) == ["dirt", "odd", None]
    assert each(spark, M.repair_markings, ["marked", "no", "x"]) == ["surface", "no", "x"]
    assert each(spark, M.width_metres, ["3", "2.5 m", "8 ft", "nan", None]) == [3.0, 2.5, None, None, None]
    assert each(spark, M.slope, ["999", "999.0", None, "text", "8.3"]) == [None, None, None, None, 8.3]
    assert each(spark, M.borough_code, ["Staten Island", "the bronx", "Else", None]) == ["SI", "BX", "Else", None]
    assert each(spark, M.borough_name, ["1", "5.0", "9"]) == ["Manhattan", "Staten Island", "9"]
    assert each(spark, M.normalize_street, ["W 42nd St", "Ave. of X", "St. Marks Pl", "Ocean  Pkwy."]) == ["w 42nd street", "avenue of x", "street marks place", "ocean parkway"]
    assert each(spark, M.house_number, ["85-26", "12A", "12a ", "A", ""]) == [(8526, ""), (12, "A"), (12, "A"), (0, "A"), (0, "")]
    assert each(spark, M.parse_address, ["85-26 123rd Street, Queens", "12A St. Marks Pl, Manhattan", "no comma"]) == [("85-26", "123rd Street", "Queens"), ("12A", "St. Marks Pl", "Manhattan"), None]
    assert each(spark, M.title_street, ["the END of fdr", "at the park"]) == ["The End of FDR", "At the Park"]
    assert each(spark, M.present, ["nan", "NaT", "", "x", None]) == [None, None, None, "x", None]


def test_ids_are_stable(spark):
    import hashlib

    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()[:16]
    assert one(spark, M.node_id(F.lit(-73.9857), F.lit(40.7484))) == sha("node|-73.9857000|40.7484000")
    assert one(spark, M.edge_id(*map(F.lit, (-73.9857, 40.7484, -73.98, 40.75)), F.lit("footway_0_x"), F.lit("walk"))) == sha("edge|footway_0_x|walk|-73.9857000,40.7484000|-73.9800000,40.7500000")
    assert one(spark, M.feature_id(F.lit("POINT (1 2)"), F.lit("Point"), F.lit("s"))) == sha("Point|s|POINT (1 2)")
    a, b = line([(0, 0), (1, 1), (2, 0)]), line([(0, 0), (1, 2), (2, 0)])
    assert one(spark, M.middle_signature(a)) != one(spark, M.middle_signature(b))


def test_decimals_are_those_of_the_exact_double(spark):
    r = random.Random(1)
    values = [0.0, -0.0, 1e-8, -1e-8, 0.5e-7, 1.5e-7, -73.98765435, 40.00000005, 179.99999995, -180.0, 2.5, -0.00000005, 73.123456749999, *[r.uniform(-180, 180) for _ in range(300)], *[round(r.uniform(-90, 90), 8) for _ in range(600)], *[k / 2**23 for k in range(-40, 40)]]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for places in (5, 6, 7):
        assert [row[0] for row in df.select(M.fixed(F.col("x"), places)).collect()] == [f"{x:.{places}f}" for x in values]


def test_binary_encodings(spark):
    assert each(spark, M.binary_incline, [0.05, -2.0, None], "double") == [500, -10000, 0]
    assert each(spark, M.binary_width, [1.5, 999.0, None], "double") == [8, 255, 0]
    assert each(spark, lambda c: M.binary_node(c, F.lit("yes")), ["lowered", "raised", None]) == [5, 6, 4]
    assert each(spark, lambda c: M.binary_flags(F.lit(True), c), ["yes", "zebra", None]) == [3, 5, 1]


def test_lengths_and_areas(spark):
    ll = line([(-74.0, 40.7), (-73.99, 40.71), (-73.98, 40.71)])
    mid = sum(math.hypot(0.01 * 111319 * math.cos(math.radians(m)), d * 111319) for m, d in ((40.705, 0.01), (40.71, 0)))
    assert one(spark, G.length_mid_latitude(ll)) == pytest.approx(mid)
    assert one(spark, G.length_start_latitude(ll)) != one(spark, G.length_mid_latitude(ll))
    assert one(spark, G.length_haversine(ll)) == pytest.approx(mid, rel=2e-3)
    assert one(spark, G.length_planar(P.project_line(ll))) == pytest.approx(mid, rel=4e-3)
    assert one(spark, G.length_mid_latitude(line([(0, 0)]))) == 0.0
    square, hole = line([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], ("x", "y")), line([(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)], ("x", "y"))
    assert one(spark, G.polygon_area(F.array(square, hole))) == 96.0
    assert one(spark, G.exterior_perimeter(F.array(square))) == 40.0
    assert one(spark, G.strip_width(F.lit(20.0), F.lit(24.0))) == 1.67
    assert tuple(one(spark, G.polygon_centroid(square))) == (5.0, 5.0)
    assert tuple(one(spark, G.line_centroid(line([(0, 0), (10, 0), (10, 2)], ("x", "y"))))) == pytest.approx((70 / 12, 2 / 12))


def test_containment_on_every_kind_of_place(spark):
    rings = F.array(line([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]), line([(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]))
    for (x, y), inside in {(1, 1): True, (11, 5): False, (0, 0): False, (5, 0): False, (5, 5): False, (4, 5): False, (10, 10): False}.items():
        assert one(spark, G.contains_point(rings, F.lit(float(x)), F.lit(float(y)))) is inside
    assert one(spark, G.contains_point(rings, F.lit(5.0), F.lit(0.0), boundary=True)) is True


def test_segments_boxes_and_inclines(spark):
    p = lambda x, y: G.point(F.lit(float(x)), F.lit(float(y)), ("x", "y"))
    assert one(spark, G.segment_distance(p(0, 0), p(10, 0), p(5, -1), p(5, 1))) == 0.0
    assert one(spark, G.segment_distance(p(0, 0), p(10, 0), p(12, 2), p(12, 5))) == pytest.approx(math.hypot(2, 2))
    assert one(spark, G.intersects_box(line([(-5, 5), (15, 5)]), 0, 0, 10, 10)) is True
    assert one(spark, G.intersects_box(line([(-5, 5), (5, 16)]), 0, 0, 10, 10)) is False
    for rise, run, want in ((1.0, 1.0, 1.0), (1.0001, 1.0, None), (1.0, 0.0, None), (None, 2.0, None), (0.5, 10.0, 0.05)):
        assert one(spark, G.incline(F.lit(rise).cast("double"), F.lit(run).cast("double"))) == want
    assert one(spark, G.outside_globe(line([(0, 0), (181, 0)]))) is True
    assert [tuple(x) for x in one(spark, G.set_endpoints(line([(0, 0), (1, 1), (2, 2)]), G.point(F.lit(9.0), F.lit(9.0)), F.lit(None)))] == [(9, 9), (1, 1), (2, 2)]
    assert G.pixel_grid(-74.1, 40.6, -73.9, 40.8, 1.0)[:2] == (3000, 3000)


def test_projection_there_and_back(spark):
    x, y = P.utm_x(F.lit(-73.9857), F.lit(40.7484)), P.utm_y(F.lit(-73.9857), F.lit(40.7484))
    assert (one(spark, x), one(spark, y)) == pytest.approx((585628.41, 4511322.45), abs=0.02)
    r = random.Random(1)
    rows = [(r.uniform(-74.3, -73.6), r.uniform(40.4, 41.0)) for _ in range(200)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumns({"x": P.utm_x(F.col("lon"), F.col("lat")), "y": P.utm_y(F.col("lon"), F.col("lat"))})
    lon, lat = P.inverse(F.col("x"), F.col("y"))
    assert df.select(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat")))).alias("e")).first()["e"] < 1e-8
