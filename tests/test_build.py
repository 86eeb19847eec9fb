"""A build of a tiny town from raw sources to a validated, repaired network."""

import pytest
from pyspark.sql import functions as F

from strideway.plans import build

M = 1e-5 * 0.9  # about a metre northwards
LON, LAT = -73.98, 40.75


def at(*points):
    return [{"lon": LON + x * M / 0.757, "lat": LAT + y * M} for x, y in points]


def ring(w, s, e, n):
    return [at((w, s), (e, s), (e, n), (w, n), (w, s))]


@pytest.fixture(scope="module")
def town(spark):
    line = "array<struct<lon:double,lat:double>>"
    ways = spark.createDataFrame(
        [
            ("1", "footway", "sidewalk", None, "Concrete", None, at((0, 0), (50, 0))),
            ("2", "footway", None, "marked", None, "3 m", at((50, 1), (60, 1))),
            ("3", "residential", None, None, "asphalt", None, at((60, 0), (60, 200))),
            ("4", "cycleway", None, None, None, None, at((0, 0), (9, 9))),
            ("5", "steps", None, None, None, None, at((0, 0), (0, -20))),
        ],
        f"osmid string, Highway string, footway string, crossing string, surface string, width string, line {line}",
    )
    ramps = spark.createDataFrame([("r1", LON + 51 * M / 0.757, LAT, "1", "Good", "999.0", "4.5"), ("r2", LON + 500 * M, LAT + 500 * M, "9", "", "8.1", None)], "rampid string, lon double, lat double, borough string, dws_conditions string, ramp_running_slope_total string, ramp_cross_slope string")
    polygons = spark.createDataFrame([(1, ring(-1, -1, 51, 1)), (2, ring(0, 300, 60, 303)), (3, ring(200, 300, 203, 303))], f"polygon_id int, rings array<{line}>")
    boroughs = spark.createDataFrame([("Manhattan", ring(-1000, -1000, 1000, 1000))], f"name string, rings array<{line}>")
    s = build.Settings()
    return s, build.clean_lines(ways, s), build.clean_points(ramps, s), build.clean_polygons(polygons, s), boroughs


def test_sources_become_a_network(spark, town):
    s, ways, ramps, polygons, boroughs = town
    edges, curbs = build.schema_map(ways, ramps, polygons, boroughs, s)
    rows = edges.collect()
    assert sorted((r.kind, r.ext_source) for r in rows) == [("crossing", "osm_walk"), ("footway", "osm_walk"), ("sidewalk", "nyc_planimetric_sidewalks"), ("sidewalk", "osm_walk"), ("street", "osm_walk")]
    by = {(r.kind, r.ext_source): r for r in rows}
    assert by["sidewalk", "osm_walk"].width == pytest.approx(1.93, abs=0.05) and by["sidewalk", "osm_walk"].surface == "concrete"
    assert by["crossing", "osm_walk"].crossing_markings == "yes" and by["crossing", "osm_walk"].width == 3.0 and by["footway", "osm_walk"].highway == "steps"
    assert by["sidewalk", "nyc_planimetric_sidewalks"].width == pytest.approx(2.86, abs=0.1) and {r.ext_borough for r in rows} == {"MN"}
    c = {r.ext_ramp_id: r for r in curbs.collect()}
    assert c["r1"].tactile_paving == "yes" and c["r1"].ext_running_slope_pct is None and c["r1"].ext_cross_slope_pct == 4.5 and c["r2"].tactile_paving is None
    nodes, out = build.assemble_network(edges, curbs, s)
    joined = {r.kind: r for r in out.where("ext_source = 'osm_walk'").collect()}
    assert joined["sidewalk"].v == joined["crossing"].u and joined["sidewalk"].u == joined["footway"].u
    kerbs = nodes.where("kerb = 'lowered'")
    assert kerbs.count() == 2 and build.validate(nodes, out).count() == 0
    assert build.topology_report(out, s).first().n_components == 2
    fixed_nodes, fixed = build.repair(nodes, out.withColumn("ext_source", F.lit(None).cast("string")), 2.0)
    assert build.validate(fixed_nodes, fixed).count() == 0 and fixed.where("surface = 'concrete'").count() == 1 and fixed.where("ext_source is null").count() == 0
