"""The audit's findings on a network small enough to tell them by hand."""

import pytest

from strideway import __main__ as cli
from strideway.operators import findings as X

NODES = "id string, lon double, lat double, barrier string, kerb string, geometry_type string, line array<struct<lon:double,lat:double>>, ext_running_slope_pct double, ext_elevation_m double"
EDGES = "id string, u string, v string, highway string, footway string, surface string, incline double, ext_borough string, geometry_type string, line array<struct<lon:double,lat:double>>"


def at(*p):
    return [{"lon": x, "lat": y} for x, y in p]


@pytest.fixture(scope="module")
def network(spark):
    here = (-74.0, 40.7)
    nodes = [(i, *p, None, None, "Point", at(p), s, e) for i, p, s, e in [("a", here, 999.0, 3.0), ("b", (-74.0, 40.71), 4.0, 999.0), ("c", (-74.0, 40.700001), None, None), ("o", (-80.0, 40.7), None, None)]]
    rows = [
        ("long", "a", "b", "residential", None, "mud", 0.31, "MN", at(here, (-74.0, 40.71))),
        ("back", "b", "a", "footway", "crossing", "asphalt", -9.99, "MN", at((-74.0, 40.7001), (-74.0, 40.7002))),
        ("short", "a", "c", "footway", "sidewalk", "", 0.30, "MN", at(here, (-74.0, 40.700001))),
        ("zero", "c", "c", "footway", "sidewalk", None, None, None, at(here, here)),
        ("lost", "a", "x", "trunk", None, "mud", 999.0, "BX", at(here, (-80.0, 41.0), (-81.0, 41.0))),
        ("none", None, "a", None, None, None, None, "BX", at(here)),
    ]
    return spark.createDataFrame(nodes, NODES), spark.createDataFrame([(*r[:8], "LineString", r[8]) for r in rows], EDGES)


def ids(found, name):
    return sorted(r.id for r in found[name].rows.collect())


def test_findings_by_hand(spark, network):
    failures = spark.createDataFrame([("u", "1", "m"), ("u", "2", "m"), ("v", "1", "m")], "check string, feature_id string, message string")
    found = X.findings(*network, failures=failures)
    assert len(found) == 13
    assert ids(found, "edges_short_lt_0.5m") == ["short"] and ids(found, "edges_long_gt_500m") == ["long", "lost"] and ids(found, "edges_zero_length") == ["zero"]
    assert sorted((r.id, r.type, r.lon) for r in found["out_of_bbox_features"].rows.collect()) == [("lost", "LineString", -80.0), ("o", "Point", -80.0)]
    assert ids(found, "self_loop_edges") == ["zero"] and ids(found, "duplicate_edges") == ["back", "long"]
    assert [tuple(r) for r in found["edges_unresolved_uv"].rows.collect()] == [("lost", "a", "x", 0, 1)]
    assert ids(found, "incline_out_of_range") == ["long"]
    assert sorted((r.id, r.field) for r in found["sentinel_999_leaks"].rows.collect()) == [("a", "ext_running_slope_pct"), ("b", "ext_elevation_m"), ("back", "incline"), ("lost", "incline")]
    assert ids(found, "orphan_nodes") == ["o"]
    assert sorted(map(tuple, found["schema_top_failures"].rows.collect())) == [("u::m", 2), ("v::m", 1)]
    assert [tuple(r) for r in found["surface_noncanonical"].rows.collect()] == [("mud", 2)]
    boroughs = {r.borough: r for r in found["borough_summary"].rows.collect()}
    mn = boroughs["MN"]
    assert sorted(boroughs) == ["BK", "BX", "MN", "QN", "SI"]
    assert (mn.edges, mn.sidewalks, mn.crossings, mn.streets, mn.sidewalk_street_ratio, mn.n_components, mn.giant_pct) == (3, 1, 1, 1, 1.0, 1, 1.0)
    assert (boroughs["BX"].edges, boroughs["QN"].edges, boroughs["QN"].n_components, boroughs["QN"].sidewalk_street_ratio) == (1, 0, 0, None)
    n = {r.finding: r.n for r in X.counts(found).collect()}
    assert n["edges_long_gt_500m"] == 2 and n["borough_summary"] == 5


def test_findings_of_nothing(network):
    nodes, edges = (df.limit(0) for df in network)
    n = {r.finding: r.n for r in X.counts(X.findings(nodes, edges)).collect()}
    assert n.pop("borough_summary") == 5 and set(n.values()) == {0}


def test_audit_command(spark, network, tmp_path):
    for name, df in zip(("nodes", "edges"), network, strict=True):
        df.write.parquet(str(tmp_path / "in" / name))
    assert cli.main(["audit", str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    top = [r.bucket for r in spark.read.csv(str(tmp_path / "out/schema_top_failures"), header=True).collect()]
    assert any("v_id_resolves" in b for b in top)
    assert {r.finding: int(r.n) for r in spark.read.csv(str(tmp_path / "out/counts"), header=True).collect()}["orphan_nodes"] == 1
