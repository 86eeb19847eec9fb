"""Spatial joins, graph, assembly, audit and shapes on small hand-made or random tables against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideway.functions import profiles
from strideway.operators import assemble, audit, graph, shapes, spatial
from strideway.operators.components import connected_components


def xy(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y)) for i, x, y in rows], "id long, x double, y double")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def random_points(n, seed, side=60):
    r = random.Random(seed)
    return [(k, r.uniform(0, side), r.uniform(0, side)) for k in range(n)]


def test_epsilon_pairs_match_brute_force(spark):
    p = random_points(300, 1)
    want = sorted((a, b) for a, ax, ay in p for b, bx, by in p if a < b and math.hypot(ax - bx, ay - by) <= 2.0)
    assert rows_of(spatial.epsilon_pairs(xy(spark, p), 2.0)) == want


def test_nearest_within_its_radius(spark):
    left, right = xy(spark, [(1, 0, 0), (2, 100, 0), (3, 200, 0)]), xy(spark, [(10, 5, 0), (11, -5, 0), (12, 105.01, 0), (13, 203, 4)])
    assert rows_of(spatial.nearest_within(left, right, 5.0).select("left_id", F.coalesce("right_id", F.lit(-1)))) == [(1, 10), (2, -1), (3, 13)]
    p, q = random_points(150, 2), random_points(150, 3)
    got = {r.left_id: r.right_id for r in spatial.nearest_within(xy(spark, p), xy(spark, q), 4.0).collect()}
    for i, x, y in p:
        d, k = min((math.hypot(x - a, y - b), j) for j, a, b in q)
        assert got[i] == (k if d <= 4.0 else None)


def test_merging_is_transitive(spark):
    assert rows_of(spatial.merge_points(xy(spark, [(3, 0, 0), (2, 1.9, 0), (1, 3.8, 0), (9, 50, 0)]), 2.0)) == [(1, 1), (2, 1), (3, 1), (9, 9)]


def square(x, y, side, hole=None):
    ring = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return [ring] + ([[(x + a, y + b) for a, b in ((hole, hole), (side - hole, hole), (side - hole, side - hole), (hole, side - hole), (hole, hole))]] if hole else [])


def test_first_polygon_and_cells_agree(spark):
    polys = spark.createDataFrame(
        [(i, [[{"x": float(a), "y": float(b)} for a, b in r] for r in rings]) for i, rings in ((2, square(0, 0, 10)), (1, square(5, 5, 10, 4)), (3, square(30, 30, 5)))], "polygon_id int, rings array<array<struct<x:double,y:double>>>"
    )
    p = xy(spark, [(1, 6, 6), (2, 10, 10), (3, 1, 1), (4, 0, 5), (5, 99, 99), (6, 31, 31)])
    want = [(1, 1), (3, 2), (6, 3)]
    for cell in (None, 3.0):
        got = spatial.first_polygon(p, polys, cell, ("x", "y"))
        assert rows_of(got.where("polygon_id is not null")) == want and got.count() == 6


def test_coverage_at_its_distance(spark):
    rings = [[{"x": float(a), "y": float(b)} for a, b in r] for r in square(0, 0, 4)]
    far = [[{"x": float(a), "y": float(b)} for a, b in r] for r in square(1000, 0, 4)]
    around = [[{"x": float(a), "y": float(b)} for a, b in r] for r in square(2000, 0, 400)]
    polys = spark.createDataFrame([(1, rings), (2, far), (3, around)], "polygon_id int, rings array<array<struct<x:double,y:double>>>")
    lines = lambda *ls: spark.createDataFrame([(k, [{"x": float(a), "y": float(b)} for a, b in x]) for k, x in enumerate(ls)], "line_id int, line array<struct<x:double,y:double>>")
    left = lambda *ls: [r.polygon_id for r in spatial.uncovered_polygons(polys, lines(*ls), 10.0).orderBy("polygon_id").collect()]
    assert left([(13.9, -50), (13.9, 50)], [(1014.1, -50), (1014.1, 50)]) == [2, 3]
    assert left([(2200, 200), (2201, 200)]) == [1, 2] and left() == [1, 2, 3]


def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(1000, 1300)] + [(7000, 7000)] + [(5000, k) for k in range(5001, 5200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges + [(None, 1)], "src long, dst long")
    assert rows_of(connected_components(df)) == sorted((x, root(x)) for x in parent)
    assert connected_components(df.where("false")).collect() == []


def edges_table(spark, rows, **more):
    df = spark.createDataFrame(rows, "id string, u string, v string")
    for k, v in more.items():
        df = df.withColumn(k, v)
    return df


def test_graph_measures(spark):
    e = edges_table(spark, [("1", "a", "b"), ("2", "b", "a"), ("3", "a", "c"), ("4", "a", "d"), ("5", "e", "e")])
    assert rows_of(graph.degrees(e)) == [("a", 3), ("b", 1), ("c", 1), ("d", 1), ("e", 2)]
    nodes = spark.createDataFrame([(x,) for x in "abcdefz"], "id string")
    c = graph.components_with_isolated(nodes, e)
    assert rows_of(c) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("e", "e"), ("f", "f"), ("z", "z")]
    s = graph.component_summary(c, 3).first()
    assert (s.n_nodes, s.n_components, s.giant_size, s.n_large) == (7, 4, 4, 1)
    assert rows_of(graph.giant(c)) == [("a",), ("b",), ("c",), ("d",)]
    assert rows_of(graph.dense_index(nodes)) == [(x, k) for k, x in enumerate("abcdefz")]
    assert rows_of(graph.collapse_parallel(e, F.col("id")).select("u", "v", "id")) == [("a", "b", "2"), ("a", "c", "3"), ("a", "d", "4"), ("e", "e", "5")]


def test_paths_respect_profiles(spark):
    rows = [("1", "a", "b", 1.0, "crossing", 0, 0.0), ("2", "b", "c", 1.0, "sidewalk", 0, 0.0), ("3", "a", "d", 5.0, "sidewalk", 0, 0.0831), ("4", "d", "c", 5.0, "sidewalk", 0, 0.08), ("5", "a", "e", 2.0, "crossing", 1, 0.0), ("6", "e", "c", 20.0, None, 0, None), ("7", "x", "y", 1.0, None, 0, 0.0)]
    e = spark.createDataFrame(rows, "id string, u string, v string, length double, footway string, curbramps int, incline double")
    plain = graph.shortest_paths(e, profiles.distance(), "a")
    assert {r.node: r.distance for r in plain.collect()} == {"a": 0, "b": 1, "c": 2, "d": 5, "e": 2}
    assert graph.route(plain, "c") == ["a", "b", "c"] and graph.route(plain, "y") == []
    wheel = graph.shortest_paths(e, profiles.wheelchair(), "a", target="c")
    assert {r.node: r.distance for r in wheel.collect()}["c"] == 22 and graph.route(wheel, "c") == ["a", "e", "c"]
    assert tuple(graph.route_summary(wheel, "c").first()) == (2, 22.0)


def lines(spark, rows):
    return spark.createDataFrame([(i, u, v, [{"lon": float(a), "lat": float(b)} for a, b in p], "osm") for i, u, v, p in rows], "id string, u string, v string, line array<struct<lon:double,lat:double>>, ext_source string")


STEP = 1e-5  # about a metre


def test_assembly_snaps_merges_and_injects(spark):
    e = lines(spark, [("1", "A", "B", [(-74, 40.7), (-74, 40.7 + 50 * STEP)]), ("2", "C", "D", [(-74, 40.7 + 51 * STEP), (-74, 40.7 + 90 * STEP)]), ("3", "B", "C", [(-74, 40.7 + 50 * STEP), (-74, 40.7 + 51 * STEP)]), ("4", "A", "A", [(-74, 40.7), (-73.99, 40.7), (-74, 40.7)])])
    merged, remap = assemble.merge_endpoints(e, 2.0)
    assert rows_of(merged.select("id", "u", "v")) == [("1", "A", "B"), ("2", "B", "D"), ("4", "A", "A")]
    assert {r.id: r.canonical for r in remap.collect()} == {"A": "A", "B": "B", "C": "B", "D": "D"}
    curbs = spark.createDataFrame([("k1", -74.0, 40.7 + 2 * STEP, "lowered"), ("k2", -74.0, 40.7 + 20 * STEP, "lowered")], "id string, lon double, lat double, kerb string")
    snapped = assemble.snap_curbs(curbs, assemble.endpoints(e))
    assert rows_of(snapped.select("id", "lat", "snapped")) == [("A", 40.7, True), ("k2", 40.7 + 20 * STEP, False)]
    lost = assemble.missing_nodes(merged, spark.createDataFrame([("A",)], "id string"))
    assert rows_of(lost.select("id", "lat")) == [("B", 40.7 + 50 * STEP), ("D", 40.7 + 90 * STEP)]
    nodes = assemble.endpoints(merged)
    out = assemble.snap_lines(merged, nodes)
    assert {r.id: r.line[0].lat for r in out.collect()}["2"] == pytest.approx(40.7 + 50 * STEP)
    assert assemble.snap_report(out).first().edges_moved == 1 and assemble.snap_lines(out.select(merged.columns), nodes).where("moved").count() == 0


def test_node_merge_takes_first_row_and_first_known_curb_fields(spark):
    n = spark.createDataFrame([("a", 0, 1, "osm", None, None), ("a", 1, 5, "curb", "lowered", None), ("a", 1, 6, "curb", "raised", 4.5), ("b", 1, 7, "curb", None, 1.0)], "id string, rank int, ord int, ext_source string, kerb string, ext_running_slope_pct double")
    assert rows_of(assemble.merge_nodes(n, ["rank", "ord"]).select("id", "ext_source", "kerb", "ext_running_slope_pct").fillna("-", ["kerb"])) == [("a", "osm", "lowered", 4.5), ("b", "curb", "-", 1.0)]


def test_raster_takes_the_first_tile_with_a_value(spark):
    tiles = spark.createDataFrame([(0, 0.0, 1.0, 0.5, 0.5, 2, 2), (1, 0.0, 1.0, 0.5, 0.5, 2, 2)], "tile_rank int, west double, north double, pixel_width double, pixel_height double, cols long, rows long")
    cells = spark.createDataFrame([(0, 0, 0, None), (0, 1, 0, 5.04), (1, 0, 0, 7.0), (1, 1, 0, 9.0), (1, 1, 1, float("nan"))], "tile_rank int, col long, row long, elev double")
    p = spark.createDataFrame([("a", 0.1, 0.9), ("b", 0.6, 0.9), ("c", 0.6, 0.1), ("d", 5.0, 5.0)], "id string, lon double, lat double")
    assert {r.id: r.elevation for r in assemble.sample_raster(p, tiles, cells).collect()} == {"a": 7.0, "b": 5.0, "c": None, "d": None}


def test_percentiles_match_numpy(spark):
    for values in ([1.0], [1.0, 2.0], [4.0, 1.0, 3.0, 2.0], [5.0] * 7):
        r = audit.describe(spark.createDataFrame([(v,) for v in values], "v double"), F.col("v"), "x").first()
        assert [r.p1, r.p50, r.p95, r.p99] == pytest.approx(np.percentile(values, [1, 50, 95, 99]).tolist()) and r.n == len(values)


def test_schema_predicates(spark):
    df = spark.createDataFrame([("1", "concrete", 2.0, "x"), ("2", "lava", -1.0, None), ("3", None, None, None)], "id string, surface string, width double, other string")
    schema = {"required": ["surface", "gone"], "properties": {"id": {"type": "string"}, "surface": {"enum": ["concrete"]}, "width": {"type": "number", "minimum": 0}}, "additionalProperties": False}
    got = sorted((r.feature_id, r.message) for r in audit.schema_failures(df, schema).collect())
    assert got == [("1", "gone is required"), ("1", "other is not allowed"), ("2", "gone is required"), ("2", "surface is none of its values"), ("2", "width is beyond its minimum"), ("3", "gone is required"), ("3", "surface is required")]
    assert audit.root_failures({"type": "FeatureCollection", "features": []}) == [f"{k} is missing" for k in ("$schema", "dataSource", "dataTimestamp", "pipelineVersion", "region")]


def test_centre_lines(spark):
    line = shapes.centre_line(np.array([[0, 0], [10, 0], [10, 2], [0, 2], [0, 0]], float))
    assert sorted(map(tuple, line.round(6).tolist())) == [(0, 1), (10, 1)]
    a = np.pi / 6
    turned = np.array([[0, 0], [10, 0], [10, 2], [0, 2]]) @ np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]])
    assert np.hypot(*np.diff(shapes.centre_line(turned), axis=0)[0]) == pytest.approx(10)
    assert shapes.centre_line(np.array([[0, 0], [0.3, 0], [0.3, 0.1], [0, 0.1]])) is None and shapes.centre_line(np.zeros((4, 2))) is None
    ring = spark.createDataFrame([([{"lon": 0.0, "lat": 0.0}, {"lon": 0.0, "lat": 0.0}, {"lon": 1.0, "lat": float("nan")}, {"lon": 1.0, "lat": 0.0}, {"lon": 1.0, "lat": 1.0}],)], "r array<struct<lon:double,lat:double>>")
    assert len(ring.select(shapes.repair_ring("r").alias("r")).first().r) == 4


def test_detached_ends_and_stable_samples(spark):
    e = lines(spark, [("1", "A", "B", [(0, 0), (1, 1)]), ("2", "B", "Z", [(1, 2), (3, 3)])])
    n = spark.createDataFrame([("A", 0.0, 0.0), ("B", 1.0, 1.0)], "id string, lon double, lat double")
    assert rows_of(audit.detached_ends(e, n)) == [("2", True, False)]
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert rows_of(audit.stable_sample(df, "k", 20)) == rows_of(audit.stable_sample(df.repartition(7), "k", 20))


def test_routes_are_found_by_doubling_and_unsettled_paths_are_an_error(spark):
    n = 40
    e = spark.createDataFrame([(f"n{k:02d}", f"n{k + 1:02d}", 1.0) for k in range(n)] + [("n00", "n30", 100.0), ("x", "y", 1.0)], "u string, v string, length double")
    paths = graph.shortest_paths(e, F.col("length"), "n00")
    assert {r.node: r.distance for r in paths.collect()} == {f"n{k:02d}": float(k) for k in range(n + 1)}
    assert graph.route(paths, "n40") == [f"n{k:02d}" for k in range(n + 1)] and graph.route(paths, "n00") == ["n00"] and graph.route(paths, "y") == []
    with pytest.raises(RuntimeError):
        graph.shortest_paths(e, F.col("length"), "n00", max_hops=5)


def test_snap_counts_each_end_and_every_closed_line(spark):
    nodes = spark.createDataFrame([("a", 0.0, 0.0), ("b", 1.0, 1.0)], "id string, lon double, lat double")
    p = lambda *xy: [{"lon": float(x), "lat": float(y)} for x, y in xy]
    rows = [("e1", "a", "b", p((0, 0), (1, 0), (1, 1.1))), ("e2", "a", "a", p((0.1, 0), (2, 2), (0, 0))), ("e3", None, "z", p((5, 5), (6, 6))), ("e4", "a", "b", p((9, 9)))]
    out = assemble.snap_lines(spark.createDataFrame(rows, "id string, u string, v string, line array<struct<lon: double, lat: double>>"), nodes)
    got = {r.id: (r.moved_u, r.moved_v, r.unresolved_u, r.unresolved_v, r.degenerate) for r in out.collect()}
    assert got == {"e1": (False, True, False, False, False), "e2": (True, False, False, False, True), "e3": (False, False, True, True, False), "e4": (False, False, False, False, False)}
    report = assemble.snap_report(out).first()
    assert (report.endpoints_snapped_u, report.endpoints_snapped_v, report.edges_with_unresolved_node_ref, report.degenerate_after_snap) == (1, 1, 1, 1)


def test_polygons_of_very_different_sizes_go_through_cells(spark):
    square = lambda x, y, w: [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))]]
    polygons = spark.createDataFrame([(1, square(0, 0, 100_000)), (2, square(10, 10, 5)), (3, square(500, 500, 2000))], "polygon_id int, rings array<array<struct<x: double, y: double>>>")
    points = spark.createDataFrame([(1, 12.0, 12.0), (2, 600.0, 600.0), (3, 99_000.0, 1.0), (4, -1.0, 5.0)], "id int, x double, y double")
    got = sorted(tuple(r) for r in spatial.points_in_polygons(points, polygons, cell=1.0, fields=("x", "y")).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 3), (3, 1)]
    assert spatial.points_in_polygons(points, polygons.where("false"), cell=1.0, fields=("x", "y")).collect() == []


def test_many_query_points_take_more_passes(spark, monkeypatch):
    monkeypatch.setattr(spatial, "QUERIES", 3)
    at = spark.createDataFrame([(k, k / 10, 0.0) for k in range(9)], "id int, lon double, lat double")
    got = {r.query_id: r.node_id for r in spatial.nearest_by_haversine(at, at).collect()}
    assert got == {k: k for k in range(9)}


def test_small_table_helpers(spark):
    df = spark.createDataFrame([(1, "Point", "x", 3, 0.1, None), (2, "Polygon", "y", 4, None, 0.2)], "id int, geometry_type string, junk string, ext_a int, lon double, lat double")
    assert [r.id for r in assemble.keep_geometry_types(df, "Polygon", "MultiPolygon").collect()] == [2]
    assert assemble.keep_columns(df, ("id",)).columns == ["id", "ext_a"] and assemble.accessible_stations(df).count() == 0
    square = lambda w: [[{"x": float(a), "y": float(b)} for a, b in ((0, 0), (w, 0), (w, w), (0, w), (0, 0))]]
    kind = "array<array<struct<x: double, y: double>>>"
    polygons = spark.createDataFrame([(1, square(1)), (2, square(3)), (3, square(3))], f"polygon_id int, rings {kind}")
    assert [(r.polygon_id, r.area) for r in assemble.largest_first(polygons).collect()] == [(2, 9.0), (3, 9.0), (1, 1.0)]
    parts = spark.createDataFrame([([square(1), square(2)],), ([],)], f"parts array<{kind}>").select(assemble.largest_part(F.col("parts")).alias("p"))
    assert [r.p and r.p[0][1].x for r in parts.collect()] == [2.0, None]


def test_dense_points_are_only_searched_nearby(spark, monkeypatch):
    radii, pairs_within = [], spatial.pairs_within
    monkeypatch.setattr(spatial, "pairs_within", lambda left, right, radius, *a: radii.append(radius) or pairs_within(left, right, radius, *a))
    right = xy(spark, [(k, k % 20, k // 20) for k in range(400)])
    got = rows_of(spatial.nearest_within(xy(spark, [(1, 5, 5), (2, 9.5, 9.5), (3, 9, 10.25)]), right, 16.0))
    assert got == [(1, 105, 0.0), (2, 189, pytest.approx(0.5**0.5)), (3, 209, 0.25)] and max(radii) < 16


def test_sparse_points_are_searched_to_the_radius(spark):
    right = xy(spark, [(10, 0.5, 0), (11, 3, 0), (12, 119, 0), (13, 217, 0), (14, 183, 0)])
    got = rows_of(spatial.nearest_within(xy(spark, [(1, 0, 0), (2, 4, 0), (3, 103, 0), (4, 200, 0)]), right, 16.0).fillna(-1))
    assert got == [(1, 10, 0.5), (2, 11, 1.0), (3, 12, 16.0), (4, -1, -1.0)]


def test_polygons_that_are_surely_covered_meet_no_more_lines(spark, monkeypatch):
    rings = [[{"x": float(a), "y": float(b)} for a, b in r] for r in square(0, 0, 4)]
    polys = spark.createDataFrame([(1, rings)], "polygon_id int, rings array<array<struct<x:double,y:double>>>")
    lines = spark.createDataFrame([(k, [{"x": 6.0 + k, "y": -50.0}, {"x": 6.0 + k, "y": 1.0}]) for k in range(5)], "line_id int, line array<struct<x:double,y:double>>")
    monkeypatch.setattr(spatial, "points_in_polygons", lambda *a, **k: pytest.fail("met all lines"))
    assert spatial.uncovered_polygons(polys, lines, 10.0).count() == 0


def test_links_shrink_as_components_are_found(spark, monkeypatch):
    from strideway.operators import components

    sizes, cut = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df, name: (out := cut(df, name), sizes.append(out.count()) if name == "cc-links" else None)[0])
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(9, 9), (60, 60)], "src long, dst long")
    assert rows_of(connected_components(edges)) == [(k, 0) for k in range(51)] + [(60, 60)]
    assert sizes == [52, 0]
