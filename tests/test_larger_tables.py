"""Queries on hand-picked keys that the smallest tables don't have, against their SQL."""

import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strideway import queries as Q
from strideway.operators import assemble, spatial

SF = "/root/testdata/sf0.001"


def both(spark, folder, name, tables):
    """The rows of a query and of its SQL over tables that replace those of the smallest scale."""
    known = {}
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        known[t] = f"{folder}/{t}.parquet"
        (tables[t] if t in tables else Q.table(spark, SF, t)).write.parquet(known[t])
    con = duckdb.connect()
    for t, path in known.items():
        con.execute(f"create view {t} as select * from '{path}/*.parquet'")
    result = Q.QUERIES[name](spark, str(folder))
    sql = con.sql(Q.ORACLE_SQL[name])
    assert sorted(result.columns) == sorted(sql.columns)
    return sorted(map(tuple, result.select(sql.columns).collect()), key=repr), sorted(sql.fetchall(), key=repr)


def orders(spark, keys):
    return spark.createDataFrame([(k, k % 7, "O", "1-URGENT") for k in keys], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")


def test_points_on_a_border_are_in_one_borough(spark, tmp_path):
    # 640152, 367829 and 726948 lie on borders, 714820 beyond the last strip.
    got, want = both(spark, tmp_path, "borough_rollup", {"orders": orders(spark, [640152, 367829, 726948, 714820, 1, 2, 3])})
    assert got == want and sum(n for _, n in got) == 6


def test_the_raster_covers_all_points(spark, tmp_path):
    # 150414 and 307369 lie north of 40.75, 714820 east of -74.00, 491544 on the northern border.
    got, want = both(spark, tmp_path, "dem_sample", {"orders": orders(spark, [150414, 307369, 714820, 491544, 1, 2, 3])})
    assert got == want and all(e is not None for _, e in got)


def plain_merge(points, radius):
    """The smallest id that each id reaches by steps of at most the radius, by looking at all pairs."""
    parent = {k: k for k, _, _ in points}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for n, (a, ax, ay) in enumerate(points):
        for b, bx, by in points[n + 1 :]:
            if math.hypot(ax - bx, ay - by) <= radius:
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {k: root(k) for k in parent}


@pytest.mark.parametrize("n, span, tests", [(400, 100.0, 1), (500, 60.0, 1), (500, 60.0, spatial.TESTS), (700, 400.0, spatial.TESTS)])
def test_merging_agrees_with_all_pairs(spark, monkeypatch, n, span, tests):
    monkeypatch.setattr(spatial, "TESTS", tests)
    deal = random.Random(n)
    points = [(k, deal.uniform(-span, span), deal.uniform(-span, span) / 4) for k in range(n)]
    points += [(n + k, 900.0, 30.0) for k in range(20)] + [(n + 20, 905.0, 30.0), (n + 21, 905.0000001, 35.1), (7, 902.0, 34.0)]  # copies, the radius itself, an id at two places
    df = spark.createDataFrame(points, "id long, x double, y double")
    want = plain_merge(points, 5.0)
    assert dict(spatial.merge_points(df, 5.0).collect()) == want and len(want) == n + 22
    named = df.withColumn("id", F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")))
    assert dict(spatial.merge_points(named, 5.0).collect()) == {f"n{k:05d}": f"n{c:05d}" for k, c in want.items()}


def test_points_without_place_or_id_stay_alone(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0), (3, float("nan"), 0.0), (4, float("inf"), 0.0), (5, 1.0, 0.0), (None, 0.5, 0.0)], "id long, x double, y double")
    assert sorted(map(tuple, spatial.merge_points(df, 5.0).collect()), key=repr) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (None, None)]


def test_cells_that_only_hidden_points_link(spark):
    # The middle points are nearest to each other, but not the farthest of their cells to any side.
    left = [(1, 1.2, 1.0), (2, 3.4, 0.1), (3, 2.3, 3.4), (4, 3.3, 1.7)]
    right = [(k + 10, 11.5 - x, 3.5 - y) for k, x, y in left]
    df = spark.createDataFrame(left + right, "id long, x double, y double")
    assert dict(spatial.merge_points(df, 5.0).collect()) == plain_merge(left + right, 5.0) == dict.fromkeys([1, 2, 3, 4, 11, 12, 13, 14], 1)


@pytest.fixture
def most(monkeypatch):
    """The rows of each table of links that components are made of."""
    rows, plain = [], spatial.connected_components

    def counted(edges, *ends):
        rows.append(edges.count())
        return plain(edges, *ends)

    monkeypatch.setattr(spatial, "connected_components", counted)
    return rows


def test_near_points_do_not_make_pairs(spark, most):
    """Four thousand points within the radius have eight million pairs; what is written holds no such table."""
    df = spark.range(4000).select("id", (F.rand(1) * 0.5).alias("x"), (F.rand(2) * 0.5).alias("y"))
    assert {c for _, c in spatial.merge_points(df, 5.0).collect()} == {0}
    assert max(most) < 4000


def test_repair_of_many_near_nodes_is_their_mean(spark, most):
    deal = random.Random(11)
    nodes = [(k, -74.0 + deal.random() * 1e-5, 40.7 + deal.random() * 1e-5, "" if k < 7 else f"n{k}") for k in range(3, 4003)] + [(1, -74.01, 40.7, None), (2, -74.02, 40.7, "alone")]
    df = spark.createDataFrame(nodes, "id long, lon double, lat double, name string").withColumn("ord", F.col("id"))
    got = {r.id: r for r in assemble.repair_merge(df, ["ord"], 5.0).collect()}
    assert set(got) == {1, 2, 3} and (got[1].merged, got[1].name, got[2].merged, got[2].name) == (1, None, 1, "alone")
    assert (got[3].merged, got[3].name) == (4000, "n7")
    assert got[3].lon == pytest.approx(math.fsum(n[1] for n in nodes[:4000]) / 4000, abs=1e-12) and got[3].lat == pytest.approx(math.fsum(n[2] for n in nodes[:4000]) / 4000, abs=1e-12)
    assert max(most) < 4000


EDGES = "id string, u string, v string, line array<struct<lon:double,lat:double>>"


def test_many_near_ends_are_merged_without_pairs(spark, most):
    deal = random.Random(3)
    at = lambda: {"lon": -74.0 + deal.random() * 1e-5, "lat": 40.7 + deal.random() * 1e-5}
    far = {"lon": -74.01, "lat": 40.7}
    rows = [(f"e{k:04d}", f"a{k:04d}", f"b{k:04d}", [at()] + [far] * (k % 2) + [at()]) for k in range(2000)] + [("e9999", "z", "a0000", [far, at()])]
    merged, remap = assemble.merge_endpoints(spark.createDataFrame(rows, EDGES), 5.0)
    got = {r.id: (r.u, r.v, len(r.line)) for r in merged.collect()}
    assert got == {f"e{k:04d}": ("a0000", "a0000", 3) for k in range(1, 2000, 2)} | {"e9999": ("z", "a0000", 2)}
    assert {r.id: r.canonical for r in remap.collect()} == {x: "a0000" for r in rows[:2000] for x in r[1:3]} | {"z": "z"}
    assert max(most) < 4000
    # Lines that aren't asked for don't travel through the joins.
    plan = merged.select("id", "u", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not any("line#" in x for x in plan.split("Join")[:-1])


def test_ends_of_several_places_or_none(spark):
    p = lambda lon, lat=40.0: {"lon": lon, "lat": lat}
    rows = [("2", "A", "B", [p(1.0), p(2.0)]), ("1", "B", "A", [p(3.0), p(4.0)]), ("3", "A", "C", [p(5.0), p(6.0)]), ("4", "C", "D", [p(6.0), p(None)]), ("5", "D", None, [p(7.0), p(8.0)]), ("6", "E", "F", None), ("7", "G", "G", [p(9.0, None), p(9.0)])]
    got = {r.id: (r.lon, r.lat) for r in assemble.endpoints(spark.createDataFrame(rows, EDGES)).collect()}
    assert got == {"A": (1.0, 40.0), "B": (3.0, 40.0), "C": (6.0, 40.0), "D": (7.0, 40.0), "E": (None, None), "F": (None, None), "G": (9.0, None)}


def test_an_end_counts_though_the_other_one_is_unknown(spark, tmp_path):
    # 181329 is near to 8 and to 81091, which aren't near each other; 181328, the other end of its edge, is no order.
    items = spark.createDataFrame([(k, 1, 1, 1) for k in (8, 181329, 81091)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    got, want = both(spark, tmp_path, "merge_remap", {"orders": orders(spark, [7, 8, 181329, 81091, 81088]), "lineitem": items})
    assert got == want == [("8-1", 8, 7), ("81091-1", 8, 81088)]


def test_merging_across_blocks_of_tiles(spark, monkeypatch):
    deal = random.Random(5)
    points = [(k, deal.uniform(0, 900.0), deal.uniform(0, 9.0)) for k in range(900)]
    cells = {}
    for k, x, y in points:
        cells.setdefault((math.floor(x / 3.5), math.floor(y / 3.5)), []).append((k, x, y))
    rows = sorted(((cx >> spatial.TILE, cy >> spatial.TILE, cx, cy, ps) for (cx, cy), ps in cells.items()), key=lambda r: r[:4])
    far = {"w": lambda p: (p[1],), "e": lambda p: (-p[1],), "s": lambda p: (p[2],), "n": lambda p: (-p[2],)}
    table = pa.table({"cx": [r[2] for r in rows], "cy": [r[3] for r in rows], "rep": [min(r[4])[0] for r in rows]} | {f"{k}{c}": [min(r[4], key=f)[i] for r in rows] for k, f in far.items() for i, c in ((1, "x"), (2, "y"))})
    monkeypatch.setattr(spatial, "BLOCK", 300)
    out = pa.Table.from_batches(spatial._tile_labels(iter(table.to_batches(max_chunksize=50)), 5.0)).to_pylist()
    assert len(out) == len(rows)
    want = plain_merge(points, 5.0)
    assert all(want[r["rep"]] == want[r["label"]] and r["label"] <= r["rep"] for r in out)
    by = {(r["cx"], r["cy"]): r for r in out}
    for (cx, cy), r in by.items():
        for i, j in spatial.AROUND:
            other = by.get((cx + i, cy + j))
            assert other is None or other["label"] == r["label"] or (other["open"] and r["open"])
