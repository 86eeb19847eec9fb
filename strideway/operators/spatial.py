"""Spatial joins: every predicate of distance or containment becomes an equi-join on grid cells and an exact test.

Points are (x, y) metres. With cells as wide as the radius, a point's matches lie in the three by three cells
around it; the left side keeps its one cell and the right side is put into nine, so each pair meets exactly once.
Coincident points can be many; joins that only need the nearest one aggregate per cell after the test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideway.functions import geometry as G
from strideway.operators.components import connected_components
from strideway.plans.lineage import cut, discard

#: Vertices of polygons that may be broadcast whole; more go through cells.
BROADCAST_VERTICES = 100_000
#: How much narrower the radii are that are searched for the nearest point first.
NARROWER = 4
#: Query points that meet all nodes in one pass.
QUERIES = 500
#: Cells that a polygon may cover; one that covers more is put into wider ones.
CELLS, WIDER = 1_024, 16


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def _spread(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Each row in its cell and the eight around it; the offsets are generated, so that coordinates are computed once."""
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    home = df.withColumns({"_hx": _cell(F.col(x), size), "_hy": _cell(F.col(y), size)}).withColumn("_o", F.explode(around))
    return home.select(*df.columns, (F.col("_hx") + F.col("_o.i")).alias("_cx"), (F.col("_hy") + F.col("_o.j")).alias("_cy"))


def pairs_within(left: DataFrame, right: DataFrame, radius: float, left_id: str = "id", right_id: str = "id") -> DataFrame:
    """(left_id, right_id, distance) of all pairs at most ``radius`` apart; both sides have x and y."""
    a = left.select(F.col(left_id).alias("left_id"), F.col("x").alias("ax"), F.col("y").alias("ay")).withColumns({"_cx": _cell(F.col("ax"), radius), "_cy": _cell(F.col("ay"), radius)})
    b = _spread(right.select(F.col(right_id).alias("right_id"), F.col("x").alias("bx"), F.col("y").alias("by")), "bx", "by", radius)
    d = F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))
    return a.join(b, ["_cx", "_cy"]).withColumn("distance", d).where(F.col("distance") <= radius).select("left_id", "right_id", "distance")


def epsilon_pairs(points: DataFrame, radius: float, key: str = "id") -> DataFrame:
    """(a, b): unordered pairs of different points at most ``radius`` apart, a < b."""
    return pairs_within(points, points, radius, key, key).where("left_id < right_id").select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))


def nearest_within(left: DataFrame, right: DataFrame, radius: float, left_id: str = "id", right_id: str = "id") -> DataFrame:
    """(left_id, right_id, distance): the nearest point on the right at most ``radius`` away; ties to the smallest id; left outer.

    Whatever is found within a small radius is the nearest, so wider ones are only searched for rows that have found nothing:
    where points are dense, few pairs meet. The left side goes into the nine cells, the right side keeps its one.
    """
    open_, found = cut(left.select(F.col(left_id).alias("id"), "x", "y"), "nearest-left"), []
    near = right.select(F.col(right_id).alias("id"), "x", "y")
    rows = open_.select(F.col("id").alias("left_id"))
    for r in (radius / NARROWER**2, radius / NARROWER, radius):
        pairs = pairs_within(near, open_, r).groupBy("right_id").agg(F.min(F.struct("distance", F.col("left_id").alias("id"))).alias("best"))
        best = cut(pairs.select(F.col("right_id").alias("left_id"), F.col("best.id").alias("right_id"), "best.distance"), "nearest-found")
        found.append(best)
        if r < radius:
            open_ = cut(open_.join(best.select(F.col("left_id").alias("id")), "id", "left_anti"), "nearest-open")
            if not open_.limit(1).count():
                break
    return rows.join(reduce(DataFrame.unionByName, found), "left_id", "left").select("left_id", "right_id", "distance")


def nearest_by_haversine(queries: DataFrame, nodes: DataFrame, k: int = 1) -> DataFrame:
    """(query_id, node_id, distance, rank): the k nearest nodes of each of a few query points (id, lon, lat on both sides).

    Nodes stream past the queries, ``QUERIES`` of them at a time; more are more passes.
    """
    n = queries.count()
    if n > QUERIES:
        parts = -(-n // QUERIES) * 2  # dealt by hash, and each part may be split again
        deal = F.pmod(F.xxhash64("id"), F.lit(parts))
        if queries.select("id").distinct().limit(2).count() < 2:
            raise ValueError("too many query points of one id")
        return reduce(DataFrame.unionByName, [nearest_by_haversine(cut(queries.where(deal == i), "spatial-queries"), nodes, k) for i in range(parts)])
    q = queries.agg(F.collect_list(F.struct(F.col("id").alias("query_id"), F.col("lon").alias("qlon"), F.col("lat").alias("qlat"))).alias("qs"))
    rows = [r.asDict() for r in q.first()["qs"]]  # QUERIES at most
    if not rows:
        return nodes.sparkSession.createDataFrame([], "query_id string, node_id string, distance double, rank int")
    literal = F.array(*[F.struct(F.lit(r["query_id"]).alias("query_id"), F.lit(r["qlon"]).alias("qlon"), F.lit(r["qlat"]).alias("qlat")) for r in rows])
    pairs = nodes.select(F.col("id").alias("node_id"), "lon", "lat", F.explode(literal).alias("q"))
    scored = pairs.select("q.query_id", "node_id", G.haversine(F.col("q.qlon"), F.col("q.qlat"), F.col("lon"), F.col("lat")).alias("distance"))
    if k == 1:
        return scored.groupBy("query_id").agg(F.min(F.struct("distance", "node_id")).alias("b")).select("query_id", "b.node_id", "b.distance", F.lit(1).alias("rank"))
    from pyspark.sql import Window

    by = Window.partitionBy("query_id").orderBy("distance", "node_id")
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "node_id", "distance", "rank")


def nearest_k(points: DataFrame, x: float, y: float, k: int) -> DataFrame:
    """The k points (id, x, y) nearest to one place; ties to the smallest id."""
    return points.withColumn("distance", F.hypot(F.col("x") - x, F.col("y") - y)).orderBy("distance", "id").limit(k)


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float | None = None, fields: tuple[str, str] = ("lon", "lat"), boundary: bool | None = False) -> DataFrame:
    """(id, polygon_id) of all points strictly inside a polygon (polygon_id, rings); ``boundary`` as in ``contains_point``.

    A few polygons are broadcast; many are put into the grid cells that their bounds touch (of width ``cell``) and
    joined on the cell, with the exact test on what meets.
    """
    x, y = fields
    few = cell is None and (polygons.agg(F.sum(F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)))).first()[0] or 0) <= BROADCAST_VERTICES
    test = G.contains_point(F.col("rings"), F.col(x), F.col(y), fields, boundary)
    if few:
        box = G.bounds(F.get("rings", F.lit(0)), fields)
        known = polygons.select("polygon_id", "rings", box.alias("box"))
        inside = F.col(x).between(F.col("box.min_x"), F.col("box.max_x")) & F.col(y).between(F.col("box.min_y"), F.col("box.max_y"))
        return points.join(F.broadcast(known), inside & test).select("id", "polygon_id")
    size = cell or 0.01
    box = polygons.select("polygon_id", "rings", G.bounds(F.get("rings", F.lit(0)), fields).alias("b"))
    # How often the cells are widened until the polygon covers few of them.
    covered = ((F.col("b.max_x") - F.col("b.min_x")) / size + 1) * ((F.col("b.max_y") - F.col("b.min_y")) / size + 1)
    sized = box.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log(covered / CELLS) / math.log(WIDER**2))).cast("int"))
    out = []
    for level in sorted(r["level"] for r in sized.where("level is not null").select("level").distinct().collect()):  # a few: each widens by WIDER
        wide = size * WIDER**level
        own = sized.where(F.col("level") == level)
        cells = own.withColumn("_cx", F.explode(F.sequence(_cell(F.col("b.min_x"), wide), _cell(F.col("b.max_x"), wide)))).withColumn("_cy", F.explode(F.sequence(_cell(F.col("b.min_y"), wide), _cell(F.col("b.max_y"), wide))))
        at = points.withColumns({"_cx": _cell(F.col(x), wide), "_cy": _cell(F.col(y), wide)})
        out.append(at.join(cells.drop("b", "level"), ["_cx", "_cy"]).where(test).select("id", "polygon_id"))
    return reduce(DataFrame.unionByName, out) if out else points.join(polygons.select("polygon_id").where("false"), F.lit(False)).select("id", "polygon_id")


def first_polygon(points: DataFrame, polygons: DataFrame, cell: float | None = None, fields: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """(id, polygon_id): the smallest polygon that holds each point, null if none does."""
    found = points_in_polygons(points, polygons, cell, fields).groupBy("id").agg(F.min("polygon_id").alias("polygon_id"))
    return points.select("id").join(found, "id", "left")


def uncovered_polygons(polygons: DataFrame, lines: DataFrame, distance: float) -> DataFrame:
    """The polygons (polygon_id, rings of x and y) that no line (line_id, line of x and y) comes within ``distance`` of.

    Segments of both sides meet in grid cells; the right side's cells are those its bounds, grown by the
    distance, touch. A polygon that holds a line's vertex is covered too. One vertex of each small cell tells most covered
    polygons first, so that only the others meet all lines.
    """
    size = max(distance, 1.0) * 4
    polygons = cut(polygons, "coverage-polygons")

    def segments(df: DataFrame, key: str, line: str) -> DataFrame:
        n = F.size(line)
        at = F.explode(F.when(n >= 2, F.sequence(F.lit(1), n - 1)))
        return df.select(key, line, at.alias("_i")).select(key, F.get(line, F.col("_i") - 1).alias("a"), F.get(line, F.col("_i")).alias("b"))

    def cells(df: DataFrame, grow: float, size: float = size) -> DataFrame:
        lo = lambda f: F.floor((F.least(F.col(f"a.{f}"), F.col(f"b.{f}")) - grow) / size)
        hi = lambda f: F.floor((F.greatest(F.col(f"a.{f}"), F.col(f"b.{f}")) + grow) / size)
        return df.withColumn("_cx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("_cy", F.explode(F.sequence(lo("y"), hi("y"))))

    rings = polygons.select("polygon_id", F.explode("rings").alias("ring"))
    small = max(distance, 1.0)
    one = lines.select(F.explode("line").alias("p")).groupBy(_cell(F.col("p.x"), small).alias("_cx"), _cell(F.col("p.y"), small).alias("_cy")).agg(F.first("p.x").alias("x"), F.first("p.y").alias("y"))
    few = (F.abs(F.col("a.x") - F.col("b.x")) / small + 3) * (F.abs(F.col("a.y") - F.col("b.y")) / small + 3) <= CELLS  # longer sides wait for the test of all lines
    met = cells(segments(rings, "polygon_id", "ring").where(few), distance, small).join(one, ["_cx", "_cy"])
    sure = met.where(G.point_segment_distance(F.col("x"), F.col("y"), F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y")) <= distance).select("polygon_id").distinct()
    polygons = cut(polygons.join(sure, "polygon_id", "left_anti"), "coverage-open")
    if not polygons.limit(1).count():
        return polygons
    rings = polygons.select("polygon_id", F.explode("rings").alias("ring"))
    own = cells(segments(rings, "polygon_id", "ring"), 0.0)
    other = cells(segments(lines, "line_id", "line"), distance).select(F.col("a").alias("c"), F.col("b").alias("d"), "_cx", "_cy")
    near = own.join(other, ["_cx", "_cy"]).where(G.segment_distance(F.col("a"), F.col("b"), F.col("c"), F.col("d")) <= distance).select("polygon_id")
    vertices = lines.select(F.col("line_id").alias("id"), F.explode("line").alias("p")).select("id", "p.x", "p.y")
    inside = points_in_polygons(vertices, polygons, cell=size * 4, fields=("x", "y")).select("polygon_id")
    return polygons.join(near.union(inside).distinct(), "polygon_id", "left_anti")


#: Steps to half of the cells around one that may hold points within the radius; the other half is met from the other side.
AROUND = tuple((i, j) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0))
#: Cells on a side of a tile, as a power of two, and how many cells are linked at once.
TILE, BLOCK = 6, 100_000
#: Labels that may be broadcast; more are joined.
BROADCAST_LABELS = 100_000
#: Distances that are taken at once, without leaving out what is known to be linked.
TESTS = 10_000_000
#: Points that stand for a cell: those farthest to the west, east, south and north.
_FAR = ("w", "e", "s", "n")


def _block_labels(block: pa.Table, radius: float) -> pa.Table:
    """Cells of whole tiles with the least ``rep`` of the cells that they are surely linked with, and whether others may be near.

    A cell is open if a cell around it has another label, or isn't here and lies in another tile. Distances that differ from the
    radius by rounding alone are left to the test of open cells.
    """
    block = block.take(pc.sort_indices(block["rep"]))  # the first is the least
    cx, cy = (block[c].to_numpy() for c in ("cx", "cy"))
    far = np.stack([np.stack([block[f"{k}{c}"].to_numpy() for c in "xy"], 1) for k in _FAR], 1)
    (ux, ix), (uy, iy) = np.unique(cx, return_inverse=True), np.unique(cy, return_inverse=True)
    place = ix * len(uy) + iy
    order = np.argsort(place)
    known = place[order]

    def moved(u: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(u, u + d), len(u) - 1)
        return at, u[at] == u + d

    ends, open_ = [], np.zeros(len(cx), bool)
    for i, j in AROUND:
        (mx, okx), (my, oky) = moved(ux, i), moved(uy, j)
        to = mx[ix] * len(uy) + my[iy]
        at = np.minimum(np.searchsorted(known, to), len(known) - 1)
        here = okx[ix] & oky[iy] & (known[at] == to)
        a, b = np.flatnonzero(here), order[at[here]]
        ends.append((a, b))
        for gone, di, dj in ((~here, i, j), (np.bincount(b, minlength=len(cx)) == 0, -i, -j)):
            open_ |= gone & (((cx + di) >> TILE != cx >> TILE) | ((cy + dj) >> TILE != cy >> TILE))
    label = np.arange(len(cx))
    for a, b in ends:
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
        step = far[a][:, :, None] - far[b][:, None, :]
        linked = (np.hypot(step[..., 0], step[..., 1]) <= radius * (1 - 1e-12)).any(axis=(1, 2))
        u, v = label[a[linked]], label[b[linked]]
        while len(u):
            np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
            while not np.array_equal(label, further := label[label]):
                label = further
            u, v = label[u], label[v]
            u, v = u[u != v], v[u != v]
    for a, b in ends:
        differ = label[a] != label[b]
        open_[a[differ]] = open_[b[differ]] = True
    return block.append_column("label", block["rep"].take(pa.array(label))).append_column("open", pa.array(open_))


def _tile_labels(batches: Iterator[pa.RecordBatch], radius: float) -> Iterator[pa.RecordBatch]:
    """``_block_labels`` of cells in the order of their tiles; a block ends where a tile does."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) < BLOCK:
            continue
        block = pa.concat_tables(held)
        tx, ty = (block[c].to_numpy() >> TILE for c in ("cx", "cy"))
        whole = int(np.flatnonzero((tx != tx[-1]) | (ty != ty[-1]))[-1]) + 1  # a tile holds far fewer cells than a block
        yield from _block_labels(block.slice(0, whole), radius).to_batches(max_chunksize=10_000)
        held = [block.slice(whole)]
    if sum(map(len, held)):
        yield from _block_labels(pa.concat_tables(held), radius).to_batches(max_chunksize=10_000)


def merge_points(points: DataFrame, radius: float) -> DataFrame:
    """(id, canonical): points at most ``radius`` apart are one, transitively; the smallest id stands for all.

    Points in one cell, whose diagonal is a little shorter than the radius, are linked without a test. A cell's farthest points
    link most cells with those around them, tile by tile; cells that may still meet others are tested by the same points across tiles, and
    only cells that are then in different components by all their points. So the pairs within the radius are never listed. Ids are
    of a type that Arrow sorts.
    """
    side = radius / 1.42
    finite = F.col("id").isNotNull() & (F.abs("x") < math.inf) & (F.abs("y") < math.inf)
    own = {c: F.when(finite, _cell(F.col(v), side)) for c, v in (("cx", "x"), ("cy", "y"))}
    stored = cut(points.select("id", "x", "y"), "merge-points")
    placed = stored.withColumns(own)
    farthest = [F.min("x").alias("wx"), F.min_by("y", "x").alias("wy"), F.max("x").alias("ex"), F.max_by("y", "x").alias("ey"), F.min_by("x", "y").alias("sx"), F.min("y").alias("sy"), F.max_by("x", "y").alias("nx"), F.max("y").alias("ny")]
    cells = placed.where("cx is not null").groupBy("cx", "cy").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("points"), *farthest)
    tile = [F.shiftright(c, TILE).alias(f"t{c}") for c in ("cx", "cy")]
    tiled = cells.select("*", *tile).repartition("tcx", "tcy").sortWithinPartitions("tcx", "tcy").drop("tcx", "tcy")
    kind = T.StructType([*tiled.schema.fields, T.StructField("label", tiled.schema["rep"].dataType), T.StructField("open", T.BooleanType())])
    cells = cut(tiled.mapInArrow(lambda batches: _tile_labels(batches, radius), kind), "merge-cells")

    # Open cells of different labels, by their farthest points; those that hold no other points are told for good.
    open_ = cells.where("open").drop("open", "rep")
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in AROUND]))
    a = open_.select(*[F.col(c).alias(f"a_{c}") for c in open_.columns], step.alias("_o")).withColumns({"cx": F.col("a_cx") + F.col("_o.i"), "cy": F.col("a_cy") + F.col("_o.j")})
    met = a.join(open_.hint("merge"), ["cx", "cy"]).where("a_label <> label")
    apart = [F.hypot(F.col(f"a_{k}x") - F.col(f"{m}x"), F.col(f"a_{k}y") - F.col(f"{m}y")) for k in _FAR for m in _FAR]
    gap = [F.greatest(F.col(f"a_{lo}") - F.col(hi), F.col(lo) - F.col(f"a_{hi}"), F.lit(0.0)) for lo, hi in (("wx", "ex"), ("sy", "ny"))]
    hidden = (F.greatest("a_points", "points") > 2) & (F.hypot(*gap) <= radius * (1 + 1e-12))
    told = met.select("a_cx", "a_cy", "a_label", "cx", "cy", "label", (F.least(*apart) <= radius).alias("linked"), hidden.alias("hidden"), (F.col("a_points") * F.col("points").cast("double")).alias("tests"))
    told = cut(told.where("linked or hidden"), "merge-told")

    # Each id once; one that is at several places links them.
    with_label = placed.join(cells.select("cx", "cy", "label").hint("merge"), ["cx", "cy"], "left")
    members = cut(with_label.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("last")), "merge-members")
    links = told.where("linked").select(F.col("a_label").alias("a"), F.col("label").alias("b")).distinct()
    if members.where("label <> last").limit(1).count():
        several = members.where("label <> last").select("id", F.col("label").alias("a")).hint("merge")
        links = links.union(with_label.join(several, "id").where("a <> label").select("a", F.col("label").alias("b")).distinct())
    links = cut(links, "merge-links")

    # Many tests of all points are worth knowing first which of them components make needless.
    rest = told.where("hidden and not linked")
    tests = rest.agg(F.sum("tests")).first()[0] or 0
    labels = None
    if not 0 < tests <= TESTS:
        labels = connected_components(links, "a", "b")
    if tests > TESTS:
        ends = [labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")).hint("merge") for c in ("a_label", "label")]
        rest = rest.join(ends[0], "a_label", "left").join(ends[1], "label", "left").where("not coalesce(_a_label, a_label) <=> coalesce(_label, label)")
    if tests:
        rest = cut(rest.select("a_cx", "a_cy", "a_label", "cx", "cy", "label"), "merge-rest")
        named = rest.select(F.col("a_cx").alias("cx"), F.col("a_cy").alias("cy")).union(rest.select("cx", "cy")).distinct()
        at = cut(placed.join(named.hint("merge"), ["cx", "cy"]).select("cx", "cy", "x", "y").distinct(), "merge-places")
        other = at.select(F.col("cx").alias("a_cx"), F.col("cy").alias("a_cy"), F.col("x").alias("ax"), F.col("y").alias("ay"))
        pairs = rest.join(other.hint("merge"), ["a_cx", "a_cy"]).join(at.hint("merge"), ["cx", "cy"]).where(F.hypot(F.col("ax") - F.col("x"), F.col("ay") - F.col("y")) <= radius)
        more = links.union(pairs.select(F.col("a_label").alias("a"), F.col("label").alias("b")).distinct())
        if labels is not None:
            discard(labels)
        labels = connected_components(more, "a", "b")
        discard(at, rest)
    labels = labels.where("node <> component")
    few = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    labels = F.broadcast(labels) if few else labels.hint("merge")
    out = members.join(labels, F.col("label") == F.col("node"), "left").select("id", F.coalesce("component", "label", "id").alias("canonical"))
    discard(stored, cells, told, links)
    return out
