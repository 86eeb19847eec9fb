"""Assembly of the network: dedup, curb snapping, endpoint merging, node injection and merging, inclines, repair variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideway.functions import geometry as G
from strideway.functions import mapping as M
from strideway.functions import projection as P
from strideway.operators.spatial import merge_points, nearest_within
from strideway.plans.lineage import cut

#: Node attributes of which the first value that isn't missing counts, whichever source it comes from.
CURB_FIELDS = ("barrier", "kerb", "tactile_paving", "ext_ramp_id", "ext_corner_id", "ext_street_1", "ext_street_2", "ext_running_slope_pct", "ext_cross_slope_pct", "ext_counter_slope_pct")
#: Order of the sources of a node.
RANKS = {"osm": 0, "curb": 1, "injected": 2}


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in a stated order; ties in the order are the caller's to avoid."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(by)).where("_place = 1").drop("_place")


def drop_degenerate(edges: DataFrame) -> DataFrame:
    """Edges whose ends differ; two unknown ends are the same."""
    return edges.where(~F.col("u").eqNullSafe(F.col("v")))


def drop_collapsed(edges: DataFrame, vertices: Column | None = None) -> DataFrame:
    """Edges but those of two vertices whose ends have become one node; vertices that were counted before needn't be again."""
    n = F.size("line") if vertices is None else vertices
    return edges.where(~(F.col("u").eqNullSafe(F.col("v")) & (n == 2)))


def drop_self_loops(edges: DataFrame) -> DataFrame:
    """The repair's variant: no equal ends, no fewer than two vertices, no two equal vertices."""
    same = (F.size("line") == 2) & (F.get("line", F.lit(0)) == F.get("line", F.lit(1)))
    return edges.where(~(F.col("u").eqNullSafe(F.col("v"))) & (F.size("line") >= 2) & ~same)


def dedup_edges(edges: DataFrame, order: str = "id") -> DataFrame:
    """The first edge per unordered pair of ends, highway and footway; edges with an unknown end all stay."""
    whole = edges.where("u is not null and v is not null")
    rest = edges.where("u is null or v is null")
    return keep_first(whole, [F.least("u", "v"), F.greatest("u", "v"), "highway", "footway"], [order]).unionByName(rest)


def endpoints(edges: DataFrame) -> DataFrame:
    """(id, lon, lat, x, y): each end node once, at the coordinates of its first edge, starts before ends.

    Most nodes have one place on all their edges, which their least and greatest coordinates tell; only the others' edges are put in order.
    """
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.col(c).alias("node"), p("line").alias("p")) for k, (c, p) in enumerate((("u", G.start_point), ("v", G.end_point)))]))
    rows = edges.select(F.col("id").alias("_edge"), ends.alias("e")).where("e.node is not null")
    lon, lat = F.col("e.p.lon"), F.col("e.p.lat")
    span = rows.groupBy(F.col("e.node").alias("id")).agg(F.min(lon).alias("lon"), F.min(lat).alias("lat"), F.max(lon).alias("_lon"), F.max(lat).alias("_lat"), F.count_if(lon.isNull() | lat.isNull()).alias("_none"))
    span = cut(span.select("id", "lon", "lat", ((F.col("lon") == F.col("_lon")) & (F.col("lat") == F.col("_lat")) & (F.col("_none") == 0)).alias("_one")), "ends")
    found, others = span.where("_one").select("id", "lon", "lat"), span.where("not coalesce(_one, false)").select("id")
    if others.limit(1).count():
        several = rows.join(others.hint("merge"), F.col("e.node") == F.col("id"), "left_semi")
        first = several.groupBy(F.col("e.node").alias("id")).agg(F.min_by("e.p", F.struct("e.role", "_edge")).alias("p"))
        found = found.unionByName(first.select("id", "p.lon", "p.lat"))
    return P.with_plane(found)


def snap_curbs(curbs: DataFrame, ends: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """Curb nodes (id, lon, lat, ...) moved to the nearest end node at most ``tolerance`` metres away, whose id they take.

    Column ``snapped`` tells which; the others stay where they are.
    """
    placed = P.with_plane(curbs)
    points = placed.select("id", "x", "y").distinct()
    near = nearest_within(points.select(F.struct("id", "x", "y").alias("id"), "x", "y"), ends, tolerance).where("right_id is not null")
    target = near.join(ends.select(F.col("id").alias("right_id"), F.col("lon").alias("_lon"), F.col("lat").alias("_lat")), "right_id").select(F.col("left_id.id").alias("id"), F.col("left_id.x").alias("x"), F.col("left_id.y").alias("y"), "right_id", "_lon", "_lat")
    out = placed.join(target, ["id", "x", "y"], "left")
    return out.withColumns({"snapped": F.col("right_id").isNotNull(), "id": F.coalesce("right_id", "id"), "lon": F.coalesce("_lon", "lon"), "lat": F.coalesce("_lat", "lat")}).select(*curbs.columns, "snapped")


def line_centroids(edges: DataFrame) -> DataFrame:
    """(id, x, y): the planar centroid of each line; lines are projected once, as one generated row each."""
    planar = edges.select("id", F.explode(F.array(P.project_line(F.col("line")))).alias("line"))
    return planar.select("id", F.explode(F.array(G.line_centroid(F.col("line")))).alias("c")).select("id", "c.x", "c.y")


def merge_endpoints(edges: DataFrame, tolerance: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(edges with merged ends, the remap (id, canonical)): ends at most ``tolerance`` apart are one node, transitively."""
    remap = cut(merge_points(endpoints(edges), tolerance), "merge-remap")
    changed = remap.where("id <> canonical")
    u, v = (changed.select(F.col("id").alias(c), F.col("canonical").alias(f"_{c}")).hint("merge") for c in ("u", "v"))
    # The vertices are counted before the joins, so that lines go through them only if they are asked for.
    counted = edges.withColumn("_n", F.size("line"))
    out = counted.join(u, "u", "left").join(v, "v", "left").withColumns({"u": F.coalesce("_u", "u"), "v": F.coalesce("_v", "v")})
    return drop_collapsed(out, F.col("_n")).select(edges.columns), remap


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, lon, lat, ext_source): nodes that edges name and ``nodes`` (id) lacks, at the end of the first edge that names them."""
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.col(c).alias("node"), p("line").alias("p")) for k, (c, p) in enumerate((("u", G.start_point), ("v", G.end_point)))]))
    named = edges.select(F.col("id").alias("_edge"), "ext_source", ends.alias("e")).where("e.node is not null").select(F.col("e.node").alias("id"), "_edge", "ext_source", "e.role", "e.p")
    lost = named.join(nodes.select("id").distinct(), "id", "left_anti")
    first = lost.groupBy("id").agg(F.min_by(F.struct("p", "ext_source"), F.struct("_edge", "role")).alias("f"))
    return first.select("id", "f.p.lon", "f.p.lat", "f.ext_source")


def merge_nodes(nodes: DataFrame, order: list[str], first_known: tuple[str, ...] = CURB_FIELDS) -> DataFrame:
    """One row per id: all attributes of the first row in ``order``, but of each ``first_known`` one the first that isn't null."""
    at = F.struct(*order)
    rest = [c for c in nodes.columns if c != "id" and c not in first_known and c not in order]
    known = [c for c in first_known if c in nodes.columns]
    aggregated = [F.min_by(F.struct(*rest), at).alias("_rest")] if rest else []
    out = nodes.groupBy("id").agg(*aggregated, *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in known], F.count(F.lit(1)).alias("_n"))
    return out.select("id", *[F.col(f"_rest.{c}").alias(c) for c in rest], *known)


def repair_merge(nodes: DataFrame, order: list[str], tolerance: float) -> DataFrame:
    """The repair's variant: nodes (id, lon, lat, ...) near each other are one, at their mean, with the first known value of everything."""
    placed = P.with_plane(nodes)
    labelled = nodes.join(merge_points(placed.select("id", "x", "y"), tolerance).hint("merge"), "id")
    at = F.struct(*order)
    rest = [c for c in nodes.columns if c not in ("id", "lon", "lat", *order)]
    known = lambda c: F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), at)).alias(c)
    return labelled.groupBy("canonical").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), *map(known, rest), F.count(F.lit(1)).alias("merged")).withColumnRenamed("canonical", "id")


def snap_lines(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose lines begin and end exactly at their nodes, with unresolved_u, unresolved_v, moved_u, moved_v, moved and degenerate.

    An end without a node, or whose node isn't known, is unresolved and stays. A line that ends where it begins is degenerate. Lines of
    fewer than two vertices are left as they are.
    """
    at = F.struct("lon", "lat")
    u = nodes.select(F.col("id").alias("u"), at.alias("_pu"))
    v = nodes.select(F.col("id").alias("v"), at.alias("_pv"))
    joined = edges.join(u, "u", "left").join(v, "v", "left")
    line = G.set_endpoints("line", F.col("_pu"), F.col("_pv"))
    whole = F.size("line") >= 2
    moved = {"moved_u": F.coalesce(whole & (G.start_point("line") != F.col("_pu")), F.lit(False)), "moved_v": F.coalesce(whole & (G.end_point("line") != F.col("_pv")), F.lit(False))}
    flags = {"unresolved_u": whole & F.col("_pu").isNull(), "unresolved_v": whole & F.col("_pv").isNull(), **moved}
    out = joined.withColumns(flags).withColumn("line", F.when(whole, line).otherwise(F.col("line"))).withColumn("moved", F.col("moved_u") | F.col("moved_v"))
    degenerate = (F.size("line") >= 2) & (G.start_point("line") == G.end_point("line"))
    return out.withColumn("degenerate", F.coalesce(degenerate, F.lit(False))).select(*edges.columns, "unresolved_u", "unresolved_v", "moved_u", "moved_v", "moved", "degenerate")


def snap_report(snapped: DataFrame) -> DataFrame:
    """One row of counts of what ``snap_lines`` did."""
    return snapped.agg(
        F.count(F.lit(1)).alias("edges"), F.count_if("moved").alias("edges_moved"), F.count_if("moved_u").alias("endpoints_snapped_u"), F.count_if("moved_v").alias("endpoints_snapped_v"),
        (F.count_if("moved_u") + F.count_if("moved_v")).alias("endpoints_snapped_total"), F.count_if(F.col("unresolved_u") | F.col("unresolved_v")).alias("edges_with_unresolved_node_ref"), F.count_if("degenerate").alias("degenerate_after_snap"),
    )


def sample_raster(nodes: DataFrame, tiles: DataFrame, cells: DataFrame) -> DataFrame:
    """(id, elevation): the nearest pixel of the first tile, in rank order, that has a value there; one decimal.

    ``tiles``: tile_rank, west, north, pixel_width, pixel_height, cols, rows; ``cells``: tile_rank, col, row,
    elev, with null or NaN for no data. Tiles are few and broadcast as one array; pixels are joined by equality.
    """
    known = [r.asDict() for r in tiles.collect()]  # one row per raster file
    if not known:
        return nodes.select("id", F.lit(None).cast("double").alias("elevation"))
    options = []
    for t in known:
        col, row = F.floor((F.col("lon") - t["west"]) / t["pixel_width"]), F.floor((t["north"] - F.col("lat")) / t["pixel_height"])
        inside = col.between(0, t["cols"] - 1) & row.between(0, t["rows"] - 1)
        options.append(F.when(inside, F.struct(F.lit(t["tile_rank"]).alias("tile_rank"), col.cast("long").alias("col"), row.cast("long").alias("row"))))
    at = nodes.select("id", F.explode_outer(F.array_compact(F.array(*options))).alias("p")).select("id", "p.*")
    pixels = cells.where("elev is not null and not isnan(elev)").select("tile_rank", F.col("col").cast("long").alias("col"), F.col("row").cast("long").alias("row"), "elev")
    found = at.join(pixels, ["tile_rank", "col", "row"], "left")
    best = found.groupBy("id").agg(F.min_by("elev", F.when(F.col("elev").isNotNull(), F.col("tile_rank"))).alias("elev"))
    return best.select("id", F.round("elev", 1).alias("elevation"))


def edge_inclines(edges: DataFrame, elevations: DataFrame) -> DataFrame:
    """Edges with ``incline``: rise between the end nodes over the length; null where an elevation or the length is missing."""
    u = elevations.select(F.col("id").alias("u"), F.col("elevation").alias("_eu"))
    v = elevations.select(F.col("id").alias("v"), F.col("elevation").alias("_ev"))
    out = edges.drop("incline").join(u, "u", "left").join(v, "v", "left")
    return out.withColumn("incline", G.incline(F.col("_ev") - F.col("_eu"), G.length_mid_latitude("line"))).drop("_eu", "_ev")


def curb_flags(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with ``curbramps``: 1 if an end node is a kerb of any usable kind."""
    curbs = nodes.where((F.col("barrier") == "kerb") | F.col("kerb").isin("lowered", "raised", "flush")).select("id").distinct()
    return _flagged(edges, curbs)


def crossing_curb_flags(edges: DataFrame, nodes: DataFrame, places: int = 5) -> DataFrame:
    """Edges with ``curbramps`` for the binary format: crossings with a lowered or flush kerb at an end node, or a curb node of that kind at its place."""
    curbs = nodes.where(F.lower("kerb").isin("lowered", "flush"))
    near = [M.fixed_units(F.col("lon"), places).alias("_x"), M.fixed_units(F.col("lat"), places).alias("_y")]
    places_of = curbs.where("barrier = 'kerb'").select(*near).distinct()
    by_place = nodes.select("id", *near).join(places_of, ["_x", "_y"], "left_semi").select("id")
    out = _flagged(edges, curbs.select("id").union(by_place).distinct())
    return out.withColumn("curbramps", F.when(F.col("footway") == "crossing", F.col("curbramps")).otherwise(0))


def _flagged(edges: DataFrame, ids: DataFrame) -> DataFrame:
    u, v = (ids.select(F.col("id").alias(c), F.lit(1).alias(f"_{c}")) for c in ("u", "v"))
    out = edges.join(u, "u", "left").join(v, "v", "left")
    return out.withColumn("curbramps", F.greatest(F.coalesce("_u", F.lit(0)), F.coalesce("_v", F.lit(0)))).drop("_u", "_v")


def split_nodes(edges: DataFrame, nodes: DataFrame, group: str) -> DataFrame:
    """Nodes with ``group``, once for each group whose edges name them."""
    named = edges.where(F.col(group).isNotNull()).select(group, F.explode(F.array("u", "v")).alias("id")).where("id is not null").distinct()
    return named.join(nodes.drop(group), "id")


def keep_geometry_types(df: DataFrame, *kinds: str, column: str = "geometry_type") -> DataFrame:
    """Rows whose geometry is of one of some kinds."""
    return df.where(F.col(column).isin(*kinds))


def keep_columns(df: DataFrame, names: tuple[str, ...], prefixes: tuple[str, ...] = ("ext_", "ext:")) -> DataFrame:
    """The named columns, and those of a prefix, in the table's order; what else a source brings along goes."""
    return df.select([F.col(f"`{c}`") for c in df.columns if c in names or c.startswith(prefixes)])


def accessible_stations(stations: DataFrame) -> DataFrame:
    """Stations that have a place."""
    return stations.where("lon is not null and lat is not null")


def largest_first(polygons: DataFrame, key: str = "polygon_id") -> DataFrame:
    """Polygons (rings, planar) with their area, by descending area and then key."""
    return polygons.withColumn("area", G.polygon_area("rings")).orderBy(F.col("area").desc(), key)


def largest_part(parts: Column) -> Column:
    """Of the parts of a multipolygon (each an array of planar rings) the one of the largest area; null if there is none."""
    sized = F.transform(parts, lambda p: F.struct(G.polygon_area(p).alias("area"), p.alias("rings")))
    return F.get(F.array_sort(sized, lambda a, b: F.when(a["area"] > b["area"], -1).when(a["area"] < b["area"], 1).otherwise(0)), F.lit(0))["rings"]
