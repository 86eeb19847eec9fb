"""The whole build as plans: clean the sources, map them onto the model, assemble the network, validate and export it.

Every stage takes DataFrames and returns DataFrames; between stages only what later ones read twice is written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideway.functions import geometry as G
from strideway.functions import mapping as M
from strideway.functions import projection as P
from strideway.operators import assemble, audit, graph, shapes, spatial
from strideway.plans.lineage import cut


@dataclass(frozen=True)
class Settings:
    """Parameters of a build."""

    # Distances, areas and counts of a default build.
    snap_metres: float = 5.0
    merge_metres: float = 2.0
    coverage_metres: float = 10.0
    least_gap_area: float = 20.0
    least_clean_area: float = 1.0
    least_centre_line: float = 2.0
    least_component: int = 3
    version: str = "0.1.0"
    timestamp: str | None = None
    snap_after_merge: bool = False
    tag_all_boroughs: bool = True
    study_area: tuple[float, float, float, float] | None = None  # south, west, north, east


# --- cleaning ----------------------------------------------------------------------------------------------


def clean_lines(raw: DataFrame, settings: Settings) -> DataFrame:
    """Lines with plain column names, at least one vertex, and inside the study area."""
    out = M.normalize_columns(raw).where(F.size("line") > 0)
    if settings.study_area:
        s, w, n, e = settings.study_area
        out = out.where(G.intersects_box("line", w, s, e, n))
    lists = [c for c, t in out.dtypes if t == "array<string>"]
    return out.withColumns({c: M.flatten_list(F.col(c)) for c in lists}) if lists else out


def clean_points(raw: DataFrame, settings: Settings) -> DataFrame:
    """Points with plain column names and coordinates, sentinels as nulls, inside the study area."""
    out = M.sentinel_to_null(M.normalize_columns(raw)).where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")
    if settings.study_area:
        s, w, n, e = settings.study_area
        out = out.where(G.in_box(F.col("lon"), F.col("lat"), w, s, e, n))
    return out


def clean_polygons(raw: DataFrame, settings: Settings) -> DataFrame:
    """Polygons (rings of lon and lat) with usable, closed rings of at least the smallest area; ``repaired`` tells which were mended."""
    named = M.normalize_columns(raw)
    fine = F.forall("rings", lambda r: G.ring_is_valid(r))
    mended = named.withColumn("_ok", F.coalesce(fine, F.lit(False)))
    outer = F.when(F.col("_ok"), F.get("rings", F.lit(0))).otherwise(shapes.repair_ring(F.get("rings", F.lit(0))))
    holes = F.filter(F.slice("rings", 2, F.greatest(F.size("rings") - 1, F.lit(0))), lambda r: G.ring_is_valid(r))
    out = mended.withColumn("_outer", outer).where("_outer is not null").withColumn("rings", F.concat(F.array("_outer"), holes))
    planar = F.transform("rings", lambda r: P.project_line(r))
    return out.withColumn("repaired", ~F.col("_ok")).where(G.polygon_area(planar) >= settings.least_clean_area).drop("_ok", "_outer")


# --- mapping -----------------------------------------------------------------------------------------------


def _have(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def map_edges(ways: DataFrame, settings: Settings) -> DataFrame:
    """The model's edges from tagged ways (line, highway, footway, crossing, surface, name, width, osmid, key, ext_borough), with ``kind``."""
    kind = M.classify_edge(_have(ways, "highway"), _have(ways, "footway"), _have(ways, "crossing"))
    w = ways.withColumn("kind", kind).where("kind is not null and size(line) > 0")
    a, b = G.start_point("line"), G.end_point("line")
    label = F.concat_ws("_", "kind", F.coalesce(_have(ways, "key").cast("string"), F.lit("0")), M.middle_signature(F.col("line")))
    out = w.select(
        M.edge_id(a["lon"], a["lat"], b["lon"], b["lat"], label, F.lit("osm_walk")).alias("id"),
        M.node_id(a["lon"], a["lat"]).alias("u"),
        M.node_id(b["lon"], b["lat"]).alias("v"),
        "line",
        "kind",
        M.highway_of(F.col("kind"), F.col("highway")).alias("highway"),
        F.when(F.col("kind").isin("sidewalk", "crossing"), F.col("kind")).alias("footway"),
        M.surface(_have(ways, "surface")).alias("surface"),
        M.width_metres(_have(ways, "width")).alias("width"),
        M.present(_have(ways, "name")).alias("name"),
        F.when(F.col("kind") == "crossing", M.crossing_markings(_have(ways, "crossing"))).alias("crossing_markings"),
        M.present(_have(ways, "osmid")).alias("ext_osm_id"),
        M.borough_code(_have(ways, "ext_borough")).alias("ext_borough"),
    )
    return out.withColumns(M.provenance("osm_walk", settings.timestamp, settings.version))


def map_ramps(ramps: DataFrame, settings: Settings) -> DataFrame:
    """Curb nodes from surveyed ramps (lon, lat and the survey's columns)."""
    slopes = {"ext_running_slope_pct": "ramp_running_slope_total", "ext_cross_slope_pct": "ramp_cross_slope", "ext_counter_slope_pct": "counter_slope"}
    names = {"ext_ramp_id": "rampid", "ext_corner_id": "cornerid", "ext_street_1": "stname1", "ext_street_2": "stname2"}
    out = ramps.where("lon is not null and lat is not null").select(
        M.node_id(F.col("lon"), F.col("lat")).alias("id"),
        "lon",
        "lat",
        F.lit("kerb").alias("barrier"),
        F.lit("lowered").alias("kerb"),
        F.when(M.present(_have(ramps, "dws_conditions")).isNotNull(), "yes").alias("tactile_paving"),
        M.borough_code(M.borough_name(_have(ramps, "borough"))).alias("ext_borough"),
        *[M.present(_have(ramps, c)).alias(k) for k, c in names.items()],
        *[M.slope(_have(ramps, c)).alias(k) for k, c in slopes.items()],
    )
    return out.withColumns(M.provenance("nyc_dot_ramps", settings.timestamp, settings.version))


def _planar_polygons(polygons: DataFrame) -> DataFrame:
    return polygons.withColumn("rings", F.transform("rings", lambda r: P.project_line(r)))


def fill_widths(edges: DataFrame, polygons: DataFrame) -> DataFrame:
    """Sidewalks without a width take that of the smallest-numbered polygon that holds their centroid."""
    planar = _planar_polygons(polygons).select("polygon_id", "rings")
    at = assemble.line_centroids(edges.where("kind = 'sidewalk' and width is null"))
    found = spatial.first_polygon(at, planar, cell=200.0, fields=("x", "y")).where("polygon_id is not null")
    width = planar.select("polygon_id", G.strip_width(G.polygon_area("rings"), G.exterior_perimeter("rings")).alias("_w"))
    known = found.join(width, "polygon_id").groupBy("id").agg(F.min("_w").alias("_w"))
    return edges.join(known, "id", "left").withColumn("width", F.coalesce("width", "_w")).drop("_w")


def fill_gaps(polygons: DataFrame, sidewalks: DataFrame, settings: Settings) -> DataFrame:
    """Sidewalk edges along the centre lines of large enough polygons that no sidewalk comes near."""
    planar = _planar_polygons(polygons).select("polygon_id", "rings").where(G.polygon_area("rings") >= settings.least_gap_area)
    lines = sidewalks.where("kind = 'sidewalk'").select(F.col("id").alias("line_id"), P.project_line(F.col("line")).alias("line"))
    bare = cut(spatial.uncovered_polygons(planar, lines, settings.coverage_metres), "build-gaps")
    centred = bare.withColumn("flat", shapes.centerline("rings")).where(F.col("flat").isNotNull() & (G.length_planar("flat") >= settings.least_centre_line))

    def globe(p: Column) -> Column:
        lon, lat = P.inverse(p["x"], p["y"])
        return G.point(lon, lat)

    c = G.polygon_centroid(F.get("rings", F.lit(0)))
    lon, lat = P.inverse(c["x"], c["y"])
    placed = centred.select("polygon_id", F.transform("flat", globe).alias("line"), G.strip_width(G.polygon_area("rings"), G.exterior_perimeter("rings")).alias("width"), F.concat(F.lit("sidewalk|"), M.fixed(lon, 6), F.lit(","), M.fixed(lat, 6)).alias("label"))
    a, b = G.start_point("line"), G.end_point("line")
    out = placed.select(
        M.edge_id(a["lon"], a["lat"], b["lon"], b["lat"], F.col("label"), F.lit("nyc_planimetric_sidewalks")).alias("id"), M.node_id(a["lon"], a["lat"]).alias("u"), M.node_id(b["lon"], b["lat"]).alias("v"), "line",
        F.lit("sidewalk").alias("kind"), F.lit("footway").alias("highway"), F.lit("sidewalk").alias("footway"), "width",
    )
    return out.withColumns(M.provenance("nyc_planimetric_sidewalks", settings.timestamp, settings.version))


def tag_boroughs(edges: DataFrame, boroughs: DataFrame) -> DataFrame:
    """Edges without a borough take that of the smallest-named one that holds their centroid; ``boroughs``: name, rings, one row a part."""
    at = assemble.line_centroids(edges.where("ext_borough is null"))
    named = _planar_polygons(boroughs).select(M.borough_code(F.col("name")).alias("polygon_id"), "rings")
    found = spatial.first_polygon(at, named, fields=("x", "y")).select("id", F.col("polygon_id").alias("_b"))
    return edges.join(found.groupBy("id").agg(F.min("_b").alias("_b")), "id", "left").withColumn("ext_borough", F.coalesce("ext_borough", "_b")).drop("_b")


def schema_map(ways: DataFrame, ramps: DataFrame, polygons: DataFrame, boroughs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(edges, curb nodes) of the model from cleaned sources."""
    edges = fill_widths(cut(map_edges(ways, settings), "build-edges"), polygons)
    gaps = fill_gaps(polygons, edges, settings)
    every = edges.unionByName(gaps, allowMissingColumns=True)
    if settings.tag_all_boroughs:
        return tag_boroughs(cut(every, "build-mapped"), boroughs), map_ramps(ramps, settings)
    side = F.col("kind") == "sidewalk"
    tagged = tag_boroughs(cut(every.where(~side), "build-mapped"), boroughs)
    return tagged.unionByName(every.where(side)), map_ramps(ramps, settings)


# --- assembly ----------------------------------------------------------------------------------------------


def assemble_network(edges: DataFrame, curbs: DataFrame, settings: Settings, osm_nodes: DataFrame | None = None, raster: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): curbs snapped, near ends merged, missing nodes injected, one row per node, inclines from the raster."""
    own = assemble.keep_first(assemble.drop_degenerate(edges), ["id"], ["u", "v", F.size("line")])
    own = cut(own, "build-own")
    ends = cut(assemble.endpoints(own), "build-ends")
    merged, _ = assemble.merge_endpoints(own, settings.merge_metres)
    merged = cut(merged, "build-merged")
    targets = assemble.endpoints(merged) if settings.snap_after_merge else ends
    snapped = assemble.snap_curbs(curbs, targets, settings.snap_metres).drop("snapped").withColumn("_rank", F.lit(assemble.RANKS["curb"]))
    parts = [snapped]
    if osm_nodes is not None:
        parts.insert(0, osm_nodes.withColumn("_rank", F.lit(assemble.RANKS["osm"])))
    known = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    lost = assemble.missing_nodes(merged, known).withColumns({"_rank": F.lit(assemble.RANKS["injected"]), "ext_pipeline_version": F.lit(settings.version)})
    every = known.unionByName(lost, allowMissingColumns=True).withColumn("_key", F.concat_ws("|", "ext_source", F.coalesce(F.col("ext_ramp_id"), F.lit("")), "lon", "lat"))
    nodes = cut(assemble.merge_nodes(every, ["_rank", "_key"]), "build-nodes")
    if raster is None:
        return nodes, merged.withColumn("incline", F.lit(None).cast("double"))
    elevations = cut(assemble.sample_raster(nodes, *raster), "build-elevations")
    nodes = nodes.join(elevations.withColumnRenamed("elevation", "ext_elevation_m"), "id", "left")
    return nodes, assemble.edge_inclines(merged, elevations)


def topology_report(edges: DataFrame, settings: Settings) -> DataFrame:
    """One row of component figures of the edges that people walk."""
    walk = edges.where(F.col("highway").isin("footway", "steps"))
    from strideway.operators.components import connected_components

    return graph.component_summary(connected_components(walk, "u", "v"), settings.least_component)


def validate(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(check, feature_id, message) of all structural failures of a network."""
    n = nodes.select("id", "barrier", "kerb", F.lit("Point").alias("geometry_type"), F.array(G.point("lon", "lat")).alias("line"))
    return audit.structural_failures(n, edges.select("id", "u", "v", F.lit("LineString").alias("geometry_type"), "line"))


def repair(nodes: DataFrame, edges: DataFrame, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a finished network, mended: no self-loops or doubles, near nodes merged at their mean, lines on their nodes, enums canonical, sources stated."""
    kept = assemble.dedup_edges(assemble.drop_self_loops(edges))
    placed = P.with_plane(nodes.select("id", "lon", "lat")).select("id", "x", "y")
    remap = cut(spatial.merge_points(placed, tolerance), "repair-remap")
    merged = cut(assemble.repair_merge(nodes.withColumn("_o", F.col("id")), ["_o"], tolerance), "repair-nodes")
    u, v = (remap.select(F.col("id").alias(c), F.col("canonical").alias(f"_{c}")) for c in ("u", "v"))
    moved = kept.join(u, "u", "left").join(v, "v", "left").withColumns({"u": F.coalesce("_u", "u"), "v": F.coalesce("_v", "v")}).select(kept.columns)
    lines = assemble.drop_self_loops(assemble.snap_lines(assemble.dedup_edges(assemble.drop_self_loops(moved)), merged).select(kept.columns))
    source = F.coalesce(F.col("ext_source"), M.heuristic_source(F.lit(True), F.col("ext_osm_id"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    out = lines.withColumns({"surface": M.repair_surface(F.col("surface")), "crossing_markings": M.repair_markings(F.col("crossing_markings")), "ext_source": source})
    return merged.drop("merged"), out
