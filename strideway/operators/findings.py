"""The audit's findings: thirteen tables of features that break a rule, each with its order and the most rows a report takes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideway.functions import geometry as G
from strideway.functions import mapping as M
from strideway.functions import projection as P
from strideway.operators import audit, graph

# The box and the areas (square kilometres) of the reports, and what counts as a street there.
BOX = (-74.2591, 40.4774, -73.7004, 40.9176)
AREAS = {"MN": 59.1, "BK": 179.6, "QN": 281.5, "BX": 109.0, "SI": 151.2}
STREETS = ("residential", "service", "secondary", "primary", "tertiary", "unclassified", "trunk", "living_street")
#: Columns of nodes and edges that may hold the sentinel 999.
SLOPES = ("ext_running_slope_pct", "ext_cross_slope_pct", "ext_counter_slope_pct", "ext_elevation_m")


@dataclass(frozen=True)
class Finding:
    rows: DataFrame
    order: tuple[str, ...]
    limit: int | None = None  # of the written report; ``rows`` are whole


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def out_of_box(nodes: DataFrame, edges: DataFrame, box: tuple[float, float, float, float] = BOX) -> DataFrame:
    """(id, type, lon, lat): points outside the box, and of lines the first vertex outside it."""
    away = lambda p: ~G.in_box(p["lon"], p["lat"], *box)
    points = nodes.where(~G.in_box(F.col("lon"), F.col("lat"), *box)).select("id", F.lit("Point").alias("type"), "lon", "lat")
    first = F.get(F.filter("line", away), F.lit(0))
    lines = edges.where(F.exists("line", away)).select("id", F.lit("LineString").alias("type"), first["lon"].alias("lon"), first["lat"].alias("lat"))
    return points.unionByName(lines)


def sentinels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, type, field, value): values that still are the sentinel; inclines also where it was divided by a hundred."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), _optional(nodes, c, "double").alias("value")) for c in SLOPES]))
    points = nodes.select("id", F.lit("Point").alias("type"), pairs.alias("p")).select("id", "type", "p.field", "p.value").where("value = 999.0")
    slope = _optional(edges, "incline", "double")
    lines = edges.where((slope == 999.0) | (F.abs(slope) >= 9.99)).select("id", F.lit("LineString").alias("type"), F.lit("incline").alias("field"), slope.alias("value"))
    return points.unionByName(lines)


def duplicates(edges: DataFrame) -> DataFrame:
    """(id, u, v, highway, footway): edges that share their two ends, whichever way round, with another one."""
    ends = [F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")]
    known = edges.where("u is not null and v is not null").select("id", "u", "v", "highway", "footway", *ends)
    return known.join(audit.duplicate_pairs(edges).select("a", "b"), ["a", "b"], "left_semi").drop("a", "b")


def steep(edges: DataFrame) -> DataFrame:
    """(id, highway, incline): inclines beyond 0.30 either way that aren't sentinels."""
    slope = F.col("incline").cast("double")
    return edges.where((F.abs(slope) > 0.30) & (F.abs(slope) < 9.99)).select("id", "highway", slope.alias("incline"))


def borough_summary(edges: DataFrame, areas: dict[str, float]) -> DataFrame:
    """One row for each borough of ``areas``: its edges between known ends, densities, crossings at intersections and components."""
    group = "ext_borough"
    own = edges.where(F.col(group).isin(*areas) & F.col("u").isNotNull() & F.col("v").isNotNull())
    crossing = (F.col("highway") == "footway") & (F.col("footway") == "crossing")
    rolled = audit.group_rollup(own, group, areas)
    touched = graph.intersections(own.where(F.col("highway").isin(*STREETS)), own.where(crossing), group)
    parts = graph.component_shares(own, group).select(group, F.col("components").alias("n_components"), "giant_pct")
    every = edges.sparkSession.createDataFrame([(b,) for b in areas], f"{group} string")
    out = every
    for part in (rolled, touched, parts):
        out = out.join(part, group, "left")
    ratio = F.col("sidewalk_street_ratio")
    zero = [c for c in out.columns if c not in (group, "sidewalk_street_ratio")]
    return out.select(F.col(group).alias("borough"), *[F.coalesce(c, F.lit(0)).alias(c) for c in zero], ratio)


def findings(nodes: DataFrame, edges: DataFrame, box: tuple[float, float, float, float] = BOX, areas: dict[str, float] | None = None, failures: DataFrame | None = None) -> dict[str, Finding]:
    """All findings by name.

    ``nodes``: id, lon, lat and the slopes there are; ``edges``: id, u, v, highway, footway, surface, incline, ext_borough, line.
    ``failures``: (check, feature_id, message) of a validation; without it the structural ones of no table are reported.
    A line of fewer than two vertices has no length and is in none of the three findings on lengths. Null ends are neither
    loops nor unresolved. An edge is a duplicate if another has the same two ends, whichever way round.
    """
    length = F.when(F.size("line") >= 2, G.length_planar("_plane"))
    placed = edges.withColumn("_plane", P.project_line(F.col("line"))).withColumn("_m", F.explode(F.array(length))).drop("_plane")
    names = ["id", "u", "v", "highway", "footway"]
    long_ = placed.select(*names, F.col("_m").alias("length_m"))
    lost = audit.unresolved(edges, nodes).select("id", "u", "v", F.col("missing_u").cast("int").alias("missing_u"), F.col("missing_v").cast("int").alias("missing_v"))
    if failures is None:
        failures = edges.sparkSession.createDataFrame([], "check string, feature_id string, message string")
    buckets = failures.groupBy(F.concat_ws("::", "check", "message").alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    surfaces = audit.non_canonical(edges.where("surface <> ''"), "surface", M.SURFACES).withColumnsRenamed({"value": "surface_value", "n": "count"})
    return {
        "edges_short_lt_0.5m": Finding(long_.where("length_m > 0 and length_m < 0.5"), ("id",)),
        "edges_long_gt_500m": Finding(long_.where("length_m > 500"), ("id",)),
        "edges_zero_length": Finding(long_.where("length_m = 0").drop("footway", "length_m"), ("id",)),
        "out_of_bbox_features": Finding(out_of_box(nodes, edges, box), ("id", "type"), 5_000),
        "self_loop_edges": Finding(edges.where("u = v").select(*names), ("id",)),
        "duplicate_edges": Finding(duplicates(edges), ("id",)),
        "edges_unresolved_uv": Finding(lost, ("id", "u", "v"), 5_000),
        "incline_out_of_range": Finding(steep(edges), ("id",)),
        "sentinel_999_leaks": Finding(sentinels(nodes, edges), ("id", "field")),
        "orphan_nodes": Finding(audit.orphans(nodes, edges).select("id"), ("id",), 10_000),
        "borough_summary": Finding(borough_summary(edges, areas or AREAS), ("borough",)),
        "schema_top_failures": Finding(buckets, ("-count", "bucket"), 50),
        "surface_noncanonical": Finding(surfaces, ("-count", "surface_value")),
    }


def counts(found: dict[str, Finding]) -> DataFrame:
    """(finding, n): the whole number of rows of each finding, not that of its report."""
    out = None
    for name, one in found.items():
        row = one.rows.agg(F.lit(name).alias("finding"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out
