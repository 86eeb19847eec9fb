"""Validation and audit: structural failures as rows, and rollups of counts, shares and percentiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideway.functions import geometry as G

#: Percentiles of the descriptive statistics.
POINTS = (0.01, 0.5, 0.95, 0.99)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, count) of all values that aren't null, for all columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, value: Column, name: str) -> DataFrame:
    """One row: name, n, min, p1, p50, p95, p99, max, mean; percentiles interpolate linearly."""
    out = df.select(value.cast("double").alias("v")).where("v is not null").agg(
        F.count("v").alias("n"), F.min("v").alias("min"), F.percentile("v", F.array(*map(F.lit, POINTS))).alias("p"), F.max("v").alias("max"), F.avg("v").alias("mean")
    )
    return out.select(F.lit(name).alias("name"), "n", "min", *[F.get("p", F.lit(k)).alias(f"p{int(q * 100)}") for k, q in enumerate(POINTS)], "max", "mean")


def outliers(edges: DataFrame, length: str = "length", slope: str = "incline") -> DataFrame:
    """One row: edges that are short (< 0.5 m), long (> 500 m), of no length, and too steep (beyond 0.30 either way, sentinels aside)."""
    steep = (F.abs(slope) > 0.30) & (F.abs(slope) < 9.99)
    return edges.agg(F.count_if(F.col(length) < 0.5).alias("short"), F.count_if(F.col(length) > 500).alias("long"), F.count_if(F.col(length) == 0).alias("zero"), F.count_if(steep).alias("steep"))


def sentinel_leaks(df: DataFrame, columns: list[str], sentinel: float = 999.0) -> DataFrame:
    """(field, leaks): values that still are the sentinel."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.*").groupBy("field").agg(F.count_if(F.col("value") == sentinel).alias("leaks"))


def incline_leaks(edges: DataFrame, slope: str = "incline") -> DataFrame:
    """(field, leaks): inclines that are the sentinel, whole or divided by a hundred."""
    v = F.col(slope).cast("double")
    return edges.agg(F.lit(slope).alias("field"), F.count_if((v == 999.0) | (F.abs(v) >= 9.99)).alias("leaks"))


def elevation_outliers(nodes: DataFrame, elevation: str = "ext_elevation_m", low: float = -10.0, high: float = 200.0) -> DataFrame:
    """One row: known elevations, sentinels aside, and those that are too low or too high."""
    v = F.col(elevation).cast("double")
    usable = v.isNotNull() & (v != 999.0)
    return nodes.agg(F.count_if(usable).alias("known"), F.count_if(usable & ((v < low) | (v > high))).alias("outliers"))


def slope_compliance(nodes: DataFrame, running: str = "ext_running_slope_pct", cross: str = "ext_cross_slope_pct") -> DataFrame:
    """One row: curb ramps with a known running slope, those of at most five and of at most 8.33 per cent, and the same of cross slopes and two per cent."""
    r, c = F.col(running).cast("double"), F.col(cross).cast("double")
    known = lambda v: v.isNotNull() & (v != 999.0)
    return nodes.agg(
        F.count_if(known(r)).alias("running_known"), F.count_if(known(r) & (F.abs(r) <= 5)).alias("running_le_5pct"), F.count_if(known(r) & (F.abs(r) <= 8.33)).alias("running_le_8_33pct"),
        F.count_if(known(c)).alias("cross_known"), F.count_if(known(c) & (F.abs(c) <= 2)).alias("cross_le_2pct"),
    )


def accessibility(edges: DataFrame) -> DataFrame:
    """One row: sidewalks and crossings with a usable incline, and those of at most five percent."""
    usable = F.col("incline").isNotNull() & (F.abs("incline") < 9.99)
    out = []
    for kind in ("sidewalk", "crossing"):
        own = (F.col("highway") == "footway") & (F.col("footway") == kind)
        out += [F.count_if(own).alias(f"{kind}_edges"), F.count_if(own & usable).alias(f"{kind}_with_incline"), F.count_if(own & usable & (F.abs("incline") <= 0.05)).alias(f"{kind}_incline_le_5pct")]
    return edges.agg(*out)


def duplicate_pairs(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(a, b, n): unordered pairs of ends that more than one edge has."""
    return edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).groupBy(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def group_rollup(edges: DataFrame, group: str, areas: dict[str, float]) -> DataFrame:
    """Per group: edges, sidewalks, crossings, streets, edges per square kilometre, sidewalks per street."""
    walk = lambda kind: F.count_if((F.col("highway") == "footway") & (F.col("footway") == kind))
    streets = F.count_if(F.col("highway").isin("residential", "service", "secondary", "primary", "tertiary", "unclassified"))
    area = reduce(lambda w, kv: w.when(F.col(group) == kv[0], float(kv[1])), areas.items(), F.when(F.lit(False), 0.0))
    out = edges.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("edges"), walk("sidewalk").alias("sidewalks"), walk("crossing").alias("crossings"), streets.alias("streets"))
    return out.withColumns({"edges_per_km2": F.col("edges") / area, "sidewalk_street_ratio": F.try_divide("sidewalks", F.nullif("streets", F.lit(0)))})


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, known, share): how many rows have a value."""
    n = F.count(F.lit(1))
    row = df.agg(n.alias("n"), *[F.count(c).alias(f"k{i}") for i, c in enumerate(columns)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"k{i}").alias("known")) for i, c in enumerate(columns)]))
    return row.select("n", pairs.alias("p")).select("p.field", "p.known", F.coalesce(F.col("p.known") / F.nullif("n", F.lit(0)), F.lit(0.0)).alias("share"))


def change_counts(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """(old, new, n) of the values that change."""
    return df.select(before.alias("old"), after.alias("new")).where("not (old <=> new)").groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"))


def top_buckets(failures: DataFrame, keys: list[str], k: int, samples: int = 3, sample: str = "feature_id") -> DataFrame:
    """The k most frequent buckets with their counts and smallest ``samples`` examples; ties by the keys."""
    by = Window.partitionBy(*keys).orderBy(sample)
    counts = failures.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *keys).limit(k)
    some = failures.join(F.broadcast(counts.select(*keys)), keys, "left_semi").withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= samples)
    return counts.join(some.groupBy(*keys).agg(F.array_sort(F.collect_list(sample)).alias("samples")), keys)


def unresolved(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, u, v, missing_u, missing_v): edges that name a node which isn't there; null ends don't count."""
    ids = nodes.select("id").distinct()
    u, v = (ids.select(F.col("id").alias(c), F.lit(True).alias(f"_{c}")) for c in ("u", "v"))
    out = edges.select("id", "u", "v").join(u, "u", "left").join(v, "v", "left")
    flags = {f"missing_{c}": F.col(c).isNotNull() & F.col(f"_{c}").isNull() for c in ("u", "v")}
    return out.withColumns(flags).where("missing_u or missing_v").select("id", "u", "v", "missing_u", "missing_v")


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that no edge names."""
    named = edges.select(F.explode(F.array("u", "v")).alias("id")).where("id is not null").distinct()
    return nodes.join(named, "id", "left_anti")


def attached_share(nodes: DataFrame, edges: DataFrame, which: Column) -> DataFrame:
    """One row: nodes of a kind, how many an edge names, and their share."""
    named = edges.select(F.explode(F.array("u", "v")).alias("id")).where("id is not null").distinct().withColumn("_hit", F.lit(1))
    out = nodes.where(which).select("id").join(named, "id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("attached"))
    return out.withColumn("share", F.coalesce(F.col("attached") / F.nullif("n", F.lit(0)), F.lit(0.0)))


def structural_failures(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(check, feature_id, message): ids that repeat, edges that are no lines or name missing nodes, curbs that are no points, vertices off the globe.

    ``nodes``: id, barrier, kerb, geometry_type, line (its vertices); ``edges``: id, u, v, geometry_type, line.
    """
    both = nodes.select("id", "geometry_type", "line").unionByName(edges.select("id", "geometry_type", "line"))
    repeats = both.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    fail = lambda check, key, message: [F.lit(check).alias("check"), F.col(key).alias("feature_id"), message.alias("message")]
    unique = repeats.withColumn("_k", F.explode(F.sequence(F.lit(2), F.col("n")))).select(*fail("unique_id", "id", F.concat(F.lit("repeated id "), "id")))
    lines = edges.where((F.col("u").isNotNull() | F.col("v").isNotNull()) & (F.col("geometry_type") != "LineString")).select(*fail("edge_geometry", "id", F.concat(F.lit("edge is a "), "geometry_type")))
    lost = unresolved(edges, nodes)
    ends = [lost.where(f"missing_{c}").select(*fail(f"{c}_id_resolves", "id", F.concat(F.lit("no node "), c))) for c in ("u", "v")]
    curb = (F.col("barrier") == "kerb") | F.col("kerb").isNotNull()
    points = nodes.where(curb & (F.col("geometry_type") != "Point")).select(*fail("curb_geometry", "id", F.concat(F.lit("curb is a "), "geometry_type")))
    off = both.where(G.outside_globe("line"))
    at = G.first_outside("line")
    range_ = off.select(*fail("coordinate_range", "id", F.concat(F.lit("vertex "), at["lon"].cast("string"), F.lit(" "), at["lat"].cast("string"))))
    return reduce(DataFrame.unionByName, [unique, lines, *ends, points, range_])


def failure_rollup(failures: DataFrame, total: int) -> DataFrame:
    """(check, failures, features, pass_pct) per check, and of all checks together."""
    per = F.round(100 * (1 - F.count_distinct("feature_id") / max(total, 1)), 4)
    out = failures.groupBy("check").agg(F.count(F.lit(1)).alias("failures"), F.count_distinct("feature_id").alias("features"), per.alias("pass_pct"))
    return out.unionByName(failures.agg(F.lit("all").alias("check"), F.count(F.lit(1)).alias("failures"), F.count_distinct("feature_id").alias("features"), per.alias("pass_pct")))


def schema_failures(df: DataFrame, schema: dict, key: str = "id") -> DataFrame:
    """(check, feature_id, message): violations of a flat JSON schema, checked on all rows as column predicates.

    Understands required, properties with type, enum, const, minimum, maximum, pattern, minLength and maxLength,
    additionalProperties and patternProperties (names). A property that the table lacks is absent everywhere.
    """
    kinds = {"string": ("string",), "number": ("double", "float", "int", "bigint", "decimal"), "integer": ("int", "bigint", "smallint", "tinyint"), "boolean": ("boolean",), "array": ("array",), "object": ("struct", "map")}
    types = dict(df.dtypes)
    bad = []
    for name in schema.get("required", []):
        bad.append(F.when(F.col(name).isNull() if name in types else F.lit(True), f"{name} is required"))
    for name, rule in schema.get("properties", {}).items():
        if name not in types:
            continue
        c, have = F.col(name), types[name].split("<")[0].split("(")[0]
        wanted = [rule["type"]] if isinstance(rule.get("type"), str) else rule.get("type", [])
        if wanted and not any(have in kinds.get(w, ()) for w in wanted):
            bad.append(F.when(c.isNotNull(), f"{name} is no {' or '.join(wanted)}"))
        if "enum" in rule:
            bad.append(F.when(~c.isin(*rule["enum"]), f"{name} is none of its values"))
        if "const" in rule:
            bad.append(F.when(c != F.lit(rule["const"]), f"{name} is not {rule['const']}"))
        for word, test in (("minimum", lambda c, x: c < x), ("maximum", lambda c, x: c > x)):
            if word in rule:
                bad.append(F.when(test(c, rule[word]), f"{name} is beyond its {word}"))
        if "pattern" in rule:
            bad.append(F.when(~c.rlike(rule["pattern"]), f"{name} has another form"))
        for word, test in (("minLength", lambda n, x: n < x), ("maxLength", lambda n, x: n > x)):
            if word in rule:
                bad.append(F.when(test(F.char_length(c), rule[word]), f"{name} is beyond its {word}"))
    if schema.get("additionalProperties") is False:
        import re

        for name in types:
            if name not in schema.get("properties", {}) and not any(re.search(p, name) for p in schema.get("patternProperties", {})):
                bad.append(F.when(F.col(name).isNotNull(), f"{name} is not allowed"))
    if not bad:
        return df.sparkSession.createDataFrame([], "check string, feature_id string, message string")
    return df.select(F.lit("schema").alias("check"), F.col(key).alias("feature_id"), F.explode(F.array_compact(F.array(*bad))).alias("message"))


def root_failures(meta: dict) -> list[str]:
    """What a feature collection's root lacks."""
    out = [f"{k} is missing" for k in ("$schema", "type", "dataSource", "dataTimestamp", "pipelineVersion", "region", "features") if k not in meta]
    if meta.get("type", "FeatureCollection") != "FeatureCollection":
        out.append("type is not FeatureCollection")
    version = meta.get("pipelineVersion") or {}
    return out + [f"pipelineVersion.{k} is missing" for k in ("version", "gitSHA", "builtAt") if "pipelineVersion" in meta and k not in version]


def cleaning_rollup(raw: DataFrame, valid: Column, repaired: Column, source: str) -> DataFrame:
    """One row per source: raw, dropped, repaired and clean rows."""
    return raw.agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("n_dropped"), F.count_if(F.coalesce(valid & repaired, F.lit(False))).alias("n_repaired"), F.count_if(valid).alias("n_clean")).withColumn("source", F.lit(source))


def non_canonical(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """(value, n) of values outside an enumeration."""
    return df.where(~F.col(column).isin(*allowed)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def detached_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, detached_u, detached_v): edges whose line doesn't begin or end exactly at its node; unknown nodes don't count."""
    at = F.struct("lon", "lat")
    u, v = (nodes.select(F.col("id").alias(c), at.alias(f"_{c}")) for c in ("u", "v"))
    out = edges.join(u, "u", "left").join(v, "v", "left")
    flags = {"detached_u": F.coalesce(G.start_point("line") != F.col("_u"), F.lit(False)), "detached_v": F.coalesce(G.end_point("line") != F.col("_v"), F.lit(False))}
    return out.withColumns(flags).where("detached_u or detached_v").select("id", "detached_u", "detached_v")


def stable_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key: the same ones however the table is partitioned."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
