"""Graph operators over edge tables: components, degrees, intersections, directed expansion, shortest paths."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideway.operators.components import connected_components
from strideway.plans.lineage import cut, discard


def components_with_isolated(nodes: DataFrame, edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, component) of all nodes (id); edges with an unknown end or without two ends don't link."""
    known = nodes.select(F.col("id").alias("node")).distinct()
    e = edges.where(F.col(src) != F.col(dst)).select(src, dst)
    e = e.join(known.withColumnRenamed("node", src), src, "left_semi").join(known.withColumnRenamed("node", dst), dst, "left_semi")
    return known.join(connected_components(e, src, dst), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))


def size_histogram(components: DataFrame) -> DataFrame:
    return component_sizes(components).groupBy("nodes").agg(F.count(F.lit(1)).alias("components"))


def giant(components: DataFrame) -> DataFrame:
    """The nodes of the largest component; of equal ones the one with the smallest label."""
    top = component_sizes(components).orderBy(F.col("nodes").desc(), "component").limit(1).select("component")
    return components.join(F.broadcast(top), "component", "left_semi").select("node")


def component_summary(components: DataFrame, least: int = 3) -> DataFrame:
    """One row: nodes, components, the giant's nodes and share, components of at least ``least`` nodes."""
    return component_sizes(components).agg(
        F.coalesce(F.sum("nodes"), F.lit(0)).alias("n_nodes"),
        F.count(F.lit(1)).alias("n_components"),
        F.coalesce(F.max("nodes"), F.lit(0)).alias("giant_size"),
        F.coalesce(F.max("nodes") / F.sum("nodes"), F.lit(0.0)).alias("giant_pct"),
        F.count_if(F.col("nodes") >= least).alias("n_large"),
    )


def component_shares(edges: DataFrame, group: str, src: str = "u", dst: str = "v") -> DataFrame:
    """Per group: edges, nodes, components, the giant's nodes and its share of the group's nodes, in each group's own graph."""
    counted = edges.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("edges"))
    sizes = components_by(edges, group, src, dst).groupBy(group, "component").agg(F.count(F.lit(1)).alias("n"))
    per = sizes.groupBy(group).agg(F.sum("n").alias("nodes"), F.count(F.lit(1)).alias("components"), F.max("n").alias("giant_size"), (F.max("n") / F.sum("n")).alias("giant_pct"))
    return counted.join(per, group, "left")


def components_by(edges: DataFrame, group: str, src: str = "u", dst: str = "v") -> DataFrame:
    """(group, node, component): the components of each group's own graph."""
    ends = [F.struct(F.col(group).alias("g"), F.col(c).alias("n")) for c in (src, dst)]
    found = connected_components(edges.where(F.col(group).isNotNull()).select(ends[0].alias("a"), ends[1].alias("b")), "a", "b")
    return found.select(F.col("node.g").alias(group), F.col("node.n").alias("node"), F.col("component.n").alias("component"))


def undirected(edges: DataFrame, src: str = "u", dst: str = "v", extra: tuple[str, ...] = ()) -> DataFrame:
    """Distinct unordered pairs, as u <= v."""
    return edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(*extra, F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).distinct()


def degrees(edges: DataFrame, src: str = "u", dst: str = "v", group: str | None = None) -> DataFrame:
    """(node, degree) in the undirected simple graph; a self-loop counts twice."""
    extra = (group,) if group else ()
    pairs = undirected(edges, src, dst, extra)
    return pairs.select(*extra, F.explode(F.array("u", "v")).alias("node")).groupBy(*extra, "node").agg(F.count(F.lit(1)).alias("degree"))


def intersections(streets: DataFrame, crossings: DataFrame, group: str, least: int = 3) -> DataFrame:
    """Per group: street nodes of degree ``least`` or more, and how many of them a crossing touches."""
    inter = degrees(streets, group=group).where(F.col("degree") >= least).select(group, "node")
    touched = crossings.select(group, F.explode(F.array("u", "v")).alias("node")).where("node is not null").distinct().withColumn("hit", F.lit(1))
    return (
        inter.join(touched, [group, "node"], "left")
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("intersections"), F.count("hit").alias("with_crossing"))
        .withColumn("pct_with_crossing", F.col("with_crossing") / F.col("intersections"))
    )


def directed(edges: DataFrame, src: str = "u", dst: str = "v", negate_incline: bool = False) -> DataFrame:
    """Every edge and its reverse with the same attributes; the incline keeps its sign unless asked to turn it."""
    back = edges.withColumns({src: F.col(dst), dst: F.col(src)})
    if negate_incline and "incline" in edges.columns:
        back = back.withColumn("incline", -F.col("incline"))
    return edges.unionByName(back)


def collapse_parallel(edges: DataFrame, order: Column, src: str = "u", dst: str = "v") -> DataFrame:
    """One edge per unordered pair, the last in ``order``: what a simple undirected graph keeps."""
    rest = [c for c in edges.columns if c not in (src, dst)]
    last = F.max_by(F.struct(*rest), order) if rest else F.lit(None)
    out = edges.groupBy(F.least(src, dst).alias(src), F.greatest(src, dst).alias(dst)).agg(last.alias("_last"))
    return out.select(src, dst, *[F.col(f"_last.{c}").alias(c) for c in rest])


def dense_index(nodes: DataFrame, key: str = "id") -> DataFrame:
    """(key, index): 0 to n-1 in key order, without a single sort of all rows: ranks inside ranges plus the ranges' offsets."""
    ranged = cut(nodes.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key).withColumn("_p", F.spark_partition_id()), "dense-index")
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1
    counts = sorted((r["_p"], r["count"]) for r in ranged.groupBy("_p").count().collect())  # one number per range
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = nodes.sparkSession.createDataFrame(starts, "_p int, _start long")
    return ranged.withColumn("_rank", rank).join(F.broadcast(offsets), "_p").select(key, (F.col("_start") + F.col("_rank")).alias("index"))


def shortest_paths(edges: DataFrame, cost: Column, origin: str, target: str | None = None, max_hops: int | None = None, is_directed: bool = False) -> DataFrame:
    """(node, distance, hops, previous) reached from ``origin`` (Bellman-Ford by frontiers).

    ``edges`` has u and v; a null ``cost`` closes an edge; of parallel edges the cheapest counts. A round relaxes the
    nodes that the last one improved, until none is; more than ``max_hops`` rounds, if that is given, are an error. With a ``target``
    the search ends when no frontier node is closer than it. What a round improves is appended; the whole state is written anew only once the
    improvements have doubled it, so writing stays in proportion to what is improved.
    """
    spark = edges.sparkSession
    both = edges if is_directed else directed(edges)
    arcs = cut(both.select("u", "v", cost.cast("double").alias("cost")).where("cost is not null and u <> v").groupBy("u", "v").agg(F.min("cost").alias("cost")), "paths-arcs")
    kind = dict(arcs.dtypes)["u"]
    schema = f"node {kind}, distance double, hops int, previous {kind}"
    start = spark.createDataFrame([(origin, 0.0, 0, None)], schema)
    best_of = lambda df: df.groupBy("node").agg(F.min(F.struct("distance", "hops", "previous")).alias("b")).select("node", "b.*")
    base, added, frontier, base_rows, added_rows = start, [], start, 1, 0
    for hop in itertools.count(1):
        state = reduce(DataFrame.unionByName, added, base)
        reach = frontier.join(arcs, F.col("node") == F.col("u")).select(F.col("v").alias("node"), (F.col("distance") + F.col("cost")).alias("distance"), F.lit(hop).alias("hops"), F.col("u").alias("previous"))
        old = state.groupBy("node").agg(F.min("distance").alias("_d"))
        better = cut(best_of(reach).join(old, "node", "left").where("_d is null or distance < _d").drop("_d"), "paths-frontier")
        live = better
        if target is not None:
            bound = state.unionByName(better).where(F.col("node") == F.lit(target)).agg(F.min("distance")).first()[0]
            live = better if bound is None else better.where((F.col("distance") < bound) | (F.col("node") == F.lit(target)))
        n = better.count()
        if not n or target is not None and not live.limit(1).count():
            break
        if max_hops is not None and hop > max_hops:
            raise RuntimeError(f"paths did not settle in {max_hops} rounds")
        added, added_rows, frontier = [*added, better], added_rows + n, live
        if added_rows >= base_rows or len(added) >= 16:
            whole = cut(best_of(reduce(DataFrame.unionByName, added, base)), "paths-state")
            discard(base, *added[:-1])
            base, base_rows, added, added_rows = whole, whole.count(), [], 0
    out = cut(best_of(reduce(DataFrame.unionByName, added, base)), "paths")
    discard(arcs, base, *added)
    return out


def route(paths: DataFrame, target: str) -> list[str]:
    """The nodes from the origin to ``target``, from the (node, hops, previous) of one search; empty if there is no way.

    Ancestors are found by doubling: a table of each node's 2^k-th one, so the joins grow with the logarithm of the way's length.
    """
    end = paths.where(F.col("node") == F.lit(target)).select("hops").first()
    if end is None:
        return []
    jump = paths.where("previous is not null").select("node", F.col("previous").alias("up"))
    jumps = [jump]
    while 2 ** len(jumps) <= end["hops"]:
        far = jump.select(F.col("node").alias("up"), F.col("up").alias("next"))
        jump = cut(jump.join(far, "up").select("node", F.col("next").alias("up")), "route-jumps")
        jumps.append(jump)
    found = paths.where(F.col("node") == F.lit(target)).select("node", F.lit(0).alias("steps"))
    for k in reversed(range(len(jumps))):
        higher = found.join(jumps[k], "node").select(F.col("up").alias("node"), (F.col("steps") + 2**k).alias("steps"))
        found = cut(found.union(higher).distinct(), "route-found")
    rows = found.orderBy(F.col("steps").desc()).collect()  # one row for each node of the way
    discard(*jumps[1:], found)
    return [r["node"] for r in rows]


def route_summary(paths: DataFrame, target: str) -> DataFrame:
    """One row: edges and total length of the way to ``target``; no row if there is none."""
    return paths.where(F.col("node") == F.lit(target)).select(F.col("hops").alias("edges"), F.col("distance").alias("total_length_m"))
