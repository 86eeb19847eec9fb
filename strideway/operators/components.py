"""Connected components of an edge list: smallest label of each component, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.plans.lineage import cut, discard


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component): each node that an edge names, with the smallest node of its component.

    Edges are undirected; self-loops name a node without linking it; rows with a null end are ignored.
    A round lets every node point to its smallest neighbour, if that is smaller, and doubles the pointers up to the
    trees' roots; then roots stand for their trees, and only edges between different ones stay. The graph so shrinks to at
    most its local minima in each round, and the smallest node of a component is never replaced. At the end all nodes go
    through the rounds' maps. Every step is written to the shared folder; nothing but counts of at most one row comes
    to the driver, and no table of nodes is broadcast, however well it compresses.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    pairs = cut(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-links")
    links, maps = pairs.where("u <> v"), []
    for _ in range(max_rounds):
        # The greater end of a pair has a smaller neighbour.
        up = cut(links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("up")), "cc-up")
        if not up.limit(1).count():
            discard(up)
            break
        while True:
            further = up.select(F.col("node").alias("up"), F.col("up").alias("next")).hint("merge")
            after = cut(up.join(further, "up", "left").select("node", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "cc-up")
            discard(up)
            moved = after.where("moved").limit(1).count()
            up = after.drop("moved")
            up._strideway_path = after._strideway_path
            if not moved:
                break
        maps.append(up)
        ends = [up.select(F.col("node").alias(c), F.col("up").alias(f"_{c}")).hint("merge") for c in ("u", "v")]
        a, b = F.coalesce("_u", "u"), F.col("_v")  # each greater end has been replaced
        renamed = links.join(ends[1], "v").join(ends[0], "u", "left").select(a.alias("u"), b.alias("v")).where("u <> v")
        fewer = cut(renamed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-links")
        if links is not pairs and len(maps) > 1:
            discard(links)
        links = fewer
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    state = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().withColumn("component", F.col("node"))
    if maps:
        # Later maps hold far fewer nodes: they are joined with each other before the first, which all nodes meet.
        whole = maps[-1]
        for earlier in reversed(maps[:-1]):
            later = whole.select(F.col("node").alias("up"), F.col("up").alias("next")).hint("merge")
            moved = earlier.join(later, "up", "left").select("node", F.coalesce("next", "up").alias("up"))
            whole = cut(moved.union(whole), "cc-up")
        state = state.join(whole.hint("merge"), "node", "left").select("node", F.coalesce("up", "component").alias("component"))
    out = cut(state, "cc-labels")
    discard(pairs, links, *maps)
    return out
