"""Exact top-k by inner product: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz residual bounds.

The components become integers, floor(scale * x). The vectors' second moments (a d x d sum) give, on the
driver, the rotation that puts most of their length into the first components. The vectors are dealt by
descending length into blocks of a bounded number. Each query first meets the longest vectors of all, a
seed of fixed size, which gives it a threshold: its k-th best score so far. By Cauchy-Schwarz a block whose longest
vector times the query's length stays below the threshold can't matter, so a query goes only to a prefix of
the blocks. Inside a block the vectors are scanned in strips of descending length; a strip first gets the
partial sums over the leading rotated components, and what these plus the product of both residual
lengths leave below the threshold is pruned. What remains gets its exact integer score.

Queries that need about as many blocks make a group, and a block goes to the groups that need it, to no other. Blocks
and groups are of bounded size, so a task holds one block and one group of queries; what leaves it is at
most k rows per query and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideway.llm import text_kernel
from strideway.plans.lineage import cut

SCALE = 256
K = 5
#: Vectors in a block, about.
BLOCK = 16_384
#: Queries in a group, about.
GROUP = 4_096
#: Longest vectors that every query meets first.
SEED = 1_024
#: Vectors in a strip, which is scanned with one threshold per query.
STRIP = 2_048
#: Components that are rotated; those of longer vectors from here on are left as they are.
ROTATED = 1_024
#: Integers up to here are exact in double precision, and in 64 bits.
_EXACT, _LONG = 2.0**52, 2.0**62


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of lists as a matrix, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, dtype=int)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _moments(full: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = min(full, ROTATED)
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), full)[:, :width].astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def _exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < _LONG:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -(2**63), 2**63 - 1).astype(np.int64)


def _rotated(m: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    out = m.astype(np.float64)
    out[:, : len(rotation)] = out[:, : len(rotation)] @ rotation
    return out


def best_of(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, rotation: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of queries, id, score): for each query its best at least ``least``, k at most, ties to the smaller id.

    Vectors come by descending length. A vector with the query's own id doesn't count.
    """
    width = queries.shape[1]
    head = max(1, min(width, len(rotation) // 4))
    rotated_q, rotated_v = _rotated(queries, rotation), _rotated(vectors, rotation)
    rest_q, rest_v = np.linalg.norm(rotated_q[:, head:], axis=1), np.linalg.norm(rotated_v[:, head:], axis=1)
    long_q, long_v = np.linalg.norm(rotated_q, axis=1), np.linalg.norm(rotated_v, axis=1)
    bar = least.astype(np.float64).copy()
    rows, found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a in range(0, len(vectors), STRIP):
        b = min(len(vectors), a + STRIP)
        live = np.flatnonzero(long_q * long_v[a] * (1 + 1e-9) + 0.5 >= bar)
        if not len(live):
            break  # the vectors that follow are no longer, but other queries stopped before
        bound = rotated_q[live, :head] @ rotated_v[a:b, :head].T
        bound += np.multiply.outer(rest_q[live], rest_v[a:b])
        slack = 0.5 + 1e-9 * long_q[live] * long_v[a]
        hit = bound + slack[:, None] >= bar[live, None]
        cols = np.flatnonzero(hit.any(axis=0))
        some = np.flatnonzero(hit.any(axis=1))
        if not len(cols):
            continue
        q = live[some]
        exact = _exact_scores(queries[q], vectors[a + cols])
        keep = hit[np.ix_(some, cols)] & (exact >= bar[q, None]) & (query_ids[q, None] != ids[None, a + cols])
        i, j = np.nonzero(keep)
        rows, found, scores = np.concatenate([rows, q[i]]), np.concatenate([found, ids[a + cols[j]]]), np.concatenate([scores, exact[i, j]])
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        full = place == k - 1
        bar[rows[full]] = np.maximum(bar[rows[full]], scores[full])
        top = place < k
        rows, found, scores = rows[top], found[top], scores[top]
    return rows, found, scores


def _tile(width: int, k: int, rotation: np.ndarray):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not queries.num_rows or not vectors.num_rows:
            return empty
        vectors = vectors.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        ids, query_ids = vectors.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        rows, found, scores = best_of(_matrix(queries.column("v"), width), query_ids, _matrix(vectors.column("v"), width), ids, k, rotation, queries.column("least").to_numpy())
        return pa.table({"query_id": query_ids[rows], "vec_id": found, "score": scores})

    return run


def _first(width: int, k: int, rotation: np.ndarray, seed: np.ndarray, seed_ids: np.ndarray):
    lowest = np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, ids = _matrix(batch.column(1), width), batch.column(0).to_numpy()
            least = np.full(len(ids), lowest)
            for a in range(0, len(ids), GROUP):
                rows, _, scores = best_of(m[a : a + GROUP], ids[a : a + GROUP], seed, seed_ids, k, rotation, least[a : a + GROUP])
                last = np.arange(len(rows)) - np.searchsorted(rows, rows) == k - 1
                least[a + rows[last]] = scores[last]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least)], names=["query_id", "v", "least"])

    return run


def _dealt_groups(counts: dict[int, int]) -> list[tuple[int, int, int]]:
    """(need, first group, groups) so that a group holds about ``GROUP`` queries of much the same need."""
    out, group, held = [], 0, 0
    for need, n in sorted(counts.items(), reverse=True):
        if held and held + n > GROUP:
            group, held = group + 1, 0
        split = -(-n // GROUP)
        out.append((need, group, split))
        group, held = (group + split, 0) if split > 1 else (group, held + n)
    return out


def _needed(tops: np.ndarray):
    """Adds how many blocks each query needs: as a block's longest vector bounds its scores, a prefix of them; ``tops``: their longest norms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, least = batch.column(2).to_numpy(), batch.column(3).to_numpy().astype(np.float64)
            reach = np.where(norm > 0, (least - 0.5) / (np.maximum(norm, 1e-300) * (1 + 1e-9)), np.where(least <= 0.5, -np.inf, np.inf))
            need = np.searchsorted(-tops, -reach, side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(need, pa.int32())], names=["query_id", "v", "norm", "least", "need"])

    return run


def top_k(embeddings: DataFrame, k: int = K, every: int = 50, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose vec_id ``every`` divides, its ``k`` best others.

    Each component x counts as floor(``scale`` * x), in double precision; the score is the integer inner product;
    ties go to the smaller vec_id; fewer candidates give fewer rows. A query's own rows (all with its vec_id)
    aren't its candidates.

    Vectors that are null, or hold null or non-finite components, and rows without vec_id take no part.
    Vectors of different lengths are compared as if zeros filled the shorter one. Rows that repeat a vec_id
    are candidates of their own; of a repeated query's rows the first by components asks. A scaled component beyond
    64 bits counts as the nearest 64-bit integer, and so does a score. An empty table gives no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    whole = F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))")
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    v = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    vectors = cut(v.withColumn("norm", norm), "topk-vectors")
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = stats["n"], max(1, stats["width"] or 1)
    result = "query_id long, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    partial = vectors.select("v").mapInArrow(text_kernel.tidy(_moments(width)), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    moments = np.zeros((min(width, ROTATED),) * 2)
    for row in partial.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():  # ROTATED * ROTATED numbers at most
        moments[row["i"], row["j"]] = row["x"]
    rotation = np.linalg.eigh(moments)[1][:, ::-1].copy()

    head = vectors.orderBy(F.col("norm").desc(), "vec_id").limit(SEED).collect()
    seed = np.zeros((len(head), width), dtype=np.int64)
    for i, row in enumerate(head):
        seed[i, : len(row["v"])] = row["v"]
    seed_ids = np.array([row["vec_id"] for row in head], dtype=np.int64)
    asked = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    queries = cut(asked.mapInArrow(text_kernel.tidy(_first(width, k, rotation, seed, seed_ids)), "query_id long, v array<long>, least long"), "topk-queries")

    blocks = -(-n // BLOCK)
    dealt = cut(vectors.repartitionByRange(blocks, F.col("norm").desc(), "vec_id").withColumn("part", F.spark_partition_id()), "topk-blocks")
    tops = sorted(((r["top"], r["part"]) for r in dealt.groupBy("part").agg(F.max("norm").alias("top")).collect()), key=lambda x: (-x[0], x[1]))  # one number for each block
    place = spark.createDataFrame([(part, k) for k, (_, part) in enumerate(tops)], "part int, block int")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    needed = queries.select("query_id", "v", length.alias("norm"), "least").mapInArrow(text_kernel.tidy(_needed(np.array([t for t, _ in tops]))), "query_id long, v array<long>, norm double, least long, need int")
    needed = cut(needed, "topk-needed")
    dealer = spark.createDataFrame(_dealt_groups({r["need"]: r["count"] for r in needed.groupBy("need").count().collect()}), "need int, start int, split int")  # one row for each number of blocks
    own_group = F.col("start") + F.pmod(F.xxhash64("query_id"), F.col("split")).cast("int")
    grouped = needed.join(F.broadcast(dealer), "need").select("query_id", "v", "least", "need", own_group.alias("grp"))
    sent = grouped.where("need > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("need") - 1)))
    wanted = grouped.groupBy("grp").agg(F.max("need").alias("need")).where("need > 0").toDF("wanted_by", "need")
    pairs = wanted.select(F.col("wanted_by").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("need") - 1)).alias("block"))
    copies = dealt.join(F.broadcast(place), "part").join(pairs, "block")
    tiles = sent.select("block", "grp", "query_id", "v", "least").groupBy("block", "grp").cogroup(copies.select("block", "grp", "vec_id", "norm", "v").groupBy("block", "grp"))
    best = tiles.applyInArrow(text_kernel.tidy_pair(_tile(width, k, rotation)), result)
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB.
TOP_K_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
    where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as place, vec_id, score from scored
)
select query_id, place::int as rank, vec_id, score from ranked where place <= 5
"""
