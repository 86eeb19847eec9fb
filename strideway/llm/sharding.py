"""Sharding by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets that fit into memory (a shuffle on disk); pass
two shuffles each bucket with Fisher-Yates and writes it, once, to the shared folder. From then on every
record has a fixed place: its bucket's offset plus its rank there. Under the law ``rows`` the shards are
equal ranges of places, so their counts differ by one at most; under ``key`` the shard comes from doc_id
and the number of shards alone, by rendezvous hashing, and the places give the order inside a shard.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.plans.lineage import cut

SHARDS = 40
SEED = 20240517
#: Bytes of text that a bucket holds, about: what one task has in memory.
BUCKET_BYTES = 32 << 20
#: Bytes of a record besides its text.
RECORD_BYTES = 16


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A permutation of 0..n-1, all equally likely: swap each place, from the last, with one not after it."""
    order = list(range(n))
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _shuffle_bucket(seed: int):
    def run(bucket: pa.Table) -> pa.Table:
        at = bucket.column("_sw_bucket")[0].as_py()
        bucket = bucket.sort_by([("_sw_order", "ascending"), ("doc_id", "ascending")])
        order = fisher_yates(bucket.num_rows, np.random.Generator(np.random.PCG64([seed, at])))
        bucket = bucket.drop_columns(["_sw_order"]).take(pa.array(order))
        return bucket.append_column("_sw_rank", pa.array(np.arange(bucket.num_rows, dtype=np.int64)))

    return run


def shuffled(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents' doc_id, text and text_crc32 with _sw_bucket and _sw_rank, written to the shared folder as shuffled buckets."""
    text = F.col("text").cast("string")
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    total = slim.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES)).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    # Rows without doc_id are told apart by where they stand, so that many of them don't meet in one bucket.
    salt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), crc, salt)
    dealt = slim.select("doc_id", "text", crc.alias("text_crc32"), order.alias("_sw_order")).withColumn("_sw_bucket", F.pmod(F.xxhash64(F.lit(seed), "_sw_order"), F.lit(buckets)).cast("int"))
    # As many partitions as the data needs, so that a task's share is a few buckets at any size.
    out = dealt.repartition(2 * buckets, "_sw_bucket").groupBy("_sw_bucket").applyInArrow(K.tidy(_shuffle_bucket(seed)), "doc_id long, text string, text_crc32 long, _sw_bucket int, _sw_rank long")
    return cut(out, "shards")


def _by_key(doc_id, shards: int):
    """Rendezvous hashing: the shard whose hash with the key is largest; one more shard takes keys only into itself."""
    best = F.array_max(F.array(*[F.struct(F.xxhash64(F.lit(SEED + 1 + s), doc_id), F.lit(s).alias("shard")) for s in range(shards)]))
    return best["shard"]


def shard(documents: DataFrame, shards: int = SHARDS, law: str = "rows", seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: all shards' counts are at most one apart, whatever the ids, sizes or copies. Law ``key``: doc_id
    and ``shards`` alone decide (rows without doc_id, or that repeat one, go together), and grown_shard is
    the shard among one more, which is the same or the new one. slot counts from 0 inside each shard,
    without gaps, in shuffled order. size is the text's UTF-8 bytes plus 16.

    Null text: no bytes, crc 0, as an empty one. Equal texts, and repeated rows, are records of their own.
    The order depends on the seed, ids and texts alone. An empty table gives no rows. Other columns are ignored.
    """
    placed = shuffled(documents, seed)
    counts = placed.groupBy("_sw_bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # one number for each bucket of tens of MB
    starts, at = [], 0
    for row in sorted(counts):
        starts.append((row["_sw_bucket"], at))
        at += row["n"]
    total = at
    spark = documents.sparkSession
    offsets = spark.createDataFrame(starts, "_sw_bucket int, _sw_start long")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + RECORD_BYTES
    rows = placed.join(F.broadcast(offsets), "_sw_bucket").withColumn("_sw_place", F.col("_sw_start") + F.col("_sw_rank"))
    keys = ["doc_id", "text", size.alias("size"), "text_crc32", F.lit(law).alias("law")]
    if law == "rows":
        # Place p goes to shard p * shards div total; a shard's first place is the ceiling of shard * total / shards.
        s = F.expr(f"_sw_place * {shards} div {max(total, 1)}")
        first = F.expr(f"(_sw_shard * {total} + {shards - 1}) div {shards}")
        return rows.withColumn("_sw_shard", s).select(*keys, F.col("_sw_shard").cast("int").alias("shard"), (F.col("_sw_place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    if law != "key":
        raise ValueError(f"no such law: {law}")
    keyed = rows.withColumn("_sw_shard", _by_key(F.col("doc_id"), shards))
    # The slot is a rank: counts per bucket and shard give each bucket's first slot, ranks inside a bucket the rest.
    inside = keyed.withColumn("_sw_in", F.row_number().over(Window.partitionBy("_sw_bucket", "_sw_shard").orderBy("_sw_rank")) - 1)
    per = keyed.groupBy("_sw_shard", "_sw_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_sw_shard").orderBy("_sw_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("_sw_shard", "_sw_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_sw_base"))
    joined = inside.join(base, ["_sw_shard", "_sw_bucket"])
    return joined.select(*keys, F.col("_sw_shard").cast("int").alias("shard"), (F.col("_sw_base") + F.col("_sw_in")).alias("slot"), _by_key(F.col("doc_id"), shards + 1).cast("int").alias("grown_shard"))
