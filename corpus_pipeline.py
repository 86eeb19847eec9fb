"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideway.llm import decontamination, line_dedup, near_dup, packing, quality
from strideway.llm.queries import table, tokenizer_path
from strideway.plans.lineage import cut

#: Ids of several texts that may be broadcast, 8 bytes each; more are joined by shuffling.
MANY = 1_000_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (a score of at least 0.5)."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    score = quality.scorer(model)(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.where(score >= 0.5)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of repeated three-line windows; n_chars follows the text."""
    out = line_dedup.remove_repeated_lines(docs)
    changed = F.col("_sw_n_removed") > 0
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of each row, and _sw_key: doc_id, or a hash of both where doc_id is null or names several texts.

    So stages decide by document, and rows that repeat both doc_id and text are one.
    """
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(text).alias("lo"), F.max(text).alias("hi"))
    several = cut(texts.where("lo <> hi").select(F.col("doc_id").alias("_sw_id"), F.lit(True).alias("_sw_several")), "ids-of-several-texts")
    known = several if several.limit(MANY + 1).count() > MANY else F.broadcast(several)
    joined = docs.join(known, F.col("doc_id") == F.col("_sw_id"), "left")
    key = F.when(F.col("doc_id").isNull() | F.col("_sw_several").isNotNull(), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long"))
    return joined.withColumn("_sw_key", key).drop("_sw_id", "_sw_several")


def _without(keyed: DataFrame, dropped: DataFrame, columns: list[str], name: str) -> DataFrame:
    gone = cut(dropped.select(F.col("doc_id").alias("_sw_key")).distinct(), name)
    return keyed.join(gone, "_sw_key", "left_anti").select(columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Rows without doc_id, and texts under a doc_id that names several, are documents of their own; among them the kept one is any.
    """
    keyed = _keyed(docs)
    found = near_dup.near_duplicates(keyed.select(F.col("_sw_key").alias("doc_id"), "text"))
    return _without(keyed, found.where("not kept"), docs.columns, "near-dropped")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; each row is judged by its own text."""
    keyed = _keyed(docs)
    found = decontamination.decontaminate(keyed.select(F.col("_sw_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(keyed, found.where("contaminated"), docs.columns, "contaminated")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL can't express the classifier, the near-duplicate stage or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read again for the next one."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage-{name}")
    return docs
