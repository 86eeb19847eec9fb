"""Streams of new features: each micro-batch of curb points is snapped to the end nodes known so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strideway.operators.assemble import snap_curbs


def read_feature_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def snap_stream(curbs: DataFrame, ends: DataFrame, target: str, checkpoint: str, tolerance: float = 5.0) -> StreamingQuery:
    """Snap each batch of a stream of curbs (id, lon, lat, ...) and append it to ``target``.

    A batch is written under its own number, so one that runs again replaces what it wrote before.
    """

    def one(batch: DataFrame, number: int) -> None:
        snap_curbs(batch, ends, tolerance).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return curbs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, key, n): events per window and key, with a watermark for late ones."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
