"""Streams over files that are there already."""

from strideway.streaming import incremental


def test_batches_are_snapped_once(spark, tmp_path):
    schema = "id string, lon double, lat double, kerb string"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    ends = spark.createDataFrame([("E", -74.0, 40.7)], "id string, lon double, lat double")
    from strideway.functions import projection as P
    from pyspark.sql import functions as F

    ends = ends.withColumns({"x": P.utm_x(F.col("lon"), F.col("lat")), "y": P.utm_y(F.col("lon"), F.col("lat"))})
    for k, lat in enumerate((40.70001, 40.71)):
        spark.createDataFrame([(f"c{k}", -74.0, lat, "lowered")], schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_feature_stream(spark, source, schema)
        incremental.snap_stream(stream, ends, target, str(tmp_path / "state")).awaitTermination()
    assert sorted((r.id, r.snapped) for r in spark.read.parquet(target).collect()) == [("E", True), ("c1", False)]
