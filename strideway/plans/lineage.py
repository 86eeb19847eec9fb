"""Cut a plan's lineage by writing it to the folder that all executors share.

The folder is ``spark.checkpoint.dir`` of the session. Where that is unset (tests, a laptop) a folder
below the warehouse is used, which executors share as well.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_own: set[str] = set()
#: Tables of each application that are still there.
_written: dict[str, set[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables and checkpoints; sets a default one if the session names none."""
    found = spark.sparkContext.getConf().get(_KEY) or spark.conf.get(_KEY, None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not spark.sparkContext.master.startswith("local"):
        warnings.warn(f"{_KEY} is not set; intermediate tables go below the warehouse, which all executors must share", stacklevel=3)
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/strideway_checkpoints/{sc.applicationId}"
    if own not in _own and sc.master.startswith("local"):
        _own.add(own)
        atexit.register(shutil.rmtree, "/" + own.removeprefix("file:").lstrip("/"), ignore_errors=True)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/strideway/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later steps never compute it again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._strideway_path = path
    _written.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return out


def release(spark: SparkSession) -> None:
    """Delete all tables that ``cut`` wrote in this application and that are still there; nothing may read them any more."""
    for path in _written.pop(spark.sparkContext.applicationId, set()):
        delete_path(spark, path)


def discard(*frames: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_strideway_path", None)
        if path:
            delete_path(df.sparkSession, path)
            _written.get(df.sparkSession.sparkContext.applicationId, set()).discard(path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
