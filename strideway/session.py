"""The session that tests, the bench and scripts use."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(name: str = "strideway", cores: int | None = None) -> SparkSession:
    """A local session with adaptive execution; on a cluster, use the cluster's own."""
    root = str(Path(__file__).resolve().parent.parent)
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH", "")]))
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
