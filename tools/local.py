"""A local Spark session for tests, tools and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from vhist.session import checkpoint_dir


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "vhist", conf: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark.

    Sets a checkpoint directory only where the configuration leaves it unset.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=conf or {})
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vhist-ckpt-"))
    return spark
