"""Session helpers: the checkpoint directory and settings sized by input."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> Optional[str]:
    """The shared checkpoint directory the session names, if any."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the checkpoint directory the cluster configured (``spark.checkpoint.dir``).

    Raises if there is none: a machine-local folder would not survive the loss
    of an executor on a cluster, so none is invented here.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before chaining merges")
    sc.setCheckpointDir(conf)
    return conf


def sizing_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Runtime SQL settings for a job reading about ``input_bytes`` on ``cores`` cores.

    Scan splits and shuffle partitions aim at ``partition_bytes`` each, so a
    task's share fits executor memory (and spills, not fails, past it); the
    shuffle partition count is a whole number of waves of ``cores``, and AQE
    merges small partitions and splits skewed ones at run time.  At 100 TB and
    256 MB this is ~400,000 shuffle partitions before AQE coalescing.
    """
    parts = max(cores, -(-int(input_bytes) // partition_bytes))
    parts = -(-parts // cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
