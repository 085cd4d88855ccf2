"""Process snapshots as their load-log records arrive.

A Structured Streaming query reads load-log records (``DataGroupName``,
``SnapshotDate``, ...) from a folder; each micro-batch goes, in
``foreachBatch``, through the reload plan (``plans.process.run_loads``):

* records of other data groups are ignored;
* one load is processed if it was asked for, else skipped; with several loads
  the history is restored to before the earliest of them;
* from the restored date on, every load that the log folder names is processed
  in order, so later dates are built again as well.

The stream's checkpoint records which log files were handled; after a failure
the batch is replayed from the same restored state, so the result is the same.
A snapshot is read only once its load-log record exists, so it is complete by
then.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vhist.config import HistoryConfig
from vhist.plans.process import run_loads

LOG_SCHEMA = "PK_DataGroupLoadLogID string, DataGroupName string, SnapshotDate date, Layer string"


def process_load_batch(
    spark: SparkSession,
    log_rows: DataFrame,
    all_loads: DataFrame,
    requests: DataFrame,
    data_group: str,
    root: str,
    cfg: HistoryConfig,
    read_snapshot: Callable[[dt.date], DataFrame],
    layer: str = "Bronze",
    forget: bool = False,
) -> tuple:
    """Handle one batch of load-log records by the reload plan: (action, dates loaded)."""
    return run_loads(log_rows, requests, data_group, root, cfg, read_snapshot, layer, forget, all_loads)


def load_log_stream(
    spark: SparkSession,
    log_dir: str,
    data_group: str,
    root: str,
    cfg: HistoryConfig,
    read_snapshot: Callable[[dt.date], DataFrame],
    checkpoint_location: str,
    available_now: bool = True,
    log_format: str = "parquet",
    forget: bool = False,
    read_requests: Optional[Callable[[], DataFrame]] = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` handles what has arrived and stops.

    ``read_requests`` gives the reload requests (DataGroupName, SnapshotDate) of
    the moment, once per batch; without it none are on file."""
    src = spark.readStream.schema(LOG_SCHEMA).format(log_format).load(log_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        log = spark.read.schema(LOG_SCHEMA).format(log_format).load(log_dir)
        requests = read_requests() if read_requests else spark.createDataFrame([], "DataGroupName string, SnapshotDate date")
        process_load_batch(spark, batch, log, requests, data_group, root, cfg, read_snapshot, forget=forget)

    w = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
