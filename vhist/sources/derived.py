"""Snapshots derived from the driver's static tables.

The tables are not dated snapshots, so snapshots are made from them
deterministically; the DuckDB oracle text in ``vhist.plans.oracle`` makes the
same frames.

* full mode: ``events``, last event per (user, day) by (ts, event_id)
* incremental mode: ``orders``, last order per (customer, month) by
  (o_orderdate, o_orderkey), with the customer's name as a sensitive column
* load log: one row per (event type, day) with events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vhist.config import HistoryConfig

# Fixed parameters of the derived test snapshots.
EVENTS_KEY = ("user_id",)
ORDERS_KEY = ("o_custkey",)
FORGET_SIGNAL_COL = "c_name"
FORGET_PATTERN = "7$"
SENSITIVE_COLS = ("c_name",)

EVENTS_CFG = HistoryConfig(key_cols=EVENTS_KEY, mode="full")
EVENTS_FLAG_CFG = HistoryConfig(key_cols=EVENTS_KEY, hash_cols=("user_id", "flag"), mode="full")
TEXT_KEYS_CFG = HistoryConfig(key_cols=("p", "q"), mode="full")
ORDERS_CFG = HistoryConfig(
    key_cols=ORDERS_KEY,
    mode="incremental",
    sensitive_cols=SENSITIVE_COLS,
    signal_col=FORGET_SIGNAL_COL,
    signal_pattern=FORGET_PATTERN,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _between(ts: str, since=None, until=None):
    """``since <= ts < until`` on a raw timestamp, as literals the scan can use
    (row-group statistics, partition pruning); a filter on a date derived from
    ``ts`` by equality would not reach the scan."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        cond = cond & (F.col(ts) < F.lit(until).cast("timestamp_ntz"))
    return cond


def events_daily(
    spark: SparkSession, sf_dir: str, flag_only: bool = False, since=None, until=None
) -> DataFrame:
    """One row per (user_id, day): the user's last event that day.

    ``since`` / ``until`` (dates) keep the days in ``[since, until)``.

    Columns: user_id, snapshot_date DATE, event_type, flag ('error'/'ok'),
    value DECIMAL(10,2); with ``flag_only`` just user_id, snapshot_date, flag.
    The reduction is an aggregate, so it is combined map-side before the shuffle
    and a user with a huge share of events costs one row per day after it.
    """
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    ev = ev.filter(_between("ts", since, until))
    last = ev.groupBy("user_id", F.to_date("ts").alias("snapshot_date")).agg(
        F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("e")
    )
    flag = F.when(F.col("e.event_type") == "error", F.lit("error")).otherwise(F.lit("ok"))
    if flag_only:
        return last.select("user_id", "snapshot_date", flag.alias("flag"))
    return last.select(
        "user_id",
        "snapshot_date",
        F.col("e.event_type").alias("event_type"),
        flag.alias("flag"),
        F.col("e.value").cast("decimal(10,2)").alias("value"),
    )


def orders_monthly(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """One row per (o_custkey, month): the customer's last order of the month,
    with the customer's name.  ``since`` / ``until`` (first days of months)
    keep the months in ``[since, until)``.

    Columns: o_custkey, snapshot_date DATE (first of month), o_orderstatus,
    o_orderpriority, c_name.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    ).filter(_between("o_orderdate", since, until))
    last = o.groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("snapshot_date")).agg(
        F.max_by(F.struct("o_orderstatus", "o_orderpriority"), F.struct("o_orderdate", "o_orderkey")).alias("o")
    )
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return last.join(cust, "o_custkey", "left").select(
        "o_custkey",
        "snapshot_date",
        F.col("o.o_orderstatus").alias("o_orderstatus"),
        F.col("o.o_orderpriority").alias("o_orderpriority"),
        "c_name",
    )


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load log: one row per (data group = event type, day with events)."""
    ev = table(spark, sf_dir, "events").select("event_type", "ts")
    days = ev.select(F.col("event_type").alias("DataGroupName"), F.to_date("ts").alias("SnapshotDate")).distinct()
    return days.select(
        F.concat_ws("_", "DataGroupName", F.date_format("SnapshotDate", "yyyyMMdd")).alias("PK_DataGroupLoadLogID"),
        "DataGroupName",
        "SnapshotDate",
        F.lit("Bronze").alias("Layer"),
    )


def reload_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reload requests: per event type, the day of its largest event value
    (ties go to the smaller event_id)."""
    ev = table(spark, sf_dir, "events").select("event_type", "ts", "value", "event_id")
    best = ev.groupBy(F.col("event_type").alias("DataGroupName")).agg(
        F.max_by(F.to_date("ts"), F.struct("value", F.col("event_id") * -1)).alias("SnapshotDate")
    )
    return best


def events_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user_id, third of a month): the user's last event in it.

    Columns: user_id, snapshot_date DATE (first day of the third), flag.
    """
    day = F.to_date("ts")
    third = F.date_add(F.trunc(day, "month"), (10 * F.least(F.floor((F.dayofmonth(day) - 1) / 10), F.lit(2))).cast("int"))
    last = table(spark, sf_dir, "events").groupBy("user_id", third.alias("snapshot_date")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")
    )
    flag = F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok"))
    return last.select("user_id", "snapshot_date", flag.alias("flag"))


def orders_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly orders under a composite text key (p, q) with the key delimiter
    inside: a customer has the key ('c<n>||x', 'y') in months whose last order
    is finished and ('c<n>', 'x||y') in others, two keys of one joined text.

    Columns: p, q, snapshot_date DATE, o_orderpriority.
    """
    name = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    finished = F.col("o_orderstatus") == "F"
    return orders_monthly(spark, sf_dir).select(
        F.when(finished, F.concat(name, F.lit("||x"))).otherwise(name).alias("p"),
        F.when(finished, F.lit("y")).otherwise(F.lit("x||y")).alias("q"),
        "snapshot_date",
        "o_orderpriority",
    )


def customer_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load log: one row per (data group = customer, day with orders); some
    customers have one load, most several."""
    days = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("DataGroupName"),
        F.to_date("o_orderdate").alias("SnapshotDate"),
    ).distinct()
    return days.select(
        F.concat_ws("_", "DataGroupName", F.date_format("SnapshotDate", "yyyyMMdd")).alias("PK_DataGroupLoadLogID"),
        "DataGroupName",
        "SnapshotDate",
        F.lit("Bronze").alias("Layer"),
    )


def last_load_of_some(log: DataFrame) -> DataFrame:
    """The log with the loads of every group whose name ends in an even digit
    reduced to its last one, so that groups with one load occur at any scale."""
    last = log.groupBy("DataGroupName").agg(F.max("SnapshotDate").alias("_last"))
    even = F.col("DataGroupName").rlike("[02468]$")
    return log.join(last, "DataGroupName").filter(~even | (F.col("SnapshotDate") == F.col("_last"))).drop("_last")


def customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reload requests: the days of a customer's urgent orders."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").startswith("1"))
    return o.select(
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("DataGroupName"),
        F.to_date("o_orderdate").alias("SnapshotDate"),
    ).distinct()
