"""Reading snapshots and stored history."""

from __future__ import annotations

import re
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from vhist.functions.columns import SYSTEM_COLUMNS

DATE_FORMAT = "yyyyMMdd"


def parse_snapshot_date(col: str, fmt: str = DATE_FORMAT):
    """``yyyyMMdd`` text (or number) to DATE, once, on ingest."""
    return F.to_date(F.col(col).cast("string"), fmt)


def read_snapshots(
    spark: SparkSession,
    path: str,
    first: Optional[str] = None,
    last: Optional[str] = None,
    id_col: str = "FK_dimSnapshotID",
    date_col: str = "snapshot_date",
    fmt: str = DATE_FORMAT,
) -> DataFrame:
    """The snapshots of a multi-snapshot dataset from ``first`` to ``last``
    (``yyyyMMdd``, both included; None: no bound).

    The filter is on the raw id column in its own type, so it prunes
    ``id_col=...`` directories (inferred as INT) or pushes down into the files
    (STRING); the id is then parsed into a DATE ``date_col``.
    """
    df = spark.read.parquet(path)
    kind = df.schema[id_col].dataType
    if first is not None:
        df = df.filter(F.col(id_col) >= F.lit(first).cast(kind))
    if last is not None:
        df = df.filter(F.col(id_col) <= F.lit(last).cast(kind))
    return df.withColumn(date_col, parse_snapshot_date(id_col, fmt)).drop(id_col)


def snapshot_on(snapshots: DataFrame, day, date_col: str = "snapshot_date", rename_to: str = "SnapshotDate") -> DataFrame:
    """One snapshot by equality on its date, date column renamed.

    Written as ``day <= date < day + 1`` (the same rows for a DATE column), so
    that when the date is a cast of a timestamp both bounds reach the scan.
    """
    if isinstance(day, str):
        d = F.to_date(F.lit(day), DATE_FORMAT)
    elif isinstance(day, Column):
        d = day
    else:
        d = F.lit(day).cast("date")
    c = F.col(date_col)
    return snapshots.filter((c >= d) & (c < F.date_add(d, 1))).withColumnRenamed(date_col, rename_to)


def snapshot_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Business columns of a snapshot, exact duplicates removed (map-side first)."""
    return df.select(*cols).distinct()


def _dated_folders(spark: SparkSession, root: str, pattern: str) -> list:
    """(date text, path) of the folders right below ``root``, in order of date."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    found = []
    for e in entries:
        name = re.search(pattern, f"/{e.getPath().getName()}/")
        if e.isDirectory() and name:
            found.append((name.group(1), e.getPath().toString()))
    return sorted(found)


def read_dated_paths(
    spark: SparkSession,
    root: str,
    date_col: str = "snapshot_date",
    pattern: str = r"/([0-9]{8})/",
    fmt: str = DATE_FORMAT,
    schema: Optional[T.StructType] = None,
    first: Optional[str] = None,
    last: Optional[str] = None,
) -> DataFrame:
    """Snapshots stored in folders named by date (``root/yyyyMMdd/*.parquet``).

    One read over all folders; the date comes from each row's file path, not
    from a driver-side loop over files.

    ``first``, ``last`` (dates as text in ``fmt``, both included; None: no
    bound): only folders right below ``root`` whose whole name is a date within
    them are listed and read.  ``root`` itself is listed once, a name per
    folder.  With no folder in the range the result is empty.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    reader = reader.option("recursiveFileLookup", "true")
    if first is None and last is None:
        df = reader.parquet(root)
    else:
        folders = _dated_folders(spark, root, pattern)
        within = [p for name, p in folders if (first is None or name >= first) and (last is None or name <= last)]
        if not within:
            if schema is None and not folders:
                raise ValueError(f"no dated folder below {root}, and no schema given")
            empty = spark.createDataFrame([], schema) if schema is not None else reader.parquet(folders[-1][1]).limit(0)
            return empty.withColumn(date_col, F.lit(None).cast("date"))
        df = reader.parquet(*within)
    raw = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn(date_col, F.to_date(raw, fmt))


def read_json(spark: SparkSession, path: str, cols: Sequence[str], schema=None) -> DataFrame:
    """JSON records projected to ``cols`` (give ``schema`` to skip inference)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path).select(*cols)


def parse_json_column(df: DataFrame, col: str, schema: str, keep: Sequence[str]) -> DataFrame:
    """A JSON text column parsed with a given DDL schema, its fields projected."""
    parsed = F.from_json(F.col(col), schema)
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


def history_schema(data_schema: T.StructType) -> T.StructType:
    """Schema of a history over snapshots with ``data_schema`` columns."""
    sys_fields = [
        T.StructField("BusinessKey", T.StringType()),
        T.StructField("RowHashKey", T.StringType()),
        T.StructField("SnapshotDate", T.DateType()),
        T.StructField("FirstSnapshot", T.DateType()),
        T.StructField("ValidFrom", T.DateType()),
        T.StructField("ValidTo", T.DateType()),
        T.StructField("IsDeleted", T.BooleanType()),
        T.StructField("GDPR_Compliant", T.StringType()),
    ]
    data = [f for f in data_schema.fields if f.name not in SYSTEM_COLUMNS]
    return T.StructType(sys_fields + data)


def empty_history(spark: SparkSession, data_schema: T.StructType) -> DataFrame:
    """A typed, empty history."""
    return spark.createDataFrame([], history_schema(data_schema))


def read_history(spark: SparkSession, path: str, data_schema: T.StructType) -> DataFrame:
    """Stored history at ``path`` with the union of its columns and the
    snapshot's: a column that the snapshot lost stays, a new one is NULL.

    A path that does not exist is a history not begun, typed and empty; a folder
    without readable history files raises, so that a damaged store does not
    start over from nothing.
    """
    schema = history_schema(data_schema)
    try:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise
    missing = [c for c in SYSTEM_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"{path} holds no history: columns {missing} are missing")
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns})
    kept = [c for c in df.columns if c not in schema.fieldNames() and c != "is_open"]
    return df.select(*schema.fieldNames(), *kept)
