"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word bytes of lower-cased text: 0-9, a-z and every byte of a non-ASCII
# character; all else separates words.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased."""
    return raw.translate(_WORD).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where a session names none (tests) a local folder is made and set.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="vhist-llm-")
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, with its path:
    computed once, and no executor's loss can take it away."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """As ``kept``, where the path is not needed."""
    return kept(df, name)[0]


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_as_empty: bool = True) -> DataFrame:
    """(id, raw): a text as its UTF-8 bytes; columns beyond these two are left behind."""
    raw = docs[text_col].cast("string").cast("binary")
    if null_as_empty:
        raw = F.coalesce(raw, F.lit(b""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), raw.alias("raw"))


def batches(rows, *columns, at_once: int | None = 1024):
    """The given columns as Python lists, of at most ``at_once`` rows (None: of
    an Arrow batch), so that Python objects are made for few rows at a time."""
    for batch in rows:
        step = at_once or max(1, batch.num_rows)
        for s in range(0, max(1, batch.num_rows), step):
            part = batch.slice(s, step)
            yield tuple(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)


def filtered(docs: DataFrame, columns: list[str], keep, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``keep(raws)``, a list of booleans for a list of
    texts (UTF-8 bytes, null as empty), lets stay: in place, without an exchange.

    The named columns travel in a struct, whatever their names are."""
    raw = F.coalesce(docs[text_col].cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("own"), raw.alias("raw"))

    def run(batches_):
        for batch in batches_:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                yield part.filter(pa.array(keep(part.column(1).to_pylist()), pa.bool_())).select(["own"])

    own = rows.select("own")
    return rows.mapInArrow(run, own.schema).select(*[F.col("own").getField(c).alias(c) for c in columns])


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)


def bucketed(df: DataFrame, name: str, key: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder in buckets of ``key`` and read again,
    with its path: joins and cogroups on the key exchange only the other side."""
    spark = df.sparkSession
    path, called = scratch_path(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(called)
    out = spark.table(called)
    spark.sql(f"DROP TABLE {called}")  # only the catalog's entry: the files are external
    return out, path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders whose rows are no longer read."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
