"""A training corpus from raw documents: each stage works on all that the one
before it kept, written as Parquet and read again between stages.

Quality and decontamination filter in place.  The near-duplicate stage
exchanges only the texts that some link may concern.

Defined cases: null texts are kept as null until encoding, where they are
empty; very long texts are read whole; rows without id and different texts
under one id are judged each; of rows repeated under one id, and of ties, one
stays; an empty table gives no row; columns beyond those of ``documents`` are
left behind, so that clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vhist.llm import bpe, decontam, jaccard, pii, quality
from vhist.llm.common import scratch_path, table, written
from vhist.llm.shipping import ship_package
from vhist.llm.sieve import Sieve

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with ``row_key``, a hash of id and text, so that rows
    without id and different texts under one id are told apart."""
    text = docs["text"].cast("string")
    return docs.select(*COLUMNS, F.xxhash64(docs["doc_id"].cast("long"), docs["doc_id"].isNull(), text, text.isNull()).alias("row_key"))


def _without(keyed: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents whose key is not among the rejected."""
    return keyed.join(rejected.select("row_key").distinct(), "row_key", "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    weights, intercept, _ = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, COLUMNS, weights, intercept)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays: of the smallest id (rows
    without id last), and of the smallest key among its texts."""
    keyed = _keyed(docs)
    linked = written(jaccard.near_duplicates(keyed, id_col="row_key").filter("n_links > 0").withColumnRenamed("doc_id", "row_key"), "linked")
    counts = written(linked.groupBy("row_key").agg(F.first("class_id").alias("class_id"), F.count("*").alias("n")), "counts")
    sieve = Sieve(counts, "row_key")
    ids = sieve.passing(keyed.select("row_key", "doc_id"), "row_key").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_key")
    stays = counts.join(ids, "row_key").groupBy("class_id").agg(F.min(order).alias("s")).select("s.row_key")
    one = written(counts.join(stays, "row_key", "left_semi"), "stays")
    near = sieve.passing(keyed, "row_key")  # all linked rows, and few others
    others = _without(near, counts)
    once = near.join(one.select("row_key"), "row_key", "left_semi").dropDuplicates(["row_key"])
    return sieve.rest(keyed, "row_key").unionByName(others).unionByName(once).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"), COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("encoding", encoding_stage),
]

# The classifier and the trees are trained, so no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
