"""Token counts from flat, unindexed token files by scanning for separators.

``write_token_files`` encodes documents into flat files of unsigned integers,
an end-of-document id after each document and nothing else, and a manifest
(file, place of the document in it, doc_id).  ``token_counts`` reads only the
files: each block of fixed bytes is searched for the separator id with one
vectorised comparison; a prefix scan over the blocks' (separators, last
separator) stitches documents that span blocks and numbers them.

Defined cases: null and empty texts are documents of no token; the separator's
own string in a text is encoded as ordinary text, so it never ends a document;
a file that does not end with a separator has one last, unfinished document;
an empty table gives no file and no row.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vhist.llm.bpe import codec, default_tokenizer
from vhist.llm.common import batches, scratch_path, text_rows

SEPARATOR = 50256  # the end-of-text id of the default tokenizer
BLOCK_BYTES = 4 << 20


def _dtype(size: int):
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str | None = None, separator: int = SEPARATOR, id_col: str = "doc_id"
) -> DataFrame:
    """Write ``<folder>/tokens/*.bin``; return the manifest, itself written to
    ``<folder>/manifest``.  A task that runs again writes a file of another
    name; only files that the manifest names count."""
    path = tokenizer or default_tokenizer()

    def write(rows):
        c = codec(path, True)
        store, base = fs.FileSystem.from_uri(f"{folder}/tokens")
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.bin"
        place, out = 0, None
        dtype = _dtype(max(c.size, separator + 1))
        for keys, raws in batches(rows, "doc_id", "raw"):
            out = out or store.open_output_stream(f"{base}/{name}")
            for raw in raws:
                out.write(np.array([*c.encode_chunked(raw), separator], dtype).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys)), pa.array(range(place, place + len(keys)), pa.int64()), pa.array(keys, pa.int64())],
                names=["file", "place", "doc_id"],
            )
            place += len(keys)
        if out:
            out.close()

    schema = "file string, place long, doc_id long"
    text_rows(documents, id_col).mapInArrow(write, schema).write.parquet(f"{folder}/manifest")
    return documents.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


def token_counts(
    spark: SparkSession, files: DataFrame, folder: str, token_bytes: int = 2, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(file, place, first_token, n_tokens) of every document in the flat files
    that ``files`` (file) names."""
    step = block_bytes // token_bytes * token_bytes
    dtype = f"<u{token_bytes}"

    def blocks(rows):
        store, base = fs.FileSystem.from_uri(f"{folder}/tokens")
        for (names,) in batches(rows, "file"):
            sizes = [i.size for i in store.get_file_info([f"{base}/{n}" for n in names])]
            out = [(n, size, at) for n, size in zip(names, sizes) for at in range(0, size, step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "size", "at"]
            )

    def search(rows):
        store, base = fs.FileSystem.from_uri(f"{folder}/tokens")
        for names, sizes, ats in batches(rows, "file", "size", "at"):
            for name, size, at in zip(names, sizes, ats):
                with store.open_input_file(f"{base}/{name}") as f:
                    data = np.frombuffer(f.read_at(min(step, size - at), at), dtype)
                ends = np.flatnonzero(data == separator) + at // token_bytes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([at], pa.int64()), pa.array([size // token_bytes], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "at", "n", "ends"],
                )

    cut = files.select("file").distinct().mapInArrow(blocks, "file string, size long, at long")
    spread = cut.repartition(max(1, spark.sparkContext.defaultParallelism * 4), F.xxhash64("file", "at"))
    found = spread.mapInArrow(search, "file string, at long, n long, ends array<long>")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy(F.col("at").desc())
    stitched = (
        found.withColumn("n_before", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
        .withColumn("last_before", F.coalesce(F.last(F.expr("try_element_at(ends, -1)"), ignorenulls=True).over(before), F.lit(-1)))
        .withColumn("is_last", F.row_number().over(after) == 1)
    )
    # a file's unfinished end counts as a document that ends at the file's end
    last_end = F.when(F.size("ends") > 0, F.expr("try_element_at(ends, -1)")).otherwise(F.col("last_before"))
    stitched = stitched.withColumn("ends", F.when(F.col("is_last") & (last_end < F.col("n") - 1), F.array_append("ends", F.col("n"))).otherwise(F.col("ends")))
    # a document starts after the separator before it: the block's own, or the carried one
    each = stitched.withColumn("starts", F.expr("concat(array(last_before + 1), transform(ends, e -> e + 1))")).select(
        "file", "n_before", "starts", F.posexplode("ends").alias("i", "end")
    )
    start = F.expr("starts[i]")
    return each.select("file", (F.col("n_before") + F.col("i")).cast("long").alias("place"), start.alias("first_token"), (F.col("end") - start).alias("n_tokens"))


def document_token_counts(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every document: files written, then scanned."""
    spark = documents.sparkSession
    c = codec(tokenizer or default_tokenizer(), True)
    folder = scratch_path(spark, "tokens")
    manifest = write_token_files(documents, folder, tokenizer)
    counts = token_counts(spark, manifest, folder, _dtype(max(c.size, SEPARATOR + 1)).itemsize)
    # one row per document on either side: never a broadcast, however small the blocks' rows before they are unnested
    return manifest.join(counts.hint("merge"), ["file", "place"], "left").select("doc_id", "n_tokens")
