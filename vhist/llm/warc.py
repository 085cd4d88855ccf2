"""WARC archives in Zstandard: writer, and a reader that checks what it reads.

An archive file is a skippable frame that holds the dictionary, then one
Zstandard frame per record.  A record whose payload another record has, and
whose page_id is not the smallest of those, is a revisit: it keeps the HTTP
headers and names the response it refers to.  The reader loads the dictionary
from the leading frame, decodes frame by frame in a stream, and checks the
version line, header syntax, content and payload lengths, the closing blank
lines, and of a response the payload's digest.

Archives are written to the shared folder under a name of their own per task
attempt; only those that the manifest names are read.

Defined cases: a null html is the empty payload; a null page_id is written
without id and is a response, unless its payload has an id'd record, which it
then revisits; rows repeated under the smallest page_id are all responses;
an empty table gives no archive; url (null too) is written percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vhist.llm.common import batches, scratch_path

# Fixed value: the magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
MIN_REVISIT_BYTES = 0
DICTIONARY_SAMPLES = 400  # pages the dictionary is made from (its use is compression only)
DICTIONARY_BYTES = 32 << 10
RECORDS_PER_ARCHIVE = 50_000
SALTS = 32
READ_BYTES = 1 << 20

_META = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class WarcError(ValueError):
    """An archive that breaks the format."""


def _page_rows(pages: DataFrame) -> DataFrame:
    html = F.coalesce(pages["html"].cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), html.alias("payload"))
    return rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload").cast("long"))


def with_record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, salts: int = SALTS) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1), size, record_type, refers_to.

    The smallest id per payload is aggregated map-side; only payloads with
    several records are joined back, spread over salts so that one payload
    that a large part of the pages share is no single task's work.
    """
    rows = _page_rows(pages).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    many = (
        _page_rows(pages).filter(F.col("size") >= min_bytes)
        .groupBy("digest", "size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull()).drop("n")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(many, ["digest", "size", "salt"], "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def train_dictionary(pages: DataFrame, samples: int = DICTIONARY_SAMPLES, size: int = DICTIONARY_BYTES) -> bytes:
    """A compression dictionary from at most ``samples`` pages (those whose ids'
    hashes are smallest); empty if there is too little to learn from."""
    ids = pages.select("page_id").dropna().orderBy(F.xxhash64("page_id"), "page_id").limit(samples)
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).join(F.broadcast(ids), "page_id", "left_semi")
    texts = [r.html.encode() for r in rows.limit(2 * samples).collect() if r.html and len(r.html) < 1 << 16]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_bytes(page_id, url, payload: bytes, sha1: bytes, record_type: str, refers_to) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~')}")
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest_text(sha1)}"]
    if record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, dictionary: bytes, per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """Write ``<folder>/warc/*.warc.zst``; return the manifest (file, records)."""

    def write(rows):
        store, base = fs.FileSystem.from_uri(f"{folder}/warc")
        store.create_dir(base, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True, write_content_size=True)
        out, name, n, done = None, "", 0, []
        for page_ids, urls, payloads, digests, types, refers in batches(rows, "page_id", "url", "payload", "digest", "record_type", "refers_to"):
            for page_id, url, payload, digest, kind, to in zip(page_ids, urls, payloads, digests, types, refers):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = store.open_output_stream(f"{base}/{name}")
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                out.write(packer.compress(record_bytes(page_id, url, payload, bytes.fromhex(digest), kind, to)))
                n += 1
                if n == per_archive:
                    out.close()
                    done.append((name, n))
                    out, n = None, 0
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["file", "records"])

    schema = "file string, records long"
    records.mapInArrow(write, schema).write.parquet(f"{folder}/manifest")
    return records.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


def frames(stream):
    """The dictionary frame's content, then the content of each frame of an
    archive, read as a stream (memory: one record)."""
    head = stream.read(8)
    if len(head) < 8:
        raise WarcError("no leading frame")
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise WarcError(f"leading frame has magic {magic:#x}")
    raw = stream.read(size)
    if len(raw) != size:
        raise WarcError("dictionary frame is cut short")
    if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be compressed
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    data = b""
    while data or (data := stream.read(READ_BYTES)):
        frame, parts = unpacker.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from e
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise WarcError("last frame is cut short")
        yield b"".join(parts)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8").split("\r\n"):
        key, colon, value = line.partition(":")
        if not colon or not key or key != key.strip():
            raise WarcError(f"bad header line {line[:80]!r}")
        out[key.lower()] = value.strip()
    return out


def _length(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not value.isdigit():
        raise WarcError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def _page_of(uri: str):
    if not (uri.startswith("<urn:page:") and uri.endswith(">")):
        raise WarcError(f"bad record id {uri[:80]!r}")
    return int(uri[10:-1]) if uri[10:-1] else None


def parse_record(record: bytes) -> dict:
    """A record's fields; raises WarcError where the record breaks the format."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1") or not blank:
        raise WarcError(f"bad version line {version[:40]!r}")
    headers = _headers(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest"} - headers.keys()
    if missing:
        raise WarcError(f"no {sorted(missing)}")
    size, kind = _length(headers), headers["warc-type"]
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    http, blank, payload = rest[:size].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/1."):
        raise WarcError("no HTTP header block")
    payload_size = _length(_headers(lines))
    scheme, _, digest = headers["warc-payload-digest"].partition(":")
    if scheme != "sha1" or kind not in ("response", "revisit"):
        raise WarcError(f"{scheme} digest of a {kind}")
    if kind == "response" and (len(payload) != payload_size or digest != digest_text(hashlib.sha1(payload).digest())):
        raise WarcError("payload does not fit its length and digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise WarcError("a revisit has no payload and refers to a response")
    return {
        "page_id": _page_of(headers["warc-record-id"]),
        "url": unquote(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
        "payload_bytes": payload_size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives that the manifest names: one row each, and
    the payload of responses if asked for.  A file with another number of
    records than the manifest says raises."""
    types = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = _META
    if with_payload:
        types += [("url", pa.string()), ("payload", pa.binary())]
        schema += ", url string, payload binary"

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in types], names=[k for k, _ in types])

    def read(rows):
        store, base = fs.FileSystem.from_uri(f"{folder}/warc")
        for names, counts in batches(rows, "file", "records"):
            for name, count in zip(names, counts):
                out, n, held = [], 0, 0
                with store.open_input_stream(f"{base}/{name}") as stream:
                    for record in frames(stream):
                        out.append(parse_record(record))
                        n, held = n + 1, held + (len(record) if with_payload else 200)
                        if held > 8 << 20:
                            yield batch(out)
                            out, held = [], 0
                if n != count:
                    raise WarcError(f"{name}: {n} records, {count} were written")
                yield batch(out)

    return manifest.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "file").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(with_record_types(pages), folder, train_dictionary(pages))
    return read_archives(spark, manifest, folder)
