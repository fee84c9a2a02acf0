"""Write pages as WARC archives and read archives record by record."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, new_folder, text_bytes

#: Fixed values of the archive format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "archive string, position long, record_id string, record_type string, target_uri string, refers_to string, "
    "payload binary, payload_bytes long, payload_digest string, error string"
)
READ_SIZE = 1 << 18


def record_uri(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One gzip member. A revisit keeps the response's header block and drops its payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
    ]
    if url:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    fields += [
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _open(path: str, write: bool = False) -> BinaryIO:
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")
    if not write:
        return store.open_input_stream(place)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    return store.open_output_stream(place)


def with_record_types(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, payload, keeper. ``keeper`` is the page whose response a revisit refers to.

    Only digests and ids are combined to find it. The join leaves a payload that a third of all
    pages share to the skew-join split.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_bytes("html").alias("payload"),
    )
    size = F.octet_length("payload")
    # A short payload gets a null digest, which joins with nothing.
    rows = rows.withColumn("digest", F.when(size >= least, F.unhex(F.sha2("payload", 256))))
    keepers = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("keeper"))
    # A null digest would gather all short pages in one task; they have nothing to look up.
    short = rows.where(F.col("digest").isNull()).select("page_id", "url", "payload", F.lit(None).cast("long").alias("keeper"))
    long = rows.where(F.col("digest").isNotNull()).join(keepers, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return long.select("page_id", "url", "payload", refers.alias("keeper")).unionByName(short)


def write_archives(pages: DataFrame, folder: str, least: int = 1000, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write every page as a record; returns the manifest (archive, records, n_bytes).

    Each task writes archives of its own, named by a fresh id, and a new one after
    ``archive_bytes``. The manifest is stored with Spark's committed output, so archives that
    a lost or repeated task left behind are in no manifest and never read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, count, size, path = None, [], 0, 0, ""
        for batch in batches:
            for page_id, url, payload, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = _open(path, write=True)
                record = make_record(page_id, url, payload, keeper)
                out.write(record)
                count, size = count + 1, size + len(record)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        columns = list(zip(*done)) if done else [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["archive", "records", "n_bytes"]
        )

    schema = "archive string, records long, n_bytes long"
    manifest = map_arrow(with_record_types(pages, least), work, schema)
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


class _Member:
    """Bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, source: BinaryIO, left: bytes):
        self.source, self.inflate, self.ready, self.left = source, zlib.decompressobj(31), bytearray(), left

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.left or self.source.read(READ_SIZE)
        if not data:
            raise EOFError("gzip member cut short")
        self.left = b""
        self.ready += self.inflate.decompress(data, READ_SIZE)
        return True

    def line(self) -> bytes:
        while (at := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("header without an end")
        found = bytes(self.ready[:at])
        del self.ready[: at + 2]
        return found

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("record shorter than its Content-Length")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        return found

    def finish(self) -> bytes:
        """What follows the member in the input."""
        while self._more():
            pass
        return self.inflate.unused_data


def _headers(member: _Member) -> dict[str, str]:
    fields: dict[str, str] = {}
    while line := member.line():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _read_record(member: _Member) -> dict:
    if not member.line().startswith(b"WARC/1."):
        raise ValueError("no WARC version line")
    fields = _headers(member)
    block = member.take(int(fields["content-length"]))
    if member.take(4) != b"\r\n\r\n":
        raise ValueError("record without its closing lines")
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields.get("warc-type") == "revisit"
    size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    wanted = fields.get("warc-payload-digest", "")
    error = None
    if fields.get("warc-block-digest", _sha1(block)) != _sha1(block):
        error = "block digest differs"
    elif not revisit and wanted and _sha1(payload) != wanted:
        error = "payload digest differs"
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload": None if revisit else payload,
        "payload_bytes": int(size[1]) if revisit and size else len(payload),
        "payload_digest": base64.b32decode(wanted[5:]).hex() if wanted.startswith("sha1:") else hashlib.sha1(payload).hexdigest(),
        "error": error,
    }


def records_of(source: BinaryIO) -> Iterator[dict]:
    """Records in order, one gzip member each; a damaged rest of the file is one error record."""
    left, position = b"", 0
    while True:
        left = left or source.read(READ_SIZE)
        if not left:
            return
        member = _Member(source, left)
        try:
            record = _read_record(member)
            left = member.finish()
        except (ValueError, KeyError, EOFError, zlib.error) as e:
            yield {"position": position, "error": f"{type(e).__name__}: {e}"}
            return
        yield record | {"position": position}
        position += 1


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All records of the archives a manifest names, one task per few archives.

    Archives are read in order and inflated piece by piece; a task holds one record and a
    small output batch. Digests of block and payload are checked; ``error`` says what is
    wrong with a record and is null otherwise. A revisit's payload is null; its size is the one its stored
    header gives. Works on any archives with one gzip member per record.
    """
    schema = pa.schema(
        [(n, pa.string()) for n in ("archive",)] + [("position", pa.int64())]
        + [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to")]
        + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, size = [], 0
                with _open(archive) as source:
                    for record in records_of(source):
                        rows.append(record | {"archive": archive})
                        size += len(record.get("payload") or b"")
                        if size > 4 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(manifest.select("archive").repartition(spread), work, RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records written here; errors raise."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    damaged = F.concat(F.lit("damaged archive "), "archive", F.lit(": "), "error")
    checked = F.when(F.col("error").isNotNull(), F.raise_error(damaged).cast("string")).otherwise(F.col("record_type"))
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", checked.alias("record_type"), page("refers_to").alias("refers_to")
    )


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back, one row per page.

    Of records with equal payloads of at least ``least`` bytes, that with the largest
    page_id is the response and the others revisit it. Shorter payloads are always
    responses. Null html counts as empty; a null url gives a record without target; null ids
    come back as null and revisit when another page holds their payload; rows repeated
    under the largest id are all responses; an empty table gives no rows.
    """
    spark = pages.sparkSession
    manifest = write_archives(pages, new_folder(spark, "warc"), least)
    return page_records(read_archives(spark, manifest))
