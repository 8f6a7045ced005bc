"""WARC archives as seekable Zstandard bundles.

Every bundle is one file: records are grouped into independent frames, and a skippable
frame at the end holds the seek table (compressed and plain size of each frame), so any
frame can be found from the last bytes of the file.  The index, a Parquet table, maps each
record id to bundle, frame, offset inside the frame and length.

Tasks write bundles under a fresh name into shared storage (any file system that the URI
names and pyarrow reaches); only bundles that the committed index lists count, so a lost
or repeated task leaves at most a file that nothing refers to.

Defined results: null html is an empty payload; of records with equal payloads of at least
``LEAST`` bytes the one with the smallest page id is the response and the others revisit it
(repeated rows with that id are responses too); a row without page id is always a response
and never referred to; null url is empty; extra columns are not read; an empty table writes
no bundle and gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_path
from .common import ready, written

#: Payloads below this size are never replaced by a revisit record.
LEAST = 100
#: Plain bytes after which a frame, and compressed bytes after which a bundle, is closed.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 32 * 1024 * 1024
LEVEL = 3
#: Tasks that read archives back, at most; beyond that many bundles a task reads several, one after the other.
MOST_TASKS = 10_000
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = ("bundle string, record_id string, frame int, frame_start long, frame_bytes long, "
         "record_start long, record_bytes long")
RECORDS = ("record_id string, page_id long, record_type string, url string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


def uri_of(path: str) -> str:
    """A URI that pyarrow understands: Hadoop writes file:/x where others write file:///x."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def record_id(page_id: int | None, bundle: str, n: int) -> str:
    name = f"page:{page_id}" if page_id is not None else f"{bundle}:{n}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _line(value) -> str:
    """A header value: control characters would end the line, so they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value or ""))


def warc_record(rid: str, page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the digest and size of its payload, but no payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {rid}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {n_bytes}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, '', 0)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse_record(b: bytes | memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, end) of the record that starts at ``at``."""
    b = bytes(b) if isinstance(b, memoryview) else b
    stop = b.index(b"\r\n\r\n", at)
    lines = b[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    if b[end:end + 4] != b"\r\n\r\n":
        raise ValueError("record without its end")
    return head, b[stop + 4:end], end + 4


class BundleWriter:
    """Writes one seekable bundle, frame by frame."""

    def __init__(self, out):
        self.out, self.plain, self.table, self.at = out, bytearray(), [], 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.pending, self.done = [], []

    def add(self, rid: str, record: bytes) -> None:
        self.pending.append((rid, len(self.plain), len(record)))
        self.plain += record
        if len(self.plain) >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if not self.plain:
            return
        packed = self.packer.compress(bytes(self.plain))
        self.out.write(packed)
        self.done += [(rid, len(self.table), self.at, len(packed), s, n) for rid, s, n in self.pending]
        self.table.append((len(packed), len(self.plain)))
        self.at += len(packed)
        self.plain, self.pending = bytearray(), []

    def close(self) -> list[tuple]:
        """Append the seek table; the index rows (id, frame, frame start, size, record start, size)."""
        self.close_frame()
        body = b"".join(struct.pack("<II", *x) for x in self.table)
        body += struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.out.close()
        return self.done


def seek_table(f) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the end of an open bundle."""
    size = f.seek(0, io.SEEK_END)
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    sizes = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    out, at = [], 0
    for k in range(n):
        out.append((at, sizes[2 * k], sizes[2 * k + 1]))
        at += sizes[2 * k]
    return out


def read_record(bundle: str, frame_start: int, frame_bytes: int, record_start: int) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record by its index row: one frame is read, nothing else."""
    where, path = fs.FileSystem.from_uri(uri_of(bundle))
    with where.open_input_file(path) as f:
        f.seek(frame_start)
        plain = zstandard.ZstdDecompressor().decompress(f.read(frame_bytes))
    head, body, _ = parse_record(plain, record_start)
    return head, body


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to).

    Digests are counted with partial aggregates; only those that occur twice or more are joined
    back, so the payloads move only where that set is too large to be sent to every task."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("payload_digest", F.sha2("payload", 256))
    twice = (rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1").drop("n"))
    out = rows.join(twice, "payload_digest", "left")
    refers = F.when((F.col("payload_bytes") >= least) & (F.col("page_id") > F.col("first_id")), F.col("first_id"))
    return out.select("page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, base: str) -> DataFrame:
    """Write the bundles under ``base``; the index, materialised once beside them."""
    spark = pages.sparkSession
    ready(spark)
    names = [x.split()[0] for x in INDEX.split(", ")]

    def run(batches):
        where, root = fs.FileSystem.from_uri(uri_of(base))
        writer, bundle, n = None, "", 0

        def finished():
            rows = [(bundle, *r) for r in writer.close()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()),
                    strict=True)], names)

        for b in batches:
            for page_id, url, payload, n_bytes, digest, refers in zip(
                    *(b.column(k).to_pylist() for k in range(6)), strict=True):
                if writer is None:
                    where.create_dir(root, recursive=True)
                    bundle, n = f"{base}/{uuid.uuid4().hex}.warc.zst", 0
                    writer = BundleWriter(where.open_output_stream(f"{root}/{bundle.rpartition('/')[2]}", compression=None))
                rid = record_id(page_id, bundle, n)
                n += 1
                writer.add(rid, warc_record(rid, page_id, url, payload, digest, n_bytes, refers))
                if writer.at >= BUNDLE_BYTES:
                    yield finished()
                    writer = None
        if writer is not None:
            yield finished()

    return written(spark, with_revisits(pages).mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of all bundles that the index lists, frame by frame; a revisit has a null payload.
    Every response is held against its digest, every index row against the bundle.  A task reads one bundle."""
    spark = index.sparkSession
    ready(spark)
    bundles = index.groupBy("bundle").agg(F.count("*").alias("n"))
    count = index.select(F.count_distinct("bundle")).first()[0]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def run(batches):
        for b in batches:
            for bundle, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                where, path = fs.FileSystem.from_uri(uri_of(bundle))
                seen = 0
                with where.open_input_file(path) as f:
                    for start, size, plain in seek_table(f):
                        f.seek(start)
                        data = zstandard.ZstdDecompressor().decompress(f.read(size), max_output_size=plain)
                        rows, at = [], 0
                        while at < len(data):
                            head, body, at = parse_record(data, at)
                            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                            kind = head["WARC-Type"]
                            if kind == "response" and (hashlib.sha256(body).hexdigest() != digest
                                                       or len(body) != int(head["X-Payload-Length"])):
                                raise ValueError(f"{head['WARC-Record-ID']}: payload and digest differ")
                            page, to = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                            rows.append((head["WARC-Record-ID"], None if page is None else int(page), kind,
                                         head["WARC-Target-URI"], int(head["X-Payload-Length"]), digest,
                                         None if to is None else int(to),
                                         body if payloads and kind == "response" else None))
                        seen += len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                if seen != n:
                    raise ValueError(f"{bundle}: {seen} records, {n} in the index")

    # by range, not by hash: a task for each bundle, where the aggregate above dealt them out by hash
    return bundles.repartitionByRange(min(max(count, 1), MOST_TASKS), "bundle").mapInArrow(run, RECORDS)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    base = checkpoint_path(spark, f"llm-warc-{uuid.uuid4().hex}")
    index = write_archives(table(spark, sf_dir, "pages"), base)
    return read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                       "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
