"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; each bundle ends
with the seek table of the public seekable format (a skippable frame listing
every frame's compressed and decompressed size).  An index maps each record
identifier to its bundle, frame and offset inside the decompressed frame, so
one record is read by one seek and one small decompression.
"""

from __future__ import annotations

import base64
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import join_counted, materialize, task_count

# Fixed values of the seekable Zstandard format and of WARC/1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = "record_id long, bundle string, frame_start long, frame_size long, offset long, length long"
RECORD_SCHEMA = ("record_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, payload binary")


class BundleWriter:
    """One bundle: frames of about ``frame_bytes`` of records each, then the seek table."""

    def __init__(self, uri: str, frame_bytes: int, level: int):
        fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs, self.name = fs, uri.rsplit("/", 1)[1]
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out, self.frame_bytes = fs.open_output_stream(self.tmp, compression=None), frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.entries, self.pending, self.size, self.start = [], [], 0, 0

    def add(self, record_id: int | None, record: bytes) -> list[tuple]:
        """Buffer a record; the index rows of the frame that this fills, if it fills one."""
        self.pending.append((record_id, self.size, record))
        self.size += len(record)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.pending:
            return []
        frame = self.compressor.compress(b"".join(r for _, _, r in self.pending))
        rows = [(i, self.name, self.start, len(frame), at, len(r)) for i, at, r in self.pending]
        self.out.write(frame)
        self.entries.append((len(frame), self.size))
        self.start += len(frame)
        self.pending, self.size = [], 0
        return rows

    def close(self) -> list[tuple]:
        """The last index rows.  The file takes its name only when whole, so retries and
        speculative copies of a task replace each other's file by an equal one."""
        rows = self.flush()
        table = b"".join(struct.pack("<II", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return rows


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from a bundle's footer."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable Zstandard bundle")
    sizes = struct.iter_unpack("<II", bundle[len(bundle) - 9 - 8 * count:-9])
    out, start = [], 0
    for packed_size, size in sizes:
        out.append((start, packed_size, size))
        start += packed_size
    return out


def _record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:  # line ends would break the header: percent-encode them (and the escape itself)
        head.append("WARC-Target-URI: " + re.sub(r"[%\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        block = http + b"\r\n"
    else:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one decompressed frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        block = data[end + 4:end + 4 + size]
        at = end + 4 + size + 4
        page = head["WARC-Record-ID"][len("<urn:page:"):-1]
        url = head.get("WARC-Target-URI")
        refers = head.get("WARC-Refers-To")
        response = head["WARC-Type"] == "response"
        yield {"record_id": int(page) if page else None,
               "url": None if url is None else re.sub("%(25|0D|0A)", lambda m: chr(int(m[1], 16)), url),
               "payload_bytes": int(head["X-Payload-Length"]),
               "payload_digest": head["WARC-Payload-Digest"].partition(":")[2], "record_type": head["WARC-Type"],
               "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None,
               "payload": block[block.index(b"\r\n\r\n") + 4:] if response else None}


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_dedup_bytes: int = 0, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 25,
                  level: int = 3) -> DataFrame:
    """Write one record per row to bundles under ``path`` (a URI on shared storage); returns the index
    (``record_id, bundle, frame_start, frame_size, offset, length``).

    Of records with equal payloads of at least ``min_dedup_bytes`` bytes, the one with the largest id is
    the response, the others are revisits that refer to it and hold no payload.

    Edge cases: a null payload is an empty one; a null url is left out; rows with a null id get an empty
    identifier and are revisits if an equal payload has an id, else responses; rows repeating the largest
    id with an equal payload are all responses; an empty table writes no bundle.  A bundle closes after
    ``bundle_bytes`` of records, so only a single larger record exceeds it.  Other columns are not read.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    slim = rows.where(F.octet_length("payload") >= min_dedup_bytes).select("id", "sha")
    groups = slim.groupBy("sha").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialize(groups, "payload-groups")
    size = pages.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0))).first()
    revisits = join_counted(slim, groups, ["sha"], "n", size[0]).where(~F.col("id").eqNullSafe(F.col("best")))
    # One key of 128 bits on both sides: the payloads are shuffled once, for the join and the bundles alike.
    key = F.struct(F.xxhash64("id", "sha"), F.xxhash64(F.lit("second"), "id", "sha")).alias("k")
    tasks = task_count(spark, size[1], bundle_bytes)
    placed = (rows.select("*", key).repartition(tasks, "k").join(revisits.select(key, "best").distinct(), "k", "left")
              .select("id", "url", "payload", "sha", "best", F.col("best").isNotNull().alias("revisit"))
              .sortWithinPartitions("id", "sha", "url"))

    def write(batches):
        part, count, bundle, held = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                if bundle is None:
                    bundle = BundleWriter(f"{path}/bundle-{part:06d}-{count:04d}.warc.zst", frame_bytes, level)
                    count, held = count + 1, 0
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                record = _record(row["id"], row["url"], row["payload"], digest, row["best"], row["revisit"])
                index += bundle.add(row["id"], record)
                held += len(record)
                if held >= bundle_bytes:
                    index += bundle.close()
                    bundle = None
            yield _batch(index)
        if bundle is not None:
            yield _batch(bundle.close())

    _make_folder(spark, path)
    return materialize(placed.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _batch(index: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*index)) or [()] * 6
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles under ``path``; a response's payload is checked against its digest.
    ``payloads=False`` leaves the payload column out of the result."""
    fields = [f for f in RECORD_SCHEMA.split(", ") if payloads or not f.startswith("payload ")]
    names = [f.split()[0] for f in fields]

    def read(batches):
        import hashlib

        decompressor = zstandard.ZstdDecompressor()
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        for batch in batches:
            for cell in batch.column(0):
                bundle = cell.as_py()
                for start, packed_size, size in seek_table(bundle):
                    frame = decompressor.decompress(bundle[start:start + packed_size], max_output_size=size)
                    records = list(parse_records(frame))
                    for r in records:
                        if r["payload"] is not None and base64.b32encode(
                                hashlib.sha1(r["payload"]).digest()).decode() != r["payload_digest"]:
                            raise ValueError(f"record {r['record_id']}: the payload does not match its digest")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[n] for r in records], types[f.split()[1]]) for n, f in zip(names, fields)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("content").mapInArrow(read, ", ".join(fields))


def fetch_records(index: DataFrame, path: str, ids: DataFrame) -> DataFrame:
    """Random access: the records whose id is in the first column of ``ids``.  Only their frames are read."""
    wanted = ids.select(F.col(ids.columns[0]).cast("long").alias("record_id")).distinct()
    hits = index.join(wanted, "record_id").repartition("bundle").sortWithinPartitions("bundle", "frame_start")

    def read(batches):
        decompressor, types = zstandard.ZstdDecompressor(), {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        fields = [f.split() for f in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            last, frame = None, b""
            for hit in batch.to_pylist():
                if last != (hit["bundle"], hit["frame_start"]):
                    last = hit["bundle"], hit["frame_start"]
                    fs, at = pafs.FileSystem.from_uri(f"{path}/{hit['bundle']}")
                    with fs.open_input_file(at) as f:
                        f.seek(hit["frame_start"])
                        frame = decompressor.decompress(f.read(hit["frame_size"]))
                records = list(parse_records(frame[hit["offset"]:hit["offset"] + hit["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], types[t]) for n, t in fields],
                                                 [n for n, _ in fields])

    return hits.mapInArrow(read, RECORD_SCHEMA)


def archive_sql() -> str:
    """What :func:`read_archive` gives for the table ``pages``, in DuckDB SQL: a SHA-1 in base 32 is eight
    times five hex digits, each of four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, payload, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{letters}', CAST(
         (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digests"""
