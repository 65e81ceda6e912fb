"""Content-addressed WARC archive: payload bytes once by digest, exact record headers apart, records rebuilt by joins."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, place, read, scratch, shuffle_parts

#: Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
#: What ends a record.
END = b"\r\n\r\n"
#: Compressed bytes after which a task begins a further file.
FILE_BYTES = 256 << 20


def base32(hex40: Column) -> Column:
    """Base32 of a 40-digit hexadecimal string: four times ten digits make eight letters."""
    letters = []
    for k in range(4):
        v = F.conv(F.substring(hex40, 1 + 10 * k, 10), 16, 10).cast("long")
        letters += [F.substring(F.lit(BASE32), (F.shiftright(v, 5 * (7 - i)).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*letters)


def _payloads(pages: DataFrame) -> DataFrame:
    p = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), p.alias("payload")).select("*", F.sha2("payload", 256).alias("key"), F.length("payload").cast("long").alias("size"))


def _compressed(rows: DataFrame) -> DataFrame:
    """``(page_id, key, size, payload)`` with each payload as a zstd frame, so that little moves and is stored."""

    def run(batches: Iterator[pa.RecordBatch]):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            frames = pa.array([z.compress(p) for p in column(b, "payload").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([column(b, c) for c in ("page_id", "key", "size")] + [frames], ["page_id", "key", "size", "frame"])

    return arrow_map(rows.select("page_id", "key", "size", "payload"), run, "page_id long, key string, size long, frame binary")


def write_archive(pages: DataFrame, folder: str, min_payload: int = 0) -> None:
    """Writes ``folder/payloads`` (key, size, frame: each payload once, compressed) and ``folder/headers`` (one row for each record: page_id, key, size, response, header).

    A payload is known by its SHA-256 and length.  Of records with equal
    payloads of at least ``min_payload`` bytes the one with the largest page_id
    is the response and the others revisit it; smaller ones are all responses.
    Null html is empty, a null url leaves out the target line, a null page_id
    counts as the smallest; rows that repeat a page_id and payload share its type;
    long payloads are stored whole; an empty table gives an archive without records.
    """
    rows = _payloads(pages)
    meta = rows.select("page_id", "url", "key", "size", F.sha1("payload").alias("sha1"))
    last = rows.groupBy("key", "size").agg(F.max("page_id").alias("last"))
    own = F.col("page_id").eqNullSafe(F.col("last")) | (F.col("size") < min_payload)
    records = meta.join(last, ["key", "size"]).withColumn("type", F.when(own, "response").otherwise("revisit"))
    digest = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    uid = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    length = F.when(F.col("type") == "response", F.col("size")).otherwise(0) + len(HTTP)
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", uid(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "%0A")), F.lit("")),
        line("WARC-Payload-Digest", digest),
        F.when(F.col("type") == "revisit", F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", uid(F.col("last"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n" + HTTP),
    ).cast("binary")
    zstd = lambda df, name: df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    zstd(records.select("page_id", "key", "size", (F.col("type") == "response").alias("response"), header.alias("header")), "headers")
    # a frame for each payload of a map task, not of a record, is moved; equal payloads have equal frames
    zstd(_compressed(rows).groupBy("key", "size").agg(F.max_by("frame", F.coalesce("page_id", F.lit(-(1 << 63)))).alias("frame")), "payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``(header, key, size, frame)`` of every record: exact header bytes; a response's payload joins it by digest and length, a revisit has none.

    Revisits stay where they are, so a payload with many copies moves once.  A
    response without its payload has a null frame, which ``export_files``
    refuses; an archive without records gives no rows.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    stored = spark.read.parquet(f"{folder}/payloads")
    own = headers.where("response").join(stored, ["key", "size"], "left").select("header", "key", "size", "frame")
    return own.unionByName(headers.where("not response").select("header", "key", "size", F.lit(None).cast("binary").alias("frame")))


def parse_header(header: bytes) -> dict[str, str]:
    head, _, _ = header.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k: v for k, _, v in (x.partition(": ") for x in lines)}


def _page(uid: str | None) -> int | None:
    value = uid[len("<urn:page:") : -1] if uid else "null"
    return None if value == "null" else int(value)


def record_bytes(header: bytes, key: str, size: int, frame: bytes | None, z: zstandard.ZstdDecompressor) -> bytes:
    """The original record; ValueError if its payload is missing, damaged, or is not the one its SHA-256 and length name."""
    h = parse_header(header)
    if h["WARC-Type"] != "response":
        return header + END
    if frame is None:
        raise ValueError(f"payload of {h['WARC-Record-ID']} is missing")
    try:
        payload = z.decompress(frame)
    except zstandard.ZstdError as e:
        raise ValueError(f"payload of {h['WARC-Record-ID']} is damaged") from e
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != key:
        raise ValueError(f"payload of {h['WARC-Record-ID']} is not the one of its key")
    return header + payload + END


def export_files(records: DataFrame, folder: str, most: int = FILE_BYTES) -> DataFrame:
    """Writes the records of ``read_archive`` as ``*.warc.gz`` files, a gzip member for each; returns (file, records).

    A task goes on to a further file after about ``most`` compressed bytes.
    Tasks without records write no file, an empty archive none at all.  A
    payload that is missing or is not the one of its key raises ValueError.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]):
        ctx = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name, part = f"{root}/records-{ctx.partitionId():06d}", f".{ctx.taskAttemptId()}.part"
        z, out, done, n, size = zstandard.ZstdDecompressor(), None, [], 0, 0

        def close():
            out.close()
            at = f"{name}-{len(done):04d}"
            place(fs, at + part, f"{at}.warc.gz")
            done.append((f"{at}.warc.gz", n))

        for b in batches:
            for row in zip(*(column(b, c).to_pylist() for c in ("header", "key", "size", "frame")), strict=True):
                member = gzip.compress(record_bytes(*row, z), compresslevel=4, mtime=0)
                if out is None:
                    out, n, size = fs.open_output_stream(f"{name}-{len(done):04d}{part}", compression=None), 0, 0
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= most:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["file", "records"])

    return arrow_map(records, run, "file string, records long")


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open ``.warc.gz`` file, one at a time; a cut or damaged file raises ValueError."""
    try:
        with gzip.GzipFile(fileobj=stream, mode="rb") as f:
            while head := f.readline():
                while not head.endswith(b"\r\n\r\n"):
                    line = f.readline()
                    if not line:
                        raise ValueError("a record's header is cut")
                    head += line
                h = parse_header(head)
                n = int(h["Content-Length"])
                block = f.read(n)
                if len(block) != n or f.read(len(END)) != END:
                    raise ValueError(f"record {h['WARC-Record-ID']} does not match its header")
                yield h, block
    except (EOFError, OSError, zlib.error) as e:
        raise ValueError("a WARC file is cut or damaged") from e


def _page(uid: str | None) -> int | None:
    value = uid[len("<urn:page:") : -1] if uid else "null"
    return None if value == "null" else int(value)


_ROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _described(h: dict[str, str], block: bytes) -> tuple:
    """A row of ``_ROW``: a response's length and digest are taken from its bytes, a revisit's length is left null."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    response = h["WARC-Type"] == "response"
    if not mark or (h["WARC-Payload-Digest"] != f"sha1:{digest}" if response else payload):
        raise ValueError(f"record {h['WARC-Record-ID']} does not match its header")
    return _page(h["WARC-Record-ID"]), len(payload) if response else None, h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], _page(h.get("WARC-Refers-To"))


def describe_files(files: DataFrame) -> DataFrame:
    """``files(file, records)`` -> ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, read from the files' bytes.

    Each record is parsed and its length and digest are verified; a revisit
    takes the length of the response that it refers to, which must be there with
    the same digest.  A damaged file, one with another number of records, or a
    revisit without its response raises an error; no files give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for name, n in zip(column(b, "file").to_pylist(), column(b, "records").to_pylist(), strict=True):
                fs, path = pafs.FileSystem.from_uri(name)
                rows, seen = [], 0
                with fs.open_input_stream(path, compression=None) as f:
                    for h, block in read_records(f):
                        rows.append(_described(h, block))
                        seen += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW.types, strict=True)], schema=_ROW)
                            rows = []
                if seen != n:
                    raise ValueError(f"{path} has {seen} records, not {n}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW.types, strict=True)], schema=_ROW)

    found = cut(arrow_map(files, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"), "warc-read")
    responses, revisits = found.where("record_type = 'response'"), found.where("record_type <> 'response'")
    sizes = responses.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("size"))
    lost = F.raise_error(F.concat(F.lit("revisit without its response: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("long")
    joined = revisits.join(sizes, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.coalesce("size", lost))
    return responses.unionByName(joined.select(responses.columns))


def describe_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Rebuilds all records of an archive by joins, writes them as WARC files below the shared folder, and describes what is read back from those.

    Payloads are held against their SHA-256 as records are rebuilt and against
    the SHA-1 of their header as files are read; an archive without records
    gives no rows, one that is damaged an error.
    """
    files = cut(export_files(read_archive(spark, folder), scratch(spark, "warc-files")), "warc-list")
    tasks = max(1, min(files.count(), 16 * shuffle_parts(spark)))
    return describe_files(files.repartition(tasks))


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as an archive, rebuilds its records into WARC files and describes those; nulls, repeats and empty tables as in ``write_archive``."""
    folder = scratch(spark, "warc")
    write_archive(read(spark, sf_dir, "pages"), folder)
    return describe_archive(spark, folder)


#: DuckDB has no base32; the digest is built from the bits of the hexadecimal SHA-1.
OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(h, CAST(1 + 10 * (i // 8) AS INTEGER), 10))::BIGINT >> CAST(5 * (7 - i % 8) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM g
"""
