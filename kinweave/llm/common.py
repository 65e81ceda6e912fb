"""Helpers shared by the corpus operators: scratch tables, Arrow text access, word caches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; a batch of whole texts then stays within tens of MB.
ARROW_ROWS = 500

#: bytes.translate table: lower-cases A-Z and leaves every other byte.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, an own one on a local master, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the driver ends."""
    path = f"{shared_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; the folder's owner cleans the shared folder
        pass


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table in the shared folder and reads it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once for each application, so that their Python can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    package = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="kinweave-zip-")) / "kinweave.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(name))
    _shipped.add(sc.applicationId)


def _trimmed(fn):
    """``fn``, after which a worker gives the memory that it no longer needs back to the system."""

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for whole texts."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(_trimmed(fn), schema)


def place(fs, source: str, target: str) -> None:
    """Moves a finished file to its place.  What an earlier attempt of the task left there is the same file and stays, so it is never missing."""
    import pyarrow.fs as pafs

    if fs.get_file_info(target).type == pafs.FileType.NotFound:
        fs.move(source, target)
    else:
        fs.delete_file(source)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(rows: pa.RecordBatch, name: str) -> pa.Array:
    """The column in this batch, by position of its name (names are unique after ``select``)."""
    return rows.column(rows.schema.get_field_index(name))


def text_bytes(array: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8; null is empty."""
    return [v if v is not None else b"" for v in array.cast(pa.large_binary()).to_pylist()]


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the n+1 offsets of the texts in it."""
    a = array.cast(pa.large_binary())
    n, off = len(a), a.offset
    bufs = a.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[off : off + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]] if n else data[:0]
    if a.null_count:  # a null may still span bytes
        lengths = np.where(np.asarray(a.is_null()), 0, np.diff(offsets))
        parts = [data[s - offsets[0] : s - offsets[0] + k] for s, k in zip(offsets[:-1], lengths, strict=True)]
        return np.concatenate(parts) if parts else data, np.concatenate([[0], np.cumsum(lengths)])
    return data, offsets - (offsets[0] if n else 0)


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), vectorised and wrapping."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def held_out(doc_id: str = "doc_id"):
    """True if crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About the ``rows`` rows with the smallest hash of ``key`` (never more): a bounded sample that reruns repeat.

    Only the key is read to find the bound, so wide columns move for the sampled rows alone.
    """
    h = F.xxhash64(F.col(key), F.lit(7))
    last = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(h <= F.lit(last)).limit(rows) if last is not None else df.limit(0)


class WordRows:
    """word -> row of a table that grows as words appear; ``trim`` between texts bounds it."""

    def __init__(self, make: Callable[[bytes], np.ndarray], width: int, limit: int = 300_000, dtype=np.float32):
        self.make, self.limit = make, limit
        self.table = np.zeros((4096, width), dtype)
        self.rows = _Rows(self)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The rows of all words, one for each."""
        if len(self.rows) > self.limit:
            self.rows.clear()
        rows = self.rows
        at = np.array([rows[w] for w in words], np.int64)
        return self.table[at]  # only now: new words may have made it grow


class _Rows(dict):
    def __init__(self, owner: WordRows):
        super().__init__()
        self.owner = owner

    def __missing__(self, word):
        o, k = self.owner, len(self)
        if k >= len(o.table):
            o.table = np.concatenate([o.table, np.zeros_like(o.table)])
        o.table[k] = o.make(word)
        self[word] = k
        return k


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
