"""Intermediate tables of iterative operators: written to the shared folder, so lineage stays short and lost executors cost little."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, an own one on a local master, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it back; the folder goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/registry/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, *sort: str) -> DataFrame:
    """As ``settle``, bucketed by ``key``: what is grouped or joined by it later is not shuffled again.  ``df`` should be partitioned by ``key`` already.

    With columns to ``sort`` by, after the key, files are a fraction of their size: numbers of a key lie close.
    """
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/registry/{unique}"
    writer = df.write.format("parquet").option("path", path).bucketBy(buckets, key)
    (writer.sortBy(key, *sort).option("compression", "zstd") if sort else writer).saveAsTable(unique)
    atexit.register(_drop, spark, unique)
    atexit.register(_remove, spark, path)
    return spark.table(unique)


def hold(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """``settle``; with ``few``, for results that the caller has bounded, rows are kept in the plan instead of in files."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema) if few else settle(df, name)


def _drop(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:  # the session has ended
        pass


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended
        pass


#: Rows up to which a settled table may be sent to all tasks.
SMALL = 200_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """A settled table, marked for broadcast if it has at most ``rows`` rows (a count from file footers); larger ones are left to shuffle joins."""
    return F.broadcast(df) if df.count() <= rows else df


#: Rows up to which the names of persons are sent to all tasks (about 200 bytes each): their texts are then in no shuffle.
NAMES = 1_000_000


def numbered(df: DataFrame, key: str) -> DataFrame:
    """``(key, code)``: the distinct values of a column and their places in its order from 0, as int; sorted by ranges, so no task has all."""
    once = df.select(key).distinct()
    rows = settle(once.repartitionByRange(key).sortWithinPartitions(key).withColumn("_m", F.monotonically_increasing_id()), "numbers")
    block = F.shiftright("_m", 33)
    before, at = {}, 0
    for r in sorted(rows.groupBy(block.alias("block")).agg(F.count("*").alias("n")).collect()):
        before[r.block], at = at, at + r.n
    if not before:
        return rows.select(key, F.lit(0).alias("code"))
    if at >= 1 << 31:
        raise ValueError(f"more than {1 << 31} values of {key}")
    start = F.array(*(F.lit(before.get(b, 0)) for b in range(max(before) + 1)))
    return settle(rows.select(key, (start[block.cast("int")] + F.col("_m").bitwiseAND((1 << 33) - 1)).cast("int").alias("code")), "codes")
