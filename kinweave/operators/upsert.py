"""Keyed upserts over file tables, and edge loads that need both ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``source``, and those of ``target`` whose key it lacks; a null in a key is a value like others, so a rerun changes nothing."""
    t, k = target.alias("t"), source.select(*key).distinct().alias("k")
    kept = t.join(k, [F.col(f"t.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key], "left_anti")
    return kept.unionByName(source)


def merge_properties(target: DataFrame, source: DataFrame, key: list[str], on_create: tuple[str, ...] = ()) -> DataFrame:
    """All rows of either, a column at a time: columns that ``source`` has replace those of ``target``, the others stay.

    Columns in ``on_create`` are set for new rows only.  A column that one side
    lacks is null for rows of the other alone.  A null that the source gives
    takes the value away, as it is given.  A null in a key is a value like others.
    Either side must not repeat a key.
    """
    t, s = target.withColumn("_old", F.lit(True)).alias("t"), source.withColumn("_new", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key], "full")
    old, new = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()

    def value(c: str):
        if c in key:
            return F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c not in target.columns:
            return F.when(old, F.lit(None)).otherwise(F.col(f"s.{c}")) if c in on_create else F.col(f"s.{c}")
        return F.when(new & ~old if c in on_create else new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    columns = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    return both.select(*(value(c).alias(c) for c in columns))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, key: list[str], partition_by: list[str] | None = None) -> None:
    """Merges into a table kept as numbered versions below ``path``.

    The new version is written whole beside the old one, under a name of its
    own, and moved to its number only then; the pointer file that names it is
    created last, so a reader never meets a half-written table and a failed run
    changes nothing.  A source that repeats a key is refused.  Of two writers of
    one version the second finds the number taken and raises RuntimeError.
    """
    from pyspark.errors import AnalysisException

    version = current_version(spark, path)
    if repeated_keys(source, key).limit(1).count():
        raise ValueError(f"{path}: the source repeats a key")
    if version is not None:
        try:
            source = merge(read_table(spark, path).select(*source.columns), source, key)
        except AnalysisException as e:
            raise ValueError(f"{path}: the table and the source have different columns") from e
    _publish(spark, path, source, partition_by, version)


def _publish(spark: SparkSession, path: str, source: DataFrame, partition_by: list[str] | None, version: int | None) -> None:
    """Writes ``source`` as the version after ``version``, which it was made from."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = 0 if version is None else version + 1
    own = f"{path}/_new-{uuid.uuid4().hex}"
    (source.write.partitionBy(*partition_by) if partition_by else source.write).parquet(own)
    try:
        fs.create(hpath(f"{path}/_writer_{new}"), False).close()
    except Exception as e:  # the file system refuses to create what is there
        fs.delete(hpath(own), True)
        raise RuntimeError(f"{path}: version {new} is being written by another run, or by one that failed (then remove _writer_{new})") from e
    try:
        if fs.exists(hpath(f"{path}/_current_{new}")):
            raise RuntimeError(f"{path}: another run has written version {new}")
        fs.delete(hpath(f"{path}/v{new}"), True)  # left by a run that failed before its pointer
        if not fs.rename(hpath(own), hpath(f"{path}/v{new}")):
            raise RuntimeError(f"{path}: version {new} could not be moved into place")
        fs.create(hpath(f"{path}/_current_{new}"), False).close()
    finally:
        fs.delete(hpath(f"{path}/_writer_{new}"), False)


def delete_keys(spark: SparkSession, path: str, gone: DataFrame, key: list[str], partition_by: list[str] | None = None) -> None:
    """A new version without the rows whose key is in ``gone``; nothing happens if there is no version yet."""
    version = current_version(spark, path)
    if version is None:
        return
    t, k = read_table(spark, path).alias("t"), gone.select(*key).distinct().alias("k")
    _publish(spark, path, t.join(k, [F.col(f"t.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key], "left_anti"), partition_by, version)


def current_version(spark: SparkSession, path: str) -> int | None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath(f"{path}/_current_*"))
    numbers = [int(s.getPath().getName().rpartition("_")[2]) for s in found or []]
    return max(numbers) if numbers else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise ValueError(f"{path} has no version")
    return spark.read.parquet(f"{path}/v{version}")


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the latest ``keep`` versions; readers of an older one fail from then on."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    latest = current_version(spark, path)
    for n in range((latest if latest is not None else -1) - max(1, keep) + 1):
        fs.delete(hpath(f"{path}/_current_{n}"), False)
        fs.delete(hpath(f"{path}/v{n}"), True)


def loadable_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """``edges(src, dst, ...)`` with both ends in ``vertices(id)``, once each."""
    v = vertices.select("id").distinct()
    return edges.join(v.withColumnRenamed("id", "src"), "src", "left_semi").join(v.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*edges.columns).distinct()


def with_missing(vertices: DataFrame, ends: DataFrame, person_type) -> DataFrame:
    """``vertices(id, person_type)`` and the ids of ``ends`` that they lack, with the given type."""
    new = ends.distinct().join(vertices.select("id"), "id", "left_anti")
    return vertices.select("id", "person_type").unionByName(new.select("id", person_type.alias("person_type")))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys of more than one row: empty where the key is unique."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def export_csv(df: DataFrame, path: str) -> None:
    """One delimited file with a header, for small exports."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_json(cache: DataFrame, path: str) -> None:
    """One JSON document a line, in gzip files: ids recur all through a document."""
    cache.select(F.col("ego_json").alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
