"""Tables laid out by the hash of their key: a lookup reads one folder, and an upsert rewrites only the folders that hold a changed key.

Folders are Spark's own partitions, by a column whose name tells how many there
are.  Within a folder rows are sorted by key, row groups are small and carry
Bloom filters of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import settle
from .upsert import merge, repeated_keys

#: Begin of the name of the folder column, which the number of folders follows.
PART = "_part_of_"
#: Bytes of a row group.
ROW_GROUP = 1 << 20


def _part(key: list, parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def _write(df: DataFrame, path: str, key: list[str], parts: int, mode: str) -> None:
    part = f"{PART}{parts}"
    rows = df.withColumn(part, _part([F.col(k) for k in key], parts)).repartition(parts, part).sortWithinPartitions(part, *key)
    writer = rows.write.mode(mode).partitionBy(part).option("compression", "zstd").option("parquet.block.size", ROW_GROUP).option("partitionOverwriteMode", "dynamic")
    for k in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(path)


def create(df: DataFrame, path: str, key: list[str], parts: int) -> None:
    """A new table at ``path``; one that is there is an error."""
    _write(df, path, key, parts, "errorifexists")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The whole table, with its folder column last."""
    return spark.read.parquet(path)


def _layout(table: DataFrame) -> tuple[str, int]:
    part = next((c for c in table.columns if c.startswith(PART)), None)
    if part is None:
        raise ValueError("the table is not laid out by key")
    return part, int(part[len(PART) :])


def rows_of(table: DataFrame, key: str, values: list) -> DataFrame:
    """The rows with these values of a key of one column: only their folders are read, and of these the row groups that may hold them."""
    part, parts = _layout(table)
    kind = table.schema[key].dataType
    wanted = [_part([F.lit(v).cast(kind)], parts) for v in dict.fromkeys(values)]
    # foldable, so the folders are chosen before anything is read
    return table.where(F.col(part).isin(wanted) & F.col(key).isin(values)).drop(part) if wanted else table.limit(0).drop(part)


def upsert(spark: SparkSession, path: str, source: DataFrame, key: list[str], gone: DataFrame | None = None) -> list[int]:
    """Merges ``source`` into a table and takes the keys in ``gone`` out, in one write; returns the folders that were rewritten.

    Only folders that hold a key of either are read and replaced; the files of
    the others stay as they are.  A key in both is replaced, not taken out.  The
    source is settled first, so that what is checked is what is written.  A
    repeated key is refused; a null in a key is a value like others; a second run
    changes nothing.  The same columns are required.
    """
    table = read(spark, path)
    part, parts = _layout(table)
    columns = [c for c in table.columns if c != part]
    if set(source.columns) != set(columns):
        raise ValueError(f"{path}: the table and the source have different columns")
    source = settle(source.select(*columns), "upsert")
    if repeated_keys(source, key).limit(1).count():
        raise ValueError(f"{path}: the source repeats a key")
    where = _part([F.col(k) for k in key], parts).alias(part)
    keys = source.select(*key)
    if gone is not None:
        gone = settle(gone.select(*key).distinct(), "gone")
        keys = keys.unionByName(gone)
    touched = sorted(r[0] for r in keys.select(where).distinct().collect())  # at most as many as there are folders
    if not touched:
        return []
    old = table.where(F.col(part).isin(touched)).select(*columns)
    if gone is not None:
        o, g = old.alias("o"), gone.alias("g")
        old = o.join(g, [F.col(f"o.{k}").eqNullSafe(F.col(f"g.{k}")) for k in key], "left_anti")
    merged = settle(merge(old, source, key), "merged")  # a folder cannot be read while it is replaced
    _write(merged, path, key, parts, "overwrite")
    left = {r[0] for r in merged.select(where).distinct().collect()}
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for n in touched:
        if n not in left:  # Spark replaces only folders that get rows
            empty = fs_path(f"{path}/{part}={n}")
            empty.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(empty, True)
    return touched
