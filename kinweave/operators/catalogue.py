"""Tables of Spark's catalogue: namespaces, tables that are made or replaced, and partitions by the day of a timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import settle

#: Suffix of the column that holds the day of a timestamp column; where a folder holds more days than one, their number follows.
DAY = "_day"
#: Folders of a table that hold a day each; beyond, days are taken together.
FOLDERS = 1000


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Makes a namespace if there is none of that name; its tables lie below ``location``, or where the catalogue puts them."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{name}`{where}")


def _day_column(table: DataFrame, column: str) -> tuple[str, int]:
    """The folder column of a table by the days of ``column``, and the days that a folder holds."""
    day = f"{column}{DAY}"
    name = next((c for c in table.columns if c == day or c.startswith(f"{day}_") and c[len(day) + 1 :].isdigit()), None)
    if name is None:
        raise ValueError(f"the table is not laid out by the day of {column}")
    return name, int(name[len(day) + 1 :] or 1)


def _span(df: DataFrame, column: str) -> int:
    """Days that a folder is to hold, a power of two: 1, or as many as leave at most FOLDERS folders, however the days lie."""
    days = settle(df.select(F.unix_date(F.to_date(column)).alias("day")).distinct(), "days")
    n, span = days.count(), 1
    while n > FOLDERS:
        span *= 2 ** max(1, (-(-n // FOLDERS) - 1).bit_length())
        n = days.select(F.floor(F.col("day") / span)).distinct().count()
        if span > 1 << 22:
            break
    return span


def save(df: DataFrame, table: str, day_of: str | None = None, mode: str = "overwrite") -> None:
    """Makes or replaces a table (or appends to it), in folders by the day of the timestamp ``day_of``.

    A null timestamp has a folder of its own.  Rows of a day are written by few
    tasks, so a day is few files.  Of more than FOLDERS days several are one
    folder, named by the first and by their number, so folders and files do not
    grow with the days; rows that are appended keep to the table's.
    """
    if not day_of:
        df.write.mode(mode).format("parquet").saveAsTable(table)
        return
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(table):
        day, span = _day_column(spark.table(table), day_of)
    else:
        span = _span(df, day_of)
        day = f"{day_of}{DAY}" if span == 1 else f"{day_of}{DAY}_{span}"
    first = F.to_date(day_of) if span == 1 else F.date_from_unix_date((F.floor(F.unix_date(F.to_date(day_of)) / span) * span).cast("int"))
    df.withColumn(day, first).repartition(F.col(day)).write.mode(mode).format("parquet").partitionBy(day).saveAsTable(table)


def within(table: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with ``start`` <= column < ``end`` (timestamps as text), without the day column: folders outside these days are not read."""
    day, span = _day_column(table, column)
    at = lambda text: F.lit(text).cast(table.schema[column].dataType)
    if start is not None:
        table = table.where((F.col(column) >= at(start)) & (F.col(day) >= F.date_sub(F.to_date(at(start)), span - 1)))
    if end is not None:
        table = table.where((F.col(column) < at(end)) & (F.col(day) <= F.to_date(at(end))))
    return table.drop(day)
