"""Definitions of silver tables and of identities: what a column is made of, and which values make two records one entity."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A column: the first non-null of its sources, through ``make`` if given; ``type`` where it is not that of the source."""

    name: str
    sources: tuple[str, ...]
    make: Callable[..., Column] | None = None
    type: str | None = None
    required: bool = False

    def column(self) -> Column:
        value = self.make(*self.sources) if self.make else F.coalesce(*self.sources) if len(self.sources) > 1 else F.col(self.sources[0])
        return (value.cast(self.type) if self.type else value).alias(self.name)


def field(name: str, *sources: str, make: Callable[..., Column] | None = None, type: str | None = None, required: bool = False) -> Field:
    return Field(name, sources or (name,), make, type, required)


def constant(name: str, value: str) -> Field:
    return Field(name, (), lambda: F.lit(value))


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()

    def observed(self, df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        """``df`` to be written, and what to call afterwards: it raises if a required value was null in what was written.

        Columns that are missing, unknown or of another type than declared are an error at once.
        """
        names = [f.name for f in self.fields]
        if set(df.columns) != set(names) or len(df.columns) != len(names):
            raise ValueError(f"{self.name}: columns {', '.join(df.columns)} in place of {', '.join(names)}")
        for f in self.fields:
            if f.type and df.schema[f.name].dataType.simpleString() != f.type:
                raise ValueError(f"{self.name}: {f.name} is {df.schema[f.name].dataType.simpleString()}, not {f.type}")
        required = [f.name for f in self.fields if f.required]
        if not required:
            return df.select(*names), lambda: None
        seen = Observation()
        out = df.select(*names).observe(seen, *(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required))

        def verdict() -> None:
            bad = [c for c in required if seen.get[c]]
            if bad:
                raise ValueError(f"{self.name}: null in {', '.join(bad)}")

        return out, verdict

    def check_key(self, df: DataFrame) -> None:
        """Raises if two rows share the key."""
        if self.key and df.groupBy(*self.key).agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
            raise ValueError(f"{self.name}: {', '.join(self.key)} is not unique")

    def of(self, df: DataFrame) -> DataFrame:
        """The table made from ``df``; rows without a required value go, and a missing source is an error that names it."""
        lacking = sorted({s for f in self.fields for s in f.sources} - set(df.columns))
        if lacking:
            raise ValueError(f"{self.name}: no column {', '.join(lacking)}")
        out = df.select(*(f.column() for f in self.fields))
        for f in self.fields:
            if f.required:
                out = out.where(F.col(f.name).isNotNull())
        return out


@dataclass(frozen=True)
class Rule:
    """Records that agree in ``parts`` are one entity, if the ``needed`` parts are known.  Without a prefix the first part is the key."""

    prefix: str | None
    parts: tuple[str, ...]
    needed: tuple[str, ...]
    confidence: float


@dataclass(frozen=True)
class Identity:
    """Normalised values, and the rules that are tried in turn to make a record's key."""

    norms: Callable[[], dict[str, Column]]
    rules: tuple[Rule, ...]

    def keyed(self, records: DataFrame) -> DataFrame:
        """``records`` with the normalised values, ``cluster_key`` and the ``confidence`` of the rule that made it."""
        key = confidence = None
        for r in self.rules:
            value = F.concat_ws("|", F.lit(r.prefix), *(F.col(p).cast("string") for p in r.parts)) if r.prefix else F.col(r.parts[0]).cast("string")
            holds = F.lit(True)
            for p in r.needed:
                holds = holds & F.col(p).isNotNull()
            key = F.when(holds, value) if key is None else key.when(holds, value)
            confidence = F.when(holds, r.confidence) if confidence is None else confidence.when(holds, r.confidence)
        return records.withColumns(self.norms()).withColumns({"cluster_key": key, "confidence": confidence})


def best_row(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in a total order; the limit on the rank is applied before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
