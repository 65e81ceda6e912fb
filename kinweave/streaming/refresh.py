"""Incremental refresh of a network cache from a stream of changed ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import keyed
from ..operators.ego import citizen_reach, kin_steps, near_steps
from ..operators.tables import settle


#: Folders of a cache that a refresh makes.
FOLDERS = 64


def affected(changed: DataFrame, parent_links: DataFrame, spouse_links: DataFrame, depth: int = 3, old: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The changed ids and everybody whose network of that depth holds one of them: reach is symmetric.

    ``old``: the parent and spouse links before the change; who lost a link to a
    changed person is found over these, so both are walked.
    """
    ids = changed.select("id").distinct()
    found = ids
    for parents, spouses in ((parent_links, spouse_links), *([old] if old else [])):
        steps = near_steps(ids, settle(kin_steps(parents, spouses), "steps"), depth)
        found = found.unionByName(citizen_reach(ids, steps, depth).select("id"))
    return found.distinct()


def refresh(changes: DataFrame, build: Callable[[DataFrame], DataFrame], widen: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """For each batch of ``changes(id)``: widen the ids, rebuild their documents and merge them into the keyed table at ``path``.

    Ids for which ``build`` gives no document (persons that are gone) lose theirs
    in the same write.  Only folders with a changed document are rewritten.  A
    batch that runs again merges the same rows, so the table is exact after a
    failure.  A table that is absent is made, of FOLDERS folders.
    """

    def one(batch: DataFrame, _: int) -> None:
        ids = batch.where(F.col("id").isNotNull()).select("id").distinct()
        if ids.limit(1).count():
            spark = batch.sparkSession
            wide = settle(widen(ids), "refresh")
            made = settle(build(wide), "documents")
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
                keyed.create(made, path, ["entity_person_id"], FOLDERS)
                return
            gone = wide.select(F.col("id").alias("entity_person_id")).join(made.select("entity_person_id"), "entity_person_id", "left_anti")
            keyed.upsert(spark, path, made, ["entity_person_id"], gone)

    writer = changes.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
