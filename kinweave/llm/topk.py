"""Exact inner-product top-k by columnar branch-and-bound over quantised vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, ship

K = 5
#: Rows of a block of candidates and of queries: what one task holds at a time.
CANDIDATES, QUERIES = 8192, 4096
#: Dimensions of a vertical block.
DIMS = 16
#: Squared norms stay below this, a little under the largest long.
NORM = 9.2e18


def quantise(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, v array<long>)`` with floor(scale * x); vectors (and ids) null or with null or non-finite components go.

    Repeated rows stay, each by itself.  A vector whose squared norm could pass
    a long raises an error: below it no inner product, whole or of some
    dimensions, leaves a long.
    """
    x = F.transform("embedding", lambda e: e.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    rows = rows.where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    norm = F.aggregate("x", F.lit(0.0), lambda a, e: a + F.pow(F.abs(e * scale) + 1, F.lit(2.0)))
    refused = F.raise_error(F.concat(F.lit("the scores of a vector leave a long: vec_id "), F.col("vec_id").cast("string"))).cast("array<bigint>")
    return rows.select("vec_id", F.when(norm < NORM, F.transform("x", lambda e: F.floor(e * scale).cast("long"))).otherwise(refused).alias("v"))


def branch_and_bound(cand: np.ndarray, cand_id: np.ndarray, query: np.ndarray, query_id: np.ndarray, k: int = K) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (row number, candidate ids, scores) of its k best in this block, ties to smaller ids.

    ``cand`` is n x d, laid out vertically here: one array for each block of
    dimensions.  After each block a candidate's score lies within the product
    of the remaining norms; those that cannot reach the k-th best lower bound
    go, and the rest is compacted before the next block.
    """
    n, d = cand.shape
    exact = np.float64 if max(int(np.abs(cand).max(initial=0)), int(np.abs(query).max(initial=0))) ** 2 * max(d, 1) < 2**53 else np.int64
    order = np.argsort(-(cand.astype(np.float64) ** 2).sum(0), kind="stable")
    blocks = [order[i : i + DIMS] for i in range(0, d, DIMS)] or [order]
    columns = [np.ascontiguousarray(cand[:, b].T.astype(exact)) for b in blocks]

    def remaining(rows: np.ndarray) -> list[np.ndarray]:
        mass = [(rows[:, b].astype(np.float64) ** 2).sum(1) for b in blocks]
        return [np.sqrt(sum(mass[i + 1 :], np.zeros(len(rows)))) * (1 + 1e-9) for i in range(len(blocks))]

    cand_rest, query_rest = remaining(cand), remaining(query)
    out = []
    for lo in range(0, len(query), 64):
        q = query[lo : lo + 64].astype(exact)
        first = q[:, blocks[0]] @ columns[0]
        for i in range(len(q)):
            me = lo + i
            live = np.flatnonzero(cand_id != query_id[me])
            acc, rest, low = first[i][live], cand_rest[0][live] * query_rest[0][me], -np.inf
            for j in range(len(blocks)):
                if j:
                    acc = acc + q[i, blocks[j]] @ columns[j][:, live]
                    rest = cand_rest[j][live] * query_rest[j][me]
                if len(live) > k:
                    bound = acc - rest
                    low = max(low, np.partition(bound, len(bound) - k)[len(bound) - k])
                    keep = acc + rest >= low - 1e-6
                    if not keep.all():
                        live, acc = live[keep], acc[keep]
            best = np.lexsort((cand_id[live], -acc))[:k]
            out.append((me, cand_id[live][best], acc[best].astype(np.int64)))
    return out


def _matrix(values: pa.ChunkedArray) -> np.ndarray:
    a = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return np.asarray(a.flatten().cast(pa.int64())).reshape(len(a), -1) if len(a) else np.zeros((0, 0), np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``vectors(vec_id, v)`` and ``queries(vec_id, v)`` -> ``(query_id, rank, vec_id, score)``.

    Both sides are dealt into blocks by a hash of the id, and every pair of a
    query block and a candidate block is one group of bounded size; each gives
    k rows for each of its queries, and the best k of those are the result.
    A query meets all vectors of its own length but those with its own id; with
    fewer than k it gets them all.  Repeated rows of a candidate each count;
    equal repeated query rows count once.  Empty sides give no rows.  Squared
    norms must fit in 64 bits, as ``quantise`` sees to.
    """
    spark = vectors.sparkSession
    ship(spark)
    queries = queries.distinct()
    blocks = lambda df, size: max(1, -(-df.count() // size))
    cb, qb = blocks(vectors, CANDIDATES), blocks(queries, QUERIES)
    dim = F.size("v").alias("dim")
    c = vectors.select("vec_id", "v", dim, F.pmod(F.xxhash64("vec_id"), F.lit(cb)).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("q"), F.lit(False).alias("query"))
    q = queries.select("vec_id", "v", dim, F.explode(F.sequence(F.lit(0), F.lit(cb - 1))).alias("c"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(qb)).cast("int").alias("q"), F.lit(True).alias("query"))

    def run(t: pa.Table) -> pa.Table:
        is_query = np.asarray(t["query"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        ids, m = t["vec_id"].to_numpy(), _matrix(t["v"])
        got = branch_and_bound(m[~is_query], ids[~is_query], m[is_query], ids[is_query], k) if (~is_query).any() else []
        qid = ids[is_query]
        rows = [(qid[i], a, s) for i, a, s in got if len(a)]
        cat = lambda parts: np.concatenate([np.asarray(p, np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
        return pa.table({"query_id": cat([np.full(len(a), i) for i, a, _ in rows]), "vec_id": cat([a for _, a, _ in rows]), "score": cat([s for _, _, s in rows]), "dim": pa.array(np.full(sum(len(a) for _, a, _ in rows), m.shape[1]), pa.int32())})

    cells = c.unionByName(q).groupBy("dim", "c", "q").applyInArrow(run, "query_id long, vec_id long, score long, dim int")
    w = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every fiftieth vector among all others; nulls and too large values as in ``quantise``, repeats and empty tables as in ``top_k``."""
    vectors = quantise(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
