"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordRows, arrow_map, column, held_out, mix64, read, sample_by_hash

#: Labelled rows that a model is fitted on, at most.
TRAIN_DOCS = 8000
BITS = 20
EPOCHS = 5
#: Lengths of word stems that count as 1-grams beside the word, so that inflected forms share a weight.
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1

#: Bytes that separate words: ASCII but letters, digits and the apostrophe.
_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() or b == 39 else 32 for b in range(256))
#: (gap, multiplier) of the second word of pairs: neighbours, and skip-grams over one and two words.
_PAIRS = ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9))
_THIRD = 0x27D4EB2F165667C5


def word_hashes() -> WordRows:
    """word -> hashes of the word and of its stems (its first 4, 5 and 6 characters, marked as such)."""

    def make(word: bytes) -> np.ndarray:
        w = word.decode("utf-8", "replace")
        return np.array([xxhash.xxh3_64_intdigest(word), *(xxhash.xxh3_64_intdigest(f"{n}:{w[:n]}") for n in STEMS)], np.uint64)

    return WordRows(make, 1 + len(STEMS), dtype=np.uint64)


def features(text: str, hashes: WordRows) -> np.ndarray:
    """Feature buckets of a whole text, repeats included: words and stems, 2- and 3-grams, skip-grams."""
    w = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    if not w:
        return np.zeros(0, np.int64)
    rows = hashes(w)
    h = rows[:, 0].copy()
    parts = [mix64(rows.ravel())]
    for gap, k in _PAIRS:
        if len(h) > gap:
            parts.append(mix64(h[:-gap] ^ (h[gap:] * np.uint64(k))))
    if len(h) > 2:
        parts.append(mix64(h[:-2] ^ (h[1:-1] * np.uint64(_PAIRS[0][1])) ^ (h[2:] * np.uint64(_THIRD))))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Non-zero weights only, so that what tasks receive is compact."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.buckets] = self.weights
        return w

    def score(self, text: str, hashes: WordRows, dense: np.ndarray) -> float:
        f = features(text, hashes)
        f = np.unique(f[dense[f] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.bias + dense[f].sum(), -35, 35))))


def fit(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """FTRL-proximal with per-coordinate rates: each document is one update of the buckets it has."""
    n, z = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_n = bias_z = 0.0
    hashes = word_hashes()
    rows = [np.unique(features(t, hashes)).astype(np.int32) for t in texts]
    y = np.array(labels, float)
    rng = np.random.default_rng(seed)

    def weight(zi, ni, l1):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            f = rows[i]
            zf, nf = z[f], n[f]
            w = weight(zf, nf, L1)
            b = float(weight(np.array(bias_z), np.array(bias_n), 0.0))
            g = 1 / (1 + np.exp(-np.clip(b + w.sum(), -35, 35))) - y[i]
            s = (np.sqrt(nf + g * g) - np.sqrt(nf)) / ALPHA
            z[f] = zf + g - s * w
            n[f] = nf + g * g
            s = (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA
            bias_z += g - s * b
            bias_n += g * g
    w = weight(z, n, L1)
    keep = np.flatnonzero(w)
    return Model(keep, w[keep], float(weight(np.array(bias_z), np.array(bias_n), 0.0)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS) -> Model:
    """Fits on at most ``rows`` labelled documents outside the held-out fifth, chosen by a hash of the id.

    Null ids, null labels and null texts are not learned from; a repeated id counts as
    toxic if one of its labels is 1, and of its texts the first in order is learned.
    Without any label every score is 0.5.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = sample_by_hash(known, "doc_id", rows)
    got = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()  # at most rows
    got.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in got], [r["toxic"] for r in got])


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, score, predicted)``; null and empty texts get the score of the bias alone.

    Long texts are scored whole, repeated rows each alike, an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        hashes, dense = word_hashes(), model.dense()
        for b in batches:
            s = [model.score(t or "", hashes, dense) for t in column(b, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], ["doc_id", "score", "predicted"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document by a model of the labels outside the held-out fifth; nulls, repeats and empty tables as in ``train`` and ``score_texts``."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score_texts(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
