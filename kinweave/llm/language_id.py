"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, held_out, read, sample_by_hash

#: Labelled rows that a model is fitted on, at most; whole texts of these go to the driver.
TRAIN_DOCS = 3000
#: Subwords are 1- to GRAM-grams of characters; their embeddings have DIM numbers, in BUCKETS buckets.
GRAM, BITS, DIM = 4, 15, 16
BUCKETS = 1 << BITS
EPOCHS = 4
#: Share of documents of learned languages that calibration lets be rejected at most, and the share of foreign ones to reject.
REJECT_SHARE, CATCH = 0.001, 0.99
#: Standard deviations that the threshold stays below the calibrated one, as models differ a little.
SLACK = 0.5
#: Calibration rows from which a held-back fifth is enough; with fewer, five folds are scored in turn.
CALIBRATE = 250
#: Documents of a model that leaves a language out, and of those that it is tried on.
FOREIGN_DOCS = 400
UNKNOWN = "und"
#: Characters of texts that are read at once; a longer text is read in pieces.
PIECE = 1 << 20

#: ASCII but letters separates words.
_WORDS = bytes(b if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subwords(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(for each length, the bucket of the subword that begins at each character; places that are none, by character; where each text begins).

    Words lie between blanks, which mark their ends in subwords; what has a
    blank inside is no subword: its bucket is BUCKETS or more.
    """
    low = [t.lower() for t in texts]
    begin = np.cumsum([0] + [len(t) + 1 for t in low])[:-1]
    plain = (" " + " ".join(low) + " " * GRAM).encode("utf-8", "surrogatepass").translate(_WORDS)
    c = np.frombuffer(plain.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(c) - GRAM
    blank = c == 32
    h = np.zeros(n, np.uint32)
    inside = np.zeros(n, bool)  # a blank between the first and the last character
    none = np.zeros(n, np.uint8)
    out = []
    for k in range(GRAM):
        if k > 1:
            inside |= blank[k - 1 : k - 1 + n]
        h = (h ^ c[k : k + n]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        bad = blank[:n] if k == 0 else blank[:n] & blank[1 : 1 + n] if k == 1 else inside
        out.append(((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)).astype(np.intp) | bad.astype(np.intp) << BITS)
        none += bad
    return out, none, begin


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of the texts, texts or parts of them) of about PIECE characters each; a long text is parted at blanks, if it has any."""
    numbers: list[int] = []
    parts: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        at = 0
        while True:
            end = len(t)
            if end - at > PIECE:
                end = t.rfind(" ", at + 1, at + PIECE) + 1 or at + PIECE
            if parts and size + end - at > PIECE:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            numbers.append(i)
            parts.append(t[at:end])
            size += end - at
            at = end
            if at >= len(t):
                break
    if parts:
        yield numbers, parts


@dataclass
class Margin:
    """For each language, how far its texts are ahead of the second language: a median, and a variance that falls with the length."""

    middle: np.ndarray
    base: np.ndarray
    slope: np.ndarray

    @staticmethod
    def of(z: np.ndarray, n: np.ndarray) -> Margin:
        """From logits and lengths; languages with fewer than five texts share one estimate."""
        best, ahead = z.argmax(1), _ahead(z)

        def one(x: np.ndarray) -> tuple[float, float, float]:
            d, k = ahead[x], n[x]
            middle = float(np.median(d))
            square, long = (d - middle) ** 2, k >= np.median(k)
            base = float(np.median(square[long])) / 0.455 + 1e-9  # the median of chi-square with one degree of freedom
            slope = float(np.median((square[~long] - base) * k[~long])) / 0.455 if (~long).any() else 0.0
            return middle, base, max(0.0, slope)

        every = one(np.ones(len(z), bool))
        rows = [one(best == k) if (best == k).sum() >= 5 else every for k in range(z.shape[1])]
        return Margin(*(np.array(c) for c in zip(*rows, strict=True)))

    def deviation(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Standard deviations that each text is above (or below) the median of the language it is taken for."""
        best = z.argmax(1)
        return (_ahead(z) - self.middle[best]) / np.sqrt(self.base[best] + self.slope[best] / n)


def _ahead(z: np.ndarray) -> np.ndarray:
    top = np.sort(z, axis=1)
    return top[:, -1] - top[:, -2]


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  #: bucket x language: embedding times output weights
    bias: np.ndarray
    temperature: float = 1.0
    margin: Margin | None = None  #: calibrated if two or more languages are known
    threshold: float = -np.inf  #: deviations below which a text is rejected
    rates: dict[str, float] = field(default_factory=dict)  #: calibration: share rejected of learned, foreign and shuffled texts

    def rejects(self, z: np.ndarray, texts: list[str]) -> np.ndarray:
        """Whether the logits of each text are too little ahead for its language and length."""
        if self.margin is None:
            return np.zeros(len(z), bool)
        return self.margin.deviation(z, _lengths(texts)) < self.threshold

    def raw(self, texts: list[str]) -> np.ndarray:
        """Mean logit of the subwords of each text above the last language's, plus the bias; whole batches at once."""
        width = len(self.langs)
        # the softmax sees differences only, so the last language is the zero that others are measured from
        base = self.logits - self.logits[:, -1:]
        lanes = [np.append(base[:, k], np.float32(0)) for k in range(width - 1)]
        total, count = np.zeros((len(texts), width)), np.zeros(len(texts))
        for numbers, parts in _pieces(texts):
            buckets, none, begin = subwords(parts)
            for k, lane in enumerate(lanes):
                acc = np.take(lane, buckets[0], mode="clip")
                for b in buckets[1:]:
                    acc += np.take(lane, b, mode="clip")
                np.add.at(total[:, k], numbers, np.add.reduceat(acc, begin))
            size = np.diff(np.append(begin, len(none)))
            np.add.at(count, numbers, GRAM * size - np.add.reduceat(none, begin, dtype=np.int64))
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return _softmax(self.raw(texts) / self.temperature)


def _lengths(texts: list[str]) -> np.ndarray:
    return np.array([max(1, len(t)) for t in texts], float)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and the share of its subwords in each."""
    out = []
    for t in texts:
        f = np.concatenate(subwords([t])[0])
        u, k = np.unique(f[f < BUCKETS], return_counts=True)
        out.append((u, (k / max(1, k.sum())).astype(np.float32)))
    return out


def _descend(bags: list, y: np.ndarray, width: int, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Stochastic gradient descent over the rows: (bucket x language, bias)."""
    emb = rng.normal(0, 0.5, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, width), np.float32)
    bias = np.zeros(width, np.float32)
    step, total = 0, EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for i in rng.permutation(rows):
            u, k = bags[i]
            rate = 4.0 * (1 - step / total) + 0.05
            step += 1
            mean = k @ emb[u] if len(u) else np.zeros(DIM, np.float32)
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * 0.2 * np.outer(mean, p)
            bias -= rate * 0.02 * p
            if len(u):
                emb[u] -= rate * k[:, None] * 10 * back[None, :]
    return emb @ out, bias


def _logits(model: tuple[np.ndarray, np.ndarray], bags: list) -> np.ndarray:
    table, bias = model
    return np.array([(k @ table[u] if len(u) else 0) + bias for u, k in bags]).reshape(len(bags), len(bias))


def _shuffled(text: str, rng: np.random.Generator) -> str:
    """The text's characters in another order: junk with the same letters."""
    return "".join(np.array(list(text))[rng.permutation(len(text))]) if text else text


def fit(texts: list[str], labels: list[str], seed: int = 13) -> Model | None:
    """Stochastic gradient descent on embeddings and output weights, then temperature and threshold.

    Calibration uses documents that a model has not seen: a fifth held back, or
    five folds in turn where a fifth has fewer than CALIBRATE rows.  What is
    calibrated is how far the best language is ahead of the second, for each
    language and by the text's length.  Negatives are texts of a language that
    a model was not taught (each language left out in turn, if three or more
    are known) and texts with their characters shuffled.  The threshold rejects
    CATCH of the negatives, or REJECT_SHARE of documents of learned languages
    less some slack, whichever is lower.
    """
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(x) for x in labels])
    bags = _bags(texts)
    order, width = rng.permutation(len(bags)), len(langs)
    folds = [order[k::5] for k in range(5)] if len(order) >= 5 else [order]
    rest = lambda fold: np.setdiff1d(order, fold) if len(folds) > 1 else order
    models = [(_descend(bags, y, width, rest(f), rng), f) for f in (folds if len(folds[0]) < CALIBRATE else folds[:1])]
    table, bias = models[0][0] if len(models) == 1 else _descend(bags, y, width, order, rng)
    model = Model(langs, table, bias)
    rows = np.concatenate([_logits(m, [bags[i] for i in f]) for m, f in models])
    truth = np.concatenate([y[f] for _, f in models])
    grid = [0.25, 0.5, 0.75, 1, 1.5, 2, 3, 5]
    model.temperature = min(grid, key=lambda t: -np.log(_softmax(rows / t)[np.arange(len(truth)), truth] + 1e-9).mean())
    if width < 2:
        return model
    n = _lengths(texts)
    seen = np.concatenate([f for _, f in models])
    model.margin = Margin.of(rows, n[seen])
    known = model.margin.deviation(rows, n[seen])
    foreign = []
    for k in range(width if width > 2 else 0):
        others, own = order[y[order] != k], order[y[order] == k][:FOREIGN_DOCS]
        others = others[: 2 * FOREIGN_DOCS]
        part = max(1, len(others) // 5)
        left = _descend(bags, y - (y > k), width - 1, others[part:], rng)
        of = Margin.of(_logits(left, [bags[i] for i in others[:part]]), n[others[:part]])
        foreign.append(of.deviation(_logits(left, [bags[i] for i in own]), n[own]))
    foreign = np.concatenate(foreign) if foreign else np.zeros(0)
    some = models[0][1][:FOREIGN_DOCS]
    junk = model.margin.deviation(_logits(models[0][0], _bags([_shuffled(texts[i], rng) for i in some])), n[some])
    model.threshold = float(min(np.quantile(np.concatenate([foreign, junk]), CATCH), np.quantile(known, REJECT_SHARE, method="lower") - SLACK))
    share = lambda x: float((x < model.threshold).mean()) if len(x) else 0.0
    model.rates = {"learned": share(known), "foreign": share(foreign), "shuffled": share(junk)}
    return model


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Model | None:
    """A model from at most ``rows`` labelled documents outside the held-out fifth; None if there are none.

    Null texts and null languages are not learned from; rows that repeat a document count each.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    got = sorted(sample_by_hash(known, "doc_id", rows).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))  # bounded by rows
    return fit([r["text"] for r in got], [r["lang"] for r in got])


def _judge(model: Model | None, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    """(language, score, whether it is rejected) of each text."""
    out = [(UNKNOWN, 0.0, True)] * len(texts)
    use = [i for i, t in enumerate(texts) if t and has_letter(t)] if model else []
    if use:
        own = [texts[i] for i in use]
        z = model.raw(own)
        p, no = _softmax(z / model.temperature), model.rejects(z, own)
        for i, k, s, r in zip(use, p.argmax(1).tolist(), p.max(1).tolist(), no.tolist(), strict=True):
            out[i] = model.langs[k], s, r
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, lang_pred, score, rejected)``, one row per row.

    ``und`` with score 0, rejected: null texts, texts without a letter, and all
    texts if there was no label to learn from.  A rejected text with a letter
    still names its likeliest language.  Long texts are read whole, in pieces;
    ties go to the language that sorts first.  Empty tables give no rows; other
    columns are ignored; repeated rows are each scored.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            got = _judge(model, column(b, "text").to_pylist())
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *cols], ["doc_id", "lang_pred", "score", "rejected"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that ``identify`` does not reject, with their columns as they are; repeated rows are each kept or not."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield b.filter(pa.array([not r for _, _, r in _judge(model, column(b, "text").cast(pa.string()).to_pylist())], pa.bool_()))

    return arrow_map(docs.select(*docs.columns), run, docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``identify`` over all documents with a model of their labelled rows; nulls, repeats and empty tables as there."""
    docs = read(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
