"""Benchmark decontamination by template canonicalisation and slot-consistent window matches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, mix64, read

#: Words of a template window; shorter items are windows of their own length, below SHORTEST words by their surface alone.
WINDOW, SHORTEST = 8, 4
#: Ordinary words that a template window needs: one of placeholders alone says nothing, and goes by its surface.
LITERALS = 3
#: Share of an item's words that consistent windows must cover, or words in a row of them (all, if the item is shorter).
COVERAGE, RUN = 0.5, 13
#: Bits (as powers of two) of the table that says which window hashes the benchmark may have: 64 a window within these bounds.
#: It only spares the shuffle of other windows; the join decides.
FILTER_BITS = (16, 26)

#: Units of measure and money that become a placeholder.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds ounce ounces ml l litre litres liter liters "
    "second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees mph kmh km/h "
    # German, French and Spanish
    "sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren gramm kilogramm kilometer zentimeter prozent grad pfund "
    "seconde secondes heure heures jour jours semaine semaines mois an ans mètre mètres kilomètre kilomètres gramme grammes degrés centime centimes "
    "segundo segundos minuto minutos hora horas día días semana semanas mes meses año años metro metros kilómetro kilómetros gramo gramos grado grados céntimo céntimos".split()
)
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
#: Characters of texts that are read at once.  A longer text is read alone, as a whole.
PIECE = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE, _MARK, _END, _DIGIT = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[list(b";:\"'()[]{}<>*_`,")] = _MARK
_CLASS[list(b".!?")] = _MARK | _END
_CLASS[48:58] = _DIGIT
#: Bytes of a character by its first byte.
_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC0:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:] = 2, 3, 4
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0 .. n - 1, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


@dataclass
class Words:
    """The words of a run of texts: their text, place in it, bytes, and the readings.

    A reading is (hashes, slot kinds, words one of which a window must hold, or
    None).  The last is of surfaces and serves the windows that ``plain``, the
    kinds of the reading without names, leaves too few ordinary words.
    """

    text: np.ndarray
    place: np.ndarray
    data: bytes
    start: np.ndarray
    end: np.ndarray
    readings: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]
    plain: np.ndarray

    def surface(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].decode("utf-8", "replace")


def _word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power, inverse = _power(len(low) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)], dtype=np.uint64)])
    return mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _hashes_of(words: list[str]) -> np.ndarray:
    raw = b" ".join(w.encode() for w in words)
    sizes = np.array([len(w.encode()) for w in words])
    start = np.cumsum(sizes + 1) - sizes - 1
    return _word_hashes(np.frombuffer(raw, np.uint8), start, start + sizes)


_TEMPLATE = dict(zip((NUMBER, UNIT, NAME), _hashes_of(["<number>", "<unit>", "<name>"]), strict=True))
_UNIT_HASHES = np.sort(_hashes_of(sorted(UNITS)))


def _lower(text: str, raw: bytes) -> bytes:
    """Lower case of the same length in bytes."""
    low = text.lower().encode("utf-8", "surrogatepass")
    return low if len(low) == len(raw) else raw.lower()


def canonical(texts: list[str]) -> Words:
    """Words of all texts: runs of other than white space and marks; a stop or comma between digits belongs to the number.
    Each character of Chinese or Japanese is a word.

    The first reading takes words with one capital, their first letter, inside
    sentences for names; the second takes no word for a name, so it does not
    depend on case and punctuation; the third takes such words that begin a
    sentence for names too.  Numbers and units are placeholders in these.
    """
    for a, b in (("\u201c", '"'), ("\u201d", '"'), ("\u2018", "'"), ("\u2019", "'")):
        texts = [t.replace(a, b) for t in texts]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw)
    o = np.frombuffer(data, np.uint8)
    low = np.frombuffer(b"\n".join(_lower(t, r) for t, r in zip(texts, raw, strict=True)), np.uint8)
    kind = _CLASS[o]
    digit = kind == _DIGIT
    inner = np.zeros(len(o), bool)
    if len(o) > 2:
        inner[1:-1] = digit[:-2] & digit[2:] & ((o[1:-1] == 46) | (o[1:-1] == 44))
    word = (kind & (_SPACE | _MARK) == 0) | inner
    wide = np.flatnonzero((o >= 0xE3) & (o <= 0xE9))
    seam = np.zeros(len(o) + 1, bool)
    if len(wide):
        stop = wide[(o[wide] == 0xE3) & (o[wide + 1] == 0x80) & (o[wide + 2] <= 0x82)]  # ideographic blank, comma, stop
        word[(stop[:, None] + np.arange(3)).ravel()] = False
        seam[wide] = seam[wide + 3] = True
    around = np.concatenate([[False], word, [False]])
    start, end = np.flatnonzero(word & (~around[:-2] | seam[:-1])), np.flatnonzero(word & (~around[2:] | seam[1:])) + 1
    count = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
    changed, digits, stops = count(o != low), count(digit), count((kind & _END > 0) & ~inner)
    bounds = np.cumsum([0] + [len(r) + 1 for r in raw])
    text = np.searchsorted(bounds, start, side="right") - 1
    first = np.ones(len(start), bool)
    first[1:] = (text[1:] != text[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    h = _word_hashes(low, start, end)
    second = np.minimum(start + _WIDTH[o[start]], end) if len(start) else start
    capital = changed[second] - changed[start]
    name = (capital > 0) & (changed[end] == changed[second]) & (second < end)
    unit = _UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, h), len(_UNIT_HASHES) - 1)] == h
    plain = np.where(digits[end] > digits[start], NUMBER, np.where(unit, UNIT, LITERAL)).astype(np.int8)
    named = np.where((plain == LITERAL) & name & ~first, NAME, plain)
    every = np.where((plain == LITERAL) & name, NAME, plain)
    surface = h ^ np.uint64(0xA0761D6478BD642F)
    for k in (NUMBER, UNIT):
        h[plain == k] = _TEMPLATE[k]
    first_word = np.searchsorted(text, np.arange(len(texts)))
    readings = [
        (np.where(named == NAME, _TEMPLATE[NAME], h), named, None),
        (h ^ np.uint64(0x5851F42D4C957F2D), plain, None),
        (np.where(every == NAME, _TEMPLATE[NAME], h), every, every != named),
        (surface, np.zeros_like(plain), None),
    ]
    return Words(text, np.arange(len(start)) - first_word[text] if len(start) else start, data, start, end, readings, plain)


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts by their numbers, gathered or alone, so that about PIECE characters are read at once."""
    held: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if held and size + len(t) > PIECE:
            yield held, [texts[k] for k in held]
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield held, [texts[k] for k in held]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each window of ``size`` template words, by doubling."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done = np.full(n, size, np.uint64), 0
    power, span, base = h, 1, 0x9E3779B97F4A7C15  # hashes of windows of ``span`` words, and the base to its power
    while done < size:
        if size - done & span:
            out = out * np.uint64(base) + power[done : done + n]
            done += span
        if done < size:
            power = power[:-span] * np.uint64(base) + power[span:]
            base, span = base * base % (1 << 64), 2 * span
    return out


def _slots(words: Words, kinds: np.ndarray, p: int, size: int) -> list[str]:
    """Surface of each slot in a window, empty for ordinary words."""
    return [words.surface(p + k) if kinds[p + k] else "" for k in range(size)]


def hash_filter(windows: DataFrame) -> tuple[int, np.ndarray]:
    """(leading bits of a hash that count, packed table of those that occur) for ``windows(h)``, of bounded size whatever their number."""
    n = windows.count()
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (64 * n).bit_length()))
    at = F.shiftrightunsigned("h", 64 - bits)
    bit = F.expr("shiftleft(1L, cast(pmod(at, 32) as int))")
    rows = windows.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("w")).agg(F.bit_or(bit).alias("b")).collect()  # bounded by FILTER_BITS
    table = np.zeros(1 << bits - 5, np.uint32)
    table[[r["w"] for r in rows]] = [r["b"] for r in rows]
    return bits, table


def windows(rows: DataFrame, sizes: list[int], wanted: tuple[int, np.ndarray] | None, least: int = 0) -> DataFrame:
    """``rows(id, th, text)`` -> ``(id, th, p, size, h, slots, n)``; only windows that the filter ``wanted`` lets pass, if given.

    ``least`` > 0: texts below the longest window give one window of their whole length, from ``least`` words on.
    """
    full = max(sizes)

    def run(batches: Iterator[pa.RecordBatch]):
        if wanted is not None:  # a bit table says no to nearly all windows at once
            shift = np.uint64(64 - wanted[0])
            table = np.unpackbits(wanted[1].view(np.uint8), bitorder="little").view(bool)
        for b in batches:
            out: list[tuple] = []
            ids, ths = column(b, "id").to_pylist(), column(b, "th").to_pylist()
            for own, texts in _pieces([t or "" for t in column(b, "text").to_pylist()]):
                w = canonical(texts)
                n = np.bincount(w.text, minlength=len(texts))
                ordinary = np.concatenate([[0], np.cumsum(w.plain == LITERAL)])
                for (number, (h, kinds, asked)), size in product(enumerate(w.readings), range(least, full + 1) if least else sizes):
                    by_surface = number == len(w.readings) - 1
                    if size < SHORTEST and not by_surface:
                        continue
                    wh = window_hashes(h, size)
                    if not len(wh):
                        continue
                    use = w.text[: len(wh)] == w.text[size - 1 :]
                    if least:  # a short text is one window
                        whole = n[w.text[: len(wh)]]
                        use &= (whole == size) if size < full else (whole >= size)
                    if wanted is not None:
                        at = np.flatnonzero(table[wh >> shift] & use)
                    else:
                        at = np.flatnonzero(use)
                    if not len(at):
                        continue
                    if by_surface:
                        at = at[(ordinary[at + size] - ordinary[at] < min(LITERALS, size - 1)) | (size < SHORTEST)]
                    else:
                        literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
                        at = at[literal[at + size] - literal[at] >= min(LITERALS, size - 1)]
                    if asked is not None:
                        held = np.concatenate([[0], np.cumsum(asked)])
                        at = at[held[at + size] > held[at]]
                    for p in at.tolist():
                        i = own[w.text[p]]
                        out.append((ids[i], ths[i], int(w.place[p]), size, int(wh[p].astype(np.int64)), _slots(w, kinds, p, size), int(n[w.text[p]])))
            kinds_ = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds_)], ["id", "th", "p", "size", "h", "slots", "n"])

    return arrow_map(rows, run, "id long, th long, p int, size int, h long, slots array<string>, n int")


@dataclass
class Diagonal:
    """What consistent windows on one diagonal of a document and an item show."""

    covered: set[int]
    used: int
    first: int
    renamed: set[str]
    longest: int


def judge_diagonal(hits: list[tuple[int, int, list[str], list[str]]]) -> Diagonal:
    """``hits``: (document word, item word, document slots, item slots), all with the same difference of words.

    The slots of the windows that count must map one to one.  Where windows
    contradict each other, each of them is tried as the one to believe, the
    rest joins it by the number of windows that hold the same replacements, and
    the set that covers most is taken: a wrong slot costs its own windows, not
    those of a consistent rest.
    """
    rows = sorted({(p, q, tuple(a), tuple(b)) for p, q, a, b in hits})
    pairs = [frozenset((i, d) for d, i in zip(doc, item, strict=True) if d or i) for _, _, doc, item in rows]
    sound = [k for k, x in enumerate(pairs) if len(x) == len({i for i, _ in x}) == len({d for _, d in x})]

    def gather(order: list[int]) -> list[int]:
        to: dict[str, str] = {}
        back: dict[str, str] = {}
        taken = []
        for k in order:
            if any(to.get(i, d) != d or back.get(d, i) != i for i, d in pairs[k]):
                continue
            to.update(pairs[k])
            back.update((d, i) for i, d in pairs[k])
            taken.append(k)
        return sorted(taken)

    cover = lambda taken: set().union(*(range(rows[k][1], rows[k][1] + len(rows[k][2])) for k in taken))
    best = gather(sound)
    if len(best) < len(sound):
        votes: dict[tuple[str, str], int] = {}
        for k in sound:
            for x in pairs[k]:
                votes[x] = votes.get(x, 0) + 1
        order = sorted(sound, key=lambda k: (-sum(votes[x] for x in pairs[k]), k))
        seeds = {pairs[k]: k for k in reversed(sound)}  # windows with the same replacements lead to the same set
        best = max([best, *(gather([seed, *order]) for seed in seeds.values())], key=lambda taken: (len(cover(taken)), [-k for k in taken]))
        best = sorted(set(best))
    longest, begin, until = 0, -1, -1
    for q, size in ((rows[k][1], len(rows[k][2])) for k in best):
        begin = q if q > until else begin
        until = max(until, q + size)
        longest = max(longest, until - begin)
    return Diagonal(cover(best), len(best), min((rows[k][0] for k in best), default=-1), {i for k in best for i, d in pairs[k] if i != d}, longest)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, th, item_id, coverage, windows, first_word, renamed)`` of documents that hold a benchmark item.

    ``th`` is a hash of the text and tells rows apart that share a doc_id.
    Numbers, units and capitalised words inside sentences are placeholders, so
    a question with other names and figures is found, if the replacements are
    consistent; a second reading without names finds it in other case, a third also takes names that begin
    sentences.  A pair counts from half of the item or RUN words in a row on one diagonal.  Null and empty texts match nothing; items of fewer than
    SHORTEST words, and windows without enough ordinary words, match by their very words; long texts are read whole; repeated
    items and documents each give their pairs once for each text, null ids included; empty tables
    give no rows; other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    b = benchmark.select(F.col("item_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    item = cut(windows(b, [WINDOW], None, least=1).distinct(), "items")
    known = item.select("h", "size").distinct()
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())
    found = windows(d, sizes or [WINDOW], hash_filter(known)).alias("d").join(item.alias("i"), (F.col("d.h") == F.col("i.h")) & (F.col("d.size") == F.col("i.size")))
    # a diagonal has at most the item's windows, however long the document is
    diagonal = (F.col("d.p") - F.col("i.p")).alias("diagonal")
    lines = found.groupBy(F.col("d.id").alias("doc_id"), F.col("d.th").alias("th"), F.col("i.id").alias("item_id"), F.col("i.th").alias("ith"), F.col("i.n").alias("n"), diagonal).agg(
        F.collect_set(F.struct(F.col("d.p").alias("p"), F.col("i.p").alias("q"), F.col("d.slots").alias("a"), F.col("i.slots").alias("b"))).alias("hits")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            keys = [column(b, c) for c in ("doc_id", "th", "item_id", "ith", "n")]
            got = [judge_diagonal([(x["p"], x["q"], x["a"], x["b"]) for x in hits]) for hits in column(b, "hits").to_pylist()]
            cols = [pa.array([sorted(g.covered) for g in got], pa.list_(pa.int32())), pa.array([sorted(g.renamed) for g in got], pa.list_(pa.string()))]
            cols += [pa.array([getattr(g, c) for g in got], pa.int32()) for c in ("used", "first", "longest")]
            yield pa.RecordBatch.from_arrays(keys + cols, ["doc_id", "th", "item_id", "ith", "n", "covered", "renamed", "used", "first", "longest"])

    key = ["doc_id", "th", "item_id", "ith", "n"]
    schema = "doc_id long, th long, item_id long, ith long, n int, covered array<int>, renamed array<string>, used int, first int, longest int"
    judged = cut(arrow_map(lines, run, schema).where("used > 0"), "diagonals")
    shown = F.explode(F.concat(F.transform("covered", lambda x: F.struct(x.alias("word"), F.lit(None).cast("string").alias("name"))), F.transform("renamed", lambda x: F.struct(F.lit(None).cast("int").alias("word"), x.alias("name"))))).alias("x")
    counts = judged.select(*key, shown).select(*key, "x.*").distinct().groupBy(*key).agg(F.count("word").alias("words"), F.count("name").cast("int").alias("renamed"))
    sums = judged.groupBy(*key).agg(F.sum("used").cast("int").alias("windows"), F.min("first").alias("first_word"), F.max("longest").alias("longest"))
    a, c = sums.alias("a"), counts.alias("c")
    pairs = a.join(c, [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]).select("a.*", "c.words", "c.renamed").withColumn("coverage", F.col("words") / F.col("n"))
    return pairs.where((F.col("coverage") >= coverage) | (F.col("longest") >= F.least(F.lit(RUN), F.col("n")))).select("doc_id", "th", "item_id", "coverage", "windows", "first_word", "renamed")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their columns as they are; null and empty texts stay, repeated rows go or stay together."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_bad_id"), F.col("th").alias("_bad_th")).distinct()
    on = docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_th"])
    return docs.join(bad, on, "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``contaminated`` over all documents and the whole benchmark; nulls, repeats and empty tables as there."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("th")
