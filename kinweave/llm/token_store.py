"""Token-id output: one wavelet matrix per shard, with rank, select and access from the compressed file.

File layout (little endian): the magic ``WMX1``, a 4-byte header length, a JSON
header, then zstd frames: document ids, document starts, the shard's alphabet
(its different ids, ascending; the matrix holds places in it), and for every
bit level its rank directory (ones before every 512-bit block) and the packed
plane in chunks of CHUNK blocks.  Level 0 holds the most significant bit; each
level is the stable partition of the one above by its bit, zeros first.

A frame is read and unpacked when a lookup needs it: access and rank touch one
block on each level, select finds its block in the rank directory.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from io import BytesIO
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, place, read, scratch, shuffle_parts

MAGIC = b"WMX1"
BLOCK = 512
END_ID = 2
#: A shard is closed at this many ids; a longer document has a shard of its own.
SHARD_TOKENS = 1 << 21
#: Blocks of a chunk of a plane, the least that a lookup unpacks.
CHUNK = 512


class Plane:
    """A bit vector in blocks of 512 bits with the ones before each block; ``chunk(i)`` gives the packed bytes of chunk i."""

    def __init__(self, chunk: Callable[[int], np.ndarray], ranks: Callable[[], np.ndarray], per_chunk: int, chunks: int):
        self.chunk, self._ranks, self.per_chunk, self.chunks = chunk, ranks, per_chunk, chunks

    @property
    def ranks(self) -> np.ndarray:
        return self._ranks()

    def whole(self) -> np.ndarray:
        return np.concatenate([self.chunk(i) for i in range(self.chunks)]) if self.chunks else np.zeros(0, np.uint8)

    def _blocks(self, block: np.ndarray) -> np.ndarray:
        """Packed bytes of the blocks, one row each; blocks past the end are zero."""
        out = np.zeros((len(block), BLOCK // 8), np.uint8)
        where = block // self.per_chunk
        for i in np.unique(where[where < self.chunks]).tolist():
            data = self.chunk(i)
            data = np.concatenate([data, np.zeros(-len(data) % (BLOCK // 8) + BLOCK // 8, np.uint8)]).reshape(-1, BLOCK // 8)
            here = where == i
            out[here] = data[np.minimum(block[here] - i * self.per_chunk, len(data) - 1)]
        return out

    def read(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bit, ones before it) at each position."""
        pos = np.asarray(pos, np.int64)
        rows, at = self._blocks(pos // BLOCK), pos % BLOCK
        byte = rows[np.arange(len(pos)), at >> 3]
        low = (at & 7).astype(np.uint8)
        ahead = np.where(np.arange(BLOCK // 8) < (at >> 3)[:, None], np.bitwise_count(rows), 0).sum(1, dtype=np.int64)
        partial = np.bitwise_count(byte & ((np.uint8(1) << low) - np.uint8(1)))
        return byte >> low & 1, self.ranks[pos // BLOCK].astype(np.int64) + ahead + partial

    def find(self, k: np.ndarray, one: int) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros."""
        ranks = self.ranks.astype(np.int64)
        before = ranks if one else BLOCK * np.arange(len(ranks)) - ranks
        out = np.empty(len(k), np.int64)
        for lo in range(0, len(k), 4096):
            part = np.asarray(k[lo : lo + 4096], np.int64)
            block = np.searchsorted(before, part, side="right") - 1
            bits = np.unpackbits(self._blocks(block), axis=1, bitorder="little") == one
            inside = np.cumsum(bits, axis=1, dtype=np.int32) > (part - before[block])[:, None]
            out[lo : lo + 4096] = block * BLOCK + inside.argmax(1)
        return out


class WaveletMatrix:
    """Succinct sequence of unsigned integers: ``access``, ``rank``, ``select``, ``count``, ``decode``."""

    def __init__(self, n: int, planes: list[Plane], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.levels = len(planes)

    @staticmethod
    def pack(ids: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[int]]:
        """(packed planes, zeros of each level) of a sequence."""
        cur = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(levels):
            bit = (cur >> cur.dtype.type(levels - 1 - level) & cur.dtype.type(1)).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            ones = np.compress(bit, cur)
            zeros.append(len(ids) - len(ones))
            cur = np.concatenate([np.compress(~bit, cur), ones])
        return planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray, levels: int = 0) -> WaveletMatrix:
        """A matrix in memory."""
        packed, zeros = cls.pack(ids, levels or (max(1, int(ids.max()).bit_length()) if len(ids) else 1))
        return cls(len(ids), [Plane(lambda _, p=p: p, lambda r=_directory(p): r, max(1, -(-len(p) // (BLOCK // 8))), 1) for p in packed], zeros)

    def access(self, pos) -> np.ndarray:
        """The ids at the given positions."""
        p = np.atleast_1d(np.asarray(pos, np.int64))
        value = np.zeros(len(p), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.read(p)
            value = value << 1 | bit
            p = np.where(bit == 1, zeros + ones, p - ones)
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            a, b = plane.read(np.array([lo, hi]))[1].tolist()
            lo, hi = (zeros + a, zeros + b) if value >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, value: int, pos: int) -> int:
        """Occurrences of a value before a position."""
        if value < 0 or value >> self.levels or not self.n:
            return 0
        lo, hi = self._range(value, 0, pos)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _up(self, value: int, p: np.ndarray) -> np.ndarray:
        """Positions in the sequence of places in the value's last range, from the last level up."""
        for level in reversed(range(self.levels)):
            one = value >> (self.levels - 1 - level) & 1
            p = self.planes[level].find(p - self.zeros[level] if one else p, one)
        return p

    def select(self, value: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence, or -1."""
        if k < 0 or k >= self.count(value):
            return -1
        return int(self._up(value, np.array([self._range(value, 0, self.n)[0] + k]))[0])

    def occurrences(self, value: int) -> np.ndarray:
        """All positions of a value, ascending."""
        if value < 0 or value >> self.levels or not self.n:
            return np.zeros(0, np.int64)
        return self._up(value, np.arange(*self._range(value, 0, self.n)))

    def decode(self) -> np.ndarray:
        """The whole sequence: stable partitions are undone from the last level up."""
        if not self.n:
            return np.zeros(0, np.uint32)
        kind = np.uint16 if self.levels <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for level in reversed(range(self.levels)):
            bit = np.unpackbits(self.planes[level].whole(), count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, kind)
            z = self.zeros[level]
            up[np.flatnonzero(~bit)] = cur[:z]
            up[np.flatnonzero(bit)] = cur[z:] | kind(1 << (self.levels - 1 - level))
            cur = up
        return cur


def _directory(packed: np.ndarray) -> np.ndarray:
    counts = np.bitwise_count(packed)
    pad = -len(counts) % (BLOCK // 8)
    blocks = np.concatenate([counts, np.zeros(pad, np.uint8)]).reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint32)


def encode_shard(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray, part: int, offset: int) -> bytes:
    """A shard as file bytes; ``starts`` has one more entry than documents, ``offset`` counts ids of the part before it."""
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen)
    code = np.zeros(len(seen), np.uint32)
    code[alphabet] = np.arange(len(alphabet))
    codes, levels = code[ids], max(1, (len(alphabet) - 1).bit_length())
    planes, zeros = WaveletMatrix.pack(codes, levels)
    z = zstandard.ZstdCompressor(level=1)
    known = np.array([d if d is not None else 0 for d in doc_ids], np.int64)
    null = np.array([d is None for d in doc_ids], bool)
    frames = [known.tobytes() + np.packbits(null).tobytes(), np.asarray(starts, np.int64).tobytes(), alphabet.astype("<u4").tobytes()]
    size = CHUNK * BLOCK // 8
    for plane in planes:
        frames.append(_directory(plane).tobytes())
        frames += [plane[i : i + size].tobytes() for i in range(0, len(plane), size)]
    frames = [z.compress(f) for f in frames]
    head = json.dumps({"n": len(ids), "docs": len(doc_ids), "levels": levels, "zeros": zeros, "chunk": CHUNK, "frames": [len(f) for f in frames], "part": part, "offset": offset}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *frames])


class Shard:
    """A shard in its file (or the file's bytes): only the header is read at once, frames when they are asked for."""

    def __init__(self, file: bytes | BinaryIO, remember: int = 256):
        f = BytesIO(file) if isinstance(file, (bytes, bytearray, memoryview)) else file
        if f.read(4) != MAGIC:
            raise ValueError("not a token shard")
        (k,) = struct.unpack("<I", f.read(4))
        self.head = h = json.loads(f.read(k))
        at = 8 + k + np.concatenate([[0], np.cumsum(h["frames"])])
        self.unpacked = 0  # frames that lookups have needed
        z = zstandard.ZstdDecompressor()
        held: dict[int, bytes] = {}

        def frame(i: int) -> bytes:
            if i not in held:
                if len(held) >= remember:
                    held.pop(next(iter(held)))
                f.seek(int(at[i]))
                held[i] = z.decompress(f.read(h["frames"][i]))
                self.unpacked += 1
            return held[i]

        self._frame = frame
        self.n = n = h["n"]
        chunks = -(-(-(-n // 8)) // (h["chunk"] * BLOCK // 8))

        def plane(level: int) -> Plane:
            first = 3 + level * (chunks + 1)
            return Plane(lambda i: np.frombuffer(frame(first + 1 + i), np.uint8), cache(lambda: np.frombuffer(frame(first), np.uint32)), h["chunk"], chunks)

        self.matrix = WaveletMatrix(n, [plane(level) for level in range(h["levels"])], h["zeros"])

    @property
    def doc_ids(self) -> list[int | None]:
        n, raw = self.head["docs"], self._frame(0)
        known = np.frombuffer(raw[: 8 * n], np.int64)
        null = np.unpackbits(np.frombuffer(raw[8 * n :], np.uint8), count=n).astype(bool)
        return [None if x else int(d) for d, x in zip(known, null, strict=True)]

    @property
    def starts(self) -> np.ndarray:
        return np.frombuffer(self._frame(1), np.int64)

    @property
    def alphabet(self) -> np.ndarray:
        return np.frombuffer(self._frame(2), "<u4")

    def _code(self, value: int) -> int:
        alphabet = self.alphabet
        k = int(np.searchsorted(alphabet, value))
        return k if k < len(alphabet) and alphabet[k] == value else -1

    def access(self, pos) -> np.ndarray:
        """The ids at the given positions of the shard."""
        return self.alphabet[self.matrix.access(pos)]

    def rank(self, value: int, pos: int) -> int:
        """Occurrences of an id before a position."""
        return self.matrix.rank(self._code(value), pos)

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of an id, or -1."""
        return self.matrix.select(self._code(value), k)

    def occurrences(self, value: int) -> np.ndarray:
        return self.matrix.occurrences(self._code(value))

    def decode(self) -> np.ndarray:
        return self.alphabet[self.matrix.decode()] if self.n else np.zeros(0, np.uint32)


# --------------------------------------------------------------------------- tokenising

#: Pieces one worker remembers: those met twice, and those met once lately.  Either starts anew when full.
PIECES, YOUNG = 800_000, 500_000
_state: dict[str, tuple] = {}


class _Irregular(Exception):
    """A text that cannot be cut into pieces."""


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit bytes; new pieces go through the tokenizer.

    A piece is a line break, or a run of other than white space with at most one
    blank before it.  Anything else is never remembered and raises _Irregular.
    """

    def __init__(self, tokenizer, special: list[str]):
        super().__init__()
        self.tokenizer, self.model, self.special = tokenizer, tokenizer.model, special
        letters = _byte_letters()
        self.letters = "".join(letters[b] for b in range(256))
        self.young: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        young = self.young
        out = young.pop(piece, None)
        if out is not None:
            self[piece] = out
            return out
        core = piece[1:] if piece[:1] == " " else piece
        if core.isalpha():  # one word: straight to the merges
            plain = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            out = array("I", [x.id for x in self.model.tokenize(plain if core is piece else self.letters[32] + plain)]).tobytes()
        elif piece == "\n":
            out = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        elif not core or core.split() != [core] or any(s in piece for s in self.special):
            raise _Irregular
        elif core[-1] in ".," and core[-2:-1].isalnum():  # the pattern always ends a token between the two
            out = self[piece[:-1]] + self[piece[-1]]
        else:
            out = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(young) >= YOUNG:
            young.clear()
        young[piece] = out
        return out


def _tokenizer(path: str):
    if path not in _state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        kind = json.loads(t.to_str())
        pre = kind["pre_tokenizer"] or {}
        special = [x.content for x in t.get_added_tokens_decoder().values()]
        cut = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex") and not kind["normalizer"] and kind["model"]["type"] == "BPE"
        cut = cut and sys.byteorder == "little" and all(len(s.split()) == 1 for s in special)
        _state[path] = (t, _Pieces(t, special) if cut else None)
    return _state[path]


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    For a byte-level tokenizer the pieces between single blanks and line breaks
    are encoded once and remembered: its pattern never lets a token reach over
    such a place.  Texts with other white space, or with the text of an added
    token, are encoded as a whole.
    """
    t, pieces = _tokenizer(path)
    out: list[bytes] = [b""] * len(texts)
    whole: list[int] = []
    if pieces is None:
        whole = list(range(len(texts)))
    else:
        if len(pieces) > PIECES:
            pieces.clear()
        for i, text in enumerate(texts):
            if "\0" in text:
                whole.append(i)
            elif text:
                marked = text.replace("\n", " \n").replace(" ", "\0 ").replace("\0 \n", "\0\n\0")
                try:
                    out[i] = b"".join([pieces[p] for p in marked.split("\0")])
                except _Irregular:
                    whole.append(i)
    for i, e in zip(whole, t.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
        out[i] = np.array(e.ids, "<u4").tobytes()
    return out


def _encoded(rows: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids with the end id) of each document."""
    end = np.array([end_id], "<u4").tobytes()
    for b in rows:
        texts, doc_ids = column(b, "text").to_pylist(), column(b, "doc_id").to_pylist()
        for at in range(0, len(texts), 200):
            ids = encode_texts([x or "" for x in texts[at : at + 200]], tokenizer)
            for d, x in zip(doc_ids[at : at + 200], ids, strict=True):
                yield d, x + end


def _stored(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    for b in rows:
        yield from zip(column(b, "doc_id").to_pylist(), column(b, "ids").to_pylist(), strict=True)


def _two(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_tokens, ids)``, ids as little-endian unsigned 32-bit bytes with the end id."""

    def run(rows: Iterator[pa.RecordBatch]):
        for b in rows:
            got = list(_encoded(iter([b]), tokenizer, end_id))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()), pa.array([len(x) // 4 for _, x in got], pa.int64()), pa.array([x for _, x in got], pa.binary())], ["doc_id", "n_tokens", "ids"])

    return arrow_map(_two(docs), run, "doc_id long, n_tokens long, ids binary")


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


def write_shards(rows: DataFrame, folder: str, shard_tokens: int = SHARD_TOKENS, encode=_stored) -> DataFrame:
    """Writes rows ``(doc_id, ids)``, which come in order, as ``*.wmx`` files; returns the manifest.

    ``encode`` turns the batches of ``rows`` into (doc_id, ids) in the same task.
    Tasks write their partitions; a file is moved to its place when complete,
    and a repeated task replaces it by the same bytes.  Manifest columns:
    part, seq, docs, n_tokens.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]):
        part = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        seq, offset = 0, 0
        docs: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def close():
            starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)])
            ids = np.frombuffer(b"".join(parts), "<u4")
            name = f"{root}/shard-{part:06d}-{seq:06d}"
            with fs.open_output_stream(f"{name}.{attempt}.part", compression=None) as f:
                f.write(encode_shard(docs, starts, ids, part, offset))
            place(fs, f"{name}.{attempt}.part", f"{name}.wmx")
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (part, seq, len(docs), len(ids))], ["part", "seq", "docs", "n_tokens"])

        for d, x in encode(batches):
            n = len(x) // 4
            if held and held + n > shard_tokens:
                yield close()
                offset, seq, docs, parts, held = offset + held, seq + 1, [], [], 0
            docs.append(d)
            parts.append(x)
            held += n
        if held:
            yield close()

    return cut(arrow_map(rows, run, "part long, seq long, docs long, n_tokens long"), "manifest")


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame, checksum: bool = False) -> DataFrame:
    """Reads the files back: ``(doc_id, start, n_tokens, ids)``, ids as little-endian unsigned 32-bit bytes.

    ``checksum``: ``ids_crc32`` instead of ids, so that no ids leave the task.
    """
    last = "ids_crc32 long" if checksum else "ids binary"
    before, at = {}, 0
    for r in manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():  # one row for each task of the write
        before[r["part"]] = at
        at += r["n"]
    if not before:
        return spark.createDataFrame([], f"doc_id long, start long, n_tokens long, {last}")

    def run(rows: Iterator[pa.RecordBatch]):
        for b in rows:
            for blob in column(b, "content").to_pylist():
                s = Shard(blob)
                raw = memoryview(s.decode().astype("<u4")).cast("B")
                base, doc_ids, starts = before[s.head["part"]] + s.head["offset"], s.doc_ids, s.starts
                step = len(doc_ids) if checksum else 256
                for lo in range(0, len(doc_ids), step):
                    st = starts[lo : lo + step + 1]
                    cuts = (4 * st).tolist()
                    values = [raw[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                    values = pa.array(map(zlib.crc32, values), pa.int64()) if checksum else pa.array([bytes(v) for v in values], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[lo : lo + step], pa.int64()), pa.array(base + st[:-1], pa.int64()), pa.array(np.diff(st), pa.int64()), values], ["doc_id", "start", "n_tokens", last.split()[0]])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wmx").load(folder).select("content")
    return arrow_map(files, run, f"doc_id long, start long, n_tokens long, {last}")


def token_output(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, checksum: bool = False) -> DataFrame:
    """Encodes, writes and reads back all documents; columns as ``read_shards`` says.

    Null texts are empty (their only id is the end id); long texts are encoded
    whole, in a shard of their own if need be; null doc_ids come first; repeated doc_ids each keep a row, ordered by text; an empty
    table writes no file and gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    by = F.col("doc_id").asc_nulls_first()
    ordered = _two(docs).repartitionByRange(shuffle_parts(spark), by).sortWithinPartitions(by, "text")
    manifest = write_shards(ordered, folder, encode=lambda rows: _encoded(rows, tokenizer, end_id))
    return read_shards(spark, folder, manifest, checksum)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``token_output`` of all documents, with checksums read from the files; nulls, repeats and empty tables as there."""
    return token_output(read(spark, sf_dir, "documents"), tokenizer_path(), checksum=True)
