"""Licence scan: a generalised suffix automaton over licence templates gives matching statistics, chained into spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, read, text_bytes

#: Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licence notices in their usual public wording, with their labels.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    # whole licence texts
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        "the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software "
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
)

#: Shortest match of the chain, in words; longest gap between chained matches; share of a template that labels a text.
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 3, 0.6

_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and all other characters above ASCII."""
    return text.translate(_WORDS).split()


class SuffixAutomaton:
    """Of several token sequences; every state knows the templates and end places it stands for."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].add((t, i))
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else -1)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        k = self._new(self.length[p] + 1, q)
        self.link[q] = k
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = k
            p = self.link[p]
        return k

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # another sequence has this already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        cur = self._new(self.length[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return cur

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """For each token: the state and the length of the longest suffix there that occurs in a template."""
        state = length = 0
        for c in tokens:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            yield state, length


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates = [(label, words(t.encode())) for label, t in templates]
        self.phrases = [(words(p.encode()), label) for p, label in phrases.items()]
        vocab = sorted({w for _, t in self.templates for w in t} | {w for p, _ in self.phrases for w in p})
        self.ids = {w: i + 1 for i, w in enumerate(vocab)}
        self.coded = [[self.ids[w] for w in t] for _, t in self.templates]
        self.base = [([self.ids[w] for w in p], label) for p, label in self.phrases]
        self.automaton = SuffixAutomaton([*self.coded, *(p for p, _ in self.base)])
        #: base phrases that end where a state's strings end, with their sizes
        self.ending = [[(t - len(self.coded), e + 1) for t, e in ends if t >= len(self.coded) and e + 1 == len(self.base[t - len(self.coded)][0]) <= size] for ends, size in zip(self.automaton.ends, self.automaton.length, strict=True)]
        for s in sorted(range(1, len(self.ending)), key=lambda s: self.automaton.length[s]):
            self.ending[s] = sorted({*self.ending[s], *self.ending[self.automaton.link[s]]})

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first, last, base labels, all labels, score, spans (label, first word, words)."""
        w = words(text)
        get = self.ids.get
        codes = np.array([get(x, 0) for x in w], np.int32)
        starts, found = self._read(codes)
        base = {self.base[p][1] for p, _ in starts}
        spans = self._chains(found)
        labels = base | {label for label, _, _, _ in spans}
        score = max([1.0 if base else 0.0, *(c for _, _, _, c in spans)])
        at = [a for _, a in starts]
        return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), float(score), [(label, a, n) for label, a, n, _ in spans]

    def _read(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], list[dict[int, list[tuple[int, int, int]]]]]:
        """One pass of the automaton over the runs of known words: (phrase, first word) of base places, and each run's
        right-maximal matches (first word, first word in the template, words) by template."""
        known = np.flatnonzero(codes)
        if not len(known):
            return [], []
        base, found = [], []
        shortest = min(len(p) for p, _ in self.base) if self.base else MIN_MATCH
        for run in np.split(known, np.flatnonzero(np.diff(known) > MAX_GAP + 1) + 1):  # words outside all templates end every match
            if len(run) < min(MIN_MATCH, shortest):
                continue
            lo, hi = int(run[0]), int(run[-1]) + 1
            matches: dict[int, list[tuple[int, int, int]]] = {}
            stats = [*self.automaton.statistics(codes[lo:hi].tolist()), (0, 0)]
            for i, ((state, n), (_, following)) in enumerate(zip(stats, stats[1:], strict=False)):
                for p, size in self.ending[state]:
                    if size <= n:
                        base.append((p, lo + i - size + 1))
                if n >= MIN_MATCH and following <= n:  # right-maximal
                    for t, end in self.automaton.ends[state]:
                        if t < len(self.templates):
                            matches.setdefault(t, []).append((lo + i - n + 1, end - n + 1, n))
            if matches:
                found.append(matches)
        return base, found

    def spans(self, codes: np.ndarray) -> list[tuple[str, int, int, float]]:
        """Chains of matches that cover enough of a template: (label, first word, words, share covered)."""
        return self._chains(self._read(codes)[1])

    def _chains(self, found: list[dict[int, list[tuple[int, int, int]]]]) -> list[tuple[str, int, int, float]]:
        return [span for matches in found for t, ms in matches.items() for span in self._chain(t, ms)]

    def _chain(self, t: int, ms: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Colinear chaining, left to right: each match continues the best chain that ends shortly before it.

        A match is no longer than the template, so only matches that begin within
        its length and the gap before this one can be continued; none of these is left out.
        """
        ms.sort()
        reach = len(self.templates[t][1]) + MAX_GAP
        best: list[tuple[int, int, int]] = []  # words covered, first match of the chain (negated for ties, then itself)
        low = 0
        for i, (a, u, n) in enumerate(ms):
            while ms[low][0] + reach < a:
                low += 1
            top = (n, -i, i)
            for j in range(low, i):
                b, v, m = ms[j]
                gap, skip = a - (b + m), u - (v + m)
                over = max(0, -gap, -skip)
                if b < a and v < u and gap <= MAX_GAP and over < n:
                    top = max(top, (best[j][0] + n - over, -best[j][2], best[j][2]))
            best.append(top)
        chains: dict[int, tuple[int, int]] = {}
        for i, (cover, _, first) in enumerate(best):
            chains[first] = max(chains.get(first, (0, 0)), (cover, i))
        label, size = self.templates[t][0], len(self.templates[t][1])
        out = []
        for first, (cover, last) in chains.items():
            if cover >= MIN_COVER * size:
                a = ms[first][0]
                out.append((label, a, ms[last][0] + ms[last][2] - a, min(1.0, cover / size)))
        return out


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:int,words:int>>"


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``, over whole texts.

    Base phrases and template matches both come from one pass of the automaton.
    Null and empty texts have no word, no label and score 0; long texts are
    scanned whole; of chains that cover the same, that with the earlier first
    match counts; repeated rows are each scanned; empty tables give no rows;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        scanner = Scanner(templates, phrases)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
        for b in batches:
            got = [scanner.scan(t) for t in text_bytes(column(b, "text"))]
            cols = [pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]
            spans = pa.array([[{"label": x, "first": a, "words": n} for x, a, n in g[7]] for g in got], span)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *cols, spans], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, SCHEMA)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_licenses`` over all documents; nulls, repeats and empty tables as there."""
    return scan_licenses(read(spark, sf_dir, "documents")).drop("spans")
