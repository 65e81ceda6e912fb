"""The pipeline over the smallest folder: each stage's decisions on its own input."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from kinweave.llm import mixing, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(docs.count())
        if name != "token_output":
            assert docs.columns == columns
            known = {tuple(r) for r in before.collect()}
            assert {tuple(r) for r in docs.collect()} <= known
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(docs.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def _plain(text):
    return " " + " ".join(re.sub(r"[.,]", " ", (text or "").lower()).split()) + " "


def _shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_decisions_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    # language: clean documents stay
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    assert kept >= {i for i, t in text.items() if t and sum(map(str.isalpha, t)) > 20}
    # near copies: close pairs never both stay, and what goes has a close partner
    kept = {r["doc_id"] for r in corpus_pipeline.near_copy_stage(spark, docs, SF).collect()}
    sh = {i: _shingles(t or "") for i, t in text.items()}
    close = {(i, j): len(sh[i] & sh[j]) / len(sh[i] | sh[j]) for i in sh for j in sh if i < j}
    assert not [p for p, v in close.items() if v >= 0.9 and p[0] in kept and p[1] in kept]
    partner = {i for p, v in close.items() if v >= 0.5 for i in p}
    assert set(text) - kept <= partner
    # benchmark: exactly the documents that hold an item go
    items = [_plain(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hold = {i for i, t in text.items() if any(x in _plain(t) for x in items)}
    assert {r["doc_id"] for r in corpus_pipeline.benchmark_stage(spark, docs, SF).collect()} == set(text) - hold
    # mixing: each source's words come near its target
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in text.items()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sums, got = Counter(), Counter()
    for i, n in size.items():
        sums[source[i]] += n
    for r in corpus_pipeline.mixing_stage(spark, docs, SF).collect():
        got[r["source"]] += size[r["doc_id"]]
    longest = max(size.values())
    assert all(abs(got[s] - t) <= 2 * longest for s, t in mixing.targets(dict(sums)).items())


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 11)]


AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
    (1, "a completely different text that only shares its number with the first one", "en", "a", 1),
    (None, "der schnelle braune Fuchs springt heute wieder über den faulen Hund am Fluss", "de", None, 2),
    (None, "das Wetter in den Bergen war gestern Abend kalt und sehr windig geblieben", "de", None, 2),
    (2, "word " * 40_000 + "at the very end another sentence stands that nothing repeats", "en", "b", 3),
    (3, None, None, None, None),
    (4, "", "en", "b", 4),
    (5, "12 34 -- 56", None, "b", 5),
    (6, "the quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 6),
    (6, "the quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 6),
]
#: Columns of documents, and some whose names the stages use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def _docs(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr("*", "'t' AS th", "1 AS size", "'k' AS key", "0L AS start", "'r' AS root")


def _benchmark(spark, folder, rows):
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_of_awkward_rows(spark, tmp_path):
    sf = _benchmark(spark, tmp_path, [(1, "the weather is not what it was when all of us were young"), (2, None), (3, "")])
    stages, docs = dict(corpus_pipeline.STAGES), _docs(spark, AWKWARD)
    ids = lambda df: Counter((r["doc_id"], (r["text"] or "")[:9]) for r in df.collect())
    every = ids(docs)
    # without a letter nothing is recognised
    kept = stages["language_id"](spark, docs, sf)
    assert kept.columns == docs.columns
    assert not {3, 4, 5} & {i for i, _ in ids(kept)}
    # copies give one row, null and empty texts one, and what only shares an id (or has none) stays
    kept = stages["simhash_near_copies"](spark, docs, sf)
    assert kept.columns == docs.columns
    assert ids(kept) == Counter(k for k in every if k[0] not in (4, 6))
    # nothing holds an item
    kept = stages["benchmark_decontamination"](spark, docs, sf)
    assert kept.columns == docs.columns and ids(kept) == every
    # texts without a word go, no document stays more than three times for each of its rows
    kept = stages["source_mixing"](spark, docs, sf)
    assert kept.columns == docs.columns
    assert all(i not in (3, 4) and n <= 3 * every[i, t] for (i, t), n in ids(kept).items())
    # each row has its tokens
    rows = stages["token_output"](spark, docs, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in AWKWARD)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {1}


def test_stages_of_nothing(spark, tmp_path):
    sf = _benchmark(spark, tmp_path, [])
    docs = _docs(spark, []).cache()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []
    full = _docs(spark, AWKWARD)
    assert corpus_pipeline.benchmark_stage(spark, full, sf).count() == len(AWKWARD)
