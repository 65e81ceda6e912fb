"""Components of near copies against brute force over all pairs; hot groups, awkward texts, and recall at the threshold."""

import random

import numpy as np
import pytest

from kinweave.llm import minhash
from kinweave.llm.minhash import SLOTS, SYMBOLS, near_duplicates

DOCS = "doc_id long, text string, lang string, n long, sid string, component_id string, kept string"


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", 7, "clash", "clash", "clash") for i, t in enumerate(texts)], DOCS).repartition(5)


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts, ids):
    sets = [shingles(t) for t in texts]
    at = list(range(len(texts)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                at[find(i)] = find(j)
    out = []
    for i in range(len(texts)):
        named = [ids[j] for j in range(len(texts)) if find(j) == find(i) and ids[j] is not None]
        low = min(named) if named else None
        out.append((ids[i], len(sets[i]), low, ids[i] == low))
    return sorted(map(str, out))


def run(spark, texts, ids=None):
    got = near_duplicates(docs(spark, texts, ids))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(str(tuple(r)) for r in got.collect())


def prose(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return words


AWKWARD = [None, "", " \t", "a", "A", "a b c d", "A  B\tc d", "a b c d e", "é É", "x y " * 3000, "X y " * 3000, "\0", " ", "same text here again now", "same text here again now"]


@pytest.mark.parametrize("group,weight", [(4096, 1 << 20), (8, 400)])
def test_components_equal_brute_force(spark, monkeypatch, group, weight):
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "WEIGHT", weight)
    rng = random.Random(group)
    texts = list(AWKWARD)
    for _ in range(6):
        base = prose(rng, rng.choice([12, 60, 250]))
        texts += [" ".join(edited(rng, base, rng.randrange(0, max(2, len(base) // 40)))) for _ in range(9)]
        texts += [" ".join(base + prose(rng, k)) for k in (1, 5, 20, 200)]
    chain = prose(rng, 300)
    for _ in range(12):  # each is near the one before, the ends are not near each other
        texts.append(" ".join(chain))
        chain = chain[6:] + prose(rng, 6)
    passage = prose(rng, 80)
    texts += [" ".join(prose(rng, 100) + passage + prose(rng, 100)) for _ in range(12)]
    rng.shuffle(texts)
    ids = list(range(len(texts)))
    assert run(spark, texts, ids) == brute(texts, ids)


def test_links_at_the_threshold(spark):
    """Pairs of similarity 0.85 exactly, just below, and just above: every link is found and none is made up."""
    rng = random.Random(1)
    texts, linked = [], set()
    for n in (20, 40, 100, 400, 2000):
        for k in range(12):
            base = prose(rng, n + 4, 10**9)  # n shingles, all distinct
            cut_ = [n * 15 // 100, n * 15 // 100 + 1, n * 15 // 100 - 1][k % 3]
            texts += [" ".join(base), " ".join(base[cut_:])]
            if 100 * (n - cut_) >= 85 * n:
                linked.add(len(texts) - 1)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, texts)).collect()}
    assert {d for d in got if got[d] != d} == linked


def test_one_hot_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP", 64)
    monkeypatch.setattr(minhash, "WEIGHT", 5000)
    rng = random.Random(2)
    base = prose(rng, 120)
    texts = [" ".join(edited(rng, base, k % 6)) for k in range(300)] + ["stop words of another kind here"] * 200 + [" ".join(prose(rng, 50)) for _ in range(30)]
    ids = list(range(len(texts)))
    assert run(spark, texts, ids) == brute(texts, ids)


def test_null_and_repeated_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [words, words, words + " end", "other text", "other text", None, None, "", "lonely words", "lonely words"]
    ids = [None, 5, 5, None, None, 7, 7, None, 3, 3]
    got = sorted(str(tuple(r)) for r in near_duplicates(docs(spark, texts, ids)).collect())
    assert got == brute(texts, ids)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_pairs_within_the_guarantee_meet_in_a_slot_that_one_bucket_owns():
    rng = np.random.default_rng(3)
    for wrong in [0, 1, 12, minhash.GUARANTEED]:
        for _ in range(40):
            a = rng.integers(0, 1 << 16, (1, SLOTS)).astype(np.uint16)
            b = a.copy()
            at = rng.choice(SLOTS, wrong, replace=False)
            b[0, at] ^= np.uint16(1)
            met = [s for (s, x), (_, y) in zip(minhash.index_keys(a), minhash.index_keys(b), strict=True) if x[0] == y[0]]
            mine = [s for s in range(SLOTS) if minhash.owned(b, a[0], s)[0]]
            assert met and len(mine) == 1 and mine[0] in met


def test_symbols_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(60):
        h = rng.integers(0, 1 << 63, 230).astype(np.uint64)
        s = minhash.symbols([np.unique(h[:200]), np.unique(h[30:])])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 170 / 230) < 0.02
    assert SLOTS % SYMBOLS == 0


def test_exact_links_join_what_is_alike_without_its_pairs():
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 1 << 62, 100).astype(np.uint64))
    sets = [np.sort(np.append(base, np.uint64(i))) for i in range(50)] + [np.array([7], np.uint64)]
    links = minhash.exact_links(sets, np.arange(51))
    assert len(links) == 49 and all(50 not in x for x in links)
    assert minhash.exact_links(sets, np.array([1] * 50 + [2])) == []
