"""Each operator against a brute-force version, an exact round trip or planted cases; and the awkward inputs."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard

from kinweave.llm import components, decontaminate, language_id, license_scan, minhash, mixing, near_copies, simhash, substring_dedup, token_store, topk, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_bytes int, component_id string, score string"


def docs(spark, texts, sources=None, ids=None, langs=None):
    rows = [(i if ids is None else ids[i], t, None if langs is None else langs[i], None if sources is None else sources[i], 7, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


AWKWARD = [None, "", " ", "\n\t", ".", "a", "é" * 3, "\0", "A" * 5000, "x y " * 4000, "same", "same", "\U0001f600 ü", "1 2 3", "<|endoftext|> b"]


# ------------------------------------------------------------------ op1


def brute_dedup(texts, k):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + k] for t in raw for i in range(len(t) - k + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - k + 1):
            if seen[t[i : i + k]] > 1:
                gone[i : i + k] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,group,split", [(400, 20000, 2048), (400, 20, 2), (40, 3, 3), (1, 50, 4)])
def test_dedup_equals_brute_force(spark, length, group, split):
    rng = random.Random(length * 100 + group)
    base = [prose(rng, 200) for _ in range(6)]
    texts = list(base) + AWKWARD
    for _ in range(12):
        a = rng.choice(base)
        i = rng.randrange(len(a))
        texts.append(prose(rng, 30) + a[i : i + rng.randrange(900)] + prose(rng, 30))
    texts += [base[0], base[0][:700] + "!" + base[0][701:], "ab" * 600, "a" * 450]
    if length < 40:
        texts = texts[:10] + texts[-8:]
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(docs(spark, texts), length, group, split=split).collect()}
    for i, want in enumerate(brute_dedup(texts, length)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_dedup_of_repeated_rows_and_null_ids(spark):
    t = prose(random.Random(5), 120)
    df = docs(spark, [t, t, t[:-1] + "#", None], ids=[1, 1, None, None])
    rows = substring_dedup.dedup_substrings(df).collect()
    assert sorted(r["n_removed"] for r in rows) == sorted([len(t), len(t), len(t) - 1, 0])
    assert substring_dedup.dedup_substrings(docs(spark, [])).collect() == []


def test_dedup_splits_a_bucket_that_all_rows_share(spark):
    rng = random.Random(8)
    core, texts = prose(rng, 20), []
    for i in range(40):  # one anchor; contexts differ at either end, in groups
        texts.append(f"{i % 5:03d} head {'h' * (i % 7)}" + core + f"{'t' * (i % 6)} tail {i % 4:03d}")
    for split in (2048, 2):
        got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(docs(spark, texts), 100, 10, split=split, least=60).collect()}
        for i, want in enumerate(brute_dedup(texts, 100)):
            assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == want, (split, i)


def brute_passages(texts, least):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + least] for t in raw for i in range(len(t) - least + 1))
    out = []
    for t in raw:
        runs = []
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + least
                else:
                    runs.append([i, i + least])
        ends = {0, len(t)} | {i for i in range(1, len(t)) if t[i - 1 : i].isspace() != t[i : i + 1].isspace()}
        n = 0
        for a, b in runs:
            inner = [e for e in sorted(ends) if a <= e <= b]
            n += sum(not t[x:y].isspace() for x, y in zip(inner, inner[1:])) > 50
        out.append(n)
    return out


def test_passages_below_the_length_are_reported_and_stay(spark):
    rng = random.Random(4)
    shared = prose(rng, 52)
    assert 256 < len(shared) < 400
    texts = [prose(rng, 90) + " " + shared + " " + prose(rng, 90), prose(rng, 5) + " " + shared, prose(rng, 300), " ".join(shared.split()[:48]), None, ""]
    rows = sorted(substring_dedup.dedup_substrings(docs(spark, texts)).collect(), key=lambda r: r["doc_id"])
    assert [r["passages"] for r in rows] == [1, 1, 0, 0, 0, 0] == brute_passages(texts, 256)
    assert all(r["n_removed"] == 0 for r in rows)


def test_refine_finds_repeated_intervals():
    plan = substring_dedup.Plan(8, 8)
    far, near, long_far, long_near = substring_dedup.refine([b"xxabcdefgh", b"yyabcdefgh", b"zzzbcdefgh"], np.array([2, 2, 2]), plan)
    assert far.tolist()[:2] == [0, 0] and near.tolist()[:2] == [0, 0]
    assert long_far.tolist() == far.tolist() and long_near.tolist() == near.tolist()


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_bwts_equal_sorted_suffixes(shards):
    rng = random.Random(shards)
    rows = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(30)]
    table = substring_dedup.align(rows, np.full(30, 4), 4, 12)
    owner = np.array([rng.randrange(shards) for _ in rows])
    parts = [np.flatnonzero(owner == k) for k in range(shards)]
    numbers = np.concatenate(parts)
    for j, merged, prefix in substring_dedup.merge_bwts([substring_dedup.shard_bwt(np.ascontiguousarray(table[:, x])) for x in parts if len(x)], 6):
        suffixes = [rows[numbers[i]][j:] for i in merged]
        assert suffixes == sorted(suffixes)
        for i in range(1, 30):
            a, b = suffixes[i - 1], suffixes[i]
            assert prefix[i] == min(6, next((k for k in range(len(a)) if a[k] != b[k]), len(a)))


# ------------------------------------------------------------------ op2


def brute_fingerprint(text, size=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(values))]


def test_simhash_equals_brute_force(spark):
    rng = random.Random(2)
    texts = list(AWKWARD)
    for _ in range(40):
        t = prose(rng, 150).split()
        texts.append(" ".join(t))
        for _ in range(rng.randrange(4)):
            u = list(t)
            u[rng.randrange(len(u))] = "Changed"
            texts.append("\t".join(u))
    fps = simhash.fingerprints(docs(spark, texts))
    got = {r["doc_id"]: r for r in simhash.near_components(fps, 3).collect()}
    values = [brute_fingerprint(t) for t in texts]
    assert [got[i]["fp"].hex() for i in range(len(texts))] == [f"{v:016x}" for v in values]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(values, 3)
    assert simhash.near_components(simhash.fingerprints(docs(spark, [])), 3).collect() == []


@pytest.mark.parametrize("group", [8192, 8])
def test_links_within_buckets_equal_brute_force(spark, group, monkeypatch):
    rng = random.Random(group)
    values = set()
    for _ in range(30):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(v)
            for _ in range(rng.randrange(1, 5)):
                v ^= 1 << rng.randrange(64)
    hot = rng.getrandbits(64)
    values |= {hot ^ (rng.getrandbits(20)) for _ in range(60)}  # many in one bucket
    values = sorted(values)
    df = spark.createDataFrame([(i, bytearray(v.to_bytes(8, "big"))) for i, v in enumerate(values)], "doc_id long, fp binary")
    links = simhash.bucket_links(df, 3, simhash.exact_keys(len(values), 3), group)
    root = {bytes(r["node"]): bytes(r["root"]) for r in components.components(links).collect()}
    want = brute_components(values, 3)
    got = [root.get(v.to_bytes(8, "big"), v.to_bytes(8, "big")) for v in values]
    assert [values[w].to_bytes(8, "big") for w in want] == got


@pytest.mark.parametrize("count", [10, 10**6, 10**8, 10**10])
def test_keys_lose_no_link(count):
    keys = simhash.exact_keys(count, 3)
    rng = random.Random(count)
    for _ in range(200):
        flip = {rng.randrange(64) for _ in range(3)}
        assert any(not flip & set(k) for k in keys)


def test_bit_sliced_counters():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, (150, 2), dtype=np.uint64)
    words[1::2] = words[::2] ^ (np.uint64(1) << rng.integers(0, 12, (75, 2)).astype(np.uint64))
    p = simhash.planes(words)
    for by in (1, 2, 64, 67):
        for radius in (0, 1, 2, 3, 50, 64):
            live = ~np.zeros(p.shape[1], np.uint64)
            hit = np.unpackbits(simhash.within(p, by, radius, live).view(np.uint8), bitorder="little")[: 150 - by]
            want = np.bitwise_count(words[:-by] ^ words[by:]).sum(1) <= radius
            assert (hit == want).all()


def test_near_copies_keep_one(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(30):
        t = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts += [" ".join(t), " ".join(t[:90] + ["other"] + t[91:]), " ".join(t)]
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(100)) for _ in range(20)]
    kept = sorted(r["doc_id"] for r in near_copies.keep_one(docs(spark, texts)).collect())
    assert kept == [*range(0, 90, 3), *range(90, 110)]


def test_near_copies_are_decided_by_exact_similarity(spark):
    rng = random.Random(80)
    texts, alike = [], {}
    for n, s in ((400, 356), (400, 350), (100, 89), (100, 88), (45, 40), (45, 39), (30, 27), (30, 26), (4, 4)):
        for _ in range(40):  # pairs of n shingles that share s, on both sides of 0.8
            t = [f"w{rng.randrange(10**9)}" for _ in range(n + 4)]
            alike[len(texts) + 1] = s / (2 * n - s) >= 0.8
            texts += [" ".join(t), " ".join(t[: s + 4] + [f"v{rng.randrange(10**9)}" for _ in range(n - s)])]
    for _ in range(40):  # 4 of 5 shingles
        t = [f"w{rng.randrange(10**9)}" for _ in range(9)]
        alike[len(texts) + 1] = True
        texts += [" ".join(t), " ".join(t[:8])]
    kept = {r["doc_id"] for r in near_copies.keep_one(docs(spark, texts)).collect()}
    assert kept == {i for i in range(len(texts)) if not alike.get(i)}


@pytest.mark.parametrize("group", [4096, 6])
def test_chains_of_near_copies_equal_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(near_copies, "GROUP", group)
    monkeypatch.setattr(minhash, "WEIGHT", group << 8)
    rng = random.Random(81)
    texts = []
    for _ in range(6):
        t = [f"w{rng.randrange(10**9)}" for _ in range(60)]
        for _ in range(15):
            texts.append(" ".join(t))
            for _ in range(rng.randrange(1, 4)):
                t[rng.randrange(len(t))] = f"v{rng.randrange(10**9)}"
    texts += ["", None, texts[3]]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((t or "").split() for t in texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    rows, label = near_copies.near_copies(docs(spark, texts))
    got = {r["doc_id"]: r["first"]["doc_id"] for r in rows.join(label, "sid").collect()}
    assert [got[i] for i in range(len(texts))] == root


def test_documents_that_share_an_id_stay_unless_near_copies(spark):
    rng = random.Random(82)
    texts = [prose(rng, 60, 10**6) for _ in range(12)]
    texts += [texts[0], texts[1], texts[6]]
    ids = [None] * 4 + [5] * 4 + [6, 7, 8, 9] + [None, 3, 5]
    kept = Counter((r["doc_id"], r["text"]) for r in near_copies.keep_one(docs(spark, texts, ids=ids)).collect())
    assert kept == Counter((ids[i], texts[i]) for i in [0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13])


@pytest.mark.parametrize("block", [1 << 15, 100, 1])
def test_pairs_across_components_equal_brute_force(block):
    rng = np.random.default_rng(4)
    group = np.sort(np.concatenate([rng.integers(0, 60, 300), np.full(150, 7), [99]]))
    comp = np.where(rng.random(len(group)) < 0.6, group % 3, rng.integers(0, 9, len(group)))
    i, j = np.triu_indices(len(group), 1)
    want = (group[i] == group[j]) & (comp[i] != comp[j])
    got = [tuple(sorted(p)) for a, b in near_copies.pairs_across(group, comp, block) for p in zip(a.tolist(), b.tolist(), strict=True)]
    assert sorted(got) == list(zip(i[want].tolist(), j[want].tolist(), strict=True))
    assert list(near_copies.pairs_across(group[:0], comp[:0])) == []
    assert list(near_copies.pairs_across(group, group)) == []  # one component in each group


def test_few_bits_of_blocks():
    rng = np.random.default_rng(6)
    for m in (0, 1, 63, 64, 200):
        x = rng.integers(0, 1 << 63, (m, 4), dtype=np.uint64) & rng.integers(0, 1 << 63, (m, 4), dtype=np.uint64)
        for radius in (0, 1, 60, 67, 256):
            assert (simhash.few_bits(x, radius) == (np.bitwise_count(x).sum(1) <= radius)).all()
            assert simhash.few_bits(x * np.uint64(0), radius).all()


def test_a_pair_of_signatures_is_owned_by_one_bucket_as_in_minhash():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 4, (50, minhash.SLOTS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.3, a + 1, a).astype(np.uint16)
    for slot in range(minhash.SLOTS):
        want = [bool(minhash.owned(b[k : k + 1], a[k], slot)[0]) for k in range(len(a))]
        assert near_copies.owned_pairs(a, b, np.full(len(a), slot)).tolist() == want


def test_near_copies_at_the_threshold_in_a_fixed_number_of_buckets(spark):
    rng = random.Random(83)
    texts, alike = [], set()
    for k in range(300):
        n = rng.choice([5, 11, 40, 99, 101, 160, 400])
        base = [f"w{rng.randrange(10**9)}" for _ in range(n + 4)]
        cut_ = n // 5 + (k % 2)  # shingles left out, at and just below 0.8
        texts += [" ".join(base), " ".join(base[cut_:])]
        if 100 * (n - cut_) >= 80 * n:
            alike.add(len(texts) - 1)
    template = [f"t{i}" for i in range(120)]  # pages of one template, similarity of about a half, stay
    texts += [" ".join(template + [f"v{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(60)]
    table = docs(spark, texts)
    assert {r["doc_id"] for r in near_copies.keep_one(table).collect()} == set(range(len(texts))) - alike
    nodes = minhash.signatures(table, 5, 4).selectExpr("doc_id rid", "sig")
    assert minhash.keyed(nodes).count() == minhash.SLOTS * len(texts)


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(200, 260)] + [(300, 300), (None, 3), (7, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got[i] for i in range(100, 161)) == {100} and set(got[j] for j in range(200, 260)) == {7} and got[7] == 7
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


# ------------------------------------------------------------------ op3


@pytest.mark.parametrize("chunk", [512, 1])
def test_wavelet_matrix(chunk, monkeypatch):
    monkeypatch.setattr(token_store, "CHUNK", chunk)
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (700, 2), (5000, 50257), (3000, 1)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        blob = token_store.encode_shard([1], np.array([0, n]), ids, 0, 0) if n else None
        w = token_store.WaveletMatrix.build(ids)
        assert (w.decode() == ids).all()
        if not n:
            continue
        s = token_store.Shard(blob)
        assert (s.decode() == ids).all() and (s.access(np.arange(n)) == ids).all()
        for v in {int(ids[0]), int(ids[-1]), top + 5}:
            at = np.flatnonzero(ids == v)
            assert s.count(v) == len(at) and (s.occurrences(v) == at).all()
            assert s.rank(v, n // 2) == (ids[: n // 2] == v).sum()
            assert [s.select(v, k) for k in range(min(3, len(at)))] == at[:3].tolist() and s.select(v, len(at)) == -1


def test_lookups_unpack_only_what_they_need(tmp_path):
    ids = np.random.default_rng(3).integers(0, 50000, 1 << 20).astype(np.uint32)
    (tmp_path / "s.wmx").write_bytes(token_store.encode_shard([1], np.array([0, len(ids)]), ids, 0, 0))
    with open(tmp_path / "s.wmx", "rb") as f:
        s = token_store.Shard(f)
        assert s.unpacked == 0 and s.access([777777])[0] == ids[777777]
        levels = s.head["levels"]
        assert s.unpacked <= 2 * levels + 1 < len(s.head["frames"]) / 2  # a chunk and a directory on each level, and the alphabet
        before, v = s.unpacked, int(ids[123456])
        at = np.flatnonzero(ids == v)
        assert s.select(v, len(at) - 1) == at[-1] and s.count(v) == len(at) and (s.occurrences(v) == at).all()
        assert s.unpacked - before < len(s.head["frames"])


def test_tokens_of_null_and_repeated_ids(spark):
    df = docs(spark, ["b", "a", None, "c", "a"], ids=[5, 5, None, 1, 5])
    rows = token_store.token_output(df, token_store.tokenizer_path()).collect()
    rows = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 5, 5, 5]
    assert [r["n_tokens"] for r in rows] == [1, 2, 2, 2, 2] and rows[2]["ids"] == rows[3]["ids"] != rows[4]["ids"]


def test_token_files_hold_what_the_tokenizer_says(spark, tmp_path):
    from tokenizers import Tokenizer

    path = token_store.tokenizer_path()
    t = Tokenizer.from_file(path)
    rng = random.Random(4)
    bits = ["a", "The", " ", "\n", ".", ",", "'s", "3", "é", "<|endoftext|>", "\t", "\xa0", "-", "ñ", "x1", "字", "_"]
    texts = AWKWARD + ["".join(rng.choice(bits) for _ in range(rng.randrange(20))) for _ in range(300)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    df = docs(spark, [texts[i] for i in order], ids=order).repartition(3)
    got = token_store.token_output(df, path, f"file://{tmp_path}/t", checksum=True).orderBy("doc_id").collect()
    at = 0
    for i, r in enumerate(got):
        ids = [*t.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    back = {r["doc_id"]: bytes(r["ids"]) for r in token_store.token_output(df, path).collect()}
    assert all(zlib.crc32(back[r["doc_id"]]) == r["ids_crc32"] for r in got)
    assert token_store.token_output(docs(spark, []), path).collect() == []


def test_shards_split_between_documents(spark, tmp_path):
    df = docs(spark, [f"word {i} " * 5 for i in range(60)])
    tokens = token_store.tokenize(df, token_store.tokenizer_path()).coalesce(1)
    manifest = token_store.write_shards(tokens, f"file://{tmp_path}/s", shard_tokens=100)
    assert manifest.count() > 5
    back = token_store.read_shards(spark, f"file://{tmp_path}/s", manifest)
    assert {(r["doc_id"], bytes(r["ids"])) for r in back.collect()} == {(r["doc_id"], bytes(r["ids"])) for r in tokens.collect()}


# ------------------------------------------------------------------ op4

BENCH = [
    (0, "At noon Tom has 3 apples and buys 4 more apples at the market, how many apples does Tom hold then?"),
    (1, "The quick brown fox jumps over the lazy dog while nobody is watching the yard."),
    (2, "too short"),
    (3, None),
    (4, "five words make an item"),
]


def test_contaminated_documents(spark, monkeypatch):
    pad = prose(random.Random(3), 60)
    cases = {
        "verbatim": (f"{pad} {BENCH[1][1]} {pad}", {1}),
        "renamed": (f"{pad} said at noon Anna has 7 apples and buys 9 more apples at the market, how many apples does Anna hold then? {pad}", {0}),
        "inconsistent": (f"{pad} said at noon Anna has 7 apples and buys 9 more apples at the market, how many apples does Berta hold then? {pad}", {0}),
        "clean": (pad, set()),
        "capitals": (f"{pad} {BENCH[1][1].upper()} {pad}", {1}),
        "no marks": (f"{pad} {BENCH[0][1].lower().replace(',', '')} {pad}", {0}),
        "part": (f"{pad} The quick brown fox jumps over {pad}", set()),
        "short": (f"{pad} five words make an item {pad}", {4}),
        "null": (None, set()),
        "empty": ("", set()),
    }
    texts = [t for t, _ in cases.values()]
    bench = spark.createDataFrame([*BENCH, BENCH[1]], "item_id long, text string")
    for bits in ((16, 26), (5, 5)):  # a filter that holds, and one so full that the join alone decides
        monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
        rows = decontaminate.contaminated(docs(spark, texts), bench).collect()
        for i, (name, (_, want)) in enumerate(cases.items()):
            assert {r["item_id"] for r in rows if r["doc_id"] == i} == want, name
    by = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert by[1, 0]["renamed"] >= 2 and by[0, 1]["renamed"] == 0
    assert by[2, 0]["coverage"] < by[1, 0]["coverage"]
    kept = decontaminate.decontaminate(docs(spark, texts), bench)
    assert {r["doc_id"] for r in kept.collect()} == {3, 6, 8, 9} and kept.columns == docs(spark, []).columns
    assert decontaminate.contaminated(docs(spark, texts), bench.limit(0)).collect() == []
    assert decontaminate.contaminated(docs(spark, []), bench).collect() == []


def _found(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}


def test_passages_and_items_without_templates_are_found(spark):
    rng = random.Random(41)
    item = prose(rng, 59).replace("x", "").replace("w", "word")
    item = " ".join("".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in item.split())
    w, pad = item.split(), " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(40))
    items = [item, "12 + 34 = 46 and 7", "3 5 8 13 21 34 55 89 144", "forty two", "日本の首都はどこですか", "5 km 7 kg 9 cm"]
    texts = [f"{pad} {' '.join(w[20:33])} {pad}", f"{pad} {' '.join(w[20:32])} {pad}", *(f"{pad} {t} {pad}" for t in items[1:4]), f"質問。{items[4]}。答え", f"{pad} {items[5]} {pad}", f"{pad} 3 5 8 13 21 35 56 91 147 {pad}", pad]
    assert _found(spark, items, texts) == {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5)}


def test_renamed_persons_that_begin_sentences_are_found(spark):
    pad = prose(random.Random(42), 30)
    items = ["Tom has 3 apples. Tom buys 4 more. Tom gives 2 away. How many are left?", "Berta runs 5 km. Then Berta walks home slowly."]
    texts = [f"{pad}. Anna has 7 apples. Anna buys 9 more. Anna gives 5 away. How many are left? {pad}", f"{pad}. Carl runs 8 km. Then Carl walks home slowly. {pad}", pad]
    assert _found(spark, items, texts) == {(0, 0), (1, 1)}


def test_slots_must_map_one_to_one():
    ok = [(0, 0, ["7", ""], ["3", ""]), (1, 1, ["", "9"], ["", "4"])]
    assert decontaminate.judge_diagonal(ok).covered == {0, 1, 2}
    clash = [(0, 0, ["7", ""], ["3", ""]), (2, 2, ["8", ""], ["3", ""])]
    assert decontaminate.judge_diagonal(clash).covered == {0, 1}


def test_one_wrong_slot_costs_only_its_own_windows():
    wrong = [(0, 0, ["8", ""], ["3", ""])]
    rest = [(2 * i, 2 * i, ["7", ""], ["3", ""]) for i in range(1, 6)]
    got = decontaminate.judge_diagonal(wrong + rest)
    assert got.covered == set(range(2, 12)) and got.used == 5 and got.renamed == {"3"} and got.first == 2


def test_largest_consistent_set_equals_all_subsets():
    from itertools import combinations

    rng = random.Random(6)
    for _ in range(150):
        hits = [(q, q, [str(rng.randrange(3)), ""], [str(rng.randrange(3)), ""]) for q in range(0, 2 * rng.randrange(1, 8), 2)]

        def fits(chosen):
            pairs = {(b[0], a[0]) for _, _, a, b in chosen}
            return len(pairs) == len({i for i, _ in pairs}) == len({d for _, d in pairs})

        most = max(2 * n for n in range(len(hits) + 1) for c in combinations(hits, n) if fits(c))
        assert len(decontaminate.judge_diagonal(hits).covered) >= 0.75 * most


def test_verbatim_items_equal_brute_force(spark):
    rng = random.Random(44)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    items = [" ".join(rng.choice(words) for _ in range(rng.randrange(4, 30))) for _ in range(12)]
    texts = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        if i % 2:
            x = rng.choice(items).split()
            a = rng.randrange(len(x))
            at = rng.randrange(len(w) + 1)
            w[at:at] = x[a : a + rng.randrange(1, 31)]
        texts.append(" ".join(w))
    want = set()
    for d, t in enumerate(texts):
        w = t.split()
        for k, item in enumerate(items):
            x = item.split()
            size = min(8, len(x))
            hit = [(p, q) for p in range(len(w) - size + 1) for q in range(len(x) - size + 1) if w[p : p + size] == x[q : q + size]]
            covered = {j for _, q in hit for j in range(q, q + size)}
            longest = 0
            for diagonal in {p - q for p, q in hit}:
                here = {j for p, q in hit if p - q == diagonal for j in range(q, q + size)}
                run = 0
                for j in range(len(x) + 1):
                    run = run + 1 if j in here else 0
                    longest = max(longest, run)
            if len(covered) >= 0.5 * len(x) or longest >= min(13, len(x)):
                want.add((d, k))
    assert _found(spark, items, texts) == want and len(want) > 5


def test_decontamination_of_null_and_repeated_ids_and_long_texts(spark):
    item = BENCH[1][1]
    pad = prose(random.Random(9), 20000)
    bench = spark.createDataFrame([(1, item), (1, item), (None, "five words make an item")], "item_id long, text string")
    df = docs(spark, [item, item, "clean text here", f"{pad} {item} {pad}", "five words make an item", item], ids=[None, 7, 7, 8, 9, 7])
    rows = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()), key=str)
    assert rows == sorted([(None, 1), (7, 1), (8, 1), (9, None)], key=str)
    assert [r["text"] for r in decontaminate.decontaminate(df, bench).collect()] == ["clean text here"]


# ------------------------------------------------------------------ op5


def brute_top(vectors, k=5):
    out = {}
    for q, v in vectors:
        if q % 50 == 0:
            s = sorted(((-int(np.dot(v, w)), c) for c, w in vectors if c != q and len(w) == len(v)))
            out[q] = [(i + 1, c, -x) for i, (x, c) in enumerate(s[:k])]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(topk, "CANDIDATES", 70)
    monkeypatch.setattr(topk, "QUERIES", 2)
    vs = [(i, rng.normal(0, 0.3, 24).astype(np.float32).tolist()) for i in range(260)]
    vs += [(i, vs[3][1]) for i in range(300, 420)]  # a hot vector: ties
    bad = [(1000, None), (1050, [float("nan")] * 24), (1001, [None, *vs[0][1][1:]]), (1002, [float("inf"), *vs[0][1][1:]]), (1100, [0.5, -0.5]), (1103, []), (1150, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in vs + bad], "vec_id long, embedding array<float>, rank int")
    q = topk.quantise(df)
    good = [(i, np.floor(256 * np.array(v, np.float64)).astype(int)) for i, v in vs + bad if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    got = {}
    for r in topk.top_k(q, q.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {k: v for k, v in brute_top(good).items() if v}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert topk.top_k(q.limit(0), q.limit(0)).collect() == []


# ------------------------------------------------------------------ op6


def test_mix_meets_its_targets(spark):
    rng = random.Random(6)
    texts, sources = [], []
    for s, n in (("a", 200), ("b", 30), ("c", 3), (None, 50), ("z", 1)):
        for _ in range(n):
            texts.append(prose(rng, rng.randrange(1, 80)))
            sources.append(s)
    texts += ["", None, "one"]
    sources += ["a", "b", "empty-ish"]
    placed, parts = mixing.mix(docs(spark, texts, sources))
    rows = mixing.taken(placed, parts).collect()
    assert len(rows) == len(texts)
    sizes = Counter()
    for t, s in zip(texts, sources, strict=True):
        sizes[s] += len((t or "").split())
    goal = mixing.targets(dict(sizes))
    assert abs(sum(goal.values()) - sum(sizes.values())) < 1e-6
    assert all(goal[s] <= 3 * sizes[s] + 1e-9 for s in goal)
    got = Counter()
    for r in rows:
        got[r["source"]] += r["taken"]
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6
    assert all(abs(got[s] - goal[s]) <= 3 + 0.01 * goal[s] for s in goal), (got, goal)
    again = mixing.taken(*mixing.mix(docs(spark, texts, sources))).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)


@pytest.mark.parametrize("slots", [1 << 18, 1000, 16, 1])
def test_sources_below_a_block_meet_their_targets(spark, slots):
    rng = random.Random(60)
    texts, sources = [], []
    for s, n in (("a", 3), ("b", 400), ("c", 2), ("d", 1), (None, 30)):
        for _ in range(n):
            texts.append(prose(rng, rng.randrange(20, 60)))
            sources.append(s)
    rows = mixing.taken(*mixing.mix(docs(spark, texts, sources), slots)).collect()
    got, goal = Counter(), {r["source"]: r["target"] for r in rows}
    for r in rows:
        got[r["source"]] += r["taken"]
    assert all(abs(got[s] - t) <= 1 for s, t in goal.items()), (got, goal)


def test_mix_of_nothing(spark):
    for texts in ([], ["", None]):
        placed, parts = mixing.mix(docs(spark, texts, ["s"] * len(texts)))
        assert parts.count() == 0 and [r["taken"] for r in mixing.taken(placed, parts).collect()] == [0] * len(texts)


def test_mixed_documents_repeat_whole(spark):
    texts = [prose(random.Random(i), 40) for i in range(60)]
    out = mixing.mixed_documents(docs(spark, texts, ["a"] * 55 + ["b"] * 5))
    n = Counter(r["doc_id"] for r in out.collect())
    assert max(n.values()) == 3 and all(n[i] == 3 for i in range(55, 60)) and out.columns == docs(spark, []).columns


def brute_mix(sizes_in_order, goal, epochs=3):
    """Words taken of each document of a source whose stream comes in that order and ends at the goal."""
    left, out = goal, [0] * len(sizes_in_order)
    for _ in range(epochs):
        for i, n in enumerate(sizes_in_order):
            take = min(n, left)
            out[i] += take
            left -= take
    return out


def test_mix_takes_what_a_plain_loop_takes(spark):
    rng = random.Random(61)
    texts = [prose(rng, rng.randrange(0, 90)) if rng.random() < 0.95 else rng.choice([None, ""]) for _ in range(200)]
    sources = [rng.choice(["a", "b", "c", "c", "c", "c", None]) for _ in range(200)]
    ids = [i if rng.random() < 0.9 else rng.choice([None, 3, 3]) for i in range(200)]
    for slots in (1 << 14, 97):
        placed, parts = mixing.mix(docs(spark, texts, sources, ids), slots=slots)
        rows = mixing.taken(placed, parts).collect()
        goal = mixing.targets({s: sum(len((t or "").split()) for t, x in zip(texts, sources) if x == s) for s in set(sources)})
        assert len(rows) == 200
        for s in set(sources):
            own = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["at"], r["size"] > 0))
            assert [r["at"] for r in own if r["size"]] == list(np.cumsum([0] + [r["size"] for r in own if r["size"]])[:-1])
            assert [r["taken"] for r in own] == brute_mix([r["size"] for r in own], int(goal[s] + 0.5))


def test_mixed_documents_keep_repeated_and_null_ids_apart(spark):
    rng = random.Random(62)
    texts = [prose(rng, 40) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[4]), (6, texts[4])]
    df = docs(spark, [t for _, t in rows], ["a"] * 6, [i for i, _ in rows])
    for _ in range(2):
        got = mixing.mixed_documents(df)
        assert got.columns == df.columns
        assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(rows)
    assert mixing.mixed_documents(docs(spark, [])).collect() == []


# ------------------------------------------------------------------ op7, op10


def test_top_k_refuses_scores_beyond_a_long_and_counts_repeats(spark):
    rows = lambda *v: spark.createDataFrame([(i, x) for i, x in v], "vec_id long, embedding array<double>")
    for big in ([1e30, 0.0], [-1e30, 0.0], [2.0**24, 2.0**24]):
        with pytest.raises(Exception, match="leave a long: vec_id 7"):
            topk.quantise(rows((0, [1.0, 1.0]), (7, big))).collect()
    q = topk.quantise(rows((0, [1.0, 2.0**22]), (1, [1.0, 2.0**22]), (1, [1.0, 2.0**22]), (None, [1.0, 1.0]), (2, [0.0, 0.0])))
    got = [tuple(r) for r in topk.top_k(q, q.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**60 + 2**16), (0, 2, 1, 2**60 + 2**16), (0, 3, 2, 0)]


def test_toxicity_learns_the_first_text_of_a_repeated_id(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, int(i % 2)) for i in ids], "doc_id long, toxic int")
    texts = lambda i: "you vile awful fool" if i % 2 else "a calm walk in the park"
    once = docs(spark, [texts(i) for i in ids], ids=ids)
    more = docs(spark, [t for i in ids for t in (texts(i), texts(i), "zz later " + texts(i + 1), None)], ids=[i for i in ids for _ in range(4)])
    a, b = toxicity.train(once, labels), toxicity.train(more, labels)
    assert len(a.weights) and a.bias == b.bias and list(a.buckets) == list(b.buckets) and list(a.weights) == list(b.weights)
    long = docs(spark, ["word " * 200_000 + "vile awful fool", "calm", "calm"], ids=[1, 2, 2])
    got = sorted(map(tuple, toxicity.score_texts(long, a).collect()))
    assert len(got) == 3 and got[1] == got[2] and got[0][1] > got[1][1]


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(600):
        w = prose(rng, 40, 300).split()
        bad = i % 5 == 0
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["nastyword", "vileword", "vilewords"])
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    df = docs(spark, texts + [None, ""])
    model = toxicity.train(df, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"))
    rows = {r["doc_id"]: r for r in toxicity.score_texts(df, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values()) and len(rows) == 602
    assert len(model.buckets) < 1 << 14
    none = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score_texts(df, none).collect()} == {0.5}
    assert toxicity.score_texts(docs(spark, []), model).collect() == []


def test_language_of_held_out_documents(spark):
    rng = random.Random(10)
    stems = {"en": ["the", "thing", "ought", "shed"], "de": ["und", "schon", "über", "nicht"], "fr": ["été", "vous", "eaux", "quelle"]}
    texts, langs = [], []
    for i in range(450):
        lang = "en de fr".split()[i % 3]
        texts.append(" ".join(rng.choice(stems[lang]) + rng.choice(stems[lang]) for _ in range(12)).capitalize())
        langs.append(lang)
    extra = [None, "", "123 !", "٣", "é", "Ñandú"]
    df = docs(spark, texts + extra, langs=langs + [None] * len(extra))
    rows = {r["doc_id"]: r for r in language_id.identify(df, language_id.train(df)).collect()}
    held = [i for i in range(450) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i]["lang_pred"] == langs[i] for i in held]) > 0.97
    assert [rows[450 + k]["lang_pred"] == "und" for k in range(6)] == [True, True, True, True, False, False]
    model = language_id.train(df)
    kept = language_id.keep_identified(df, model)
    assert len({r["doc_id"] for r in kept.collect()} & set(range(450))) >= 448 and kept.columns == df.columns
    nobody = docs(spark, ["abc"])
    assert [r["lang_pred"] for r in language_id.identify(nobody, language_id.train(nobody)).collect()] == ["und"]


STEMS = {"en": ["the", "thing", "ought", "shed"], "de": ["und", "schon", "über", "nicht"], "fr": ["été", "vous", "eaux", "quelle"], "es": ["año", "los", "muy", "calle"]}


def invented(rng, lang, n=30):
    return " ".join(rng.choice(STEMS[lang]) + rng.choice(STEMS[lang]) for _ in range(n))


@pytest.mark.parametrize("rows", [120, 1400])
def test_language_rejection_is_calibrated(rows):
    rng = random.Random(rows)
    langs = [["en", "de", "fr", "es"][i % 4] for i in range(rows)]
    model = language_id.fit([invented(rng, x) for x in langs], langs)
    own = [invented(rng, x) for x in langs[:200]]
    foreign = [" ".join(rng.choice(["kyz", "wojn", "szcz", "przy", "łódź"]) + rng.choice(["ąk", "owy", "gzy"]) for _ in range(30)) for _ in range(50)]
    no = model.rejects(model.raw(own + foreign), own + foreign)
    assert no[: len(own)].mean() <= 0.01 and no[len(own) :].mean() >= 0.9
    assert set(model.rates) == {"learned", "foreign", "shuffled"} and model.rates["learned"] <= 0.01


def test_language_scores_equal_a_plain_version_and_do_not_depend_on_the_batch(monkeypatch):
    rng = random.Random(3)
    langs = [["en", "de", "fr"][i % 3] for i in range(60)]
    model = language_id.fit([invented(rng, x) for x in langs], langs)
    texts = [invented(rng, "de"), "", "A", "é!x", "a" * 500, " 12 ", "The  thing"]
    together = model.probabilities(texts)

    def plain(text):
        words = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text.lower()).split()
        z, n = np.zeros(3), 0
        for w in words:
            w = f" {w} "
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    g = w[i : i + k]
                    if g == " ":
                        continue
                    h = 0
                    for c in g:
                        h = ((h ^ ord(c)) * 0x9E3779B1) % 2**32
                        h ^= h >> 15
                    z, n = z + model.logits[(h * 0x85EBCA6B) % 2**32 >> 17], n + 1
        z = (z / max(n, 1) + model.bias) / model.temperature
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    for t, p in zip(texts, together):
        assert np.allclose(p, plain(t), atol=1e-4) and np.allclose(model.probabilities([t])[0], p, atol=1e-5)
    monkeypatch.setattr(language_id, "PIECE", 64)
    assert np.allclose(model.probabilities(texts)[0], together[0], atol=1e-2)


# ------------------------------------------------------------------ op8


def brute_spans(scanner, codes):
    """All chains of right-maximal matches, by trying every earlier match."""
    out = []
    for t, seq in enumerate(scanner.coded):
        ms = []
        for a in range(len(codes)):
            for u in range(len(seq)):
                n = 0
                while a + n < len(codes) and u + n < len(seq) and codes[a + n] == seq[u + n]:
                    n += 1
                ms.append((a, u, n))
        # longest match that ends at each place, and only those that no longer match of any template continues
        longest = [0] * (len(codes) + 1)
        for other in scanner.coded + [p for p, _ in scanner.base]:
            for e in range(1, len(codes) + 1):
                for v in range(1, len(other) + 1):
                    n = 0
                    while n < min(e, v) and codes[e - 1 - n] == other[v - 1 - n]:
                        n += 1
                    longest[e] = max(longest[e], n)
        good = []
        for e in range(1, len(codes) + 1):
            n = longest[e]
            if n >= license_scan.MIN_MATCH and (e == len(codes) or longest[e + 1] <= n):
                good += [(e - n, v - n, n) for v in range(n, len(seq) + 1) if codes[e - n : e] == seq[v - n : v]]
        good.sort()
        best = []
        for i, (a, u, n) in enumerate(good):
            top = (n, -i, i)
            for j in range(i):
                b, v, m = good[j]
                gap, skip = a - (b + m), u - (v + m)
                over = max(0, -gap, -skip)
                if b < a and v < u and gap <= license_scan.MAX_GAP and over < n:
                    top = max(top, (best[j][0] + n - over, -best[j][2], best[j][2]))
            best.append(top)
        ends = {}
        for i, (cover, _, first) in enumerate(best):
            if first not in ends or (cover, i) > ends[first]:
                ends[first] = (cover, i)
        for first, (cover, i) in ends.items():
            if cover >= license_scan.MIN_COVER * len(seq):
                out.append((scanner.templates[t][0], good[first][0], good[i][0] + good[i][2] - good[first][0], min(1.0, cover / len(seq))))
    return sorted(out)


def test_license_spans_equal_brute_force():
    rng = random.Random(88)
    templates = [("x", "a b c d e f g h i j k l"), ("y", "c d e a b c q r s t"), ("z", "a b c a b c a b c d")]
    scanner = license_scan.Scanner(templates, {"a b": "ab"})
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 9)):
            t = rng.choice(templates)[1].split()
            i = rng.randrange(len(t))
            words += t[i : i + rng.randrange(1, 12)] + ["zz"] * rng.randrange(0, 3)
        codes = [scanner.ids.get(w.encode(), 0) for w in words]
        assert sorted(scanner.spans(np.array(codes, np.int32))) == brute_spans(scanner, codes), words


def test_a_chain_looks_back_past_many_fragments():
    # the second half of the notice comes after far more than twenty matches of its own repeated words
    notice = [f"n{i}" for i in range(30)]
    repeated = ["a", "b", "c"] * 15
    scanner = license_scan.Scanner([("x", " ".join(notice[:15] + repeated + notice[15:]))], {"a b": "ab"})
    codes = [scanner.ids[w.encode()] for w in notice[:15] + ["a", "b", "c"] * 14 + notice[15:]]
    (span,) = [s for s in scanner.spans(np.array(codes, np.int32)) if s[1] == 0]
    assert span[3] > 0.9 and span[2] == len(codes)


def test_license_phrases_equal_brute_force(spark):
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    texts = AWKWARD + [
        "Released under the MIT License. mit-license, MIT\nlicense",
        "GNU General Public License and the Apache License; cc by cc BY-NC 4.0",
        "the mité license is no MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in it without restriction",
        "in the software license",
    ]
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = word.findall(low)
        places, labels = [], set()
        for p, label in license_scan.PHRASES.items():
            p = p.split()
            at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    assert rows[len(AWKWARD) + 3]["labels"] == "mit" and rows[len(AWKWARD) + 3]["spans"][0]["first"] == 0
    assert rows[len(AWKWARD) + 4]["labels"] == ""


def test_suffix_automaton_gives_matching_statistics():
    rng = random.Random(1)
    seqs = [[rng.randrange(4) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    auto = license_scan.SuffixAutomaton(seqs)
    subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [rng.randrange(5) for _ in range(300)]
    for i, (state, n) in enumerate(auto.statistics(text)):
        assert n == max([k for k in range(0, i + 2) if k == 0 or tuple(text[i + 1 - k : i + 1]) in subs])
        if n:
            m = tuple(text[i + 1 - n : i + 1])
            want = {(t, e) for t, s in enumerate(seqs) for e in range(len(s)) if tuple(s[e + 1 - n : e + 1]) == m and e + 1 >= n}
            assert want <= auto.ends[state]


# ------------------------------------------------------------------ op9


PAGES = "page_id long, url string, html string, payload string"


def test_warc_round_trip(spark, tmp_path):
    long = "<p>é</p>" * 30_000
    html = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "é\r\n\r\nx", "<p>a</p>", long]
    pages = spark.createDataFrame([(i, f"http://h/{i}" if i % 2 else None, t, "clash") for i, t in enumerate(html)] + [(1, "http://h/1", html[1], "clash"), (None, "u", html[0], ""), (None, None, "alone", "")], PAGES)
    folder = f"file://{tmp_path}/w"
    warc.write_archive(pages, folder)
    rows = warc.describe_archive(spark, folder).collect()
    texts = dict(enumerate(html))
    for r in rows:
        if r["page_id"] is None:
            continue
        body = (texts[r["page_id"]] or "").encode()
        last = max(i for i, t in texts.items() if (t or "") == (texts[r["page_id"]] or ""))
        want = ("response", None) if last == r["page_id"] else ("revisit", last)
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), *want)
    # a null page_id is the smallest: it revisits, or is the response where no other page has the payload
    assert sorted((r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows if r["page_id"] is None) == [(5, "response", None), (8, "revisit", 6)]
    assert len(rows) == 11 and spark.read.parquet(f"{folder}/payloads").count() == 6
    files = warc.export_files(warc.read_archive(spark, folder).coalesce(1), f"file://{tmp_path}/files", most=600).collect()
    assert len(files) > 1 and sum(f["records"] for f in files) == 11
    found = [x for f in files for x in warc.read_records(open(f["file"], "rb"))]
    assert {h["WARC-Type"] for h, _ in found} == {"response", "revisit"}
    assert any(block.endswith("é\r\n\r\nx".encode()) for _, block in found)
    small = f"file://{tmp_path}/s"
    warc.write_archive(pages, small, min_payload=1 << 20)
    assert {r["record_type"] for r in warc.describe_archive(spark, small).collect()} == {"response"}


def test_archive_without_records(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], PAGES), f"file://{tmp_path}/none")
    assert warc.describe_archive(spark, f"file://{tmp_path}/none").collect() == []


def test_damaged_archive_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc", ""), (2, "u", "abc", ""), (3, "u", "other", "")], PAGES)
    folder = f"file://{tmp_path}/good"
    warc.write_archive(pages, folder)

    def spoilt(name, headers=lambda h: h, payloads=lambda p: p):
        headers(spark.read.parquet(f"{folder}/headers")).write.parquet(f"file://{tmp_path}/{name}/headers")
        payloads(spark.read.parquet(f"{folder}/payloads")).write.parquet(f"file://{tmp_path}/{name}/payloads")
        return lambda: warc.describe_archive(spark, f"file://{tmp_path}/{name}").collect()

    swap = lambda a, b: lambda h: h.withColumn("header", warc.F.expr(f"cast(replace(cast(header as string), '{a}', '{b}') as binary)"))
    other = bytearray(zstandard.compress(b"abd"))
    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    cases = [
        (spoilt("payload", payloads=lambda p: p.withColumn("frame", warc.F.lit(other))), "not the one of its key"),
        (spoilt("frame", payloads=lambda p: p.withColumn("frame", warc.F.lit(bytearray(b"zz")))), "is damaged"),
        (spoilt("missing", payloads=lambda p: p.where("size <> 3")), "is missing"),
        (spoilt("keys", *[lambda t: t.withColumn("key", warc.F.reverse("key"))] * 2), "not the one of its key"),
        (spoilt("digest", headers=swap(digest, digest[::-1])), "does not match"),
        (spoilt("length", headers=swap("Content-Length: ", "Content-Length: 1")), "does not match"),
        (spoilt("refers", headers=swap("Refers-To: <urn:page:2>", "Refers-To: <urn:page:3>")), "revisit without its response"),
    ]
    for run, what in cases:
        with pytest.raises(Exception, match=what):
            run()
    files = warc.export_files(warc.read_archive(spark, folder), f"file://{tmp_path}/files")
    files = spark.createDataFrame(files.collect(), files.schema)
    assert warc.describe_files(files).count() == 3
    with pytest.raises(Exception, match="records, not"):
        warc.describe_files(files.withColumn("records", warc.F.col("records") + 1)).collect()
    name = files.first()["file"]
    whole = open(name, "rb").read()
    open(name, "wb").write(whole[:-9])
    with pytest.raises(Exception, match="cut or damaged"):
        warc.describe_files(files).collect()


@pytest.mark.parametrize("run", [lambda d: substring_dedup.dedup_substrings(d), lambda d: simhash.fingerprints(d), lambda d: license_scan.scan_licenses(d), lambda d: token_store.tokenize(d, token_store.tokenizer_path())])
def test_awkward_texts_give_a_row_each(spark, run):
    assert run(docs(spark, AWKWARD)).count() == len(AWKWARD)
