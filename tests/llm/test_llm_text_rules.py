"""Repetition rules, SimHash and BPE against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

from strata.llm import bpe, repetition, simhash
from strata.llm.components import connected_components

ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "one two three"), (4, "a b"), (4, "a b"), (5, "x " * 30000), (6, "A b  cé \U0001f600")]


def odd(spark):
    rows = [(i, t, "z", 9) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, `row` string, n_words int")


def windows(w, k):
    seen = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    hit = [0] * len(w)
    for i in range(len(w) - k + 1):
        if seen[tuple(w[i:i + k])] > 1:
            hit[i:i + k] = [1] * k
    return sum(hit)


def longest(w):
    k = 0
    while k < len(w) and max(Counter(tuple(w[i:i + k + 1]) for i in range(len(w) - k)).values(), default=0) > 1:
        k += 1
    return k


def test_suffix_array_equals_brute_force():
    r = random.Random(5)
    for _ in range(150):
        docs = []
        for _ in range(r.randint(1, 6)):
            w = [r.randint(0, r.choice((1, 3, 40))) for _ in range(r.randint(0, 50))]
            docs.append(w * r.randint(1, 3) if r.random() < 0.3 else w)
        assert repetition.measure(docs, 5) == [(windows(w, 3), windows(w, 5), longest(w)) for w in docs]


def test_rules_on_odd_rows(spark):
    got = repetition.rules(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {r.id: r for r in got}
    assert (by[1].n_words, by[1].kept, by[2].base_failed, by[3].word_chars) == (0, False, True, 0)
    assert by[5].n_repeat_words == 30000 and by[5].longest_repeat == 29999 and not by[5].kept
    assert by[6].n_words == 4 and by[6].word_chars == 5
    assert repetition.rules(odd(spark).limit(0)).count() == 0
    kept = repetition.keep_good(odd(spark), min_words=2, max_window_percent=100)
    assert kept.columns == ["doc_id", "text", "row", "n_words"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 4, 4, 6]


def test_rules_keep_prose_and_drop_repeats(spark):
    r = random.Random(1)
    prose = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300))
    block = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    rows = [(1, prose), (2, f"{prose} {block} {block} {block} {block}"), (3, f"{prose} {' '.join(prose.split()[:40])}")]
    got = {r.id: r for r in repetition.rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in (1, 2, 3)] == [True, False, True]
    assert got[2].longest_repeat == 180 and got[3].longest_repeat == 40


def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints(spark):
    got = [(r.id, r.fp & (2 ** 64 - 1)) for r in simhash.fingerprints(odd(spark)).collect()]
    assert sorted(got, key=str) == sorted(((i, brute_fingerprint(t)) for i, t in ODD), key=str)
    native = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()[0]
    assert native & (2 ** 64 - 1) == brute_fingerprint("A b c")        # one shingle: its XXH64, as Spark has it


@pytest.mark.parametrize("posting_rows", [64, 3, 1])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_links_equal_all_pairs(spark, posting_rows, max_bits):
    r = random.Random(max_bits)
    fps = set()
    for _ in range(12):
        seed = r.getrandbits(64)
        for _ in range(12):                            # a walk: chains of near fingerprints
            fps.add(seed)
            for _ in range(r.choice((1, 2, 3))):
                seed ^= 1 << r.randrange(64)
    fps |= {0, 1, 3, 7, 2 ** 63, 2 ** 64 - 1}
    signed = {int(np.uint64(f).astype(np.int64)): f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {(r.node): r.root for r in connected_components(simhash.links(df, max_bits, posting_rows)).collect()}
    pairs = {frozenset((a, b)) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= max_bits}
    parent = {s: s for s in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    back = {f: s for s, f in signed.items()}
    for p in pairs:
        x, y = (find(back[f]) for f in p)
        parent[max(x, y)] = min(x, y)
    assert {s: got.get(s, s) for s in signed} == {s: find(s) for s in signed}


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    root = brute_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    got = simhash.near_duplicates(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    assert {r.id: r.component_id for r in got} == {i: least[root[f]] for i, f in fps.items()}


def test_keep_one_of_each_group(spark):
    got = simhash.keep_one(odd(spark)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(
        [(1, None), (None, "one two three"), (4, "a b"), (5, "x " * 30000), (6, ODD[-1][1])], key=str)
    assert simhash.keep_one(odd(spark).limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.range(200).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    got = connected_components(chain.unionByName(chain.select(F.lit(None).cast("long").alias("a"), "b"))).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


@pytest.fixture(scope="module")
def library():
    ranks = dict(bpe.read_ranks(bpe.VOCABULARY))
    return tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(3000)]
    table = bpe.PerfectHash(keys, list(range(3000)))
    assert [table.get(k) for k in keys] == list(range(3000))
    assert len(table.keys) == 3000 and table.get(b"other") is None


def test_encoder_equals_library(library):
    e, r = bpe.Encoder(bpe.read_ranks(bpe.VOCABULARY)), random.Random(2)
    signs = "ab  \n\t'sé¼²\x1c\x85​ 　😀1,.!日ſK\r\x0b᠎ⅷ٣<|endoftext|>"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for t in texts + ["x" * 5000, " " * 300, "a  b \n c", "<|endoftext|>"]:
        ids = e.encode(t).tolist()
        assert ids == library.encode_ordinary(t), repr(t)
        assert e.decode(ids) == t.encode()


def test_encoder_forgets_without_harm(library, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBER", 3)
    e = bpe.Encoder(bpe.read_ranks(bpe.VOCABULARY))
    for t in ["zq xw vbn", "qqq www eee rrr", "zq www"] * 3:
        assert e.encode(t).tolist() == library.encode_ordinary(t)


def test_encode_frame(spark, library):
    got = bpe.encode(odd(spark), round_trip=True).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD), key=str)
    assert sorted(((r.id, r.ids, bytes(r.decoded)) for r in got), key=str) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    back = bpe.decode(bpe.encode(odd(spark)), "id").collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in ODD)
    assert bpe.encode(odd(spark).limit(0)).count() == 0


def test_documents_equal_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode(docs).collect():
        assert r.ids == library.encode_ordinary(text[r.id])
