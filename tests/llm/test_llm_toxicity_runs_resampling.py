"""Toxicity, periodic runs and importance resampling: brute force, held-out accuracy, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from strata.llm import periodic, resampling, toxicity
from strata.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- toxicity ---------------------------------------------------------------

@pytest.mark.parametrize("raw,want", [
    ("You 1d1ot!", " you idiot "), ("m0r0n the$$$ st!! w0rthle55", " moron the st worthless "),
    ("іdіоt $tupid", " idiot stupid "), ("ｉｄｉｏｔ id​iot", " idiot idiot "),      # Cyrillic, full width, invisible
    ("", " "), ("12 + 34", " "), ("Größe été", " größe été ")])
def test_fold(raw, want):
    assert toxicity.fold(raw) == want


def brute_hits(lexicon, folded):
    """Best entry of each word, word by word."""
    out, words, at = {}, folded.split(), 0
    spans = []
    for phrase in lexicon.exceptions:
        p = folded.find(phrase)
        while p >= 0:
            spans.append((p, p + len(phrase) - 1))
            p = folded.find(phrase, p + 1)
    for w in words:
        best = max((weight for e, weight in lexicon.weights.items() if f" {w} ".startswith(e)), default=0)
        if best > 0 and not any(a <= at < b for a, b in spans):
            out[at] = best
        at += len(w) + 1
    return out


def test_matches_equal_a_word_by_word_search():
    r = random.Random(3)
    words = ["".join(r.choice("ab") for _ in range(r.randint(1, 5))) for _ in range(40)]
    for _ in range(300):
        entries = {f" {w}" + r.choice(["", " "]): r.choice([1.0, 2.0, 3.0]) for w in r.sample(words, 6)}
        phrases = [f" {r.choice(words)} {r.choice(words)} " for _ in range(2)]
        lexicon = toxicity.Lexicon(entries, phrases)
        folded = toxicity.fold(" ".join(r.choices(words, k=r.randint(0, 30))))
        assert lexicon.hits(folded) == brute_hits(lexicon, folded)


def test_exceptions_and_length():
    lexicon = toxicity.Lexicon({" clown ": 5.0}, [" clown fish "], 0.5, 1.0, -1.0)
    assert lexicon.total(toxicity.fold("a clown fish")) == (0.0, 3)
    assert lexicon.total(toxicity.fold("a clown fish, you CL0WN")) == (5.0, 5)
    short, long = lexicon.score(np.array([5.0, 5.0]), np.array([5.0, 500.0]))
    assert short > long
    assert toxicity.Lexicon({}).total(" ") == (0.0, 0)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op11_toxicity"](spark, sf).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got.held_out.items())
    both = got.join(labels, how="inner")
    both = both[both.held_out]
    assert (both.predicted == both.toxic).mean() >= 0.95
    assert both.predicted[both.toxic == 1].mean() >= 0.75 and (both.predicted[both.toxic == 0] == 0).mean() >= 0.99
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def _training(spark):
    r = random.Random(5)
    plain = ["one", "two", "three", "four", "five", "six"]
    docs, labels = [], []
    for i in range(120):
        w = r.choices(plain, k=30)
        if i % 3 == 0:
            w[4], w[9], w[20] = "grumbly", "nastyfied", "nastyones"
        if i % 3 == 1:
            w[5:7] = ["grumbly", "bear"]
        docs.append((i, " ".join(w), "x", 1.5, i))
        labels.append((i, int(i % 3 == 0), "y"))
    return docs, labels


def test_odd_rows_of_toxicity(spark):
    docs, labels = _training(spark)
    odd = [(200, None), (201, ""), (202, "grуmbly n4styfied " * 3), (None, "grumbly nastyones nastyfied"), (203, "one " * 200_000),
           (204, "grumbly bear one two"), (204, "grumbly bear one two"), (205, "!!! 12 $$$")]
    docs += [(i, t, "x", 1.5, 0) for i, t in odd]
    docs += [(0, docs[0][1], "x", 1.5, 0)] * 50                    # a labelled id that repeats teaches once
    labels += [(None, 1, "y"), (3, None, "y"), (6, 1, "y"), (6, 1, "y"), (999, 1, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, y string, pattern double, score long")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = toxicity.classify(df, lab, F.lit(True))
    assert got.columns == ["id", "score", "predicted", "words", "matches"]
    rows = got.collect()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
    assert by[200][0].score == by[201][0].score == by[205][0].score < 0.5 and not by[200][0].matches and by[200][0].words == 0
    assert by[202][0].predicted == 1 and by[None][0].predicted == 1
    assert by[203][0].predicted == 0 and by[203][0].words == 200_000
    assert len(by[204]) == 2 and not by[204][0].matches            # "grumbly bear" was learned as an exception
    assert len(by[0]) == 51 and len({r.score for r in by[0]}) == 1
    assert toxicity.classify(df.limit(0), lab, F.lit(True)).collect() == []
    assert max(r.score for r in toxicity.classify(df, lab.limit(0), F.lit(True)).collect()) < 1e-12
    assert {r.predicted for r in toxicity.classify(df, lab, F.lit(False)).collect()} == {0}


# --- periodic runs ----------------------------------------------------------

def brute_runs(words, least):
    """All runs, period by period."""
    ids: dict = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], int)
    out = []
    for q in range(1, len(words) // 2 + 1):
        step = np.diff(np.r_[False, a[:-q] == a[q:], False].astype(int))
        for start, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            length = end - start + q
            if length >= max(least, 2 * q) and not any(q % p == 0 and s <= start and s + n >= start + length for s, n, p in out):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    r = random.Random(1)
    for _ in range(1500):
        docs = []
        for _ in range(r.randint(1, 4)):
            w = [r.choice("abcd"[:r.randint(1, 4)]) for _ in range(r.randint(0, 60))]
            if w and r.random() < 0.5:
                a, p = r.randrange(len(w)), r.randint(1, 8)
                p = min(p, len(w) - a)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            docs.append(w)
        least = r.choice([2, 3, 5, 12])
        assert periodic.find_runs(docs, least) == [brute_runs(d, least) for d in docs]


def test_large_sets_of_positions():
    word = ["a"] * 3000
    assert periodic.find_runs([word]) == [[(0, 3000, 1)]]
    assert periodic.collapse(word, [(0, 3000, 1)]) == ["a"]
    r = random.Random(2)
    word = [r.choice("ab") for _ in range(4000)]
    assert periodic.find_runs([word, word[:50]]) == [brute_runs(word, 12), brute_runs(word[:50], 12)]
    held = periodic.Positions(500)
    rest = [x for x in r.sample(range(10_000), 5000) if x != 500]
    known = [500]
    for x in rest:
        below, above = held.add(x)
        assert (below, above) == (max((k for k in known if k < x), default=-1), min((k for k in known if k > x), default=-1)) or len(known) > 300
        known.append(x)
    assert list(held) == sorted(known)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op12_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and sum(r.n_runs > 0 for r in got.values()) > 10
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words, 12)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        row = got[doc_id]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == digest("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert row.collapsed_sha256 == digest(" ".join(w for i, w in enumerate(words) if i not in gone))
        s, length, q = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (row.start, row.length, row.period) == (s, length, q)
        assert row.exponent_milli == (1000 * length // q if runs else None)


def test_odd_rows_of_runs(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "x " * 100_000), (None, "a b " * 6), (5, "a b c " * 4), (5, "a b c " * 4),
            (6, "a b " * 6 + "a b c " * 6)]
    df = spark.createDataFrame([(*r, [1], "t") for r in rows], "doc_id long, text string, runs array<int>, id string")
    got = [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(df).collect()]
    by = {i: (n, runs, text) for i, n, runs, text in got}
    assert len(got) == len(rows)
    assert by[1] == by[2] == by[3] == (0, [], "")
    assert by[4] == (100_000, [(0, 100_000, 1)], "x")
    assert by[None] == (12, [(0, 12, 2)], "a b")
    assert [g for g in got if g[0] == 5] == [(5, 12, [(0, 12, 3)], "a b c")] * 2
    assert by[6][1] == brute_runs(("a b " * 6 + "a b c " * 6).split(), 12)
    assert periodic.periodic_runs(df.limit(0)).collect() == []


# --- resampling -------------------------------------------------------------

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text, m):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return len(w), [zlib.crc32(x.encode()) % m for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute_resample(docs, goal, m=10_000, percent=25, least=20):
    found = [(i, *brute_features(t, m)) for i, t in docs]
    s, t = Counter(b for x in found for b in x[2]), Counter(b for x in goal for b in brute_features(x, m)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + m) / ((s[b] + 1) * (all_t + m)))) for b in range(m)]
    out = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(digest(f"7:{'' if i is None else i}")[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((o for o in out if o[4] >= least), key=lambda o: (-o[3], o[0] is None, o[0]))
    for k, o in enumerate(fit):
        o[4] = k + 1 if k < percent * len(fit) // 100 else None
    for o in out:
        if o not in fit:
            o[4] = None
    return sorted(map(tuple, out), key=str)


def test_op13_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    goal = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op13_resampling"](spark, SF_SMALL).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(got, key=str) == brute_resample(docs, goal)
    assert "op13_resampling" in SQL


@pytest.mark.parametrize("words,pairs", [(0, 0), (1, 0), (3, 2), (100, 100)])
def test_head_and_tail_give_the_same_buckets(words, pairs):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcé7") for _ in range(r.randint(1, 6))).encode() for _ in range(50)]
    known = vocabulary[:words]
    head = resampling.Head(known, [(r.choice(vocabulary), r.choice(vocabulary)) for _ in range(pairs)], 997)
    for n in (0, 1, 2, 200):
        w = r.choices(vocabulary, k=n)
        want = [zlib.crc32(x) % 997 for x in w + [a + b" " + b for a, b in zip(w, w[1:])]]
        assert head.features(w).tolist() == want


def test_odd_rows_of_resampling(spark):
    long = "Alpha beta 7 gamma " * 6
    rows = [(1, None), (2, ""), (3, "!!! ..."), (4, "word " * 300_000), (None, long), (5, long), (5, long), (5, long), (6, "short"),
            *[(i, long + f"é{i % 7}") for i in range(10, 60)]]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, rank int, id string")
    goal = spark.createDataFrame([(1, "gamma delta"), (2, None)], "item_id long, text string")
    names = ["id", "n_features", "weight", "score", "rank"]
    run = lambda d, g: [tuple(r) for r in resampling.resample(d, g).select(*names).collect()]
    got = run(df, goal)
    same = lambda found: sorted(((*r[:4], r[4] is None) for r in found), key=str)
    want = brute_resample(rows, ["gamma delta", None])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, len([r for r in want if r[4]]) + 1))
    assert same(got) == same(want)
    assert run(df.limit(0), goal) == []
    assert same(run(df, goal.limit(0))) == same(brute_resample(rows, []))
    with pytest.raises(ValueError):
        resampling.resample(df, goal, buckets=70_000)
