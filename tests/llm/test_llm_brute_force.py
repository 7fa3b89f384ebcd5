"""Queries without SQL held against plain versions, and odd inputs of several operators."""

import math
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from strata.llm import langid, pages, quality
from strata.llm.common import labelled_sample
from strata.llm.queries import QUERIES


def plain_statistics(text):
    """The document statistics, a character and a word at a time."""
    data = text.encode()
    n = max(1, len(data))
    share = lambda ok: sum(1 for b in data if ok(b)) / n
    among = lambda chars: share(lambda b: chr(b) in chars if b < 128 else False)
    words = data.split()
    k = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x.split()]
    seen = Counter(words)
    windows = {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
    return [math.log(1 + len(words)), sum(map(len, words)) / k, max(map(len, words), default=0), sum(len(w) <= 3 for w in words) / k,
            len(seen) / k, max(seen.values(), default=0) / k, len(windows) / max(1, len(words) - 2),
            math.log(1 + len(lines)), len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
            sum(data.count(c) for c in (b".", b"!", b"?")) / k,
            among("#*$%&|<>"), among("!"), among("|"), share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), among(" \t\n\v\f\r"),
            share(lambda b: b >= 128), among(","), among("'\""), among("()[]{}"), sum(w.isupper() for w in words) / k]


def test_op3_equals_a_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    x = {i: np.array(plain_statistics(t or ""), np.float32).astype(float) for i, t in docs}
    known = sorted(i for i, y in labels.items() if i in x and y is not None and zlib.crc32(str(i).encode()) % 3 != 1)
    forest = quality.Forest().fit(np.stack([x[i] for i in known]), np.array([float(labels[i]) for i in known]))
    for r in QUERIES["op3_quality"](spark, SF_SMALL).collect():
        z = forest.start
        for t in range(forest.trees):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + (1 if x[r.doc_id][forest.feature[t, node]] <= forest.threshold[t, node] else 2)
            z += forest.value[t, node - (2 ** forest.depth - 1)]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9) and r.predicted == (r.score >= 0.5)


def plain_counts(text):
    b = f" {text.lower()} ".encode()
    out = np.zeros(langid.DIMS)
    half, m = langid.DIMS // 2, 1 << 32
    for i in range(len(b) - 1):
        two = (b[i] * 2531 + b[i + 1] * 40503) % m
        out[(two >> 3) % half] += 1
        if i + 2 < len(b):
            out[half + ((two * 31 + b[i + 2] * 2654435761) % m >> 20)] += 1
    return out / max(1, len(b) - 1)


def test_op6_equals_a_plain_version():
    texts = ["the cat and the dog", "der hund und die katze", "le chat et le chien", "el perro y el gato", "Größe, été!", "x"]
    for t in texts:
        assert langid.counts(t) == pytest.approx(plain_counts(t), abs=1e-6)
    langs = ["en", "de", "fr", "es", "de", "en"]
    model = langid.Hierarchy(np.stack([langid.counts(t) for t in texts] * 3), langs * 3)
    asked = [*texts, "the dog and der hund", "el gato et le chat", "zzz qqq"]
    found, score = model.predict(np.stack([langid.counts(t) for t in asked]))
    for t, lang, sure in zip(asked, found, score):
        x = langid.counts(t).astype(float) * model.SCALE
        margin = [float(x @ w[:-1].astype(float) + float(w[-1])) for w in model.weights]
        chance = lambda m: 1 / (1 + math.exp(-2 * m))
        k = max(range(len(model.families)), key=lambda f: margin[f])
        votes, weight = Counter(), Counter()
        want = chance(margin[k])
        duels = [(a, b, margin[len(model.families) + j]) for j, (f, a, b) in enumerate(model.pairs) if f == k]
        for a, b, m in duels:
            won, lost = (a, b) if m > 0 else (b, a)
            votes[won] += 1
            weight[won] += abs(m)
            weight[lost] -= abs(m)
        best = max(model.members[k], key=lambda v: (votes[v], weight[v]))
        for a, b, m in duels:
            if best in (a, b):
                want *= chance(m) if best == a else 1 - chance(m)
        assert lang == best and sure == pytest.approx(want, abs=1e-4)


def test_repeated_rows_of_language_and_pages(spark):
    rows = [(1, "the cat and the dog", "en")] * 3 + [(2, "der hund und die katze", "de")] * 2
    got = Counter((r.id, r.lang_pred) for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True)).collect())
    assert got == {(1, "en"): 3, (2, "de"): 2}
    long = "word " * 100_000
    html = [(7, "http://a.example/1", "<article><p>same</article>")] * 6 + [(8, "http://a.example/2", f"<body><div><p>{long}</p></div><nav>menu</nav>"), (7, None, "x")]
    out = Counter((r.id, r.text) for r in pages.main_text(spark.createDataFrame(html, "page_id long, url string, html string")).collect())
    assert out == {(7, "same"): 6, (8, long.strip()): 1, (7, "x"): 1}


def test_a_sample_is_bounded_by_its_ids(spark):
    docs = spark.createDataFrame([(1, "a")] * 500 + [(2, "b"), (2, "bb"), (3, None), (None, "c")], "id long, text string")
    known = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, 0.0), (3, 1.0), (None, 1.0), (4, 1.0), (2, None)], "id long, y double")
    got = {(r.id, r.y): r.text for r in labelled_sample(known, docs, 100, 1).collect()}
    assert set(got) == {(1, 1), (2, 0), (3, 1)} and got[(1, 1)] == "a" and got[(3, 1)] == "" and got[(2, 0)] in ("b", "bb")


def _stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_SMALL).cache()
        if name != "bpe_encode":
            assert docs.columns == before.columns
        yield name, docs.collect()


def test_pipeline_on_odd_tables(spark):
    good = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("n_chars > 600").limit(12)
    odd = good.select(F.lit(None).cast("long").alias("doc_id"), F.reverse("text").alias("text"), "lang", F.lit(None).cast("string").alias("source"), "n_chars")
    none = good.limit(2).withColumn("text", F.lit(None).cast("string"))
    docs = good.union(good).union(odd).union(none)
    docs = docs.withColumn("row", F.lit("r")).withColumn("id", F.lit(1.5)).withColumn("fp", F.lit(2)).withColumn("size", F.lit("s")).withColumn("base", F.lit("b"))
    last = {}
    for name, rows in _stages(spark, docs):
        assert rows or name == "none"
        last[name] = rows
    kept = {r.doc_id for r in last["simhash_near_dedup"] if r.doc_id is not None}
    assert len([r for r in last["simhash_near_dedup"] if r.doc_id is not None]) == len(kept)      # copies went
    assert any(r.doc_id is None for r in last["simhash_near_dedup"]) and all(r.text for r in last["quality_rules"])
    assert all(r.row == "r" and r.id == 1.5 and r.fp == 2 and r.size == "s" for r in last["mix_sources"])
    for name, rows in _stages(spark, docs.limit(0)):
        assert rows == [], name
