"""Nearest neighbours, quality and language: recall and held-out accuracy."""

import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from strata.llm import ann, langid, quality
from strata.llm.queries import QUERIES


def brute(ids, vecs, queries, k):
    out = {}
    for i in queries:
        s = (vecs * vecs[list(ids).index(i)]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_every_list_read_is_exact(spark):
    r = np.random.default_rng(0)
    v = r.normal(size=(300, 12)) * r.uniform(0.1, 3, size=(300, 1))
    v[50:120] = v[50]                                  # a crowd of equal vectors
    ids = r.permutation(1000)[:300]
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 3 == 0, k=5, lists=6, probes=1.0, segment_rows=40, chunk_queries=9, epsilon=6.0, block=4)
    found = {}
    for r_ in got.orderBy("query_id", "rank").collect():
        found.setdefault(r_.query_id, []).append((r_.vec_id, r_.score))
        assert r_.rank == len(found[r_.query_id])
    want = brute(ids, v, [i for i in ids if i % 3 == 0], 5)
    assert {q: [i for i, _ in x] for q, x in found.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(a[1] == pytest.approx(b[1], abs=1e-12) for q in want for a, b in zip(found[q], want[q]))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (None, [1.0, 1.0]),
            (3, [0.5, 0.5]), (4, [float("inf"), 1.0]), (5, [1.0, 2.0, 3.0]), (6, [0.5, 0.5]), (0, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, list int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()]
    assert {x[0] for x in got} == {0} and {x[2] for x in got} == {3, 6}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_queries_have_results_of_their_own(spark):
    r = np.random.default_rng(2)
    v = r.normal(size=(200, 8))
    rows = [(0, v[0].tolist())] * 10 + [(i, v[i].tolist()) for i in range(1, 200)] + [(20, v[150].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=20, lists=5, probes=1.0, epsilon=6.0).toPandas()
    one = got[got.query_id == 0]
    assert len(one) == 200 and one.groupby(["rank", "vec_id"]).size().tolist() == [10] * 20
    assert len(got[got.query_id == 20]) == 40               # two vectors under one id: both are searched
    assert len(got) == 200 + 40 + 8 * 20


def test_recall_where_most_lists_are_skipped(spark):
    """20,000 clustered vectors, a tenth of the lists read at most."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(80, 24)) * 2
    v = (centres[r.integers(0, 80, 20_000)] + r.normal(size=(20_000, 24)) * 0.35).astype(np.float32)
    ids = np.arange(20_000)
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<float>").repartition(4)
    got = ann.search(df, F.col("vec_id") % 200 == 0, k=20, lists=100, probes=0.1).toPandas()
    scores = v[::200].astype(float) @ v.T.astype(float)
    scores[np.arange(100), ids[::200]] = -np.inf
    want = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    hit = sum(len(set(want[i]) & set(got[got.query_id == 200 * i].vec_id)) for i in range(100))
    assert hit >= 0.9 * 2000 and len(got) == 2000


def test_recall_on_all_given_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op1_nearest"](spark, sf).toPandas()
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, v = t.vec_id.to_numpy(), np.stack(t.embedding).astype(float)
    want = brute(ids, v, [i for i in ids if i % 20 == 0], 20)
    hit = sum(len({i for i, _ in x} & set(got[got.query_id == q].vec_id)) for q, x in want.items())
    assert hit >= 0.9 * 20 * len(want) and len(got) == 20 * len(want)


def test_recall_on_embeddings(spark):
    got = QUERIES["op1_nearest"](spark, SF_SMALL).toPandas()
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, v, [i for i in ids if i % 20 == 0], 20)
    hit = sum(len({i for i, _ in x} & set(got[got.query_id == q].vec_id)) for q, x in want.items())
    assert hit >= 0.9 * 20 * len(want) and len(got) == 20 * len(want)


def test_quality_held_out(spark):
    got = QUERIES["op3_quality"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id")
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in got.held_out.items())
    both = got[got.held_out].join(labels, how="inner")
    assert (both.predicted == both.quality).mean() > 0.95
    assert ((got.score >= 0) & (got.score <= 1)).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b", 1), (3, "w " * 50000, 1), (3, "w", 1)], "doc_id long, text string, stats int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs, none, F.lit(True)).collect()} == {0.5}
    some = spark.createDataFrame([(1, 0), (2, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    got = quality.classify(docs, some, F.lit(True))
    assert got.count() == 5 and got.where("score is null").count() == 0
    assert quality.classify(docs.limit(0), some, F.lit(True)).count() == 0


def test_flattened_trees_equal_a_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    f = quality.Forest(trees=20, depth=3).fit(x, y)
    for row, s in zip(x[:50], f.score(x[:50])):
        z = f.start
        for t in range(f.trees):
            node = 0
            for _ in range(f.depth):
                node = 2 * node + (1 if row[f.feature[t, node]] <= f.threshold[t, node] else 2)
            z += f.value[t, node - (2 ** f.depth - 1)]
        assert s == pytest.approx(1 / (1 + np.exp(-z)))
    assert ((f.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_language_held_out(spark):
    got = QUERIES["op6_language"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got.held_out.items())
    both = got[got.held_out].join(docs)
    assert (both.lang_pred == both.lang).mean() > 0.97
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, None, "en"), (3, "12 ²! ", "de"), (4, "der hund und die katze", "de"), (None, "le chien", "fr"),
            (5, "le chat et le chien", "fr"), (6, "abc", None), (7, "x " * 50000, "en"), (8, "el perro y el gato", "es")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = langid.identify(df, F.lit(True)).collect()
    by = {r.id: r.lang_pred for r in got}
    assert len(got) == len(rows) and by[2] == by[3] == "und" and set(by.values()) <= {"und", "en", "de", "fr", "es"}
    assert {r.lang_pred for r in langid.identify(df, F.lit(False)).collect()} == {"und"}
    one = langid.identify(df, F.col("lang") == "en").collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    assert langid.identify(df.limit(0), F.lit(True)).count() == 0
