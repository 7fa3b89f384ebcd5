"""Mixing and page text against brute force; the pipeline's stages."""

import hashlib
import math

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing, pages
from strata.llm.queries import QUERIES


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight, cut at the cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * w[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def seats(votes, n, limits):
    """Highest quotients, one seat at a time."""
    got = dict.fromkeys(votes, 0)
    for _ in range(n):
        free = [p for p in votes if votes[p] > 0 and got[p] < limits[p]]
        if not free:
            break
        got[min(free, key=lambda p: (-votes[p] / (2 * got[p] + 1), p))] += 1
    return got


def test_seats_equal_highest_quotients(spark):
    groups = {1: {"a": 53.0, "b": 24.0, "c": 23.0}, 2: {"a": 1000.0, **{f"p{i:02}": 4.9 for i in range(30)}},
              3: {"a": 5.0, "b": 5.0, "c": 0.0}, 4: {"a": 10.0, "b": 90.0}}
    total = {1: 7, 2: 100, 3: 3, 4: 60}
    limit = {(g, p): 54 if (g, p) == (4, "b") else 10 ** 6 for g, v in groups.items() for p in v}
    rows = [(g, p, v, total[g], limit[g, p]) for g, x in groups.items() for p, v in x.items()]
    df = spark.createDataFrame(rows, "g int, party string, votes double, n long, most long")
    for g in groups:                                   # parties are unique across groups in use
        part = mixing._seats(df.where(f"g = {g}"), ["g"], "votes", F.col("n"), F.col("most"))
        got = {r.party: r.seats for r in part.collect()}
        assert got == seats(groups[g], total[g], {p: limit[g, p] for p in groups[g]}), g


@pytest.mark.parametrize("shard_words", [1 << 18, 2000])
def test_mix_of_documents(spark, shard_words):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.id, r.source, r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(docs, shard_words=shard_words).collect()]
    text = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in docs.collect()}
    assert {r[0]: r[1:3] for r in rows} == text
    sizes = {}
    for s, n in text.values():
        sizes[s] = sizes.get(s, 0) + n
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r[1] == s]
        assert all(r[3] == sizes[s] and r[4] == pytest.approx(want[s], rel=1e-12) for r in own)
        shards = math.ceil(sizes[s] / shard_words)
        assert abs(sum(r[5] for r in own) - want[s]) <= 16 * (2 + shards)
    assert all(0 <= r[5] <= 2 * r[2] for r in rows)
    again = {r.id: r.taken for r in mixing.mix(docs.repartition(5), shard_words=shard_words).collect()}
    assert again == {r[0]: r[5] for r in rows}


MIX_ROWS = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "w " * 4000, None), (None, "q r", "y"), (5, "s t u v", "z"),
            (5, "s t u v", "z"), (6, "k" * 3, "empty")]


def test_mix_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in MIX_ROWS], "doc_id long, text string, source string, size int, n_chars int")
    got = mixing.mix(df).collect()
    assert len(got) == len(MIX_ROWS) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    sizes = {}
    for _, t, s in MIX_ROWS:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] for r in got)
    assert mixing.mix(df.limit(0)).count() == 0
    mixed = mixing.apply_mix(df)
    assert mixed.columns == df.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {}
    for r in got:
        if r.taken:
            taken[r.id] = taken.get(r.id, 0) + r.taken
    assert words == taken
    empty = spark.createDataFrame([(1, None, "x"), (2, "  ", "y")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0.0, 0), (0.0, 0)]


def test_equal_rows_of_two_sources(spark):
    rows = [(1, "a b c d e f g h", "x", 15), (1, "a b c d e f g h", "y", 15), (2, "i j k l", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mixed = mixing.apply_mix(df, weights=(1,), share=1.5, max_repeat=2).collect()
    words = {}
    for r in mixed:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    taken = {r.source: r.taken for r in mixing.mix(df, weights=(1,), share=1.5, max_repeat=2).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    assert words == taken and set(words) == {"x", "y"}
    assert max(sum(r.doc_id == 1 and r.source == s for r in mixed) for s in "xy") <= 2


def test_many_shards_of_one_source(spark):
    """A source of 1e5 shards: its quota goes to groups of them, then to each; no task ranks them all."""
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h").alias("text"),
                                       F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("source"))
    got = mixing.mix(docs, weights=(1, 4), share=0.9, shard_words=8, group_shards=500, block_words=1)
    r = {x.source: x for x in got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target"), F.max("taken").alias("most"),
                                                        F.count(F.lit(1)).alias("n")).collect()}
    assert r["hot"].n == 90_000 and r["small"].n == 10_000
    for x in r.values():
        assert abs(x.t - x.target) <= 0.002 * x.target and x.most <= 16


ARTICLE = ("<!DOCTYPE html><html><head><title>t</title><script>var x='</p>';</script></head><body><nav><ul><li>Home</ul></nav>"
           "<div class='cookie-notice'>We use cookies</div><article><header class='entry-header'><h1>T &lt; 1</h1><span>by me</span></header>"
           "<p>a<b>b</b>  c<br>d&nbsp;e<p>two &amp three<div class=share>s</div><section id=comments><p>nice</section><ul><li>x<li>y</ul>"
           "<table><tr><td>1<td>2</table><form>f</form></article><footer>&copy;</footer></body>")


def test_blocks_of_a_page():
    assert pages.Page(ARTICLE).texts == ["T < 1", "ab c d e", "two & three", "x", "y", "1", "2"]
    assert pages.Page("").texts == [] and pages.Page("plain <b>text").texts == ["plain text"]
    assert pages.Page("a < b <p>c</i></div>d<!-- x -->e <foot").texts == ["a < b", "c", "de"]
    assert pages.Page("<div>" * 3000 + "deep").texts == ["deep"]
    assert pages.Page("<p title='a>b'>x</p><p class=\"broken>y</p>").texts[0] == "x"


def test_template_is_counted_per_host(spark):
    rows = []
    for host in ("a.example", "b.example"):
        for i in range(8):
            same = "<div class='x'><p>All about us</p></div>" if host == "a.example" or i == 0 else ""
            rows.append((len(rows), f"http://{host}/{i}", f"<body>{same}<div><p>Text {host} {i}</p><p>Read on</p></div></body>"))
    article = "<body><article><div><p>copied</p></div></article></body>"
    rows += [(300 + i, f"http://e.example/{i}", f"<body><article><p>On {WORDS[i]}</p><div><p>Sign up</p><p>for letters</p></div><div><p>See also</p></div><p>end</p></article></body>") for i in range(6)]
    rows += [(100 + i, "http://c.example/x", article) for i in range(8)]          # equal pages count once
    rows += [(200, None, "<p>no host</p>"), (201, "http://a.example/z", None), (None, "nonsense", "<p>q</p>"), (0, "http://d.example", "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, row string, rid int")
    got = pages.main_text(df).collect()
    assert len(got) == len(rows)
    text = {(r.id, r.url): r.text for r in got}
    # a recurring container is template, in articles one of several blocks; a line is not, nor what one page of a host has
    assert text[(0, "http://a.example/0")] == "Text a.example 0\nRead on"
    assert text[(8, "http://b.example/0")] == "All about us\nText b.example 0\nRead on"
    assert text[(100, "http://c.example/x")] == "copied"
    assert text[(303, "http://e.example/3")] == "On delta\nSee also\nend"
    assert text[(200, None)] == "no host" and text[(201, "http://a.example/z")] == "" and text[(None, "nonsense")] == "q"
    assert pages.main_text(df.limit(0)).count() == 0


WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty kelp larch mango noble ocean pearl".split()


def _texts(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.id: r.text for r in pages.main_text(df, **options).collect()}


def test_articles_keep_their_recurring_lines(spark):
    article = lambda w: (f"<h1>{w}</h1><p>All that is known of {w} and more</p><h2>History</h2><p>{w} is old</p><div class='heading'><h2>Climate</h2></div>"  # noqa: E731
                         f"<table><tr><th>Kind<td>{w}<tr><th>Size<td>large</table><ul><li>Trees<li>{w}</ul><div>See also the list of towns.</div>"
                         "<p>Licensed under the same terms</p>")
    lines = lambda w: "\n".join([w, f"All that is known of {w} and more", "History", f"{w} is old", "Climate", "Kind", w, "Size", "large",
                                 "Trees", w, "See also the list of towns.", "Licensed under the same terms"])
    rows = [(i, f"http://f.example/{i}", f"<html><body><article>{article(w)}</article></body></html>") for i, w in enumerate(WORDS)]
    # a copied article under other dates, and one under other titles, recur with the same text around
    rows += [(100 + i, f"http://g.example/{i}", f"<main><p>{i + 10} May</p><div><p>A story told again in full</p><p>Its end</p></div></main>") for i in range(12)]
    got = _texts(spark, rows)
    assert got == {i: lines(w) for i, w in enumerate(WORDS)} | {100 + i: f"{i + 10} May\nA story told again in full\nIts end" for i in range(12)}


def test_counts_alone_remove_the_template(spark):
    page = lambda w, i: ("<body><nav><ul><li>Home<li>News</ul></nav>Skip to content<div id=x1><p>Buy two, get three</p></div>"  # noqa: E731
                         f"<article><h1>{w}</h1><p>All that is known of {w}, at length</p><p>Licensed under the same terms</p></article>"
                         f"<section><h3>Read on</h3><ul><li>One<li>Two</ul></section><footer>&copy; us</footer><div>Page {i}</div></body>")
    rows = [(i, f"http://k.example/{i}", page(w, i)) for i, w in enumerate(WORDS)] + [(50, "http://l.example", page("lone", 7))]
    got = _texts(spark, rows, declared=False)
    lines = lambda w, *more: "\n".join([w, f"All that is known of {w}, at length", "Licensed under the same terms", *more])
    assert {i: t for i, t in got.items() if i < 50} == {i: lines(w, f"Page {i}") for i, w in enumerate(WORDS)}
    assert got[50].startswith("Home\nNews\nSkip to content\nBuy two, get three\nlone\n")
    assert _texts(spark, rows) == {i: lines(w) for i, w in [*enumerate(WORDS), (50, "lone")]}


def test_articles_of_the_given_pages_are_whole(spark):
    """Each given page has one article of a heading and paragraphs: its lines, all of them, are the result."""
    import html as h
    import re
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in QUERIES["op8_main_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(h.unescape(re.sub("<[^>]*>", " " if x == "<br>" else "", x)).split()) for x in re.split("</?p>|</?h1>", re.sub("<br>", " ", inside))]
        assert got[r.page_id] == "\n".join(x for x in lines if x)


def test_template_of_a_section_of_a_large_host(spark):
    pair = lambda i: f"{WORDS[i % 16]} {WORDS[i // 16]}"
    rows = [(i, f"http://h.example/{i}", f"<body><div>{'<div><p>Notice to all</p></div>' if i < 6 else ''}<p>A page about {pair(i)} here</p></div></body>")
            for i in range(120)]
    text = {r.id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert text == {i: f"A page about {pair(i)} here" for i in range(120)}


def test_names_and_containers_never_empty_a_page():
    long = "The whole of the article in many words, "* 3
    for start in ("<body class='has-sidebar'><article>", "<body class=no-comments><main class='header-fixed'>",
                  "<html class=header-on><body id=page><article class='post type-post comments-open'>", "<body><div class='with-sidebar'>",
                  "<body><div class='page-header-fixed'><div id=ad-free>", "<body><article><div class='has-header'>"):
        assert pages.Page(f"<body>{start}<p>{long}<span class=comment>x</span><div class=sidebar>s</div>").texts == [long.strip()], start
    assert pages.Page(f"<article></article><p>{long}").texts == [long.strip()]
    assert pages.Page(f"<article><p>Read more</article><p>{long}").texts == ["Read more", long.strip()]
    assert pages.Page(f"<article><p>{long}</article><p>Read more").texts == [long.strip()]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scan", "mix_sources", "bpe_encode"]
    from strata.llm import bpe, repetition, secrets, simhash
    kept = {r.id for r in repetition.rules(docs).where("kept").collect()}
    now, before = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, SF_SMALL)
        now = now.cache()
        if name != "bpe_encode":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
        if name == "quality_rules":
            assert {r.doc_id for r in now.collect()} == kept and now.count() == len(kept)
        elif name == "simhash_near_dedup":
            groups = {r.id: r.component_id for r in simhash.near_duplicates(before).collect()}
            assert sorted(r.doc_id for r in now.collect()) == sorted(set(groups.values()))
        elif name == "secret_scan":
            assert now.count() == before.count()
            assert secrets.scan(now).where(F.size("base") > 0).count() == 0
        elif name == "mix_sources":
            size = {r.id: r.taken for r in mixing.mix(before).collect()}
            words = {}
            for r in now.collect():
                words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
                assert r.n_chars == len(r.text)
            assert words == {i: n for i, n in size.items() if n}
        else:
            text = sorted((r.doc_id, r.text) for r in before.collect())
            e = bpe.Encoder(bpe.read_ranks(bpe.VOCABULARY))
            assert sorted((r.doc_id, r.ids) for r in now.collect()) == sorted((i, e.encode(t).tolist()) for i, t in text)
            digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
            assert sorted((r.doc_id, r.decoded_sha256) for r in now.collect()) == sorted((i, digest(t)) for i, t in text)
    assert corpus_pipeline.run(spark, SF_SMALL).count() == now.count()
