"""The numbered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ann import search
    return search(_table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0, k=20)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.simhash import near_duplicates
    found = near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _remainder(id_col: str, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.quality import classify
    held = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    found = classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), learn=~held).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.bpe import encode
    found = encode(_table(spark, sf_dir, "documents"), round_trip=True)
    return found.select(F.col("id").alias("doc_id"), "n_tokens",
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.langid import identify
    held = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    found = identify(_table(spark, sf_dir, "documents"), learn=~held).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import mix
    found = mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_repeat=2)
    return found.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pages import main_text
    found = main_text(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.repetition import rules
    found = rules(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _digests(found: DataFrame) -> DataFrame:
    """Base findings and all findings as text, kind:start:end joined by commas."""
    text = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    return found.withColumns({"base_sha256": F.sha2(text("base"), 256), "all_spans": text("spans")})


def _count(kind: str):
    """How many base findings are of a kind."""
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pii import find
    found = _digests(find(_table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), *map(_count, ("email", "ip", "card", "phone")), "base_sha256", F.col("all_spans").alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secrets import scan
    found = _digests(scan(_table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), *map(_count, ("assign", "access", "hex")), "base_sha256", F.col("all_spans").alias("spans"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import classify
    held = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    found = classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), learn=~held).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """The contract's rewriting: in the documents whose id's CRC-32 h ends in 0, the words from a on repeat
    the p words at a. Other texts, and rows without id, stay as they are."""
    pattern = F.lit("[^\\x20\\x09-\\x0D]+")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = docs.where(h % 10 == 0).withColumn("words", F.regexp_extract_all("text", pattern, F.lit(0)))
    n, g = F.size("words").cast("long"), F.floor(h / 10)
    a = F.expr("g % n")
    hit = hit.withColumns({"n": n, "g": g}).withColumn("a", F.when(F.col("n") > 0, a))
    hit = hit.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    again = F.expr("transform(sequence(a, n - 1), i -> words[int(a + (i - a) % p)])")
    new = F.array_join(F.concat(F.expr("slice(words, 1, int(a))"), again), " ")
    return docs.where(F.coalesce(h % 10 != 0, F.lit(True))).select("doc_id", "text").unionByName(
        hit.select("doc_id", F.when(F.col("n") > 0, new).otherwise(F.col("text")).alias("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.periodic import periodic_runs
    found = periodic_runs(_with_planted_period(_table(spark, sf_dir, "documents")), min_length=12)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                        length.alias("length"), period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.resampling import resample
    found = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=25, min_words=20)
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_bpe": op4_bpe,
    "op5_pii": op5_pii,
    "op6_language": op6_language,
    "op7_mixing": op7_mixing,
    "op8_main_text": op8_main_text,
    "op9_quality_rules": op9_quality_rules,
    "op10_secrets": op10_secrets,
    "op11_toxicity": op11_toxicity,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_resampling": op13_resampling,
}

def _covered(k: int) -> str:
    """SQL for (rid, n): words in windows of ``k`` words that occur twice or
    more. The union of all repeated substrings of ``k`` words or more is that
    of their windows of ``k``, so this also measures the suffix array's spans."""
    return f"""SELECT rid, COUNT(DISTINCT p) AS n FROM (
      SELECT rid, UNNEST(range(i, i + {k})) AS p FROM (
        SELECT rid, i, COUNT(*) OVER (PARTITION BY rid, g) AS c FROM (
          SELECT rid, i, array_to_string(words[i:i + {k - 1}], ' ') AS g
          FROM (SELECT rid, words, UNNEST(range(1, len(words) - {k - 2})) AS i FROM t) a) b) d
      WHERE c > 1) e GROUP BY rid"""


#: SQL for a table ``steps`` (l): the CRC-32 of each byte.
_STEPS = """steps AS (  -- CRC-32 of one byte
  SELECT list(v ORDER BY i) AS l FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i) a) b)"""


def _crc(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of ``text``, next to the table ``steps``."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))),
         lambda c, b: xor(c >> 8, l[1 + (xor(c, b) & 255)])), 4294967295)"""


SQL: dict[str, str] = {
    "op9_quality_rules": rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
three AS ({_covered(3)}),
eight AS ({_covered(8)}),
long AS (  -- a repeat of over 200 words: a window of 201 that occurs twice
  SELECT DISTINCT rid FROM (
    SELECT rid, array_to_string(words[i:i + 200], ' ') AS g
    FROM (SELECT t.rid, words, UNNEST(range(1, len(words) - 199)) AS i FROM t JOIN eight ON t.rid = eight.rid) a) b
  GROUP BY rid, g HAVING COUNT(*) > 1),
facts AS (
  SELECT t.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(three.n, 0) AS BIGINT) AS n_repeat_words, coalesce(eight.n, 0) AS spans, long.rid IS NOT NULL AS long
  FROM t LEFT JOIN three ON t.rid = three.rid LEFT JOIN eight ON t.rid = eight.rid LEFT JOIN long ON t.rid = long.rid),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND 10 * spans <= 3 * n_words AND NOT long AS kept
FROM judged""",
    "op12_periodic_runs": rf"""
WITH {_STEPS},
docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                CASE WHEN doc_id IS NOT NULL THEN {_crc("CAST(doc_id AS VARCHAR)")} END AS h FROM documents, steps),
planned AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM docs),
texts AS (  -- the contract's rewriting
  SELECT rid, doc_id, CASE WHEN a IS NULL THEN w ELSE
    list_concat(w[1:a], list_transform(range(a, n), lambda i: w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1])) END AS w FROM planned),
sixes AS (SELECT rid, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT rid, w, unnest(range(0, len(w) - 5)) AS i FROM texts) a),
equal AS (  -- six words that come again d words on: a run of 12 words or two periods has them at every start but its last
  SELECT x.rid, x.i, y.i - x.i AS d FROM sixes x JOIN sixes y ON x.rid = y.rid AND x.s = y.s AND x.i < y.i),
stretches AS (
  SELECT rid, d, min(i) AS start, count(*) + 5 + d AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, d ORDER BY i) AS k FROM equal) b GROUP BY rid, d, k),
runs AS (  -- a stretch with several periods has them all at full length
  SELECT rid, start, length, min(d) AS period FROM stretches WHERE length >= greatest(12, 2 * d) GROUP BY rid, start, length),
told AS (
  SELECT rid, count(*) AS n_runs, first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS best,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY i) AS words
  FROM (SELECT rid, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM texts WHERE rid IN (SELECT rid FROM told)) c ANTI JOIN gone USING (rid, i)
  GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.words, array_to_string(w, ' '))) AS collapsed_sha256
FROM texts LEFT JOIN told ON texts.rid = told.rid LEFT JOIN kept ON texts.rid = kept.rid""",
    "op13_resampling": rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
{_STEPS},
words AS (SELECT rid, 0 AS kind, unnest(w) AS f FROM docs UNION ALL
  SELECT rid, 0, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM docs UNION ALL
  SELECT 0, 1, unnest(w) FROM goal UNION ALL
  SELECT 0, 1, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM goal),
counted AS (SELECT f, rid, kind, count(*) AS n FROM words GROUP BY ALL),
texts AS (SELECT DISTINCT f FROM counted),
hashed AS (
  SELECT f, {_crc("f")} % 10000 AS b
  FROM texts, steps),
bucketed AS (SELECT rid, kind, b, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
sums AS (SELECT coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM bucketed),
gain AS (
  SELECT b, CAST(floor(1000 * ln((x.t + 1)::DOUBLE * (sums.s + 10000)::DOUBLE / ((x.s + 1)::DOUBLE * (sums.t + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM (SELECT b, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM bucketed GROUP BY b) x, sums),
weighed AS (SELECT rid, CAST(floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE) AS BIGINT) AS weight FROM bucketed JOIN gain USING (b) WHERE kind = 0 GROUP BY rid),
scored AS (
  SELECT docs.rid, doc_id, len(w) AS n_words, CAST(greatest(2 * len(w) - 1, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed ON docs.rid = weighed.rid),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id ASC NULLS LAST, rid) AS r, sum(CAST(n_words >= 20 AS BIGINT)) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= (25 * n) // 100 THEN r END AS rank FROM placed""",
}
