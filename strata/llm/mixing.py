"""Mixing sources to target weights: Sainte-Laguë apportionment of blocks.

Everything here is DataFrame operations. Texts are read once, to count their
words; from then on only (id, source, size) rows move.

1. *Targets.* A source's target is ``min(cap, level * weight)`` for the one
   level at which the targets add up to the wanted total: what a source cannot
   take is shared again among the others by weight, until none is above its
   cap. Sorted by cap / weight that level is read off running sums.
2. *Quotas per source.* Sources at their cap get every block ``max_repeat``
   times. The other blocks go, one by one, to the source with the highest
   quotient ``target / (2 j + 1)``, ``j`` being the blocks it has so far. Every
   source's number of seats lies between its rounded share of ``n - s / 2`` and
   of ``n + s / 2`` seats (``s`` sources), so only the quotients in between are
   made and ranked: about two per source, however many blocks there are.
3. *Quotas per shard.* A source is dealt, by a seeded hash of the id, over
   shards of about ``shard_words`` words, and its quota by the same rule over
   groups of ``group_shards`` shards, then each group's over its shards. A
   hot source has many shards, and no task ranks more than a group of them.
4. *Selection.* A shard's documents stand in seeded order; their words, end to
   end, are its blocks. ``quota`` blocks are taken from the front, wrapping
   round: whole documents, but for one at the end that is cut at a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD_PATTERN, row_key, written


def _seats(df: DataFrame, by: list[str], votes: str, total: Column, limit: Column) -> DataFrame:
    """``df`` (one row per party, ``votes`` > 0 or the party gets nothing)
    with a column ``seats``: ``total`` seats of each group ``by``, dealt out
    by highest quotients, no party above ``limit`` (which is not below its
    share rounded down). Ties go to the party with the smaller ``party``."""
    group = Window.partitionBy(*by)
    share = F.col(votes) / F.sum(votes).over(group)
    n = F.count(F.lit(1)).over(group)
    df = df.withColumns({"_n": total.cast("long"), "_max": limit.cast("long"), "_share": F.coalesce(share, F.lit(0.0)), "_s": n})
    low = F.greatest(F.lit(0), F.floor(F.col("_share") * (F.col("_n") - F.col("_s") / 2) + 0.5) - 1).cast("long")
    high = (F.ceil(F.col("_share") * (F.col("_n") + 2 * F.col("_s")) + 0.5) + 1).cast("long")
    df = df.withColumns({"_low": F.least(low, "_max"), "_high": F.when(F.col("_share") > 0, F.least(high, "_max")).otherwise(F.lit(0).cast("long"))})
    df = df.withColumn("_left", F.col("_n") - F.sum("_low").over(group))
    quotients = df.where("_high > _low").select(
        *by, "party", "_left", F.col(votes).alias("_v"), F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_j"))
    ranked = quotients.withColumn("_r", F.row_number().over(
        Window.partitionBy(*by).orderBy(F.desc(F.col("_v") / (2 * F.col("_j") + 1)), "party", "_j")))
    more = ranked.where("_r <= _left").groupBy("party").agg(F.count(F.lit(1)).alias("_more"))
    return (df.join(more, "party", "left").withColumn("seats", F.col("_low") + F.coalesce("_more", F.lit(0)))
            .drop("_n", "_max", "_share", "_s", "_low", "_high", "_left", "_more"))


def targets(sizes: DataFrame, weights: list[float], share: float, max_repeat: int) -> DataFrame:
    """(source, source_size, weight, target, full) of every source in
    ``sizes`` (source, size): sources in code point order, null last, weigh
    ``weights`` over and over and share ``share`` times all words; a target
    stops at ``max_repeat`` times its source's words (``full``), the excess
    being shared again by weight until none is above."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", w).withColumn("cap", F.lit(max_repeat) * F.col("source_size"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    src = src.withColumns({
        "_capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "_weights": F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
        "_total": F.sum("source_size").over(every) * float(share)})
    src = src.withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_weights"))
    src = src.withColumn("full", F.col("_level") * F.col("weight") >= F.col("cap"))
    # the level of the first source below its cap; assuming further ones capped only lowers it
    level = F.max(F.when(~F.col("full"), F.col("_level"))).over(every)
    return src.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))).select(
        "source", "source_size", "weight", "target", "full")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, block_words: int = 4,
        shard_words: int = 1 << 18, group_shards: int = 4096, seed: int = 42) -> DataFrame:
    """(id, text_hash, source, size, source_size, target, taken) of every row of ``docs``: ``taken`` is
    how many of its words the mix takes, repeats counted (0 to ``max_repeat`` times ``size``).

    A null or empty text has no words and gives none. Null is a source like
    the others, ordered last. Rows without id and repeated rows take part like any other, in an order
    fixed by their hash, so reruns agree. An empty table gives an empty result. Other columns are
    not read."""
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    rows = written(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_hash"),
        F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size")), "sizes")
    src = written(targets(rows, list(weights), share, max_repeat).withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("int")), "targets")

    keyed = rows.withColumn("_key", F.xxhash64(F.lit(seed), "id", "text_hash"))
    keyed = keyed.join(src, keyed.source.eqNullSafe(src.source)).drop(src.source)
    keyed = keyed.withColumn("shard", F.pmod(F.xxhash64("_key", F.lit(seed + 1)), "shards").cast("int"))
    shard = keyed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                                                 F.first("full").alias("full"))
    shard = shard.withColumn("blocks", F.ceil(F.col("words") / block_words).cast("long"))
    shard = written(shard, "shards")

    # blocks of each source, then of each of its groups of shards, then of each shard
    party = shard.groupBy("source").agg(F.sum("blocks").alias("blocks"), F.first("target").alias("target"),
                                        F.first("full").alias("full")).withColumn("party", F.struct("source"))
    rest = party.where(~F.col("full"))
    every = Window.partitionBy("all")
    rest = _seats(rest.withColumn("all", F.lit(1)), ["all"], "target",
                  F.round(F.sum("target").over(every) / block_words), F.col("blocks") * max_repeat)
    quota = rest.select("source", "seats")
    shares = shard.join(quota.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    shares = shares.withColumn("group", F.floor(F.col("shard") / group_shards).cast("int"))
    part = shares.where(~F.col("full")).withColumnRenamed("seats", "_quota")
    group = part.groupBy("source", "group").agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks"), F.first("_quota").alias("_quota"))
    group = _seats(group.withColumn("party", F.struct("source", "group")), ["source"], "words", F.col("_quota"), F.col("blocks") * max_repeat)
    group = group.select(F.struct("source", "group").alias("_of"), F.col("seats").alias("_quota"))
    part = part.drop("_quota").join(group, F.struct("source", "group").eqNullSafe(F.col("_of"))).drop("_of")
    part = _seats(part.withColumn("party", F.struct("source", "shard")), ["source", "group"], "words", F.col("_quota"), F.col("blocks") * max_repeat)
    quotas = written(part.select("source", "shard", "blocks", "seats").unionByName(
        shares.where("full").select("source", "shard", "blocks", (F.col("blocks") * max_repeat).alias("seats"))), "quotas")
    quotas = quotas.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "blocks", "seats")

    # seeded order within the shard: words before this document, then what the quota covers of it
    order = Window.partitionBy("source", "shard").orderBy("_key", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("_end", F.sum("size").over(order))
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    passes = F.when(F.col("blocks") > 0, F.expr("seats div blocks")).otherwise(F.lit(0))
    front = F.when(F.col("blocks") > 0, F.col("seats") % F.col("blocks")).otherwise(F.lit(0)) * block_words
    partly = F.greatest(F.lit(0), F.least(F.col("size"), front - (F.col("_end") - F.col("size"))))
    return placed.select("id", "text_hash", "source", "size", "source_size", "target",
                         (passes * F.col("size") + partly).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              length_col: str | None = "n_chars", **settings) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it
    whole, and once more cut after its last taken word where it takes a part.
    Columns are those of ``docs``; ``length_col`` of a cut text is counted anew.

    A null or empty text is never taken; rows without id and null sources take part like any other; rows equal in id, text and
    source share what they take, all of it given by one of them; an empty table gives an empty result; columns may have any names."""
    taken = mix(docs, id_col, text_col, source_col, **settings).where("taken > 0")
    # equal rows (same id, text and source) take what they take together, spread over them
    taken = taken.groupBy(F.struct("id", F.col("text_hash").alias("t"), F.col("source").alias("s")).alias("key")).agg(
        F.sum("taken").alias("_taken"), F.max("size").alias("_size"))
    row = docs.select(F.struct("*").alias("row"))
    row = row.withColumn("key", row_key(F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"), docs.schema[id_col].dataType, F.col(f"row.`{source_col}`")))
    row = row.withColumn("_copy", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))).where("_copy = 1")
    out = row.join(taken, "key")
    whole = F.expr("_taken div _size").cast("int")
    last = (F.col("_taken") % F.col("_size")).cast("int")
    out = out.withColumn("_last", last).withColumn(
        "_words", F.explode(F.concat(F.array_repeat(F.lit(-1), whole), F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<int>")))))
    text = F.col(f"row.`{text_col}`")
    pieces = F.regexp_extract_all(text.cast("string"), F.lit(f"[\\x20\\x09-\\x0D]*{WORD_PATTERN}"), F.lit(0))
    cut = F.when(F.col("_words") < 0, text).otherwise(F.array_join(F.slice(pieces, 1, F.greatest(F.col("_words"), F.lit(1))), ""))
    cols = []
    for c in docs.columns:
        col = F.col(f"row.`{c}`")
        if c == text_col:
            col = cut
        elif c == length_col:
            col = F.when(F.col("_words") < 0, col).otherwise(F.length(cut)).cast(docs.schema[c].dataType)
        cols.append(col.alias(c))
    return out.select(*cols)
