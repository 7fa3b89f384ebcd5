"""Aggregations: value counts, grouped metrics, quantiles, histograms,
distinct values and order-insensitive checksums.

All are ``groupBy``/``agg`` plans, so Spark aggregates partially on the map
side before the shuffle: a hot key costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import join_on_keys
from strata.sources.layers import written


def present(c) -> Column:
    """The column with NaN as NULL (missing either way)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c.cast("double")), c)


def mean(c) -> Column:
    """Mean of the values that are neither NULL nor NaN (NULL if none)."""
    return F.avg(present(c).cast("double"))


def value_counts(df: DataFrame, cols: list[str] | str, count_col: str = "count") -> DataFrame:
    """Rows per distinct value (NULL kept as its own group)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))


def sorted_value_counts(df: DataFrame, cols: list[str] | str, count_col: str = "count") -> DataFrame:
    """``value_counts`` ordered by count (desc) then the keys."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return value_counts(df, cols, count_col).orderBy(F.desc(count_col), *[F.asc_nulls_first(c) for c in cols])


def group_metrics(df: DataFrame, by: list[str], metrics: dict[str, Column],
                  drop_null_keys: bool = True) -> DataFrame:
    """Named multi-aggregate per group. ``drop_null_keys`` mirrors a pandas
    ``groupby`` (rows with a NULL key are not a group)."""
    if drop_null_keys:
        for b in by:
            df = df.filter(F.col(b).isNotNull())
    return df.groupBy(*by).agg(*[e.alias(n) for n, e in metrics.items()])


#: Rank accuracy (1 / this) of the sketch that brackets exact quantiles. Groups
#: of no more rows than this are their own bracket.
BRACKET_ACCURACY = 10000
#: Values of a bracket that are put in order; larger brackets are narrowed first.
ORDERED_VALUES = 100_000
#: Cuts of a bracket that is narrowed.
_CUTS = 64


def _measure(vals: DataFrame, bracket: DataFrame, by: list[str], qs: int) -> DataFrame:
    """``bracket`` with what one pass over the values finds, written: rows below (_below) and inside (_inside) of
    [_lo, _hi], and values (_cuts) that part the inside ones about evenly."""
    per = F.sort_array(F.collect_list(F.struct("q_index", "_lo", "_hi")))
    both = _beside(vals, bracket.groupBy(*by).agg(per.alias("_q")), by)
    each = [F.col("_q")[i] for i in range(qs)]
    below = both.groupBy(*by).agg(F.array(*[F.sum(F.when(F.col("_v") < x["_lo"], 1).otherwise(0)) for x in each]).alias("_counts"))
    hit = F.filter(F.array(*[F.when(F.col("_v").between(x["_lo"], x["_hi"]), F.lit(i)) for i, x in enumerate(each)]), lambda x: x.isNotNull())
    steps = [k / _CUTS for k in range(1, _CUTS)]
    inside = both.select(*by, "_v", F.explode(hit).alias("q_index")).groupBy(*by, "q_index").agg(
        F.count(F.lit(1)).alias("_inside"), F.percentile_approx("_v", steps, 1000).alias("_cuts"))
    out = join_on_keys(_beside(bracket, below, by), inside, [*by, "q_index"], "left")
    return written(out.withColumn("_below", F.col("_counts")[F.col("q_index")]).withColumn("_inside", F.coalesce("_inside", F.lit(0))).drop("_counts"),
                   "bracket")


def _beside(rows: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with their group's ``facts`` (without groups: scalar subqueries)."""
    if by:
        return join_on_keys(rows, facts, by)
    return rows.withColumns({c: facts.select(c).scalar() for c in facts.columns})


_MEASURED = ["_below", "_inside", "_cuts"]


def quantiles(df: DataFrame, col: str, qs: list[float], by: list[str] | None = None,
              alias: str = "quantile", with_distinct: bool = False, accuracy: int = BRACKET_ACCURACY,
              ordered: int = ORDERED_VALUES) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``
    semantics; NULL and NaN ignored): (by..., q_index, alias).

    1. A mergeable sketch gives, per group and quantile, a bracket of two values around the target ranks.
    2. One pass counts the rows below and inside, which proves the bracket: where a target rank is outside it is
       opened on that side and counted again, so a sketch that errs costs a pass and no result.
    3. A bracket of more than ``ordered`` rows is narrowed by a sketch of its inside, and proved again, a sixteenth or
       less of it being left each time; one that errs is taken back and stays as it was.
    4. The value frequencies inside, in order, give the one or two values at the target ranks: ``lo + (hi - lo) * frac``.
    ``accuracy``: of the first sketch. ``with_distinct`` adds the number of distinct values per group.
    """
    by = list(by or [])
    v = F.col(col).cast("double")
    vals = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    low, high = F.lit(float("-inf")), F.lit(float("inf"))

    step = 2.0 / accuracy
    ends = [p for q in qs for p in (max(0.0, q - step), min(1.0, q + step))]
    few = F.col("_n") <= accuracy
    stats = vals.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_b")).where("_n > 0")
    bracket = stats.select(*by, "_n", F.explode(F.array(*[F.struct(
        F.lit(i).alias("q_index"), (F.lit(float(q)) * (F.col("_n") - 1)).alias("_pos"),
        F.when(few, low).otherwise(F.col("_b")[2 * i]).alias("_lo"), F.when(few, high).otherwise(F.col("_b")[2 * i + 1]).alias("_hi"),
        F.lit(False).alias("_stays")) for i, q in enumerate(qs)])).alias("_x")).select(*by, "_n", "_x.*")
    under, over = F.col("_below") > F.floor("_pos"), F.col("_below") + F.col("_inside") <= F.ceil("_pos")
    large = (F.col("_inside") > ordered) & (F.col("_lo") < F.col("_hi")) & ~F.col("_stays") & ~few
    found = _measure(vals, written(bracket, "sketch"), by, len(qs))

    def any_of(*conditions: Column) -> list[bool]:
        return [bool(x) for x in found.agg(*[F.max(c) for c in conditions]).first()]

    missed, wide = any_of(under | over, large)
    if missed:
        found = _measure(vals, found.withColumns({"_lo": F.when(under, low).otherwise(F.col("_lo")),
                                                  "_hi": F.when(over, high).otherwise(F.col("_hi"))}).drop(*_MEASURED), by, len(qs))
        (wide,) = any_of(large)
    while wide:
        at = lambda rank, more: ((rank - F.col("_below")) / F.col("_inside") * _CUTS).cast("int") + more
        a, b = at(F.floor("_pos"), -2), at(F.ceil("_pos"), 2)
        old = found.withColumns({"_was_lo": F.col("_lo"), "_was_hi": F.col("_hi")})
        narrow = old.withColumns({"_lo": F.when(large & (a >= 0), F.get("_cuts", a)).otherwise(F.col("_lo")),
                                  "_hi": F.when(large & (b < _CUTS - 1), F.get("_cuts", b)).otherwise(F.col("_hi"))})
        narrow = narrow.withColumn("_stays", F.col("_stays") | (F.col("_lo").eqNullSafe(F.col("_was_lo")) & F.col("_hi").eqNullSafe(F.col("_was_hi"))))
        found = _measure(vals, narrow.drop(*_MEASURED), by, len(qs))
        missed, wide = any_of(under | over, large)
        if missed:
            back = under | over
            found = _measure(vals, found.withColumns({"_stays": F.col("_stays") | back, "_lo": F.when(back, F.col("_was_lo")).otherwise(F.col("_lo")),
                                                      "_hi": F.when(back, F.col("_was_hi")).otherwise(F.col("_hi"))}).drop(*_MEASURED), by, len(qs))
            (wide,) = any_of(large)
        found = found.drop("_was_lo", "_was_hi")

    ends_of = found.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("q_index", "_lo", "_hi"))).alias("_q"))
    both = _beside(vals, ends_of, by)
    hit = F.filter(F.array(*[F.when(F.col("_v").between(F.col("_q")[i]["_lo"], F.col("_q")[i]["_hi"]), F.lit(i)) for i in range(len(qs))]), lambda x: x.isNotNull())
    freq = both.select(*by, "_v", F.explode(hit).alias("q_index")).groupBy(*by, "q_index", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = join_on_keys(freq, found.select(*by, "q_index", "_below", "_pos"), [*by, "q_index"])
    upto = Window.partitionBy(*by, "q_index").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_cum", F.sum("_c").over(upto) + F.col("_below"))
    start = F.col("_cum") - F.col("_c")
    has = [(start <= r) & (r < F.col("_cum")) for r in (F.floor("_pos"), F.ceil("_pos"))]
    picked = ranked.filter(has[0] | has[1]).groupBy(*by, "q_index").agg(
        F.max(F.when(has[0], F.col("_v"))).alias("_lo"), F.max(F.when(has[1], F.col("_v"))).alias("_hi"),
        F.max(F.col("_pos") - F.floor("_pos")).alias("_frac"))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
    out = picked.select(*by, "q_index", value.alias(alias))
    if with_distinct:
        different = vals.groupBy(*by, "_v").agg(F.lit(1)).groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("distinct"))
        out = _beside(out, different, by)
    return out


def quantile(df: DataFrame, col: str, q: float, by: list[str] | None = None,
             approx: bool = False, alias: str = "quantile", accuracy: int = 10000) -> DataFrame:
    """One quantile of ``col`` per group of ``by`` (one row when no ``by``).

    Exact by default (see ``quantiles``); ``approx=True`` uses a mergeable
    sketch with the given accuracy instead.
    """
    by = list(by or [])
    if approx:
        vals = df.select(*by, F.col(col).cast("double").alias("_v"))
        vals = vals.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        return vals.groupBy(*by).agg(F.percentile_approx("_v", q, accuracy).alias(alias))
    return quantiles(df, col, [q], by=by, alias=alias).drop("q_index")


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Fixed-width histogram over ``[lo, hi)``: (bin, bin_start, bin_end, count).

    Values outside the range are not counted; empty bins are absent.
    """
    width = (hi - lo) / bins
    x = F.col(col)
    b = F.floor((x - F.lit(lo)) / F.lit(width)).cast("int")
    inside = df.filter((x >= F.lit(lo)) & (x < F.lit(hi)))
    return (inside.select(F.least(b, F.lit(bins - 1)).alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                    "count"))


def distinct_values(df: DataFrame, cols: list[str] | str) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()


def row_hash(cols: list[str]) -> str:
    """SQL text of a 64-bit hash of a row. Each column's NULLs are hashed as
    such (``xxhash64`` alone skips them, so shifted NULLs would go unseen)."""
    names = ["`" + c.replace("`", "``") + "`" for c in cols]
    return "xxhash64(" + ", ".join(names + [f"isnull({c})" for c in names]) + ")"


def checksum_parts(h: str = "_h") -> str:
    """SQL text of the exact sum of a 64-bit hash, as a struct of three BIGINT
    sums of its 22/21/21-bit parts (no overflow below ~2e12 rows per part,
    and no slow wide-decimal arithmetic)."""
    m = (1 << 21) - 1
    return (f"struct(coalesce(sum(shiftrightunsigned({h}, 42)), 0L) AS p0, "
            f"coalesce(sum(shiftright({h}, 21) & {m}L), 0L) AS p1, coalesce(sum({h} & {m}L), 0L) AS p2)")


def checksum(df: DataFrame, alias: str = "checksum") -> DataFrame:
    """Order-insensitive checksum: the SUM of a NULL-safe 64-bit row hash. One
    row, one struct column."""
    return df.select(F.expr(row_hash(df.columns)).alias("_h")).agg(F.expr(checksum_parts()).alias(alias))


def row_count(df: DataFrame, alias: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))
