"""Missing-data and distribution profiling.

Missing-data statistics come from one scan that counts rows per missing
pattern (an array of booleans, one per column); per-column counts come from
that table, pairwise co-missing sums from one matrix per task of it, summed by
index pair. Nothing is collected to the driver; NaN in floating columns counts
as missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from strata.operators.aggregate import mean, quantiles
from strata.operators.reshape import unpivot_pairs
from strata.sources.layers import written


def _is_missing(df: DataFrame, c: str):
    t = df.schema[c].dataType
    col = F.col(f"`{c}`")
    if isinstance(t, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _indicator(df: DataFrame, c: str):
    return F.when(_is_missing(df, c), 1).otherwise(0)


def null_to_nan_free(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in floating columns (one projection)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(F.isnan(F.col(f"`{f.name}`")), F.lit(None)).otherwise(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One wide row: missing values per column."""
    cols = cols or df.columns
    return df.select(*[F.sum(_indicator(df, c)).cast("bigint").alias(c) for c in cols])


_BITS = 62   # columns per bitmask word (stays clear of the sign bit)


def missing_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """(pattern, n): how many rows share each missing pattern. ``pattern`` is
    an array of booleans (one per column).

    On the scan side each row's pattern is a bigint bitmask per 62 columns --
    plain arithmetic inside whole-stage codegen and a fixed-width grouping
    key; partial aggregation collapses the scan to one row per distinct
    pattern per task. The boolean array is built only on that small table.
    """
    words = []
    for w in range(0, len(cols), _BITS):
        chunk = cols[w:w + _BITS]
        bits = [F.when(_is_missing(df, c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, c in enumerate(chunk)]
        words.append(reduce(lambda a, b: a + b, bits).alias(f"_w{w // _BITS}"))
    counts = df.select(*words).groupBy(*[f"_w{i}" for i in range(len(words))]).agg(
        F.count(F.lit(1)).alias("n"))
    flags = [F.shiftright(F.col(f"_w{j // _BITS}"), j % _BITS).bitwiseAND(F.lit(1)) == 1
             for j in range(len(cols))]
    return counts.select(F.array(*flags).alias("pattern"), "n")


def _names(cols: list[str]):
    return F.array(*[F.lit(c) for c in cols])



def _long_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, missing_count, n_rows) from the pattern counts.

    (``posexplode_outer``: a plain ``posexplode`` makes Catalyst infer a
    non-empty-array filter and push it below the aggregation, re-computing
    the pattern for every scanned row; the arrays are never empty anyway.)"""
    pats = missing_patterns(df, cols)
    per_col = (pats.select("n", F.posexplode_outer("pattern").alias("i", "miss"))
               .groupBy("i").agg(F.sum(F.when(F.col("miss"), F.col("n")).otherwise(0)).alias("missing_count"),
                                 F.sum("n").alias("n_rows")))
    return per_col.select(F.element_at(_names(cols), F.col("i") + 1).alias("column_name"),
                          F.col("missing_count").cast("bigint").alias("missing_count"),
                          F.col("n_rows").cast("bigint").alias("n_rows"))


def missing_percent(df: DataFrame, cols: list[str] | None = None, digits: int = 3) -> DataFrame:
    """(column_name, missing_count, missing_pct) ordered by missing desc."""
    cols = cols or df.columns
    long = _long_counts(df, cols)
    # round half up of the exact ratio, in integer arithmetic (no binary
    # representation ties between engines)
    scale = 10 ** digits
    halfup = F.expr(f"(missing_count * {2 * 100 * scale} + n_rows) div (2 * n_rows)")
    pct = F.when(F.col("n_rows") > 0, halfup.cast("double") / F.lit(float(scale)))
    return (long.select("column_name", "missing_count", pct.alias("missing_pct"))
            .orderBy(F.desc("missing_count"), "column_name"))


def columns_with_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns holding at least one missing value."""
    return _long_counts(df, cols or df.columns).filter(F.col("missing_count") > 0).select("column_name", "missing_count")


def completeness(df: DataFrame, cols: list[str] | None = None, only_missing_columns: bool = False) -> DataFrame:
    """Available vs missing cells. ``only_missing_columns`` counts cells of
    the columns that have any missing value only (the reference's choice)."""
    long = _long_counts(df, cols or df.columns)
    if only_missing_columns:
        long = long.filter(F.col("missing_count") > 0)
    return long.agg(
        (F.sum("n_rows") - F.sum("missing_count")).cast("bigint").alias("available_cells"),
        F.sum("missing_count").cast("bigint").alias("missing_cells"),
        F.sum("n_rows").cast("bigint").alias("total_cells"))


def _pair_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column pair (i < j): n, missing counts of each, co-missing count.

    A task adds its missing patterns up to one matrix of co-missing counts (a product of the 0/1 patterns, weighted by their rows) and
    gives its upper half once: (number of columns)^2 / 2 rows a task, however many different patterns there are."""
    k = len(cols)
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((k, k)), 0
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("pattern").flatten()).reshape(batch.num_rows, k).astype(np.float64)
                n = batch.column("n").to_numpy().astype(np.float64)
                both += (x * n[:, None]).T @ x
                rows += int(n.sum())
        i, j = (np.r_[u, k].astype(np.int32) for u in upper)         # the last one: all rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(np.r_[both[upper], float(rows)])], ["i", "j", "sab"])

    pats = missing_patterns(df, cols).select("n", "pattern")
    sums = pats.mapInArrow(run, "i int, j int, sab double").groupBy("i", "j").agg(F.sum("sab").alias("sab"))
    sums = written(sums, "co-missing")                 # read four times below
    one = sums.where(F.col("i") == F.col("j"))
    a, b = one.select("i", F.col("sab").alias("sa")), one.select("j", F.col("sab").alias("sb"))
    total = one.where(F.col("i") == k).select(F.col("sab").alias("n")).scalar()
    names = _names(cols)
    return sums.where(F.col("i") < F.col("j")).join(a, "i").join(b, "j").select(
        F.element_at(names, F.col("i") + 1).alias("column_a"), F.element_at(names, F.col("j") + 1).alias("column_b"), total.alias("n"), "sa", "sb", "sab")


def missing_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of the 0/1 missing indicators for each column
    pair (phi coefficient); NULL when an indicator is constant."""
    n, sa, sb, sab = F.col("n"), F.col("sa"), F.col("sb"), F.col("sab")
    num = n * sab - sa * sb
    den = F.sqrt((n * sa - sa * sa) * (n * sb - sb * sb))
    return _pair_sums(df, cols).select("column_a", "column_b", F.when(den > 0, num / den).alias("correlation"))


def missing_distance(df: DataFrame, cols: list[str]) -> DataFrame:
    """For each column pair, rows where exactly one of the two is missing
    (Hamming distance of the missing patterns -- what a dendrogram of
    missing columns clusters on)."""
    d = F.col("sa") + F.col("sb") - 2 * F.col("sab")
    return _pair_sums(df, cols).select("column_a", "column_b", d.cast("bigint").alias("distance"))


def missing_rate_by(df: DataFrame, target: str, by, alias: str = "missing_pct",
                    drop_null_keys: bool = True) -> DataFrame:
    """% of rows with ``target`` missing, per value of ``by`` (a column name
    or an expression named ``by_name``)."""
    key = F.col(by) if isinstance(by, str) else by
    d = df.select(key.alias("_key") if not isinstance(by, str) else key, _indicator(df, target).alias("_m"))
    kname = by if isinstance(by, str) else "_key"
    if drop_null_keys:
        d = d.filter(F.col(kname).isNotNull())
    return d.groupBy(kname).agg((F.avg("_m") * 100).alias(alias))


def mean_by(df: DataFrame, value: str, by: str, alias: str | None = None, drop_null_keys: bool = True) -> DataFrame:
    d = df.filter(F.col(by).isNotNull()) if drop_null_keys else df
    return d.groupBy(by).agg(mean(value).alias(alias or f"avg_{value}"))


def profile_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Long-format profile, one row per numeric column: count, missing,
    distinct, mean, stddev, min, q25, median, q75, max.

    The columns are stacked into (column_name, value) rows in the scan's
    stage. Moments come from one grouped aggregate ; the exact quartiles (linear interpolation) and distinct
    counts from the distributed selection in ``quantiles``, so no task holds
    a whole column. ``approx=True`` uses
    mergeable sketches instead.
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    numbers = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(c) for c in cols])
    long = unpivot_pairs(numbers, [(c, c) for c in cols], "column_name", "value", keep=[])
    long = long.withColumn("value", F.when(F.isnan("value"), F.lit(None)).otherwise(F.col("value")))
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.sum(F.when(F.col("value").isNull(), 1).otherwise(0)).cast("bigint").alias("missing"),
        mean("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    vals = long.filter(F.col("value").isNotNull())
    if approx:
        shape = vals.groupBy("column_name").agg(
            F.approx_count_distinct("value").alias("distinct"),
            F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("qs"))
    else:
        qs = quantiles(vals, "value", [0.25, 0.5, 0.75], by=["column_name"], alias="qv", with_distinct=True)
        shape = qs.groupBy("column_name").agg(
            F.max("distinct").alias("distinct"),
            F.array_sort(F.collect_list(F.struct("q_index", "qv"))).alias("_qs")).select(
            "column_name", "distinct", F.transform("_qs", lambda x: x["qv"]).alias("qs"))
    out = moments.join(shape, "column_name", "left").select(
        "column_name", "count", "missing", F.coalesce("distinct", F.lit(0)).cast("bigint").alias("distinct"),
        "mean", "stddev", "min", F.col("qs")[0].alias("q25"), F.col("qs")[1].alias("median"),
        F.col("qs")[2].alias("q75"), "max")
    return out


def profile_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long-format profile, one row per text column: count, missing, distinct,
    min, max. The columns are stacked in the scan's stage; one aggregation per
    value and one per column, so no task holds a column."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    text = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(c) for c in cols])
    each = unpivot_pairs(text, [(c, c) for c in cols], "column_name", "value", keep=[]).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    return each.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).cast("bigint").alias("count"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).cast("bigint").alias("missing"),
        F.count("value").alias("distinct"), F.min("value").alias("min"), F.max("value").alias("max"))
