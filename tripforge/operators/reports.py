"""EDA and validation reports (A10-A20, L7, L8) as DataFrame -> DataFrame.

Every report is one or two aggregation jobs with partial aggregation; results
are long (unpivoted) tables. Exact quantiles reuse the scalable rank table
(no single-task window, no collected value lists).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.functions.expr import round_half_even
from tripforge.operators.ranking import _C, _S, _V, _ranks_bucketed, _ranks_window

BOOLEAN_FLAGS = ["warm_destination", "cold_destination", "summer_destination", "winter_destination",
                 "rain_risk", "island_destination", "mountain_destination", "coastal_destination",
                 "city_destination", "balanced_destination"]


def _stack(pairs: Sequence[tuple[str, Column]], name_col: str, value_col: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(n).alias(name_col), c.alias(value_col)) for n, c in pairs]))


# ----------------------------------------------------------------------- A10
def group_profile(df: DataFrame, group_col: str, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Mean of each column per group (rounded) plus the group size."""
    return df.groupBy(group_col).agg(*[round_half_even(F.avg(c), digits).alias(c) for c in columns],
                                     F.count(F.lit(1)).alias("size"))


# ----------------------------------------------------------------------- A11
def label_summary(labels: DataFrame, label_col: str = "label", noise: int = -1) -> DataFrame:
    """Clusters (noise excluded), noise count, largest label size (noise counts)."""
    sizes = labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count_distinct(F.when(F.col(label_col) != noise, F.col(label_col))).alias("cluster_count"),
        F.coalesce(F.sum(F.when(F.col(label_col) == noise, F.col("n"))), F.lit(0)).alias("noise_count"),
        F.max("n").alias("largest_cluster_size"),
        F.max(F.when(F.col(label_col) != noise, F.col("n"))).alias("largest_cluster_size_without_noise"),
    )


# ----------------------------------------------------------------------- A12
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.select(_stack([(c, F.col(c)) for c in columns], "column", "null_count").alias("s")).select("s.*")


# ------------------------------------------------------------- exact quantiles
def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float],
                    method: str = "bucketed", n_buckets: int | None = None) -> DataFrame:
    """(column, q, value) with linear interpolation at position (n-1)*q.

    Distinct values with running counts come from the scalable rank table;
    the two values around each position are picked by a range filter.
    """
    long = df.select(_stack([(c, F.col(c).cast("double")) for c in columns], _S, _V).alias("s")).select("s.*")
    values = long.where(F.col(_V).isNotNull()).groupBy(_S, _V).agg(F.count(F.lit(1)).alias(_C))
    if method == "window":
        ranks = _ranks_window(values)
    else:
        ranks = _ranks_bucketed(values, n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n_per = ranks.groupBy(_S).agg(F.max("__pr_n").alias("n"))
    pos = (n_per.select(_S, "n", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
           .select(_S, "q", ((F.col("n") - 1) * F.col("q")).alias("h")))
    pos = pos.select("*", F.floor("h").alias("lo"), F.ceil("h").alias("hi"))
    r = ranks.select(_S, _V, F.col("__pr_before").alias("b"), (F.col("__pr_before") + F.col(_C)).alias("e"))
    pos = F.broadcast(pos)  # columns x quantiles rows
    lo = pos.join(r, (pos[_S] == r[_S]) & (r.b <= pos.lo) & (pos.lo < r.e)).select(pos[_S], "q", "h", "lo", F.col(_V).alias("v_lo"))
    hi = pos.join(r, (pos[_S] == r[_S]) & (r.b <= pos.hi) & (pos.hi < r.e)).select(pos[_S], "q", F.col(_V).alias("v_hi"))
    out = lo.join(hi, [_S, "q"])
    val = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("h") - F.col("lo"))
    return out.select(F.col(_S).alias("column"), "q", val.alias("value"))


# ----------------------------------------------------------------------- A13
def describe(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, sample std, min, 25%, 50%, 75%, max per column (long form)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs)
    basic = row.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in columns])).alias("s")).select("s.*")
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                                   for v, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = basic.join(qw, "column", "left")
    return out.select("column", "count", *[round_half_even(F.col(c), digits).alias(c)
                                           for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


# ----------------------------------------------------------------------- A14
def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "value"))


# ------------------------------------------------------------------ A15, A16
def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair i < j in one aggregation (long form)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                                                   round_half_even(F.col(f"{a}__{b}"), digits).alias("correlation"))
                                          for a, b in pairs])).alias("s")).select("s.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    upper = correlation_pairs(df, columns, digits)
    lower = upper.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "column_a string, column_b string, correlation double")
    return upper.unionByName(lower).unionByName(diag)


def strongest_pairs(df: DataFrame, columns: Sequence[str], top: int = 15, digits: int = 4) -> DataFrame:
    pairs = correlation_pairs(df, columns, digits)
    return pairs.orderBy(F.abs("correlation").desc_nulls_last(), "column_a", "column_b").limit(top)


# ----------------------------------------------------------------------- A17
def linear_fits(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 4) -> DataFrame:
    aggs = []
    for x, y in pairs:
        xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
        aggs += [F.regr_slope(yc, xc).alias(f"{x}__{y}__slope"), F.regr_intercept(yc, xc).alias(f"{x}__{y}__icpt"),
                 F.corr(xc, yc).alias(f"{x}__{y}__corr")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(x).alias("x"), F.lit(y).alias("y"),
        round_half_even(F.col(f"{x}__{y}__slope"), digits).alias("slope"),
        round_half_even(F.col(f"{x}__{y}__icpt"), digits).alias("intercept"),
        round_half_even(F.col(f"{x}__{y}__corr"), digits).alias("correlation")) for x, y in pairs])).alias("s")).select("s.*")


# ----------------------------------------------------------------------- A18
def box_summary(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (furthest data inside the fences), outliers."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                                   for v, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = qw.select("*", (F.col("q3") - F.col("q1")).alias("iqr"))
    qw = qw.select("*", (F.col("q1") - 1.5 * F.col("iqr")).alias("lo_fence"), (F.col("q3") + 1.5 * F.col("iqr")).alias("hi_fence"))
    long = df.select(_stack([(c, F.col(c).cast("double")) for c in columns], "column", "x").alias("s")).select("s.*")
    j = long.join(F.broadcast(qw), "column")
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    agg = j.groupBy("column").agg(
        F.min(F.when(inside, F.col("x"))).alias("lower_whisker"), F.max(F.when(inside, F.col("x"))).alias("upper_whisker"),
        F.count_if(F.col("x").isNotNull() & ~inside).alias("outliers"))
    out = qw.join(agg, "column")
    return out.select("column", *[round_half_even(F.col(c), digits).alias(c) for c in
                                  ["q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker"]], "outliers")


# ----------------------------------------------------------------------- A19
def histogram(df: DataFrame, column: str, bins: int = 8) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept."""
    from tripforge.operators.features import global_stats
    x = F.col(column).cast("double")
    lo, hi = global_stats(df, [F.min(x), F.max(x)])
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    if hi == lo:
        b = F.lit(0)
    else:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins
    allbins = spark.createDataFrame([(i, lo + width * i, lo + width * (i + 1)) for i in range(bins)],
                                    "bin int, bin_start double, bin_end double")
    out = allbins.join(counts, "bin", "left")
    return out.select("bin", "bin_start", "bin_end", F.coalesce(F.col("count"), F.lit(0)).alias("count"))


# ----------------------------------------------------------------------- A20
def cohort_vs_population(df: DataFrame, cohort: Column, measures: Sequence[str], digits: int = 2) -> DataFrame:
    aggs = []
    for m in measures:
        aggs += [F.avg(F.when(cohort, F.col(m))).alias(f"{m}__c"), F.avg(F.col(m)).alias(f"{m}__p")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(m).alias("measure"), round_half_even(F.col(f"{m}__c"), digits).alias("cohort_mean"),
        round_half_even(F.col(f"{m}__p"), digits).alias("population_mean"),
        round_half_even(F.col(f"{m}__c") - F.col(f"{m}__p"), digits).alias("difference")) for m in measures])).alias("s")).select("s.*")


# ------------------------------------------------------------------------ L8
def feature_quality(df: DataFrame, flags: Sequence[str] = BOOLEAN_FLAGS,
                    counts: Sequence[str] = (), near_constant_share: float = 0.9) -> DataFrame:
    """Per flag: true/false counts, share of the majority value, near-constant
    marker; per count column: number of zeros and nulls, and whether there are
    zeros at all (suspicious in a count of places). What does not apply is null."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in flags:
        aggs += [F.count_if(F.col(f)).alias(f"{f}__t"), F.count_if(~F.col(f)).alias(f"{f}__f")]
    for c in counts:
        aggs += [F.count_if(F.col(c) == 0).alias(f"{c}__z"), F.count_if(F.col(c).isNull()).alias(f"{c}__null")]
    row = df.agg(*aggs)
    items = []
    for f in flags:
        t, fl = F.col(f"{f}__t"), F.col(f"{f}__f")
        share = F.greatest(t, fl) / F.col("__n")
        items.append(F.struct(F.lit(f).alias("column"), F.lit("flag").alias("kind"), t.alias("true_count"),
                              fl.alias("false_count"), F.lit(None).cast("long").alias("zero_count"),
                              F.lit(None).cast("long").alias("null_count"),
                              round_half_even(share, 4).alias("majority_share"),
                              (share >= near_constant_share).alias("near_constant"), F.lit(None).cast("boolean").alias("has_zeros")))
    for c in counts:
        items.append(F.struct(F.lit(c).alias("column"), F.lit("count").alias("kind"),
                              F.lit(None).cast("long").alias("true_count"), F.lit(None).cast("long").alias("false_count"),
                              F.col(f"{c}__z").alias("zero_count"), F.col(f"{c}__null").alias("null_count"),
                              F.lit(None).cast("double").alias("majority_share"),
                              F.lit(None).cast("boolean").alias("near_constant"), (F.col(f"{c}__z") > 0).alias("has_zeros")))
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def top_k(df: DataFrame, metric: str, k: int = 10, ascending: bool = False,
          tie_break: Sequence[str] = ("destination_name", "country")) -> DataFrame:
    """Top-k by a metric (TakeOrderedAndProject: per-partition top-k, then merge)."""
    m = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.orderBy(m, *tie_break).limit(k)


def limit_input(df: DataFrame, n: int | None, key: Sequence[str] = ("destination_name", "country")) -> DataFrame:
    """T4: the first ``n`` rows by key (row order is undefined in Spark, so
    'head' is made deterministic by an explicit order)."""
    return df if not n else df.orderBy(*key).limit(n)
