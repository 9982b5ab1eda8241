"""Percentile score with average ties (pandas ``rank(pct=True)``).

``pct = (values below x + (ties + 1) / 2) / non-null count``; nulls stay null
and are not counted. Neither ``percent_rank`` nor ``cume_dist`` gives this.

Several columns are ranked in one pass: the values are stacked into
``(key, signal, value)`` rows, ranked per signal, and pivoted back onto the
key, so the input is read once and the plan does not grow with the number of
signals.

Two plans, equal results:

* ``window`` - one window per signal over all its values (a single task per
  signal); for small inputs and as the brute-force reference in tests.
* ``bucketed`` (default) - scalable prefix sum:
  1. partial-aggregate to distinct (signal, value) with counts (a hot value
     becomes one row),
  2. range-partition the distinct values; the range partition is the bucket,
  3. bucket totals (bounded by the bucket count) give offsets via a tiny window,
  4. a window *partitioned by (signal, bucket)* gives running counts inside
     buckets,
  5. join back on (signal, value) - AQE splits a skewed value's partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.functions.expr import round_half_even

_S, _V, _C = "__pr_sig", "__pr_value", "__pr_cnt"


def _ranks_window(values: DataFrame) -> DataFrame:
    w_run = Window.partitionBy(_S).orderBy(_V).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(_S)
    return values.select(_S, _V, _C, (F.sum(_C).over(w_run) - F.col(_C)).alias("__pr_before"),
                         F.sum(_C).over(w_all).alias("__pr_n"))


def _ranks_bucketed(values: DataFrame, n_buckets: int) -> DataFrame:
    # Bounds are data (one row per signal), so a value's bucket is the same
    # every time the plan is executed.
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = values.groupBy(_S).agg((F.percentile_approx(_V, probs, 1000) if probs else F.array().cast("array<double>"))
                                    .alias("__pr_bounds"))
    bounds = values.sparkSession.createDataFrame(bounds.collect(), bounds.schema)
    bucketed = (values.join(F.broadcast(bounds), _S)
                .withColumn("__pr_bucket", F.size(F.filter("__pr_bounds", lambda b: b < F.col(_V)))).drop("__pr_bounds"))
    totals = bucketed.groupBy(_S, "__pr_bucket").agg(F.sum(_C).alias("__pr_btotal"))
    # At most n_buckets + signals rows.
    w_b = Window.partitionBy(_S).orderBy("__pr_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(_S, "__pr_bucket",
                            (F.sum("__pr_btotal").over(w_b) - F.col("__pr_btotal")).alias("__pr_offset"),
                            F.sum("__pr_btotal").over(Window.partitionBy(_S)).alias("__pr_n"))
    w_in = (Window.partitionBy(_S, "__pr_bucket").orderBy(_V)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (bucketed.join(F.broadcast(offsets), [_S, "__pr_bucket"])
            .select(_S, _V, _C,
                    (F.col("__pr_offset") + F.sum(_C).over(w_in) - F.col(_C)).alias("__pr_before"),
                    "__pr_n"))


def pct_ranks(df: DataFrame, key: Sequence[str], specs: Mapping[str, Column], scale: float = 100.0,
              digits: int | None = 2, method: str = "bucketed", n_buckets: int | None = None) -> DataFrame:
    """Add one average-tie percentile column per ``specs`` entry (name -> value
    expression over ``df``). ``key`` must identify rows of ``df``."""
    key = list(key)
    names = list(specs)
    stacked = df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(n).alias(_S), specs[n].cast("double").alias(_V)) for n in names])).alias("__pr"))
    long = stacked.select(*key, F.col(f"__pr.{_S}").alias(_S), F.col(f"__pr.{_V}").alias(_V))
    values = long.where(F.col(_V).isNotNull()).groupBy(_S, _V).agg(F.count(F.lit(1)).alias(_C))
    if method == "window":
        ranks = _ranks_window(values)
    else:
        n_buckets = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranks = _ranks_bucketed(values, max(1, n_buckets))
    pct = ((F.col("__pr_before") + (F.col(_C) + F.lit(1)) / F.lit(2.0))
           / F.col("__pr_n").cast("double")) * F.lit(float(scale))
    if digits is not None:
        pct = round_half_even(pct, digits)
    ranks = ranks.select(_S, _V, pct.alias("__pr_pct"))
    per_key = (long.join(ranks, [_S, _V], "left")
               .groupBy(*key).agg(*[F.max(F.when(F.col(_S) == n, F.col("__pr_pct"))).alias(n) for n in names]))
    base = df.drop(*[n for n in names if n in df.columns])
    return base.join(per_key, key, "left")


def pct_rank_avg(df: DataFrame, key: Sequence[str], value, out_col: str, **kw) -> DataFrame:
    val = F.col(value) if isinstance(value, str) else value
    return pct_ranks(df, key, {out_col: val}, **kw)


def sql_pct_rank_avg(value_expr: str, digits: int | None = 2, scale: float = 100.0) -> str:
    """The same percentile in DuckDB SQL as a window expression."""
    core = (f"((rank() OVER (ORDER BY {value_expr} ASC NULLS LAST) "
            f"+ (count(*) OVER (PARTITION BY {value_expr}) + 1) / 2.0 - 1) "
            f"/ CAST(count({value_expr}) OVER () AS DOUBLE)) * {float(scale)!r}")
    if digits is not None:
        scale_d = f"{float(10 ** digits)!r}"
        core = f"(round_even(({core}) * {scale_d}, 0) / {scale_d})"
    return f"CASE WHEN {value_expr} IS NULL THEN NULL ELSE {core} END"
