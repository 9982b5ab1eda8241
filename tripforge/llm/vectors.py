"""Helpers for vector tables: which rows take part, exact local top-k, merging."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, nonzero: bool, kind: str = "double") -> DataFrame:
    """vec_id, v (array of ``kind``): one row for each vec_id with a vector that is whole,
    finite and of the table's most frequent length (ties: the smaller). So repeated
    rows are one candidate and one query; of different vectors of one vec_id the
    smallest in array order counts."""
    x = rows.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("v")).filter("vec_id is not null and v is not null")
    x = x.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("v") > 0))
    if nonzero:
        x = x.filter(F.exists("v", lambda c: c != 0))
    length = x.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return x.filter(F.size("v") == (length["d"] if length else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack([np.asarray(x, dtype) for x in column]) if len(column) else np.empty((0, 0), dtype)


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products of one query and rows, summed in component order, so equal vectors get equal sums."""
    total = np.zeros(len(x))
    for d in range(len(q)):
        total += q[d] * x[:, d]
    return total


def merged(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query; replicas of a vec_id count once, at its best score."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = once.withColumn("rank", F.row_number().over(order)).filter(f"rank <= {k}")
    return best.select("query_id", "rank", "vec_id", "score")
