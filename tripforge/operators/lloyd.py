"""K-means restarts that advance together (M4, M5, M7).

Every restart of every k is one run; all runs share a pass over the points. A task
compares its points with the centroids of all runs in numpy, adds up one row per
centroid, and one aggregation of those rows moves all runs a step further. So a
sweep over k with n restarts costs as many jobs as its slowest run has iterations,
and only centroids (runs x k rows) ever reach the driver.

Starts are deterministic: among the ``POOL`` rows whose key has the smallest md5,
restart r takes the first k by md5 of ``r|key``. Ties in distance go to the lower
cluster, an empty cluster keeps its centroid, the best run has the lowest inertia
(at six digits), then the lowest restart. Rows with a missing feature take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.session import cut_lineage

#: Rows among which starting points are chosen; points compared in one numpy step; points a task is meant to compare.
POOL, STEP, POINTS_PER_TASK = 1000, 4096, 8192


@dataclass(frozen=True)
class Run:
    """One restart: its centroids (clusters x features) and inertia."""

    k: int
    restart: int
    centroids: np.ndarray
    inertia: float


def _key_text(key: Sequence[str], prefix: Column | None = None) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", *([prefix.cast("string")] if prefix is not None else []), *parts))


def starts(points: DataFrame, key: Sequence[str], n_init: int, k_max: int) -> dict[int, np.ndarray]:
    """The starting points of each restart, at most ``k_max`` of them in order."""
    pool = points.select(*key, "x").orderBy(_key_text(key), *key).limit(POOL)
    tries = pool.withColumn("restart", F.explode(F.sequence(F.lit(0), F.lit(n_init - 1))))
    w = Window.partitionBy("restart").orderBy(_key_text(key, F.col("restart")), *key)
    rows = tries.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k_max).select("restart", "place", "x").collect()
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.restart, r.place)):
        out.setdefault(r.restart, []).append(r.x)
    return {r: np.array(x, float) for r, x in out.items()}


def _step(points: DataFrame, runs: list[np.ndarray], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, sums and squared distances per centroid, of all runs in a row."""
    shared = points.sparkSession.sparkContext.broadcast(runs)  # runs x k rows
    sums = [f"s{i}" for i in range(features)]

    def assign(batches):
        cents = np.concatenate(shared.value)
        edges = np.cumsum([0, *[len(c) for c in shared.value]])
        n, cost, total = np.zeros(len(cents)), np.zeros(len(cents)), np.zeros((len(cents), features))
        for b in batches:
            whole = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            for lo in range(0, len(whole), STEP):
                x = whole[lo: lo + STEP]
                d = np.zeros((len(x), len(cents)))
                for i in range(features):
                    t = x[:, i, None] - cents[None, :, i]
                    d += t * t
                for a, z in zip(edges[:-1], edges[1:]):
                    near = d[:, a:z].argmin(1)
                    n[a:z] += np.bincount(near, minlength=z - a)
                    cost[a:z] += np.bincount(near, d[np.arange(len(x)), a + near], z - a)
                    for i in range(features):
                        total[a:z, i] += np.bincount(near, x[:, i], z - a)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cents))), pa.array(n), pa.array(cost), *[pa.array(total[:, i].copy()) for i in range(features)]],
                                         ["centroid", "n", "cost", *sums])

    parts = points.select("x").mapInArrow(assign, "centroid long, n double, cost double, " + ", ".join(f"{s} double" for s in sums))
    rows = parts.groupBy("centroid").agg(F.sum("n"), F.sum("cost"), *[F.sum(s) for s in sums]).collect()
    table = np.array([list(r)[1:] for r in sorted(rows, key=lambda r: r.centroid)], float).reshape(-1, features + 2)
    return table[:, 0], table[:, 2:], table[:, 1]


def fit_runs(points: DataFrame, key: Sequence[str], k_values: Sequence[int], n_init: int = rules.N_INIT,
             max_iter: int = rules.MAX_ITER) -> list[Run]:
    """All runs over ``points`` (key, x array<double>), a stored table."""
    first = starts(points, key, n_init, max(k_values))
    names = [(k, r) for k in k_values for r in sorted(first)]
    cents = [first[r][:k].copy() for k, r in names]
    if not cents:
        return []
    features, still = cents[0].shape[1], np.ones(len(names), bool)
    cost = np.zeros(len(names))
    for turn in range(max_iter + 1):
        moving = np.flatnonzero(still)
        n, total, costs = _step(points, [cents[i] for i in moving], features)
        at = 0
        for i in moving:
            rows = slice(at, at + len(cents[i]))
            at += len(cents[i])
            cost[i] = costs[rows].sum()
            new = np.where(n[rows, None] > 0, total[rows] / np.maximum(n[rows, None], 1), cents[i])
            if turn == max_iter or np.allclose(new, cents[i], rtol=1e-12, atol=1e-12):
                still[i] = False  # the inertia belongs to the centroids kept
            else:
                cents[i] = new
        if not still.any():
            break
    return [Run(k, r, c, float(x)) for (k, r), c, x in zip(names, cents, cost)]


def best_run(runs: Sequence[Run], k: int) -> Run | None:
    return min((r for r in runs if r.k == k), key=lambda r: (round(r.inertia, 6), r.restart), default=None)


def cluster_of(x: Column, centroids: np.ndarray) -> Column:
    """The nearest centroid's number, as one expression over the array ``x``."""
    dist = []
    for c in centroids.tolist():
        terms = [(x[i] - F.lit(v)) * (x[i] - F.lit(v)) for i, v in enumerate(c)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        dist.append(total)
    return (F.array_position(F.array(*dist), F.array_min(F.array(*dist))) - 1).cast("int")


def standard_points(df: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Stored (key, x): standardised features of the rows that have them all."""
    from tripforge.operators.cluster import standard_scale
    scaled, _ = standard_scale(df.dropna(subset=list(features)), features, keep=key)
    rows = scaled.count()
    if rows > POINTS_PER_TASK:  # few bytes a point, but every run is compared with it
        scaled = scaled.repartition(-(-rows // POINTS_PER_TASK), *key)
    return cut_lineage(scaled.select(*key, F.array(*features).alias("x")), "points")


# ---------------------------------------------------------------------- oracle
def sql_lloyd(source: str, key: Sequence[str], features: Sequence[str], k_values: Sequence[int], n_init: int, max_iter: int,
              name: str = "km") -> str:
    """DuckDB CTEs of the same runs, one iteration a step: ``{name}_points`` and
    ``{name}_labels`` (k, key, x, cluster, inertia, centroid of the best run)."""
    dims = range(1, len(features) + 1)
    keys = ", ".join(key)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in features)
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS d{i}" for i, c in enumerate(features))
    scaled = ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0::DOUBLE ELSE (CAST({c} AS DOUBLE) - m{i}) / d{i} END" for i, c in enumerate(features))
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in key)
    dist = " + ".join(f"(x[{i}] - c[{i}]) * (x[{i}] - c[{i}])" for i in dims)
    out = [f"""{name}_points AS MATERIALIZED (SELECT {keys}, [{scaled}] AS x
       FROM (SELECT * FROM {source} WHERE {whole}), (SELECT {stats} FROM {source} WHERE {whole}) s)""",
           f"{name}_pool AS MATERIALIZED (SELECT * FROM {name}_points ORDER BY md5({text}), {keys} LIMIT {POOL})",
           f"""{name}_start AS (SELECT restart, row_number() OVER (PARTITION BY restart ORDER BY md5(restart || '|' || {text}), {keys}) - 1 AS cluster, x AS c
       FROM {name}_pool, range({n_init}) r(restart))""",
           f"""{name}_c0 AS MATERIALIZED (SELECT k, restart, cluster, c FROM {name}_start, (VALUES {', '.join(f'({k})' for k in k_values)}) ks(k) WHERE cluster < k)"""]
    for t in range(max_iter + 1):
        out.append(f"""{name}_a{t} AS MATERIALIZED (SELECT k, restart, {keys}, x, cluster, {dist} AS d FROM {name}_points, {name}_c{t}
       QUALIFY row_number() OVER (PARTITION BY k, restart, {keys} ORDER BY {dist}, cluster) = 1)""")
        if t < max_iter:
            mean = ", ".join(f"avg(x[{i}])" for i in dims)
            out.append(f"""{name}_c{t + 1} AS MATERIALIZED (SELECT k, restart, cluster, coalesce(m.c, b.c) AS c FROM {name}_c{t} b
       LEFT JOIN (SELECT k, restart, cluster, [{mean}] AS c FROM {name}_a{t} GROUP BY k, restart, cluster) m USING (k, restart, cluster))""")
    out.append(f"""{name}_best AS MATERIALIZED (SELECT k, restart, inertia FROM (SELECT k, restart, sum(d) AS inertia FROM {name}_a{max_iter} GROUP BY k, restart)
       QUALIFY row_number() OVER (PARTITION BY k ORDER BY round(inertia, 6), restart) = 1)""")
    out.append(f"{name}_labels AS MATERIALIZED (SELECT k, {keys}, x, CAST(cluster AS INTEGER) AS cluster, inertia FROM {name}_a{max_iter} JOIN {name}_best USING (k, restart))")
    return ",\n".join(out)
