"""Operator 10: exact top-k search as a Voronoi kNN join.

Vectors are whole numbers ``floor(scale * x)``; the score is their inner product.
One more component makes all data vectors equally long, so the largest product is
the nearest distance and the triangle inequality holds.

1. Every vector belongs to its nearest pivot (a bounded hash sample). Each cell is
   summarised: its radius, and the distances of its ``k + 1`` members nearest to the pivot.
2. Query cells are put together in groups. A group's bound is the ``k + 1``-th
   smallest upper bound ``|p q| + |p p'| + |p' s|`` over all summaries.
3. A vector goes to a group only if its lower bound
   ``|p p'| - radius - |p' s|`` does not pass the group's bound.
4. A group's queries and the vectors sent to it meet in blocks of bounded size;
   each block gives its best ``k`` per query, the best of these are the result.

Exact: the bounds hold with a margin for rounding, and products are computed in
whole numbers. Ties go to smaller vec_id. Where distances say little (many
dimensions) most vectors go to most groups; the groups' number grows with the
queries, so the join then costs queries times vectors, in blocks.

Defined results: vectors that are null, empty, hold null or non-finite components
or have another length than most take no part (zero vectors do); repeated rows of a
vec_id count once, of its different vectors the smallest; rows with the query's vec_id are left out; fewer candidates than ``k`` are all returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import hashed_sample, stored
from tripforge.llm.vectors import matrix, merged, usable

#: Vectors for each pivot, most pivots.
PER_PIVOT, MAX_PIVOTS = 400, 2048
#: Queries of a group aimed at, vectors and queries of a block.
GROUP, CHUNK, BLOCK = 2000, 20_000, 2000


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact whole-number products: in floating point where sums stay below 2**53."""
    most = np.abs(q).max(initial=0).astype(float) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def local_best(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of ``data`` for each row of ``queries``."""
    x, ids = matrix(data["v"], np.int64), data["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    q, qid = matrix(queries["v"], np.int64), queries["vec_id"].to_numpy()
    out = []
    for lo in range(0, len(q), 256):
        s = products(q[lo: lo + 256], x)
        for i in range(len(s)):
            other = ids != qid[lo + i]
            r = s[i][other]
            if not len(r):
                continue
            m = min(k, len(r))
            least = np.partition(r, len(r) - m)[len(r) - m]
            at = np.flatnonzero(r >= least)
            at = at[np.argsort(-r[at], kind="stable")[:m]]
            out.append((np.full(m, qid[lo + i]), ids[other][at], r[at]))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols))).astype("int64")


def search(rows: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score of rows whose vec_id is divisible by ``every``."""
    spark = rows.sparkSession
    whole = F.transform("v", lambda c: F.floor(F.lit(scale) * c))
    x = usable(rows, nonzero=False).select("vec_id", whole.alias("v"))
    x = stored(x.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)), "voronoi-vectors")
    n, queries, longest = x.agg(F.count("*"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0), F.max("norm")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not queries:
        return empty
    pivots = int(max(1, min(MAX_PIVOTS, n // PER_PIVOT)))
    sample = matrix(hashed_sample(x, pivots, "vec_id", "voronoi").toPandas()["v"])

    def raised(v, query):
        last = np.zeros(len(v)) if query else np.sqrt(np.maximum(longest - (v * v).sum(1), 0))
        return np.concatenate([v, last[:, None]], 1)

    centres = raised(sample, False)
    shared = spark.sparkContext.broadcast(centres)  # at most MAX_PIVOTS rows

    def assign(query):
        def run(batches):
            p = shared.value
            for b in batches:
                for lo in range(0, len(b), 4096):
                    part = b.iloc[lo: lo + 4096]
                    v = raised(matrix(part["v"]), query)
                    d = (v * v).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * v @ p.T
                    cell = d.argmin(1)
                    far = np.sqrt(((v - p[cell]) ** 2).sum(1))
                    yield part[["vec_id", "v"]].assign(cell=cell, far=far)
        return run

    kind = "vec_id long, v array<long>, cell long, far double"
    data = stored(x.mapInPandas(assign(False), kind), "voronoi-data")
    asked = stored(x.filter(F.pmod("vec_id", F.lit(every)) == 0).mapInPandas(assign(True), kind), "voronoi-queries")

    # summaries: one row per pivot, at most k + 1 distances each
    from pyspark.sql import Window

    near = Window.partitionBy("cell").orderBy("far", "vec_id")
    nearest = data.select("cell", "far", "vec_id").withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1).toPandas()
    cells = asked.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).orderBy("cell").toPandas()

    between = np.sqrt(np.maximum(((centres[:, None] - centres[cells["cell"].to_numpy()][None]) ** 2).sum(2), 0)) if len(centres) * len(cells) * centres.shape[1] < 5e7 else \
        np.stack([np.sqrt(((centres - c) ** 2).sum(1)) for c in centres[cells["cell"].to_numpy()]], 1)
    radius = cells["radius"].to_numpy()
    upper = radius[None] + between[nearest["cell"].to_numpy()] + nearest["far"].to_numpy()[:, None]
    m = min(k + 1, len(upper))
    bound = np.partition(upper, m - 1, 0)[m - 1] if len(upper) > k else np.full(len(cells), np.inf)
    # neighbouring query cells make a group until it has GROUP queries
    line = np.argsort(between[0], kind="stable")
    group = np.zeros(len(cells), np.int64)
    group[line] = (np.cumsum(cells["n"].to_numpy()[line]) - 1) // GROUP
    # a vector of cell j at distance far goes to group g if far >= reach[j, g]
    groups = int(group.max()) + 1
    reach = np.full((len(centres), groups), np.inf)
    for i, g in enumerate(group):
        reach[:, g] = np.minimum(reach[:, g], between[:, i] - radius[i] - bound[i] * (1 + 1e-9) - 1e-6)
    table = pd.DataFrame([(j, g, max(-1.0, float(reach[j, g]))) for j in range(len(centres)) for g in range(groups)], columns=["cell", "g", "reach"])
    table = spark.createDataFrame(table)
    sent = data.join(table, "cell").filter("far >= reach").drop("reach", "far", "cell")
    sizes = stored(data.select("cell", "far").join(table, "cell").filter("far >= reach").groupBy("g").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "voronoi-sizes")
    names = spark.createDataFrame(pd.DataFrame({"cell": cells["cell"], "g": group}))
    asked = asked.join(F.broadcast(names), "cell").select("vec_id", "v", "g")
    blocks = asked.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))

    size = F.broadcast(sizes.join(blocks, "g"))
    left = (sent.join(size, "g").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks"))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("g", "chunk", "block", "vec_id", "v"))
    right = (asked.join(size, "g").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select("g", "chunk", "block", "vec_id", "v"))

    def solve(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return local_best(b, a, k)

    key = ["g", "chunk", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(solve, "query_id long, vec_id long, score long")
    return merged(found, k)
