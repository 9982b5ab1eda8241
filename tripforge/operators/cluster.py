"""Machine learning on the catalogue.

* M2 standardisation uses the *population* std (ML ``StandardScaler`` uses the
  sample std), one aggregation for all features; zero std -> 0.0.
* M4 K-means restarts of every k advance together (``operators.lloyd``): a sweep
  costs as many jobs as its slowest run has iterations. Starts are deterministic.
* M6/M13 silhouette is the squared-Euclidean form computed from per-cluster
  sums (O(points x clusters), the same definition as Spark's
  ``ClusteringEvaluator``). The exact Euclidean silhouette needs every pair of
  points and is not built (see README).
* M9 names clusters by a rule on their centroids, not by their arbitrary ids.
* Rows with a missing feature take part in no model and get null labels;
  ``rows_dropped`` tells how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import round_half_even
from tripforge.operators.features import global_stats
from tripforge.operators.lloyd import best_run, cluster_of, fit_runs, standard_points

ID = ["destination_name", "country"]


# ------------------------------------------------------------------- M1-M3
def standard_scale(df: DataFrame, features: Sequence[str] = rules.MODEL_FEATURES,
                   keep: Sequence[str] = ID) -> tuple[DataFrame, list[tuple[str, float, float]]]:
    """``(x - mean) / std_pop``; returns the scaled frame and (feature, mean, std)."""
    stats = global_stats(df, [f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)])
    out, summary = [], []
    for i, c in enumerate(features):
        mean, std = stats[2 * i], stats[2 * i + 1]
        summary.append((c, mean, std))
        x = F.col(c).cast("double")
        out.append((F.lit(0.0) if not std else (x - F.lit(mean)) / F.lit(std)).alias(c))
    return df.select(*keep, *out), summary


def scaling_summary(df: DataFrame, features: Sequence[str] = rules.MODEL_FEATURES, digits: int = 4) -> DataFrame:
    """M3: mean/std before and after scaling per feature."""
    scaled, before = standard_scale(df, features)
    after = global_stats(scaled, [f(F.col(c)) for c in features for f in (F.avg, F.stddev_pop)])
    rows = [(c, m, s, after[2 * i], after[2 * i + 1]) for i, (c, m, s) in enumerate(before)]
    sdf = df.sparkSession.createDataFrame(rows, "feature string, mean_before_scaling double, std_before_scaling double, "
                                                "mean_after_scaling double, std_after_scaling double")
    # + 0.0 turns a rounded -0.0 into 0.0
    return sdf.select("feature", *[(round_half_even(F.col(c), digits) + F.lit(0.0)).alias(c) for c in sdf.columns[1:]])


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


# ------------------------------------------------------------ M6, M13 (sq.)
def silhouette(points: DataFrame, vec_col: str, label_col: str, noise: int | None = None,
               digits: int | None = 4) -> float | None:
    """Mean squared-Euclidean silhouette (clusters of one point score 0).

    Cluster sums (count, sum of vectors, sum of squared norms) are one
    aggregation with k rows; each point is then compared with every cluster
    through those sums. ``noise`` labels are removed first; fewer than two
    clusters or three points -> None (the guarded form).
    """
    p = points.select(F.col(label_col).alias("lab"), F.col(vec_col).cast("array<double>").alias("x"))
    if noise is not None:
        p = p.where(F.col("lab") != noise)
    p = p.where(F.col("x").isNotNull())
    dim_row = p.select(F.max(F.size("x"))).first()
    if dim_row is None or dim_row[0] is None:
        return None
    d = int(dim_row[0])
    sq = F.aggregate(F.col("x"), F.lit(0.0), lambda acc, v: acc + v * v)
    stats = p.groupBy("lab").agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("q"),
                                 *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).collect()
    n_total = sum(r.n for r in stats)
    if len(stats) < 2 or (noise is not None and n_total < 3):
        return None
    # k cluster summaries (bounded by the number of clusters) become literals.
    dist = {}
    for r in stats:
        s = F.array(*[F.lit(float(r[f"s{i}"])) for i in range(d)])
        dot = F.aggregate(F.zip_with(F.col("x"), s, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        dist[r.lab] = (sq - 2.0 * dot / F.lit(float(r.n)) + F.lit(float(r.q) / r.n), r.n)
    own_n = None
    for lab, (_, n) in dist.items():
        own_n = F.when(F.col("lab") == lab, F.lit(n)) if own_n is None else own_n.when(F.col("lab") == lab, F.lit(n))
    own_d = None
    for lab, (e, _) in dist.items():
        own_d = F.when(F.col("lab") == lab, e) if own_d is None else own_d.when(F.col("lab") == lab, e)
    others = [F.when(F.col("lab") != lab, e) for lab, (e, _) in dist.items()]
    b = F.least(*others)
    a = own_d * own_n / (own_n - 1)
    s = (F.when(own_n <= 1, F.lit(0.0)).when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    val = p.select(F.avg(s)).first()[0]
    return None if val is None else (round(val, digits) if digits is not None else val)


# ------------------------------------------------------------------- M9
NAMING_COLUMNS = ["restaurant_count", "cafe_count", "bar_count", "museum_count", "summer_avg_temp"]


def name_clusters(assigned: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """(cluster, cluster_profile): most urban POIs -> Urban; of the rest the
    warmest summer -> Warm Coastal; the others -> Cool/Nature."""
    urban = F.col("restaurant_count") + F.col("cafe_count") + F.col("bar_count") + F.col("museum_count")
    cents = (assigned.groupBy(cluster_col).agg(F.avg(urban).alias("u"), F.avg("summer_avg_temp").alias("t"))
             .collect())
    names = {}
    rest = sorted(cents, key=lambda r: (-r.u, r[cluster_col]))
    if rest:
        names[rest[0][cluster_col]] = rules.PROFILE_URBAN
        rest = sorted(rest[1:], key=lambda r: (-(r.t if r.t is not None else float("-inf")), r[cluster_col]))
        if rest:
            names[rest[0][cluster_col]] = rules.PROFILE_WARM_COASTAL
        for r in rest[1:]:
            names[r[cluster_col]] = rules.PROFILE_COOL_NATURE
    spark = assigned.sparkSession
    return spark.createDataFrame(list(names.items()), f"{cluster_col} int, cluster_profile string")


# ------------------------------------------------------------ M4, M5, M7, M15
def dropped_rows(df: DataFrame, features: Sequence[str]) -> int:
    """Rows that lack a feature."""
    missing = F.lit(False)
    for c in features:
        missing = missing | F.col(c).isNull()
    return df.filter(missing).count()


def kmeans_sweep(catalog: DataFrame, k_values: Sequence[int] = rules.K_VALUES, n_init: int = rules.N_INIT,
                 features: Sequence[str] = rules.MODEL_FEATURES, max_iter: int = rules.MAX_ITER,
                 key: Sequence[str] = ID) -> DataFrame:
    """k, inertia (round 4), squared-Euclidean silhouette (round 4), rows_dropped."""
    points = standard_points(catalog, key, features)
    runs = fit_runs(points, key, k_values, n_init, max_iter)
    dropped, rows = dropped_rows(catalog, features), []
    for k in k_values:
        if (run := best_run(runs, k)) is not None:
            labelled = points.withColumn("label", cluster_of(F.col("x"), run.centroids))
            rows.append((k, round(run.inertia, 4), silhouette(labelled, "x", "label"), dropped))
    return catalog.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq_euclidean double, rows_dropped long")


def cluster_labels(catalog: DataFrame, k_values: Sequence[int] = (3,), n_init: int = rules.N_INIT,
                   features: Sequence[str] = rules.MODEL_FEATURES, max_iter: int = rules.MAX_ITER,
                   key: Sequence[str] = ID) -> DataFrame:
    """The label table (M7, M9): k, key, cluster, cluster_profile of every row
    that has all features, from the best run of each k."""
    points = standard_points(catalog, key, features)
    runs = fit_runs(points, key, k_values, n_init, max_iter)
    out = None
    for k in k_values:
        run = best_run(runs, k)
        label = cluster_of(F.col("x"), run.centroids) if run else F.lit(None).cast("int")
        one = points.select(F.lit(k).alias("k"), *key, label.alias("cluster"))
        named = catalog.select(*key, *NAMING_COLUMNS).join(one, list(key))
        one = one.join(F.broadcast(name_clusters(named)), "cluster").select("k", *key, "cluster", "cluster_profile")  # k rows
        out = one if out is None else out.unionByName(one)
    return out


def clustered_catalog(catalog: DataFrame, k: int = 3, n_init: int = rules.N_INIT, features: Sequence[str] = rules.MODEL_FEATURES,
                      max_iter: int = rules.MAX_ITER, key: Sequence[str] = ID) -> DataFrame:
    """Catalogue + cluster id (M7) + profile named by rule (M9); null where a feature is missing."""
    labels = cluster_labels(catalog, [k], n_init, features, max_iter, key).drop("k")
    return catalog.drop("cluster", "cluster_profile").join(labels, list(key), "left")


ASSIGNMENT_COLUMNS = ["dominant_travel_style", "climate_category", "overall_score"]
PROFILE_MEASURES = [*rules.MODEL_FEATURES, "food_score", "nightlife_score", "culture_score", "nature_score", "beach_score", "overall_score"]


def cluster_assignments(catalog: DataFrame, labels: DataFrame, key: Sequence[str] = ID) -> DataFrame:
    """M7: one row per k and labelled destination with its features, in the
    order (k, cluster, key); ``row_number`` is that order."""
    from tripforge.operators.ordering import ordered
    rows = labels.select("k", "cluster", *key).join(catalog.select(*key, *ASSIGNMENT_COLUMNS, *rules.MODEL_FEATURES), list(key))
    return ordered(rows.select("k", *key, "cluster", *ASSIGNMENT_COLUMNS, *rules.MODEL_FEATURES), [(c, True) for c in ("k", "cluster", *key)])


def cluster_profiles(catalog: DataFrame, labels: DataFrame, key: Sequence[str] = ID) -> DataFrame:
    """M8: means (round 2) of features and scores, and the size, per k and cluster."""
    rows = labels.select("k", "cluster", *key).join(catalog.select(*key, *PROFILE_MEASURES), list(key))
    return rows.groupBy("k", "cluster").agg(*[round_half_even(F.avg(c), 2).alias(c) for c in PROFILE_MEASURES],
                                            F.count(F.lit(1)).alias("destination_count"))


def pca_2d(catalog: DataFrame, features: Sequence[str] = rules.MODEL_FEATURES) -> tuple[DataFrame, list[float]]:
    """Two principal components of the standardised features, the sign
    of each component fixed so that its largest-magnitude loading is positive.
    Rows with a missing feature have null components."""
    scaled, _ = standard_scale(catalog.dropna(subset=list(features)), features)
    vec = assemble(scaled, features)
    model = PCA(k=2, inputCol="features", outputCol="pcs").fit(vec)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    tr = model.transform(vec).withColumn("__pcs", vector_to_array("pcs"))
    out = tr.select(*ID, (F.col("__pcs")[0] * signs[0]).alias("PC1"), (F.col("__pcs")[1] * signs[1]).alias("PC2"))
    out = catalog.select(*ID).join(out, ID, "left")
    return out, [float(v) for v in model.explainedVariance.toArray()]


NOTES = {
    "K-Means": "Centroid-based clustering; works well with standardized numeric features.",
    "Hierarchical": "Useful comparison model; creates nested distance-based groups (over K-means micro-clusters).",
}


def compare_models(catalog: DataFrame, k_values: Sequence[int] = (2, 3, 4), n_init: int = rules.N_INIT,
                   features: Sequence[str] = rules.MODEL_FEATURES, max_iter: int = rules.MAX_ITER,
                   key: Sequence[str] = ID) -> DataFrame:
    """Model, cluster_count, noise_count, largest_cluster_size, silhouette, notes, rows_dropped."""
    from tripforge.operators.reports import label_summary
    points = standard_points(catalog, key, features)
    runs = fit_runs(points, key, k_values, n_init, max_iter)
    dropped, rows = dropped_rows(catalog, features), []

    def row(kind: str, parameter: str, labelled: DataFrame) -> None:
        summ = label_summary(labelled).first()
        rows.append((f"{kind} {parameter}", int(summ.cluster_count), int(summ.noise_count), int(summ.largest_cluster_size or 0),
                     silhouette(labelled, "x", "label", noise=-1), NOTES[kind], dropped))

    for k in k_values:
        if (run := best_run(runs, k)) is not None:
            row("K-Means", f"k={k}", points.withColumn("label", cluster_of(F.col("x"), run.centroids)))
    for k in k_values:
        labels = ward_clusters(catalog, k, features).withColumnRenamed("ward_cluster", "label")
        row("Hierarchical", f"k={k}", points.join(labels, list(key)))
    return catalog.sparkSession.createDataFrame(
        rows, "model string, cluster_count int, noise_count int, largest_cluster_size int, "
              "silhouette_sq_euclidean double, notes string, rows_dropped long")


# ------------------------------------------------------------------- M11
def _ward_merge(centroids, counts, k: int) -> list[int]:
    """Ward agglomeration of weighted points (a bounded summary): repeatedly
    merge the pair with the smallest increase in within-cluster sum of
    squares, n_a*n_b/(n_a+n_b)*|c_a-c_b|^2. Returns a label per input row."""
    import numpy as np
    c = np.asarray(centroids, dtype=float)
    n = np.asarray(counts, dtype=float)
    members = [[i] for i in range(len(c))]
    alive = list(range(len(c)))
    while len(alive) > k:
        idx = np.array(alive)
        cc, nn = c[idx], n[idx]
        d2 = ((cc[:, None, :] - cc[None, :, :]) ** 2).sum(-1)
        cost = (nn[:, None] * nn[None, :]) / (nn[:, None] + nn[None, :]) * d2
        np.fill_diagonal(cost, np.inf)
        i, j = np.unravel_index(np.argmin(cost), cost.shape)
        a, b = int(idx[i]), int(idx[j])
        tot = n[a] + n[b]
        c[a] = (c[a] * n[a] + c[b] * n[b]) / tot
        n[a] = tot
        members[a] += members[b]
        alive.remove(b)
    labels = [0] * len(c)
    for lab, root in enumerate(sorted(alive, key=lambda r: min(members[r]))):
        for m in members[root]:
            labels[m] = lab
    return labels


def ward_clusters(catalog: DataFrame, k: int = 3, features: Sequence[str] = rules.MODEL_FEATURES,
                  max_micro: int = 200, seed: int = rules.RANDOM_STATE) -> DataFrame:
    """M11 re-aimed: K-means reduces the points to at most ``max_micro`` weighted
    micro-clusters at every size; Ward merges those and the labels are joined
    back (broadcast, at most ``max_micro`` rows). Rows with a missing feature
    have a null label."""
    spark = catalog.sparkSession
    scaled, _ = standard_scale(catalog.dropna(subset=list(features)), features)
    vec = assemble(scaled, features)
    model = KMeans(k=max_micro, seed=seed, featuresCol="features", predictionCol="micro").fit(vec)
    cents = [list(v) for v in model.clusterCenters()]
    sizes = model.summary.clusterSizes
    keep = [i for i, s in enumerate(sizes) if s > 0]
    labels = _ward_merge([cents[i] for i in keep], [sizes[i] for i in keep], k)
    mapping = spark.createDataFrame([(i, lab) for i, lab in zip(keep, labels)], "micro int, ward_cluster int")
    labelled = model.transform(vec).join(F.broadcast(mapping), "micro").select(*ID, "ward_cluster")
    return catalog.select(*ID).join(labelled, ID, "left")
