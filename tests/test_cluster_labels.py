"""Clustering by joint restarts, the label table and the total order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.operators import cluster, lloyd
from tripforge.operators.joins import JoinValidationError
from tripforge.operators.ordering import ordered
from tripforge.sources import labels as label_table

KEY = ["destination_name", "country"]


def with_null(df):
    """One destination lacks a feature."""
    return df.withColumn("park_count", F.when(F.col("destination_name") != "Mallorca", F.col("park_count")))


def test_sweep_is_as_good_as_the_published_metrics(sample):
    golden = {2: 91.5949, 3: 63.245, 4: 50.9382, 5: 39.8281, 6: 35.0442}
    # random starts end in local optima: at k = 5 these starts need 40 restarts, the others 20
    got = {r.k: r for n, ks in ((20, [2, 3, 4, 6]), (40, [5])) for r in cluster.kmeans_sweep(sample, ks, n).collect()}
    assert sorted(got) == sorted(golden)
    assert got[2].inertia == golden[2] and got[3].inertia == golden[3]
    assert all(got[k].inertia <= golden[k] + 1e-4 and got[k].rows_dropped == 0 for k in golden)
    assert all(-1 <= r.silhouette_sq_euclidean <= 1 for r in got.values())


def test_runs_equal_a_plain_lloyd(spark):
    """Every restart, its centroids and inertia, against numpy on all points; ties, equal rows, one empty cluster."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.4, (40, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2))] + [np.zeros((30, 3))])
    rows = [(f"d{i}", "c", [float(v) for v in p]) for i, p in enumerate(x)]
    points = spark.createDataFrame(rows, "destination_name string, country string, x array<double>").repartition(5).cache()
    runs = lloyd.fit_runs(points, KEY, [2, 3, 5], n_init=6, max_iter=50)
    first = lloyd.starts(points, KEY, 6, 5)
    assert len(runs) == 18 and all(len(s) == 5 for s in first.values())
    for run in runs:
        c = first[run.restart][: run.k].copy()
        for _ in range(50):
            near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(run.k)])
        assert np.allclose(run.centroids, c, atol=1e-9)
        near = ((x[:, None] - c[None]) ** 2).sum(2)
        assert np.isclose(run.inertia, near.min(1).sum())
    best = lloyd.best_run(runs, 3)
    assert best.inertia == min(r.inertia for r in runs if r.k == 3)
    got = {r.destination_name: r.c for r in points.select("destination_name", lloyd.cluster_of(F.col("x"), best.centroids).alias("c")).collect()}
    want = ((x[:, None] - best.centroids[None]) ** 2).sum(2).argmin(1)
    assert [got[f"d{i}"] for i in range(len(x))] == want.tolist()


def test_names_and_labels_of_the_sample(sample):
    """M9: the profile with most urban places is Urban, the warmest other one Warm Coastal."""
    out = cluster.clustered_catalog(sample, 3)
    rows = out.collect()
    assert len(rows) == 20 and {r.cluster for r in rows} == {0, 1, 2}
    by = {}
    for r in rows:
        by.setdefault(r["cluster_profile"], []).append(r)
    assert set(by) == set(rules.CLUSTER_PROFILES)

    def mean(name, f):
        return sum(map(f, by[name])) / len(by[name])
    urban = {n: mean(n, lambda r: r.restaurant_count + r.cafe_count + r.bar_count + r.museum_count) for n in by}
    assert max(urban, key=urban.get) == rules.PROFILE_URBAN
    assert mean(rules.PROFILE_WARM_COASTAL, lambda r: r.summer_avg_temp) > mean(rules.PROFILE_COOL_NATURE, lambda r: r.summer_avg_temp)
    expected = {r.destination_name: r.cluster_profile for r in sample.collect()}
    # the published k = 3 run, too, has Funchal with the cool destinations; the shipped catalogue's label differs there
    assert [r.destination_name for r in rows if expected[r.destination_name] != r["cluster_profile"]] == ["Funchal"]


def test_a_missing_feature_drops_the_row_only(sample):
    """One path per model: sweep, labels, comparison, components."""
    broken = with_null(sample)
    sweep = cluster.kmeans_sweep(broken, k_values=[2, 3], n_init=4)
    assert [r.rows_dropped for r in sweep.collect()] == [1, 1]
    full = cluster.clustered_catalog(broken, 3, n_init=4)
    assert [r.destination_name for r in full.where("cluster is null").collect()] == ["Mallorca"] and full.count() == 20
    models = cluster.compare_models(broken, k_values=(2,), n_init=4).collect()
    assert [m.model for m in models] == ["K-Means k=2", "Hierarchical k=2"] and {m.rows_dropped for m in models} == {1}
    assert cluster.pca_2d(broken)[0].where("PC1 is null").count() == 1


def test_empty_and_tiny_tables(sample):
    assert cluster.kmeans_sweep(sample.limit(0), k_values=[2], n_init=2).count() == 0
    one = cluster.clustered_catalog(sample.where("destination_name = 'Mallorca'"), 3, n_init=2).collect()
    assert len(one) == 1 and one[0].cluster == 0


def test_principal_components_equal_svd(sample):
    out, ratio = cluster.pca_2d(sample)
    got = {r.destination_name: (r.PC1, r.PC2) for r in out.collect()}
    rows = sample.collect()
    x = np.array([[float(r[c]) for c in rules.MODEL_FEATURES] for r in rows])
    x = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    signs = [1 if v[np.abs(v).argmax()] >= 0 else -1 for v in vt[:2]]
    want = x @ (vt[:2] * np.array(signs)[:, None]).T
    assert np.allclose([got[r.destination_name] for r in rows], want, atol=1e-8)
    assert np.allclose(ratio, (s ** 2 / (s ** 2).sum())[:2])


def test_assignments_and_profiles(sample):
    cat = sample.withColumnsRenamed({"expected_style": "dominant_travel_style", "expected_climate": "climate_category", "expected_overall": "overall_score"})
    for c in ("food_score", "nightlife_score", "culture_score", "nature_score", "beach_score"):
        cat = cat.withColumn(c, F.col("park_count") * 1.0)
    labels = cluster.cluster_labels(cat, [2, 3], n_init=5)
    rows = cluster.cluster_assignments(cat, labels).orderBy("row_number").collect()
    assert [r.row_number for r in rows] == list(range(1, 41))
    assert [(r.k, r.cluster, r.destination_name) for r in rows] == sorted((r.k, r.cluster, r.destination_name) for r in rows)
    prof = cluster.cluster_profiles(cat, labels).collect()
    assert sorted(sum(p.destination_count for p in prof if p.k == k) for k in (2, 3)) == [20, 20]
    for p in prof:
        mine = [r for r in rows if (r.k, r.cluster) == (p.k, p.cluster)]
        assert p.destination_count == len(mine) and p.park_count == pytest.approx(np.mean([r.park_count for r in mine]), abs=0.0051)


def test_label_versions(spark, sample, tmp_path):
    path = str(tmp_path / "labels")
    first = cluster.cluster_labels(sample, [3], n_init=3).drop("k")
    label_table.publish_labels(first, path, 1)
    label_table.publish_labels(first.withColumn("cluster_profile", F.lit("other")), path, 2)
    assert label_table.label_versions(spark, path) == [1, 2]
    assert {r.cluster_profile for r in label_table.read_labels(spark, path).collect()} == {"other"}
    assert label_table.read_labels(spark, path, 1).count() == 20
    label_table.publish_labels(first.limit(5), path, 2)  # a repeated run replaces its own version
    assert [label_table.read_labels(spark, path, v).count() for v in (1, 2)] == [20, 5]
    with pytest.raises(ValueError):
        label_table.read_labels(spark, path, 3)
    with pytest.raises(JoinValidationError):
        label_table.publish_labels(first.union(first), path, 3)
    with pytest.raises(KeyError):
        label_table.publish_labels(first.drop("cluster"), path, 3)
    assert label_table.label_versions(spark, path) == [1, 2]


def test_recommendations_from_published_labels(spark, sample, tmp_path):
    """Narrow labels are joined one to one onto the features; a second label row of a key is refused."""
    from tripforge.operators.features import add_scores
    from tripforge.plans.catalog import assemble_catalog, catalog_labels, feature_chain
    feats = feature_chain(add_scores(sample.drop("cost_of_living_index", "cluster_profile")), sample.select(*KEY, "cost_of_living_index"))
    labels = catalog_labels(feats)
    cat = assemble_catalog(feats, labels)
    assert cat.count() == 20 and set(rules.PREFERENCE_COLUMNS.values()) < set(cat.columns)
    assert {r.cluster_profile for r in cat.collect()} == set(rules.CLUSTER_PROFILES)
    with pytest.raises(JoinValidationError):
        assemble_catalog(feats, labels.union(labels)).count()


@pytest.mark.parametrize("keys", [[("g", True), ("v", False)], [("v", False), ("g", True)], [("v", True)]])
def test_total_order(spark, keys):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 4)) if i % 9 else None, float(rng.integers(0, 50)), i, "part") for i in range(500)] + [(1, 7.0, 1000 + i, "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "g int, v double, place int, tie string").repartition(6)
    got = sorted(ordered(df, keys, "n", partitions=7).collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(1, 801)) and {r.place for r in got} == {r[2] for r in rows}

    def rank(r):
        return [(r[c] is None, (r[c] or 0) * (1 if up else -1)) for c, up in keys]
    assert [rank(r) for r in got] == sorted(rank(r) for r in got)
    assert ordered(df.limit(0), keys).count() == 0
