"""Reports, costs, incremental collection, geocoding, silhouette, streaming."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_exact_quantiles_match_numpy(spark):
    from tripforge.operators.reports import exact_quantiles
    vals = [5.0, 1.0, 3.0, 3.0, 9.0, 2.0, None, 7.0, 3.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.q: r.value for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0], n_buckets=3).collect()}
    arr = np.array([v for v in vals if v is not None])
    for q, v in got.items():
        assert math.isclose(v, float(np.quantile(arr, q)), rel_tol=1e-12)


def test_histogram_keeps_empty_bins(spark):
    from tripforge.operators.reports import histogram
    df = spark.createDataFrame([(0.0,), (0.5,), (10.0,), (10.0,)], "x double")
    rows = sorted((r.bin, r["count"]) for r in histogram(df, "x", 4).collect())
    assert rows == [(0, 2), (1, 0), (2, 0), (3, 2)]


def test_label_summary_counts_noise_as_label(spark):
    from tripforge.operators.reports import label_summary
    df = spark.createDataFrame([(-1,)] * 5 + [(0,)] * 3 + [(1,)] * 2, "label int")
    r = label_summary(df).first()
    assert (r.cluster_count, r.noise_count, r.largest_cluster_size, r.largest_cluster_size_without_noise) == (2, 5, 5, 3)


def test_travel_cost_index_nullable_minmax(spark):
    from tripforge.operators.costs import add_travel_cost_index
    rows = [("a", "x", 100.0, 10.0, 2.0, 5.0, None, 1.0), ("b", "x", 200.0, None, 3.0, 5.0, None, 2.0),
            ("c", "x", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "destination_name string, country string, median_hotel_price_eur double, "
                               "restaurant_meal_price_eur double, cappuccino_price_eur double, "
                               "groceries_basket_price_eur double, museum_or_attraction_price_eur double, "
                               "local_transport_price_eur double")
    out = {r.destination_name: r for r in add_travel_cost_index(df).collect()}
    assert out["a"].restaurant_price_score is None and out["a"].groceries_price_score is None  # constant -> null
    assert out["b"].travel_cost_index == 100.0 and out["b"].travel_cost_level == "Luxury"
    assert out["a"].travel_cost_index == 0.0 and out["a"].travel_cost_level == "Budget"
    assert out["c"].travel_cost_index is None and out["c"].travel_cost_level == "Unknown"
    assert out["a"].cost_data_coverage == round(5 / 6, 2) and out["c"].cost_data_coverage == 0.0


def test_price_payload_keywords_and_missing(spark):
    from tripforge.operators.costs import hotel_price_stats, keyword_prices
    p = spark.createDataFrame([
        ("a", '{"name":"A","contributors":3,"prices":[{"item_name":"Meal, Inexpensive Restaurant","average_price":10},'
              '{"item_name":"Milk (regular), (1 liter)","average_price":1.0},{"item_name":"Eggs (regular) (12)","average_price":3.0},'
              '{"item_name":"Cappuccino (regular)","average_price":null}]}'),
        ("b", None)], "k string, payload string")
    out = {r.k: r for r in keyword_prices(p, ["k"]).collect()}
    assert out["a"].restaurant_meal_price_eur == 10.0 and out["a"].groceries_basket_price_eur == 2.0
    assert out["a"].cappuccino_price_eur is None and out["a"].numbeo_contributors == 3
    assert out["b"].restaurant_meal_price_eur is None
    h = spark.createDataFrame([
        ("a", 1, '{"data":[{"offers":[{"price":{"total":"100.0"}},{"price":{}}]}]}'),
        ("a", 2, '{"data":[{"offers":[{"price":{"total":"300"}}]}]}'),
        ("a", 21, '{"data":[{"offers":[{"price":{"total":"999"}}]}]}'),
        ("a", 3, "not json")], "k string, hotel_rank int, payload string")
    s = hotel_price_stats(h, ["k"]).first()
    assert (s.avg_hotel_price_eur, s.median_hotel_price_eur, s.hotel_sample_size) == (200.0, 200.0, 2)


def test_upsert_latest_wins_and_pending(spark):
    from tripforge.sources.incremental import pending, upsert
    done = spark.createDataFrame([(1, "city", 100, 1.00001, 2.0, 5, 1), (2, "city", 100, 3.0, 4.0, None, 1)],
                                 "destination_id long, destination_type string, search_radius_m int, "
                                 "place_latitude double, place_longitude double, restaurant_count long, run_id int")
    dest = spark.createDataFrame([(1, "city", 100, 1.00002, 2.0), (2, "city", 100, 3.0, 4.0), (3, "city", 100, 0.0, 0.0)],
                                 "destination_id long, destination_type string, search_radius_m int, latitude double, longitude double")
    todo = sorted(r.destination_id for r in pending(dest, done, counts=["restaurant_count"]).collect())
    assert todo == [2, 3]  # 1 is complete and matches at 4 decimals
    fresh = spark.createDataFrame([(2, 7, 2), (3, 1, 2)], "destination_id long, restaurant_count long, run_id int")
    out = {r.destination_id: r.restaurant_count for r in upsert(done, fresh).collect()}
    assert out == {1: 5, 2: 7, 3: 1}


def test_geocode_normalises_and_picks_best(spark):
    from tripforge.sources.incremental import geocode
    dest = spark.createDataFrame([(1, "Lisbon", None, "Portugal"), (2, "Nowhere", "X", "Y")],
                                 "destination_id long, destination_name string, search_name string, country string")
    gaz = spark.createDataFrame([(" LISBON", "portugal", 38.7, -9.1, 0.9), ("lisbon", "Portugal", 1.0, 1.0, 0.5)],
                                "search_name string, country string, lat double, lon double, importance double")
    out = {r.destination_id: (r.latitude, r.longitude) for r in geocode(dest, gaz).collect()}
    assert out == {1: (38.7, -9.1), 2: (None, None)}


def test_silhouette_matches_bruteforce_squared(spark):
    from tripforge.operators.cluster import silhouette
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (15, 3)), rng.normal(5, 1, (10, 3)), [[20, 20, 20]]])
    lab = [0] * 15 + [1] * 10 + [2]
    df = spark.createDataFrame([(int(l), [float(v) for v in p]) for l, p in zip(lab, pts)], "label int, x array<double>")
    got = silhouette(df, "x", "label", digits=None)
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    lab = np.array(lab)
    s = []
    for i in range(len(pts)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(float(np.mean(s)), rel=1e-9)


def test_streaming_equals_batch(spark):
    from tripforge.plans import registry
    from tripforge.plans.registry_more import q_streamed_recommendations
    cols = ["request_id", "rank", "destination_name", "recommendation_score", "explanation"]
    a = sorted(tuple(r) for r in registry.q_recommend(spark, SF).select(*cols).collect())
    b = sorted(tuple(r) for r in q_streamed_recommendations(spark, SF).select(*cols).collect())
    assert a == b and len(a) > 0


def test_registry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    assert df.count() > 0 and "recommendation_score" in df.columns


def test_explode_daily_and_seasons(spark):
    from tripforge.operators.features import seasonal_features
    from tripforge.sources.catalog_io import explode_daily
    payload = ('{"daily":{"time":["2023-01-01","2023-07-01","2023-07-02","2024-12-31"],'
               '"temperature_2m_mean":[2.0,25.0,27.0,"NaN"],"precipitation_sum":[1.0,0.0,0.5,2.0]}}')
    df = spark.createDataFrame([(1, payload)], "destination_id long, payload string")
    daily = explode_daily(df, ["destination_id"])
    assert daily.count() == 4
    s = seasonal_features(daily).first()
    assert s.summer_avg_temp == 26.0 and s.summer_avg_daily_rain == 0.25
    assert s.winter_avg_temp == 2.0 and s.winter_avg_daily_rain == 1.5  # NaN temperature -> null, skipped
    assert s.spring_avg_temp is None


def test_ward_merge_matches_bruteforce_sse():
    import itertools
    from tripforge.operators.cluster import _ward_merge
    rng = np.random.default_rng(5)
    pts = rng.normal(0, 1, (7, 2))
    labels = _ward_merge(pts, [1] * 7, 3)
    assert len(set(labels)) == 3

    def sse(groups):
        return sum(((pts[g] - pts[g].mean(0)) ** 2).sum() for g in groups)
    # greedy Ward: each merge is the cheapest one available (check the first merge)
    costs = {(i, j): 0.5 * ((pts[i] - pts[j]) ** 2).sum() for i, j in itertools.combinations(range(7), 2)}
    i, j = min(costs, key=costs.get)
    assert labels[i] == labels[j]
    # weighted points: a point of weight 3 behaves like three copies
    w = _ward_merge([[0.0], [0.1], [5.0], [5.2]], [3, 1, 1, 1], 2)
    assert w[0] == w[1] and w[2] == w[3] and w[0] != w[2]
