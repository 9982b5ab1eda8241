"""Golden checks on the shipped 20-row catalogue inputs (FIXTURES.md §5)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripforge.operators.features import add_scores
from tripforge.plans.catalog import add_recommendation_signals, feature_chain

EXPECTED = ["expected_climate", "expected_style", "expected_city", "expected_overall",
            "expected_std", "expected_cost_level"]


@pytest.fixture(scope="module")
def features(sample):
    places = add_scores(sample.drop("cost_of_living_index", "cluster_profile"))
    living = sample.select("destination_name", "country", "cost_of_living_index")
    feats = feature_chain(places, living)
    feats = add_recommendation_signals(feats)
    return feats.join(sample.select("destination_name", "country", "cluster_profile"),
                      ["destination_name", "country"]).cache()


def test_labels_match_shipped_values(features):
    rows = features.collect()
    assert len(rows) == 20
    for r in rows:
        assert r.climate_category == r.expected_climate, r.destination_name
        assert r.dominant_travel_style == r.expected_style, r.destination_name
        assert str(r.city_destination) == r.expected_city, r.destination_name
        assert r.overall_score == pytest.approx(r.expected_overall, abs=0.011), r.destination_name
        assert r.score_balance_std == pytest.approx(r.expected_std, abs=0.011), r.destination_name
        assert r.cost_level == r.expected_cost_level, r.destination_name


def test_label_counts(features):
    rows = features.collect()
    assert Counter(r.climate_category for r in rows) == {"Warm": 5, "Mild": 9, "Cool": 6}
    assert Counter(r.dominant_travel_style for r in rows) == {
        "Beach": 9, "Balanced": 5, "Culture": 4, "Nature": 1, "Food & Nightlife": 1}
    assert Counter(r.cost_level for r in rows) == {"Mid-range": 9, "Luxury": 10, "Budget": 1}
    assert sum(r.balanced_destination for r in rows) == 7
    assert sum(r.rain_risk for r in rows) == 10
    assert {r.destination_name for r in rows if r.city_destination} == {
        "Funchal", "Mallorca", "Lisbon", "Barcelona", "Nice", "Prague", "Vienna", "Paris", "Amsterdam"}


def test_signals(features):
    sig = {r.destination_name: r for r in features.collect()}
    m = sig["Mallorca"]
    assert (m.food_recommendation_signal, m.nightlife_recommendation_signal, m.culture_recommendation_signal,
            m.nature_recommendation_signal, m.beach_recommendation_signal) == (70.0, 70.0, 55.0, 87.5, 100.0)
    b = sig["Barcelona"]
    assert (b.food_recommendation_signal, b.nightlife_recommendation_signal, b.beach_recommendation_signal) == (95.0, 100.0, 50.0)


def test_recommendation_golden(spark, features):
    from tripforge.operators.recommend import recommend
    from tripforge.sources.requests import parse_requests
    cat = features.withColumn("destination_id", F.xxhash64("destination_name", "country"))
    req = spark.createDataFrame([(1, 8.0, 9.0, 3.0, 6.0, 4.0, "August", "Medium (Comfort)", "Any", 20)],
                                "request_id long, food double, beach double, culture double, nature double, "
                                "nightlife double, month string, budget string, weather_preference string, top_n int")
    valid, rejected = parse_requests(req)
    assert rejected.count() == 0
    recs = {r.destination_name: r for r in recommend(valid, cat).collect()}
    assert len(recs) == 20
    expected = {"Mallorca": (1, 86.60), "Split": (2, 75.56), "Nice": (3, 74.84), "Sardinia": (4, 74.56),
                "Lisbon": (5, 71.98), "Barcelona": (6, 67.00), "Zermatt": (20, -19.82)}
    for name, (rank, score) in expected.items():
        assert recs[name].rank == rank, name
        assert recs[name].recommendation_score == pytest.approx(score, abs=1e-9), name
    assert recs["Mallorca"].weather_score == 89.98
    assert recs["Lisbon"].must_have_penalty == 8.0
    assert recs["Zermatt"].must_have_penalty == 41.56
    assert recs["Mallorca"].cost_score == recs["Mallorca"].budget_match_score
    assert recs["Mallorca"].reason.cluster_bonus == 5.0
    assert recs["Mallorca"].explanation == ("strong food match; strong beach match; good summer weather "
                                            "(26.2C, 0.9 mm rain/day); belongs to Warm Coastal & Beach")
