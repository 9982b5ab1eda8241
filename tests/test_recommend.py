"""Scoring units (the reference's own test expectations) and end-to-end."""

import pytest
from pyspark.sql import functions as F

from tripforge.operators.recommend import budget_match_score, temperature_comfort_score


def test_budget_matrix(spark):
    df = spark.createDataFrame([("Low (Essential)", "Budget"), ("Low (Essential)", "Mid-range"),
                                ("Low (Essential)", "Luxury"), ("High (Luxury)", "Luxury"),
                                ("Unknown budget", "Budget"), ("Medium (Comfort)", "Unknown"),
                                ("Medium (Comfort)", None)], "b string, l string")
    got = [r[0] for r in df.select(budget_match_score(F.col("b"), F.col("l"))).collect()]
    assert got == [100.0, 65.0, 25.0, 100.0, 75.0, 70.0, 70.0]


def test_temperature_comfort(spark):
    df = spark.createDataFrame([(27.0,), (24.0,), (33.0,)], "t double")
    a, b, c = [r[0] for r in df.select(temperature_comfort_score(F.col("t"), 27, 5)).collect()]
    assert a == 100.0 and b < 100.0 and c < 60.0


def test_end_to_end_top3(spark):
    from tripforge.plans.registry import catalog
    from tripforge.operators.recommend import recommend
    from tripforge.sources.requests import parse_requests
    sf = "/root/testdata/sf0.001"
    req = spark.createDataFrame([(7, 6.0, 6.0, 6.0, 6.0, 4.0, "August", "Medium (Comfort)", "Warm", 3)],
                                "request_id long, food double, beach double, culture double, nature double, "
                                "nightlife double, month string, budget string, weather_preference string, top_n int")
    valid, _ = parse_requests(req)
    recs = recommend(valid, catalog(spark, sf)).orderBy("rank").collect()
    assert [r["rank"] for r in recs] == [1, 2, 3]
    for r in recs:
        assert r.recommendation_score <= 100
        assert r.cost_score == r.budget_match_score
        assert r.explanation and r.natural_reason
    scores = [r.recommendation_score for r in recs]
    assert scores == sorted(scores, reverse=True)


def test_top_n_is_prefix(spark):
    from tripforge.plans.registry import catalog
    from tripforge.operators.recommend import recommend
    from tripforge.sources.requests import parse_requests
    sf = "/root/testdata/sf0.001"
    rows = [(n, 8.0, 2.0, 5.0, 7.0, 1.0, "March", "Low (Essential)", "Mild", n) for n in (3, 4)]
    req = spark.createDataFrame(rows, "request_id long, food double, beach double, culture double, nature double, "
                                "nightlife double, month string, budget string, weather_preference string, top_n int")
    valid, _ = parse_requests(req)
    recs = recommend(valid, catalog(spark, sf)).collect()
    by = {n: [r.destination_name for r in sorted((r for r in recs if r.request_id == n), key=lambda r: r["rank"])]
          for n in (3, 4)}
    assert by[4][:3] == by[3]


def test_block_sizes_do_not_change_results(spark):
    from tripforge.plans.registry import catalog
    from tripforge.operators.recommend import recommend
    from tripforge.sources import standins
    from tripforge.sources.requests import parse_requests
    sf = "/root/testdata/sf0.001"
    valid, _ = parse_requests(standins.requests(spark, sf))
    cols = ["request_id", "rank", "destination_name", "recommendation_score"]
    a = sorted(tuple(r) for r in recommend(valid, catalog(spark, sf), with_texts=False).select(*cols).collect())
    b = sorted(tuple(r) for r in recommend(valid, catalog(spark, sf), sig_block=7, dest_block=3,
                                           with_texts=False).select(*cols).collect())
    assert a == b and len(a) > 0


def test_request_validation(spark):
    from tripforge.sources.requests import parse_requests
    req = spark.createDataFrame([(1, 11.0, 1.0, 1.0, 1.0, 1.0, "May", None, None, None),
                                 (2, 1.0, 1.0, 1.0, 1.0, 1.0, "Smarch", None, None, 5),
                                 (3, 1.0, 1.0, 1.0, 1.0, 1.0, " june ", None, None, 21),
                                 (4, 1.0, 1.0, 1.0, 1.0, 1.0, "JUNE", None, None, None)],
                                "request_id long, food double, beach double, culture double, nature double, "
                                "nightlife double, month string, budget string, weather_preference string, top_n int")
    valid, rejected = parse_requests(req)
    errs = {r.request_id: r.error for r in rejected.collect()}
    assert set(errs) == {1, 2, 3}
    assert "food must be between 0 and 10" in errs[1]
    assert errs[2].startswith("Invalid month 'Smarch'. Use one of: January")
    assert "top_n" in errs[3]
    v = valid.first()
    assert (v.request_id, v.season, v.budget, v.weather_preference, v.top_n) == (4, "summer", "Medium (Comfort)", "Any", 5)
