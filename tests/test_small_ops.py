"""Small operators of SURVEY §2."""

import datetime

import pytest
from pyspark.sql import functions as F


def test_alias_repair_required_columns_and_projection(spark):
    from tripforge.operators.joins import coalesce_aliases, require_columns, select_existing
    df = spark.createDataFrame([(1, 5)], "id long, nearby_beach_count_y long")
    out = coalesce_aliases(df, {"nearby_beach_count": ["beach_count", "nearby_beach_count_x", "nearby_beach_count_y"]})
    assert out.first().nearby_beach_count == 5
    with pytest.raises(KeyError, match="Missing cost_level"):
        require_columns(out, ["id", "cost_level"])
    assert select_existing(out, ["nearby_beach_count", "nope", "id"]).columns == ["nearby_beach_count", "id"]


def test_one_to_one_join_rejects_duplicates(spark):
    from tripforge.operators.joins import JoinValidationError, left_join_1to1
    a = spark.createDataFrame([("x", "c", 1), ("y", "c", 2)], "destination_name string, country string, v int")
    b = spark.createDataFrame([("x", "c", 10), ("x", "c", 11)], "destination_name string, country string, w int")
    with pytest.raises(JoinValidationError, match="right"):
        left_join_1to1(a, b, ["destination_name", "country"])
    ok = left_join_1to1(a, b.limit(1), ["destination_name", "country"]).orderBy("v").collect()
    assert [(r.v, r.w) for r in ok] == [(1, 10), (2, None)]


def test_lookup_with_default(spark):
    from tripforge.operators.joins import lookup_with_default
    df = spark.createDataFrame([("Nice",), ("Oslo",)], "destination_name string")
    t = spark.createDataFrame([("Nice", "3-5 days")], "k string, stay string")
    out = {r.destination_name: r.stay for r in lookup_with_default(df, t, "destination_name", "k", "stay", "stay", "3-5 days").collect()}
    assert out == {"Nice": "3-5 days", "Oslo": "3-5 days"}


def test_labels_radius_stars_checkin(spark):
    from tripforge.operators.costs import representative_check_in
    from tripforge.operators.enrich import beach_access_level, radius_label, score_level, star_rating
    df = spark.createDataFrame([(3000, 60, 80.0, "August"), (2500, 21, 59.99, " march "), (None, 5, 35.0, "May"),
                                (0, 6, 10.0, "December")], "r int, b int, s double, m string")
    out = df.select(radius_label(F.col("r")).alias("rl"), beach_access_level(F.col("b")).alias("bl"),
                    score_level(F.col("s")).alias("sl"), star_rating(F.col("s")).alias("st"),
                    representative_check_in(F.col("m"), F.lit(datetime.date(2026, 3, 1))).alias("d")).collect()
    assert [r.rl for r in out] == ["within 3 km", "within 2.5 km", "adaptive radius", "adaptive radius"]
    assert [r.bl for r in out] == ["Excellent", "High", "Low", "Moderate"]
    assert [r.sl for r in out] == ["Excellent", "Moderate", "Moderate", "Limited"]
    assert [r.st for r in out] == ["****.", "***..", "**...", "....."]  # round half to even: 1.75->2, 0.5->0
    assert [r.d for r in out] == [datetime.date(2027, 8, 15), datetime.date(2027, 3, 15),
                                  datetime.date(2027, 5, 15), datetime.date(2027, 12, 15)]


def test_tags_from_reason(spark):
    from tripforge.operators.enrich import tags_from_reason
    schema = "reason struct<weather double, budget double, food double, beach double, culture double, nature double, nightlife double>"
    df = spark.createDataFrame([((85.0, 0.0, 65.0, 90.0, 95.0, 10.0, 99.0),), ((10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),)], schema)
    got = [r[0] for r in df.select(tags_from_reason()).collect()]
    assert got == [["Excellent beaches", "Great food", "Excellent weather"], ["Balanced match"]]


def test_round_numeric_new_columns_limit(spark):
    from tripforge.operators.features import round_numeric
    from tripforge.operators.reports import limit_input
    from tripforge.sources.incremental import new_columns
    df = spark.createDataFrame([("b", "x", 2.675, 1), ("a", "x", 0.125, 2)], "destination_name string, country string, v double, n int")
    r = round_numeric(df).orderBy("destination_name").collect()
    assert [x.v for x in r] == [0.12, 2.68] and r[0].n == 2
    assert [x.destination_name for x in limit_input(df, 1).collect()] == ["a"]
    after = df.withColumn("w", F.lit(1.0)).withColumn("flag", F.lit(True))
    assert [(x.column, x.type) for x in new_columns(df, after).collect()] == [("w", "double"), ("flag", "boolean")]


def test_catalog_assembly_and_json_output(spark, sample):
    import json
    from tripforge.operators.features import add_scores
    from tripforge.operators.recommend import recommend
    from tripforge.plans.catalog import assemble_catalog, feature_chain
    from tripforge.sources.requests import parse_requests, recommendations_to_json
    places = add_scores(sample.drop("cost_of_living_index", "cluster_profile"))
    feats = feature_chain(places, sample.select("destination_name", "country", "cost_of_living_index"))
    cat = assemble_catalog(feats, sample.select("destination_name", "country", "cluster_profile"))
    cat = cat.withColumn("destination_id", F.xxhash64("destination_name", "country"))
    assert cat.count() == 20 and cat.where(F.col("cluster_profile").isNull()).count() == 0
    req = spark.createDataFrame([(1, 8.0, 9.0, 3.0, 6.0, 4.0, "August", None, None, 2)],
                                "request_id long, food double, beach double, culture double, nature double, "
                                "nightlife double, month string, budget string, weather_preference string, top_n int")
    valid, _ = parse_requests(req)
    doc = json.loads(recommendations_to_json(recommend(valid, cat)).first().json)
    assert [r["destination_name"] for r in doc["recommendations"]] == ["Mallorca", "Split"]
    assert doc["recommendations"][0]["reason"]["beach"] == 100.0


def test_stage_write_optional_read_and_json_requests(spark, tmp_path):
    from pyspark.sql import types as T
    from tripforge.sources.catalog_io import read_optional, write_stage
    from tripforge.sources.requests import parse_requests, requests_from_json
    schema = T.StructType([T.StructField("destination_name", T.StringType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([("a", 1.0), ("b", 2.5)], schema)
    for fmt, name in (("parquet", "stage"), ("csv", "stage.csv")):
        path = write_stage(df, str(tmp_path / name), fmt=fmt)
        back = read_optional(spark, path, schema, fmt=fmt)
        assert sorted(tuple(r) for r in back.collect()) == [("a", 1.0), ("b", 2.5)]
    assert read_optional(spark, str(tmp_path / "missing"), schema) is None
    bodies = spark.createDataFrame([('{"request_id": 1, "food": 8, "beach": 9, "culture": 3, "nature": 6, '
                                     '"nightlife": 4, "month": "August"}',),
                                    ('{"request_id": 2, "food": 1, "month": "Nope"}',)], "body string")
    valid, rejected = parse_requests(requests_from_json(bodies))
    v = valid.first()
    assert (v.request_id, v.season, v.budget, v.weather_preference, v.top_n) == (1, "summer", "Medium (Comfort)", "Any", 5)
    err = rejected.first().error
    assert "beach must be between 0 and 10" in err and "Invalid month 'Nope'" in err
