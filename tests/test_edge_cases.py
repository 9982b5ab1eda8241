"""Edge-case rows from FIXTURES §6."""

from pyspark.sql import functions as F

from tripforge import rules

COUNTS = rules.PLACE_COUNT_COLUMNS


def _places(spark, rows):
    schema = ("destination_id long, destination_name string, country string, destination_type string, "
              + ", ".join(f"{s}_avg_temp double, {s}_avg_daily_rain double" for s in rules.SEASONS) + ", "
              + ", ".join(f"{c} long" for c in COUNTS))
    return spark.createDataFrame(rows, schema)


def test_all_null_counts_constant_columns_missing_temps(spark):
    from tripforge.operators.features import add_climate_features, add_experience_features, add_scores
    rows = [
        (1, "A", "X", None, None, None, 10.0, 1.0, None, 0.5, 12.0, 1.0, None, None, None, None, None, None),
        (2, "B", "X", "island", 11.0, 4.0, 15.0, 1.0, 25.0, 1.0, 18.0, 1.0, None, None, None, None, None, None),
    ]
    df = add_scores(_places(spark, rows))
    out = {r.destination_id: r for r in add_experience_features(add_climate_features(df)).collect()}
    # every count null -> raw scores null everywhere -> max null -> constant 0
    assert all(out[i][s] == 0.0 for i in (1, 2) for s in rules.SCORE_COLUMNS)
    # missing summer/winter temperature: flags False, category Mild (pandas comparison semantics)
    assert out[1].warm_destination is False and out[1].climate_category == "Mild"
    assert out[2].climate_category == "Warm" and out[2].rain_risk is True
    # constant score columns -> balanced, std 0, style Balanced (tie)
    assert out[1].score_balance_std == 0.0 and out[1].dominant_travel_style == "Balanced"
    assert out[1].food_scene_intensity is None  # a + b is null when either is null


def test_nan_weather_becomes_null(spark):
    from tripforge.operators.features import seasonal_features
    import datetime
    daily = spark.createDataFrame([(1, datetime.date(2024, 7, 1), float("nan"), 1.0),
                                   (1, datetime.date(2024, 7, 2), 30.0, float("nan"))],
                                  "destination_id long, day date, temperature_2m_mean double, precipitation_sum double")
    r = seasonal_features(daily).first()
    assert r.summer_avg_temp == 30.0 and r.summer_avg_daily_rain == 1.0


def test_unknowns_and_zero_preferences(spark):
    from tripforge.operators.recommend import budget_match_score, preference_weights
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, "Gold", None)],
                               "food double, beach double, culture double, nature double, nightlife double, "
                               "budget string, level string")
    w = preference_weights({p: F.col(p) for p in ["food", "beach", "culture", "nature", "nightlife"]})
    r = df.select(*[v.alias(k) for k, v in w.items()], budget_match_score(F.col("budget"), F.col("level")).alias("b")).first()
    assert [r[p] for p in ["food", "beach", "culture", "nature", "nightlife"]] == [0.2] * 5
    assert r.b == 70.0  # unknown budget -> Medium row; missing level -> 70
