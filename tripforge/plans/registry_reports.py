"""Registered report / enrichment queries over the catalogue, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripforge import rules
from tripforge.operators import enrich, reports
from tripforge.plans import oracle

R4 = lambda e: oracle.R(e, 4)

PROFILE_COLS = [*rules.MODEL_FEATURES, *rules.SCORE_COLUMNS, "overall_score"]
DESCRIBE_COLS = list(rules.MODEL_FEATURES)
CORR_COLS = [*rules.MODEL_FEATURES, *rules.SCORE_COLUMNS]
FIT_PAIRS = [("restaurant_count", "bar_count"), ("summer_avg_temp", "beach_score"), ("museum_count", "culture_score")]
COHORT_MEASURES = ["summer_avg_temp", "food_score", "culture_score", "beach_score", "cost_of_living_index"]
NULL_COLS = ["destination_type", "summer_avg_temp", "winter_avg_temp", *rules.PLACE_COUNT_COLUMNS,
             "cost_of_living_index", "cost_level", "food_recommendation_signal"]


def _cat(spark, sf_dir):
    from tripforge.plans.registry import catalog
    return catalog(spark, sf_dir)


def _with(sql_body: str) -> str:
    return f"WITH {oracle.catalog_ctes()}\n{sql_body}"


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- queries
def q_profile(spark, sf):
    return reports.group_profile(_cat(spark, sf), "cluster_profile", PROFILE_COLS)


def o_profile():
    cols = ", ".join(f"{oracle.R(f'avg({c})')} AS {c}" for c in PROFILE_COLS)
    return _with(f"SELECT cluster_profile, {cols}, count(*) AS size FROM catalog GROUP BY cluster_profile")


def q_nulls(spark, sf):
    return reports.null_counts(_cat(spark, sf), NULL_COLS)


def o_nulls():
    return _with(_union([f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM catalog"
                         for c in NULL_COLS]))


def q_describe(spark, sf):
    return reports.describe(_cat(spark, sf), DESCRIBE_COLS)


def o_describe():
    parts = []
    for c in DESCRIBE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column, count({x}) AS count, {R4(f'avg({x})')} AS mean, {R4(f'stddev_samp({x})')} AS std, "
            f"{R4(f'min({x})')} AS min, {R4(f'quantile_cont({x}, 0.25)')} AS p25, {R4(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{R4(f'quantile_cont({x}, 0.75)')} AS p75, {R4(f'max({x})')} AS max FROM catalog")
    return _with(_union(parts))


def q_value_counts(spark, sf):
    return reports.value_counts(_cat(spark, sf), "dominant_travel_style")


def o_value_counts():
    return _with("SELECT CAST(dominant_travel_style AS VARCHAR) AS value, count(*) AS count FROM catalog GROUP BY 1")


def _pairs():
    return [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]


def _corr_sql(a, b):
    return R4(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))")


def q_corr(spark, sf):
    return reports.correlation_matrix(_cat(spark, sf), CORR_COLS)


def o_corr():
    parts = []
    for a, b in _pairs():
        parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_corr_sql(a, b)} AS correlation FROM catalog")
        parts.append(f"SELECT '{b}' AS column_a, '{a}' AS column_b, {_corr_sql(a, b)} AS correlation FROM catalog")
    parts += [f"SELECT '{c}' AS column_a, '{c}' AS column_b, 1.0 AS correlation" for c in CORR_COLS]
    return _with(_union(parts))


def q_strongest(spark, sf):
    return reports.strongest_pairs(_cat(spark, sf), CORR_COLS, top=15)


def o_strongest():
    parts = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_corr_sql(a, b)} AS correlation FROM catalog"
             for a, b in _pairs()]
    return _with(f"SELECT * FROM ({_union(parts)}) ORDER BY abs(correlation) DESC NULLS LAST, column_a, column_b LIMIT 15")


def q_fits(spark, sf):
    return reports.linear_fits(_cat(spark, sf), FIT_PAIRS)


def o_fits():
    parts = []
    for x, y in FIT_PAIRS:
        xc, yc = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
        parts.append(f"SELECT '{x}' AS x, '{y}' AS y, {R4(f'regr_slope({yc}, {xc})')} AS slope, "
                     f"{R4(f'regr_intercept({yc}, {xc})')} AS intercept, {R4(f'corr({xc}, {yc})')} AS correlation FROM catalog")
    return _with(_union(parts))


def q_box(spark, sf):
    return reports.box_summary(_cat(spark, sf), DESCRIBE_COLS)


def o_box():
    parts = []
    for c in DESCRIBE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column, {R4('q1')} AS q1, {R4('med')} AS median, {R4('q3')} AS q3,
  {R4('q3 - q1')} AS iqr,
  {R4(f'(SELECT min({x}) FROM catalog WHERE {x} >= q1 - 1.5 * (q3 - q1) AND {x} <= q3 + 1.5 * (q3 - q1))')} AS lower_whisker,
  {R4(f'(SELECT max({x}) FROM catalog WHERE {x} >= q1 - 1.5 * (q3 - q1) AND {x} <= q3 + 1.5 * (q3 - q1))')} AS upper_whisker,
  (SELECT count(*) FROM catalog WHERE {x} IS NOT NULL AND NOT ({x} >= q1 - 1.5 * (q3 - q1) AND {x} <= q3 + 1.5 * (q3 - q1))) AS outliers
FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS med, quantile_cont({x}, 0.75) AS q3 FROM catalog)""")
    return _with(_union(parts))


def q_hist(spark, sf):
    return reports.histogram(_cat(spark, sf), "summer_avg_temp", 8)


def o_hist():
    return _with("""SELECT b.bin, mm.lo + ((mm.hi - mm.lo) / 8) * b.bin AS bin_start,
       mm.lo + ((mm.hi - mm.lo) / 8) * (b.bin + 1) AS bin_end, count(c.summer_avg_temp) AS count
FROM (SELECT min(summer_avg_temp) AS lo, max(summer_avg_temp) AS hi FROM catalog) mm
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(8)) b
LEFT JOIN catalog c ON c.summer_avg_temp IS NOT NULL AND
     CAST(least(floor((c.summer_avg_temp - mm.lo) / (mm.hi - mm.lo) * 8), 7) AS INTEGER) = b.bin
GROUP BY b.bin, mm.lo, mm.hi""")


def q_cohort(spark, sf):
    return reports.cohort_vs_population(_cat(spark, sf), F.col("city_destination"), COHORT_MEASURES)


def o_cohort():
    parts = []
    for m in COHORT_MEASURES:
        c, p = f"avg(CASE WHEN city_destination THEN {m} END)", f"avg({m})"
        parts.append(f"SELECT '{m}' AS measure, {oracle.R(c)} AS cohort_mean, {oracle.R(p)} AS population_mean, "
                     f"{oracle.R(f'{c} - {p}')} AS difference FROM catalog")
    return _with(_union(parts))


def q_quality(spark, sf):
    return reports.feature_quality(_cat(spark, sf), counts=rules.PLACE_COUNT_COLUMNS)


def o_quality():
    parts = []
    for f in reports.BOOLEAN_FLAGS:
        share = f"greatest(count_if({f}), count_if(NOT {f})) / CAST(count(*) AS DOUBLE)"
        parts.append(f"SELECT '{f}' AS column, 'flag' AS kind, CAST(count_if({f}) AS BIGINT) AS true_count, "
                     f"CAST(count_if(NOT {f}) AS BIGINT) AS false_count, CAST(NULL AS BIGINT) AS zero_count, "
                     f"CAST(NULL AS BIGINT) AS null_count, {R4(share)} AS majority_share, "
                     f"{share} >= 0.9 AS near_constant, CAST(NULL AS BOOLEAN) AS has_zeros FROM catalog")
    for c in rules.PLACE_COUNT_COLUMNS:
        parts.append(f"SELECT '{c}' AS column, 'count' AS kind, CAST(NULL AS BIGINT) AS true_count, "
                     f"CAST(NULL AS BIGINT) AS false_count, CAST(count_if({c} = 0) AS BIGINT) AS zero_count, "
                     f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, CAST(NULL AS DOUBLE) AS majority_share, "
                     f"CAST(NULL AS BOOLEAN) AS near_constant, count_if({c} = 0) > 0 AS has_zeros FROM catalog")
    return _with(_union(parts))


def q_top_food(spark, sf):
    return reports.top_k(_cat(spark, sf), "food_score", 10).select("destination_name", "country", "food_score")


def o_top_food():
    return _with("SELECT destination_name, country, food_score FROM catalog "
                 "ORDER BY food_score DESC NULLS LAST, destination_name, country LIMIT 10")


def q_markers(spark, sf):
    return enrich.map_markers(_cat(spark, sf)).select(
        "destination_name", "country", "layer", "score", "colour", "marker_radius", "stars", "tooltip")


def o_markers():
    w = ("round_even((0.7 * least(greatest(100.0 - (abs(summer_avg_temp - 27.0) / 12.0 * 100.0), 0.0), 100.0)"
         " + 0.3 * least(greatest(100.0 - summer_avg_daily_rain * 20.0, 0.0), 100.0)) * 100.0, 0) / 100.0")
    parts = []
    for name, col, top in rules.MAP_LAYERS:
        score = w if col == "summer_weather_score" else col
        parts.append(f"SELECT destination_name, country, '{name}' AS layer, {score} AS score, '{top}' AS top_colour FROM catalog")
    return _with(f"""SELECT destination_name, country, layer, score,
  CASE WHEN score >= 80 THEN top_colour WHEN score >= 50 THEN 'orange' ELSE 'red' END AS colour,
  6.0 + score / 100.0 * 9.0 AS marker_radius,
  repeat('*', CAST(round_even(score / 20.0, 0) AS INTEGER)) || repeat('.', 5 - CAST(round_even(score / 20.0, 0) AS INTEGER)) AS stars,
  printf('%s - %s/100', destination_name, {oracle.sql_fmt1('score')}) AS tooltip
FROM ({_union(parts)})""")


def q_listing(spark, sf):
    return enrich.catalog_listing(_cat(spark, sf))


def o_listing():
    return _with(f"SELECT {', '.join(enrich.LISTING_COLUMNS)} FROM catalog")


QUERIES = {
    "cluster_profile_summary": (q_profile, o_profile),
    "null_counts": (q_nulls, o_nulls),
    "describe_model_features": (q_describe, o_describe),
    "travel_style_counts": (q_value_counts, o_value_counts),
    "feature_correlation_matrix": (q_corr, o_corr),
    "strongest_correlations": (q_strongest, o_strongest),
    "linear_fits": (q_fits, o_fits),
    "box_plot_summary": (q_box, o_box),
    "summer_temp_histogram": (q_hist, o_hist),
    "city_cohort_vs_population": (q_cohort, o_cohort),
    "feature_quality_report": (q_quality, o_quality),
    "top10_food_score": (q_top_food, o_top_food),
    "map_markers": (q_markers, o_markers),
    "catalog_listing": (q_listing, o_listing),
}
