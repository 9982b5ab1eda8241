"""Registered queries of collection, payloads, order, documents and checks, and their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import round_half_even
from tripforge.plans import oracle
from tripforge.sources import standins

KEY = ["destination_name", "country"]


def _cat(spark, sf):
    from tripforge.plans.registry import catalog
    return catalog(spark, sf)


def _recs(spark, sf):
    from tripforge.plans import registry
    return registry._recs(spark, sf)


# -------------------------------------------------------------- S5 payloads
def q_payload_weather(spark, sf):
    """Seasonal means from JSON payloads with parallel arrays."""
    from tripforge.operators.features import seasonal_features
    from tripforge.sources.catalog_io import explode_daily
    return seasonal_features(explode_daily(standins.weather_payloads(spark, sf), ["destination_id"]))


def o_payload_weather():
    from tripforge.plans.registry import o_seasonal_weather
    return o_seasonal_weather()


def q_payload_days(spark, sf):
    """Days per destination and month where an array is too short: its missing values are null."""
    from tripforge.sources.catalog_io import explode_daily
    d = explode_daily(standins.weather_payloads(spark, sf, shortened=True), ["destination_id"])
    return d.groupBy("destination_id", "month").agg(
        F.count(F.lit(1)).alias("days"), F.count("precipitation_sum").alias("rain_days"), F.max("day").alias("last_day"),
        round_half_even(F.sum("precipitation_sum"), 2).alias("rain"), round_half_even(F.avg("temperature_2m_mean"), 2).alias("temperature"))


def o_payload_days():
    inner = standins.DAILY_WEATHER_SQL.replace("FROM lineitem", ", l_orderkey, l_linenumber FROM lineitem")
    return f"""WITH d AS (SELECT *, month(day) AS m, row_number() OVER (PARTITION BY destination_id, month(day) ORDER BY day DESC, l_orderkey DESC, l_linenumber DESC) AS back
  FROM ({inner})),
e AS (SELECT destination_id, m, day, temperature_2m_mean AS t, CASE WHEN destination_id % 7 = 0 AND back = 1 THEN NULL ELSE precipitation_sum END AS r FROM d)
SELECT destination_id, CAST(m AS INTEGER) AS month, count(*) AS days, count(r) AS rain_days, max(day) AS last_day,
       {oracle.R('sum(r)')} AS rain, {oracle.R('avg(t)')} AS temperature FROM e GROUP BY destination_id, m"""


# --------------------------------------------------------- S8, U1 collection
def _collection_inputs(spark, sf):
    from tripforge.operators.features import resolve_destination_type
    base = standins.destinations(spark, sf)
    old = resolve_destination_type(base, radius_by_type=dict(standins.STANDIN_TYPE_RADIUS_M, region=1_500_000))
    return old, resolve_destination_type(base, radius_by_type=standins.STANDIN_TYPE_RADIUS_M)


def q_collection_runs(spark, sf):
    """Three runs into one stored table: an old radius for regions and failed mountains,
    then the current rules, then nothing left to do."""
    from tripforge.operators.spatial import poi_counts
    from tripforge.session import checkpoint_dir
    from tripforge.sources.collection import collect_run, stored_rows
    old, now = _collection_inputs(spark, sf)
    pois = standins.pois(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/collection-{uuid.uuid4().hex}"

    def failing(dest):
        got = poi_counts(dest, pois)
        bad = F.col("destination_type") == "mountain"
        return got.select(*[c for c in got.columns if c not in rules.PLACE_COUNT_COLUMNS],
                          *[F.when(~bad, F.col(c)).alias(c) for c in rules.PLACE_COUNT_COLUMNS])

    done = [collect_run(old, failing, path, 1), collect_run(now, lambda d: poi_counts(d, pois), path, 2),
            collect_run(now, lambda d: poi_counts(d, pois), path, 3)]
    rows = stored_rows(spark, path).select("destination_id", "fingerprint", *rules.PLACE_COUNT_COLUMNS, "run_id")
    return rows.select("*", *[F.lit(n).cast("long").alias(f"collected_in_run_{i + 1}") for i, n in enumerate(done)])


def o_collection_runs():
    counts = ", ".join(rules.PLACE_COUNT_COLUMNS)
    redone = "destination_type = 'mountain' OR destination_type = 'region'"
    coordinate = "CASE WHEN {0} IS NULL THEN '-' ELSE printf('%.4f', round({0}, 4) + 0.0) END"
    return f"""WITH {oracle.places_ctes()}
SELECT destination_id, coalesce(destination_type, '-') || '|' || search_radius_m || '|' || {coordinate.format('latitude')} || '|' || {coordinate.format('longitude')} AS fingerprint,
       {counts}, CASE WHEN {redone} THEN 2 ELSE 1 END AS run_id, (SELECT count(*) FROM places0) AS collected_in_run_1,
       (SELECT count(*) FROM places0 WHERE {redone}) AS collected_in_run_2, CAST(0 AS BIGINT) AS collected_in_run_3 FROM places0"""


# ----------------------------------------------------------- U2 column report
def q_new_columns(spark, sf):
    """What the feature build and the labels add to the table with places."""
    from tripforge.plans.catalog import with_places
    from tripforge.sources.collection import column_report
    report = column_report(with_places(spark, sf), _cat(spark, sf))
    return report.filter("change <> 'kept'").select("column", "type_after", "change")


def o_new_columns():
    names = {"DOUBLE": "double", "BIGINT": "bigint", "BOOLEAN": "boolean", "VARCHAR": "string", "INTEGER": "int"}
    kind = "CASE column_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"
    return f"""SELECT column_name AS column, {kind} AS type_after, 'new' AS change
FROM (DESCRIBE WITH {oracle.catalog_ctes()} SELECT * FROM catalog)
WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE WITH {oracle.places_ctes()} SELECT * FROM places))"""


# -------------------------------------------------------------- T2, P13, F8
def q_balanced_order(spark, sf):
    """Destinations by mean score, then least score, then name, with their place."""
    from tripforge.operators.ordering import ordered
    scores = [F.col(c) for c in rules.SCORE_COLUMNS]
    mean = sum(scores[1:], F.lit(0.0) + scores[0]) / F.lit(float(len(scores)))
    d = _cat(spark, sf).select(*KEY, round_half_even(mean, 2).alias("average_experience_score"), F.least(*scores).alias("minimum_experience_score"))
    return ordered(d, [("average_experience_score", False), ("minimum_experience_score", False), *[(c, True) for c in KEY]])


def o_balanced_order():
    mean = f"(0.0 + {' + '.join(rules.SCORE_COLUMNS)}) / {float(len(rules.SCORE_COLUMNS))!r}"
    return f"""WITH {oracle.catalog_ctes()},
s AS (SELECT destination_name, country, {oracle.R(mean)} AS average_experience_score, least({', '.join(rules.SCORE_COLUMNS)}) AS minimum_experience_score FROM catalog)
SELECT *, row_number() OVER (ORDER BY average_experience_score DESC NULLS LAST, minimum_experience_score DESC NULLS LAST, destination_name, country) AS row_number FROM s"""


ROUNDED = ["latitude", "longitude", "cost_of_living_index", "overall_score", "score_balance_std", "food_recommendation_signal"]


def q_rounded(spark, sf):
    """Every floating column of the catalogue at two digits."""
    from tripforge.operators.features import round_numeric
    return round_numeric(_cat(spark, sf).select("destination_id", *KEY, "restaurant_count", *ROUNDED), 2)


def o_rounded():
    return (f"WITH {oracle.catalog_ctes()}\nSELECT destination_id, destination_name, country, restaurant_count, "
            + ", ".join(f"{oracle.R(c)} AS {c}" for c in ROUNDED) + " FROM catalog")


def q_check_in(spark, sf):
    """F8: representative check-in of every order's month, seen from its date."""
    from tripforge.operators.costs import representative_check_in
    from tripforge.sources.catalog_io import read_table
    o = read_table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("as_of"),
                                               F.element_at(standins._arr(standins.MONTH_NAMES), (F.col("o_orderkey") % 12 + 1).cast("int")).alias("month"))
    return o.select("o_orderkey", "as_of", "month", representative_check_in(F.col("month"), F.col("as_of")).alias("check_in"))


def o_check_in():
    number = "CASE lower(month) " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(rules.MONTH_TO_SEASON)) + " END"
    return f"""SELECT o_orderkey, as_of, month, make_date(year(as_of) + 1, {number}, 15) AS check_in
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS as_of, {standins._sql_list(standins.MONTH_NAMES)}[(o_orderkey % 12) + 1] AS month FROM orders)"""


# ------------------------------------------------------------ S10 documents
ITEM = ["rank", "destination_name", "country", "recommendation_score"]


def q_documents(spark, sf):
    """One JSON document per request, ranked, the reason as an object."""
    from tripforge.sources.requests import recommendations_to_json
    return recommendations_to_json(_recs(spark, sf).select("request_id", *ITEM, "reason"))


def o_documents():
    from tripforge.plans.registry import REASON_FIELDS
    src = {"weather": "weather_score", "budget": "budget_match_score", "food": "food_recommendation_signal", "beach": "beach_recommendation_signal",
           "culture": "culture_recommendation_signal", "nature": "nature_recommendation_signal", "nightlife": "nightlife_recommendation_signal",
           "cluster_bonus": "cluster_bonus", "must_have_penalty": "must_have_penalty"}

    def item(name, value):
        return f"CASE WHEN {value} IS NOT NULL THEN '\"{name}\":' || {value} END"
    text = "'\"' || replace({0}, '\"', '\\\"') || '\"'"
    reason = ", ".join(item(f, oracle.R(src[f])) for f in REASON_FIELDS)
    fields = ", ".join([item("rank", "rank"), item("destination_name", text.format("destination_name")), item("country", text.format("country")),
                        item("recommendation_score", "recommendation_score"),
                        f"'\"reason\":{{' || array_to_string(list_filter([{reason}], lambda x: x IS NOT NULL), ',') || '}}'"])
    return f"""WITH {oracle.scored_ctes()},
items AS (SELECT request_id, rank, '{{' || array_to_string(list_filter([{fields}], lambda x: x IS NOT NULL), ',') || '}}' AS item FROM top)
SELECT request_id, '{{"request_id":' || request_id || ',"recommendations":[' || string_agg(item, ',' ORDER BY rank) || ']}}' AS json FROM items GROUP BY request_id"""


# ---------------------------------------------------------- J4, L7 check report
BASE = [*rules.PLACE_COUNT_COLUMNS, "food_score", "nightlife_score", "culture_score", "nature_score", "beach_score", "summer_avg_temp", "summer_avg_daily_rain"]
ATTACHED = ["recommendation_score", "preference_score", "weather_score", "explanation"]


def _recommended(spark, sf):
    """Catalogue rows that some request was recommended, then its scores."""
    from tripforge.operators.joins import semi_then_attach
    recs = _recs(spark, sf).filter("rank <= 3").select("request_id", "rank", *KEY, *ATTACHED)
    return semi_then_attach(_cat(spark, sf).select(*KEY, "cluster_profile", *BASE), None, recs, KEY)


def q_recommended(spark, sf):
    """L7, first part: recommended rows with their base scores."""
    return _recommended(spark, sf).select("request_id", "rank", *KEY, "cluster_profile", *BASE, *ATTACHED)


def o_recommended():
    cols = ", ".join(["request_id", "rank", *KEY, "cluster_profile", *BASE, *ATTACHED[:3]])
    return f"WITH {oracle.scored_ctes()}\nSELECT {cols}, {oracle.explanation_sql()} AS explanation FROM top WHERE rank <= 3"


def q_weather_check(spark, sf):
    """L7, second part: does a better weather score stand for warmer, drier summers? Per
    request, recommended rows by score beside their place by weather score."""
    d = _recommended(spark, sf)
    w = Window.partitionBy("request_id").orderBy(F.col("weather_score").desc_nulls_last(), "rank")  # three rows
    return d.select("request_id", "rank", *KEY, "recommendation_score", "summer_avg_temp", "summer_avg_daily_rain", "weather_score",
                    F.row_number().over(w).alias("weather_rank"))


def o_weather_check():
    return f"""WITH {oracle.scored_ctes()}
SELECT request_id, rank, destination_name, country, recommendation_score, summer_avg_temp, summer_avg_daily_rain, weather_score,
       CAST(row_number() OVER (PARTITION BY request_id ORDER BY weather_score DESC NULLS LAST, rank) AS INTEGER) AS weather_rank
FROM top WHERE rank <= 3"""


# ------------------------------------------------- S1-S3, P1, P2, T4, A11 stages
STAGE = [*KEY, "latitude", "longitude", *rules.PLACE_COUNT_COLUMNS, "summer_avg_temp", "overall_score"]


def q_stage_round_trip(spark, sf):
    """The catalogue written as CSV under an older column name, read with
    its schema, the name repaired, required columns checked; a missing cost table is no error."""
    from pyspark.sql import types as T

    from tripforge.operators.joins import coalesce_aliases, require_columns
    from tripforge.session import checkpoint_dir
    from tripforge.sources.catalog_io import read_catalog, read_optional, write_stage
    base = f"{checkpoint_dir(spark).rstrip('/')}/tables/stage-{uuid.uuid4().hex}"
    old = _cat(spark, sf).select(*STAGE).withColumnRenamed("nearby_beach_count", "beach_count")
    path = write_stage(old, f"{base}/catalog.csv", "csv")
    back = read_catalog(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in old.schema.fields]), "csv")
    back = coalesce_aliases(back, {"nearby_beach_count": ["beach_count", "beach_count_x"]})
    require_columns(back, STAGE)
    costs = read_optional(spark, f"{base}/travel_costs.parquet", T.StructType([T.StructField("destination_name", T.StringType())]))
    return back.select(*STAGE, F.lit(costs is not None).alias("has_travel_costs"))


def o_stage_round_trip():
    return f"WITH {oracle.catalog_ctes()}\nSELECT {', '.join(STAGE)}, false AS has_travel_costs FROM catalog"


def q_limited(spark, sf):
    """T4: the first 25 destinations by key."""
    from tripforge.operators.reports import limit_input
    return limit_input(_cat(spark, sf).select(*KEY, "overall_score"), 25)


def o_limited():
    return f"WITH {oracle.catalog_ctes()}\nSELECT destination_name, country, overall_score FROM catalog ORDER BY destination_name, country LIMIT 25"


def q_label_summary(spark, sf):
    """Clusters, noise and the largest cluster of the published labels; a missing label counts as noise."""
    from tripforge.operators.reports import label_summary
    return label_summary(_cat(spark, sf).select(F.coalesce("cluster", F.lit(-1)).alias("label")))


def o_label_summary():
    return f"""WITH {oracle.catalog_ctes()},
l AS (SELECT coalesce(cluster, -1) AS label, count(*) AS n FROM catalog GROUP BY 1)
SELECT count(*) FILTER (WHERE label <> -1) AS cluster_count, coalesce(sum(n) FILTER (WHERE label = -1), 0)::BIGINT AS noise_count,
       max(n) AS largest_cluster_size, max(n) FILTER (WHERE label <> -1) AS largest_cluster_size_without_noise FROM l"""


QUERIES = {
    "catalog_stage_round_trip": (q_stage_round_trip, o_stage_round_trip),
    "first_destinations": (q_limited, o_limited),
    "label_summary": (q_label_summary, o_label_summary),
    "weather_from_payloads": (q_payload_weather, o_payload_weather),
    "payload_days_unequal": (q_payload_days, o_payload_days),
    "collection_runs": (q_collection_runs, o_collection_runs),
    "feature_new_columns": (q_new_columns, o_new_columns),
    "balanced_destinations": (q_balanced_order, o_balanced_order),
    "catalog_rounded": (q_rounded, o_rounded),
    "order_check_in": (q_check_in, o_check_in),
    "recommendation_documents": (q_documents, o_documents),
    "recommended_base_scores": (q_recommended, o_recommended),
    "recommendation_weather_check": (q_weather_check, o_weather_check),
}
