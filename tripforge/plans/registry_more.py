"""Registered queries of texts, costs, models, streams and collection, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripforge import rules
from tripforge.sources import standins
from tripforge.sources.catalog_io import read_table


def _cat(spark, sf):
    from tripforge.plans.registry import catalog
    return catalog(spark, sf)


# ------------------------------------------------------------ preferences
PREFS = ["food", "beach", "culture", "nature", "nightlife"]


def _translated(spark, sf):
    from tripforge.operators.preferences import translate_answers
    return translate_answers(standins.answers(spark, sf), keywords=standins.STANDIN_KEYWORD_WEIGHTS, weather=standins.STANDIN_WEATHER_KEYWORDS)


def q_translate_answers(spark, sf):
    """X1-X7 with rules whose terms occur in the texts: words, phrases, similar words."""
    return _translated(spark, sf).select("answer_id", *PREFS, "weather_preference", F.array_join("matched_keywords", ",").alias("matched_keywords"), "error")


def o_translate_answers():
    from tripforge.plans import oracle
    return f"WITH RECURSIVE {oracle.translated_ctes()}\nSELECT answer_id, {', '.join(PREFS)}, weather_preference, matched_keywords, error FROM translated"


FACTS = ["summer_avg_temp", "summer_avg_daily_rain", "search_radius_m", "restaurant_count", "museum_count", "nearby_beach_count"]


def q_planner_recommendations(spark, sf):
    """Answers -> preferences -> recommendations -> fact columns."""
    from tripforge.operators.joins import enrich_missing
    from tripforge.operators.preferences import answers_to_requests
    from tripforge.operators.recommend import recommend
    from tripforge.session import cut_lineage
    from tripforge.sources.requests import parse_requests
    valid, _ = parse_requests(answers_to_requests(_translated(spark, sf)))
    valid = cut_lineage(valid, "planner_requests")  # read for the signatures and for the answers; translated once
    cat = _cat(spark, sf)
    recs = recommend(valid, cat).select("request_id", "rank", "destination_name", "country", "recommendation_score")
    return enrich_missing(recs, cat, ["destination_name", "country"], FACTS)


def o_planner_recommendations():
    from tripforge.plans import oracle
    requests = f"SELECT answer_id AS request_id, {', '.join(PREFS)}, month, budget, weather_preference, top_n FROM translated WHERE error = ''"
    return (f"WITH RECURSIVE {oracle.translated_ctes()},\n{oracle.scored_ctes(requests)}\n"
            f"SELECT request_id, rank, destination_name, country, recommendation_score, {', '.join(FACTS)} FROM top")


def q_conversation_signals(spark, sf):
    """X4/X5 over whole conversation turns."""
    from tripforge.operators.preferences import text_signals, text_terms
    conv = read_table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("id"), "text")
    rule = (standins.STANDIN_KEYWORD_WEIGHTS, standins.STANDIN_WEATHER_KEYWORDS)
    s = text_signals(text_terms(conv, "id", "text", *rule), *rule)
    return s.select("id.conv_id", "id.turn", F.array_join("matched_keywords", ",").alias("matched_keywords"), "text_weather",
                    *[F.col(f"text_weights.{p}").alias(f"w_{p}") for p in PREFS])


def o_conversation_signals():
    from tripforge.plans import oracle
    texts = "(SELECT {'conv_id': conv_id, 'turn': turn} AS id, any_value(text) AS text FROM conversations GROUP BY conv_id, turn)"
    return f"""WITH RECURSIVE {oracle.text_signal_ctes(texts, standins.STANDIN_KEYWORD_WEIGHTS, standins.STANDIN_WEATHER_KEYWORDS)}
SELECT id.conv_id AS conv_id, id.turn AS turn, array_to_string(matched, ',') AS matched_keywords, vote AS text_weather, {', '.join(f'w_{p}' for p in PREFS)} FROM signals"""


def q_similar_terms(spark, sf):
    """F4, UD1: words of all documents that a rule term resembles, with their ratio."""
    from tripforge.operators import terms as tm
    docs = read_table(spark, sf, "documents")
    low = F.lower(F.coalesce(F.col("text"), F.lit("")))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit("[a-zA-Z]+"), F.lit(0)))).alias("word")).distinct()
    listed = tm.all_terms(standins.STANDIN_KEYWORD_WEIGHTS, standins.STANDIN_WEATHER_KEYWORDS)
    table = tm.term_table(spark, listed).filter("pieces = 1 and length(term) >= 4").select("term")
    pairs = tm.fuzzy_candidates(words, table).withColumn("ratio", tm.ratcliff_ratio("word", "term"))
    return pairs.filter(F.col("ratio") >= rules.FUZZY_RATIO).select("word", "term", "ratio")


def o_similar_terms():
    from tripforge.operators import terms as tm
    from tripforge.plans.oracle import _lit
    listed = [t for t in tm.all_terms(standins.STANDIN_KEYWORD_WEIGHTS, standins.STANDIN_WEATHER_KEYWORDS) if " " not in t and len(t) >= 4]
    return f"""WITH RECURSIVE words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-zA-Z]+')) AS word FROM documents),
close AS (SELECT word, term FROM words, (VALUES {', '.join(f'({_lit(t)})' for t in listed)}) t(term)
  WHERE {tm.sql_close(rules.FUZZY_RATIO)}),
{tm.sql_ratcliff("close")}
SELECT word, term, ratio FROM ratcliff WHERE ratio >= {rules.FUZZY_RATIO}"""


QUERIES = {
    "translate_answers": (q_translate_answers, o_translate_answers),
    "planner_recommendations": (q_planner_recommendations, o_planner_recommendations),
    "conversation_text_signals": (q_conversation_signals, o_conversation_signals),
    "similar_rule_terms": (q_similar_terms, o_similar_terms),
}


# ------------------------------------------------------------------- costs
KEY = ["destination_name", "country"]
TRAVEL_COLUMNS = ["destination_name", "country", "month", "hotel_search_radius_km", "avg_hotel_price_eur",
                  "median_hotel_price_eur", "hotel_sample_size", "restaurant_meal_price_eur", "cappuccino_price_eur",
                  "groceries_basket_price_eur", "local_transport_price_eur", "numbeo_city_name",
                  "numbeo_contributors", "museum_or_attraction_price_eur", "attraction_price_coverage",
                  "hotel_price_score", "restaurant_price_score", "cafe_price_score", "groceries_price_score",
                  "attraction_price_score", "transport_price_score", "travel_cost_index", "travel_cost_level",
                  "cost_data_coverage"]


def q_keyword_prices(spark, sf):
    from tripforge.operators.costs import keyword_prices
    return keyword_prices(standins.price_payloads(spark, sf), KEY, keywords=standins.STANDIN_PRICE_KEYWORDS)


def q_hotel_stats(spark, sf):
    from tripforge.operators.costs import hotel_price_stats
    return hotel_price_stats(standins.hotel_offer_payloads(spark, sf), KEY)


def travel_costs(spark, sf):
    from tripforge.operators.costs import add_travel_cost_index, cost_records
    dest = standins.destinations(spark, sf)
    from tripforge.session import cut_lineage
    rec = cost_records(dest, q_keyword_prices(spark, sf), q_hotel_stats(spark, sf), KEY, "August", 3.0)
    # The min-max statistics and the final table both read the written records.
    return add_travel_cost_index(cut_lineage(rec, "cost_records"))


def q_travel_costs(spark, sf):
    return travel_costs(spark, sf).select(*TRAVEL_COLUMNS)


def q_catalog_travel_levels(spark, sf):
    from tripforge.operators.costs import add_cost_features
    cat = _cat(spark, sf).drop("cost_of_living_index", "cost_of_living_level", "cost_level")
    out = add_cost_features(cat, standins.living_costs(spark, sf), travel_costs(spark, sf))
    return out.select(*KEY, "cost_of_living_index", "cost_of_living_level", "travel_cost_index",
                      "travel_cost_level", "cost_data_coverage", "cost_level")


def _price_sql():
    from tripforge.plans.oracle import R
    cols = []
    for c, words in standins.STANDIN_PRICE_KEYWORDS.items():
        hit = " OR ".join(f"contains(item_name, '{w.lower()}')" for w in words)
        cols.append(f"{R(f'avg(CASE WHEN ({hit}) AND average_price IS NOT NULL THEN average_price END)')} AS {c}")
    return (f"SELECT destination_name, country, {', '.join(cols)}, max(numbeo_city_name) AS numbeo_city_name, "
            f"max(numbeo_contributors) AS numbeo_contributors FROM ({standins.PRICE_ITEMS_SQL}) GROUP BY 1, 2")


def _hotel_sql():
    from tripforge.plans.oracle import R
    return f"""SELECT destination_name, country, {R('avg(total)')} AS avg_hotel_price_eur,
  {R('CASE WHEN n % 2 = 1 THEN max(CASE WHEN rn = (n + 1) / 2 THEN total END) '
     'ELSE 0.5 * max(CASE WHEN rn = n / 2 THEN total END) + 0.5 * max(CASE WHEN rn = n / 2 + 1 THEN total END) END')}
    AS median_hotel_price_eur,
  CAST(count(total) AS INTEGER) AS hotel_sample_size
FROM (SELECT *, row_number() OVER (PARTITION BY destination_name, country ORDER BY total) AS rn,
             count(total) OVER (PARTITION BY destination_name, country) AS n
      FROM ({standins.HOTEL_OFFERS_SQL}) WHERE hotel_rank <= 20 AND total IS NOT NULL)
GROUP BY destination_name, country, n"""


def o_keyword_prices():
    return _price_sql()


def o_hotel_stats():
    return _hotel_sql()


def _travel_sql():
    from tripforge import rules
    from tripforge.plans.oracle import R
    sources = rules.TRAVEL_COST_SCORE_SOURCES
    stats = ", ".join(f"min({src}) AS lo_{s}, max({src}) AS hi_{s}" for s, src in sources.items())
    scores = ", ".join(
        f"CASE WHEN mm.lo_{s} IS NULL OR mm.lo_{s} = mm.hi_{s} THEN CAST(NULL AS DOUBLE) "
        f"ELSE {R(f'({src} - mm.lo_{s}) / (mm.hi_{s} - mm.lo_{s}) * 100.0')} END AS {s}"
        for s, src in sources.items())
    num = "(0.0" + "".join(f" + coalesce({s}, 0.0) * {w!r}" for s, w in rules.TRAVEL_COST_WEIGHTS.items()) + ")"
    den = "(0.0" + "".join(f" + CASE WHEN {s} IS NOT NULL THEN {w!r} ELSE 0.0 END" for s, w in rules.TRAVEL_COST_WEIGHTS.items()) + ")"
    idx = f"CASE WHEN {den} > 0 THEN {R(f'{num} / {den}')} END"
    cov = " + ".join(f"CAST({c} IS NOT NULL AS DOUBLE)" for c in
                     ["median_hotel_price_eur", "restaurant_meal_price_eur", "cappuccino_price_eur",
                      "groceries_basket_price_eur", "museum_or_attraction_price_eur", "local_transport_price_eur"])
    return f"""rec AS (
  SELECT d.destination_name, d.country, 'August' AS month, CAST(3.0 AS DOUBLE) AS hotel_search_radius_km,
         h.avg_hotel_price_eur, h.median_hotel_price_eur, coalesce(h.hotel_sample_size, 0) AS hotel_sample_size,
         p.restaurant_meal_price_eur, p.cappuccino_price_eur, p.groceries_basket_price_eur, p.local_transport_price_eur,
         p.numbeo_city_name, p.numbeo_contributors, CAST(NULL AS DOUBLE) AS museum_or_attraction_price_eur,
         '{rules.ATTRACTION_COVERAGE_NOTE}' AS attraction_price_coverage
  FROM ({standins.DESTINATIONS_SQL}) d LEFT JOIN ({_hotel_sql()}) h USING (destination_name, country)
       LEFT JOIN ({_price_sql()}) p USING (destination_name, country)),
scored AS (SELECT rec.*, {scores} FROM rec, (SELECT {stats} FROM rec) mm),
travel AS (SELECT *, {idx} AS travel_cost_index,
  CASE WHEN ({idx}) IS NULL THEN 'Unknown' WHEN ({idx}) < 35 THEN 'Budget' WHEN ({idx}) <= 65 THEN 'Mid-range' ELSE 'Luxury' END
    AS travel_cost_level,
  {R(f'({cov}) / 6')} AS cost_data_coverage FROM scored)"""


def o_travel_costs():
    return f"WITH {_travel_sql()}\nSELECT {', '.join(TRAVEL_COLUMNS)} FROM travel"


def o_catalog_travel_levels():
    col = ("CASE WHEN l.cost_of_living_index IS NULL THEN 'Unknown' WHEN l.cost_of_living_index < 45 THEN 'Budget' "
           "WHEN l.cost_of_living_index <= 65 THEN 'Mid-range' ELSE 'Luxury' END")
    return f"""WITH {_travel_sql()}
SELECT d.destination_name, d.country, l.cost_of_living_index, {col} AS cost_of_living_level, t.travel_cost_index,
       t.travel_cost_level, t.cost_data_coverage,
       CASE WHEN t.travel_cost_level IS NOT NULL AND t.travel_cost_level <> 'Unknown'
                 AND coalesce(t.cost_data_coverage, 0) > 0 THEN t.travel_cost_level ELSE {col} END AS cost_level
FROM ({standins.DESTINATIONS_SQL}) d LEFT JOIN travel t USING (destination_name, country)
     LEFT JOIN ({standins.LIVING_COSTS_SQL}) l USING (destination_name, country)"""


QUERIES.update({
    "keyword_price_means": (q_keyword_prices, o_keyword_prices),
    "hotel_price_stats": (q_hotel_stats, o_hotel_stats),
    "travel_cost_table": (q_travel_costs, o_travel_costs),
    "catalog_cost_levels_with_travel": (q_catalog_travel_levels, o_catalog_travel_levels),
})


# ---------------------------------------------------------------------- ML
def q_scaled_features(spark, sf):
    from tripforge import rules
    from tripforge.functions.expr import round_half_even
    from tripforge.operators.cluster import standard_scale
    scaled, _ = standard_scale(_cat(spark, sf))
    return scaled.select(*KEY, *[(round_half_even(F.col(c), 4) + F.lit(0.0)).alias(c) for c in rules.MODEL_FEATURES])


def o_scaled_features():
    from tripforge import rules
    from tripforge.plans import oracle
    cols = ", ".join(
        f"{oracle.R(f'(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER ()', 4)} + 0.0 AS {c}"
        for c in rules.MODEL_FEATURES)
    return f"WITH {oracle.catalog_ctes()}\nSELECT destination_name, country, {cols} FROM catalog"


def q_scaling_summary(spark, sf):
    from tripforge.operators.cluster import scaling_summary
    return scaling_summary(_cat(spark, sf))


def o_scaling_summary():
    from tripforge import rules
    from tripforge.plans import oracle
    parts = []
    for c in rules.MODEL_FEATURES:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS feature, {oracle.R(f'avg({x})', 4)} + 0.0 AS mean_before_scaling, "
                     f"{oracle.R(f'stddev_pop({x})', 4)} + 0.0 AS std_before_scaling, "
                     f"{oracle.R('avg(z)', 4)} + 0.0 AS mean_after_scaling, {oracle.R('stddev_pop(z)', 4)} + 0.0 AS std_after_scaling "
                     f"FROM (SELECT {c}, ({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER () AS z FROM catalog)")
    return f"WITH {oracle.catalog_ctes()}\n" + "\nUNION ALL\n".join(parts)


def q_embedding_silhouette(spark, sf):
    from tripforge.operators.cluster import silhouette
    emb = read_table(spark, sf, "embeddings")
    val = silhouette(emb, "embedding", "label")
    return spark.createDataFrame([(val,)], "silhouette_sq_euclidean double")


def o_embedding_silhouette():
    return """WITH p AS (SELECT vec_id, label AS lab, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT max(len(x)) AS dim FROM p),
st AS (SELECT lab, count(*) AS n, sum(list_sum(list_transform(x, lambda v: v * v))) AS q FROM p GROUP BY lab),
el AS (SELECT p.lab, t.i, sum(p.x[t.i]) AS s FROM p, d, range(1, 1 + d.dim) t(i) GROUP BY p.lab, t.i),
dots AS (SELECT p.vec_id, p.lab AS own, el.lab AS other, sum(p.x[el.i] * el.s) AS dot
         FROM p JOIN el ON true GROUP BY p.vec_id, p.lab, el.lab),
dist AS (SELECT dots.vec_id, dots.own, dots.other,
                list_sum(list_transform(p.x, lambda v: v * v)) - 2.0 * dots.dot / st.n + st.q / st.n AS dd, st.n
         FROM dots JOIN st ON st.lab = dots.other JOIN p ON p.vec_id = dots.vec_id),
pt AS (SELECT vec_id, max(CASE WHEN own = other THEN dd * n / (n - 1) END) AS a,
              min(CASE WHEN own <> other THEN dd END) AS b, max(CASE WHEN own = other THEN n END) AS own_n
       FROM dist GROUP BY vec_id)
SELECT round_even(avg(CASE WHEN own_n <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END) * 10000.0, 0) / 10000.0
       AS silhouette_sq_euclidean FROM pt"""


SWEEP_ITERATIONS, ASSIGNMENT_K = 20, (2, 3)


def q_kmeans_sweep(spark, sf):
    from tripforge.operators.cluster import kmeans_sweep
    return kmeans_sweep(_cat(spark, sf), max_iter=SWEEP_ITERATIONS)


def o_kmeans_sweep():
    """Silhouette by all pairs of squared distances within the best run of each k."""
    from tripforge import rules
    from tripforge.plans import oracle
    dist = " + ".join(f"(p.x[{i}] - q.x[{i}]) * (p.x[{i}] - q.x[{i}])" for i in range(1, len(rules.MODEL_FEATURES) + 1))
    missing = " OR ".join(f"{c} IS NULL" for c in rules.MODEL_FEATURES)
    return f"""WITH {oracle.catalog_ctes()},
{oracle.label_ctes(rules.K_VALUES, "sweep", max_iter=SWEEP_ITERATIONS)},
sizes AS (SELECT k, cluster, count(*) AS n FROM sweep GROUP BY k, cluster),
pairs AS (SELECT p.k, p.destination_name, p.country, p.cluster AS own, q.cluster AS other, sum({dist}) AS total, count(*) AS n
          FROM sweep p JOIN sweep q ON p.k = q.k GROUP BY ALL),
pt AS (SELECT k, destination_name, country, max(CASE WHEN own = other THEN n END) AS own_n,
              max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b
       FROM pairs GROUP BY k, destination_name, country),
sil AS (SELECT k, avg(CASE WHEN own_n <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END) AS s FROM pt GROUP BY k)
SELECT k, {oracle.R('max(inertia)', 4)} AS inertia, {oracle.R('max(s)', 4)} AS silhouette_sq_euclidean,
       (SELECT count(*) FROM feat3 WHERE {missing}) AS rows_dropped
FROM sweep JOIN sil USING (k) GROUP BY k"""


def q_clustered_catalog(spark, sf):
    """The full labels of k = 3 (the catalogue itself carries the published ones)."""
    from tripforge.operators.cluster import clustered_catalog
    return clustered_catalog(_cat(spark, sf), max_iter=SWEEP_ITERATIONS).select(*KEY, "cluster", "cluster_profile")


def o_clustered_catalog():
    from tripforge.plans import oracle
    return f"WITH {oracle.catalog_ctes()}\nSELECT destination_name, country, cluster, cluster_profile FROM catalog"


def _labels(spark, sf):
    from tripforge.operators.cluster import cluster_labels
    from tripforge.session import cut_lineage
    return cut_lineage(cluster_labels(_cat(spark, sf), ASSIGNMENT_K, max_iter=SWEEP_ITERATIONS), "labels")


def q_assignments(spark, sf):
    """Assignments of k = 2 and 3 in the order k, cluster, destination."""
    from tripforge import rules
    from tripforge.operators.cluster import ASSIGNMENT_COLUMNS, cluster_assignments
    out = cluster_assignments(_cat(spark, sf), _labels(spark, sf))
    return out.select("row_number", "k", *KEY, "cluster", *ASSIGNMENT_COLUMNS, *rules.MODEL_FEATURES)


def _assigned_ctes():
    from tripforge.plans import oracle
    return f"{oracle.catalog_ctes()},\n{oracle.label_ctes(ASSIGNMENT_K, 'assigned', max_iter=SWEEP_ITERATIONS)}"


def o_assignments():
    from tripforge import rules
    from tripforge.operators.cluster import ASSIGNMENT_COLUMNS
    cols = ", ".join([*ASSIGNMENT_COLUMNS, *rules.MODEL_FEATURES])
    return f"""WITH {_assigned_ctes()}
SELECT row_number() OVER (ORDER BY a.k, a.cluster, destination_name, country) AS row_number, a.k, destination_name, country, a.cluster, {cols}
FROM assigned a JOIN catalog c USING (destination_name, country)"""


def q_model_profiles(spark, sf):
    """M8 on model clusters."""
    from tripforge.operators.cluster import cluster_profiles
    return cluster_profiles(_cat(spark, sf), _labels(spark, sf))


def o_model_profiles():
    from tripforge.operators.cluster import PROFILE_MEASURES
    from tripforge.plans import oracle
    cols = ", ".join(f"{oracle.R(f'avg({c})')} AS {c}" for c in PROFILE_MEASURES)
    return f"""WITH {_assigned_ctes()}
SELECT a.k, a.cluster, {cols}, count(*) AS destination_count FROM assigned a JOIN catalog c USING (destination_name, country) GROUP BY a.k, a.cluster"""


def q_pca(spark, sf):
    """M10 at six digits: two components of every destination and their shares of the variance."""
    from tripforge.functions.expr import round_half_even
    from tripforge.operators.cluster import pca_2d
    out, ratio = pca_2d(_cat(spark, sf))
    return out.select(*KEY, *[(round_half_even(F.col(c), 6) + F.lit(0.0)).alias(c) for c in ("PC1", "PC2")],
                      *[round_half_even(F.lit(r), 6).alias(f"pc{i + 1}_variance_ratio") for i, r in enumerate(ratio)])


def o_pca():
    """The covariance matrix squared twelve times over, so that its first direction alone is left; then again without it."""
    from tripforge.plans import oracle
    n = len(rules.MODEL_FEATURES)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in rules.MODEL_FEATURES)
    scaled = ", ".join(f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) OVER () = 0 THEN 0.0::DOUBLE ELSE (CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) "
                       f"/ stddev_pop(CAST({c} AS DOUBLE)) OVER () END" for c in rules.MODEL_FEATURES)
    ctes = [oracle.catalog_ctes(), f"z AS MATERIALIZED (SELECT destination_name, country, [{scaled}] AS x FROM catalog WHERE {whole})",
            f"m1_0 AS MATERIALIZED (SELECT i, j, sum(x[i] * x[j]) AS v FROM z, range(1, {n + 1}) a(i), range(1, {n + 1}) b(j) GROUP BY i, j)"]
    for c in (1, 2):
        for t in range(12):
            ctes.append(f"m{c}_{t + 1} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) / (SELECT max(abs(v)) FROM m{c}_{t}) / (SELECT max(abs(v)) FROM m{c}_{t}) AS v "
                        f"FROM m{c}_{t} a JOIN m{c}_{t} b ON a.j = b.i GROUP BY a.i, b.j)")
        ctes.append(f"""d{c} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS w FROM m{c}_12 WHERE j = (SELECT i FROM m{c}_12 WHERE i = j ORDER BY v DESC, i LIMIT 1))""")
        ctes.append(f"p{c} AS MATERIALIZED (SELECT list(w * s ORDER BY i) AS w FROM d{c}, (SELECT CASE WHEN w >= 0 THEN 1 ELSE -1 END AS s FROM d{c} ORDER BY abs(w) DESC, i LIMIT 1))")
        ctes.append(f"l{c} AS MATERIALIZED (SELECT sum(p.w[m.i] * m.v * p.w[m.j]) AS v FROM m1_0 m, p{c} p)")
        if c == 1:
            ctes.append("m2_0 AS MATERIALIZED (SELECT i, j, m.v - l.v * p.w[i] * p.w[j] AS v FROM m1_0 m, l1 l, p1 p)")
    dots = [" + ".join(f"x[{i}] * p{c}.w[{i}]" for i in range(1, n + 1)) for c in (1, 2)]
    ratios = ", ".join(f"(SELECT {oracle.R(f'l{c}.v / (SELECT sum(v) FROM m1_0 WHERE i = j)', 6)} FROM l{c}) AS pc{c}_variance_ratio" for c in (1, 2))
    return f"""WITH {', '.join(ctes)}
SELECT c.destination_name, c.country, {oracle.R(dots[0], 6)} + 0.0 AS PC1, {oracle.R(dots[1], 6)} + 0.0 AS PC2, {ratios}
FROM catalog c LEFT JOIN z USING (destination_name, country), p1, p2"""


def q_compare_models(spark, sf):
    from tripforge.operators.cluster import compare_models
    return compare_models(_cat(spark, sf), max_iter=SWEEP_ITERATIONS)


QUERIES.update({
    "ml_scaled_features": (q_scaled_features, o_scaled_features),
    "ml_scaling_summary": (q_scaling_summary, o_scaling_summary),
    "embedding_silhouette": (q_embedding_silhouette, o_embedding_silhouette),
    "kmeans_k_sweep": (q_kmeans_sweep, o_kmeans_sweep),
    "clustered_catalog_k3": (q_clustered_catalog, o_clustered_catalog),
    "kmeans_assignments": (q_assignments, o_assignments),
    "kmeans_cluster_profiles": (q_model_profiles, o_model_profiles),
    "pca_2d": (q_pca, o_pca),
    "clustering_comparison": (q_compare_models, None),
})


# ---------------------------------------------------------------- streaming
def q_streamed_recommendations(spark, sf):
    """ST1: the same recommendations, produced by a Structured Streaming query."""
    import uuid
    from tripforge.plans.registry import REC_COLUMNS
    from tripforge.streaming.requests import read_sink, run_to_completion
    sink = run_to_completion(spark, sf, _cat(spark, sf), f"requests-{uuid.uuid4().hex}")
    return read_sink(spark, sink).select(*REC_COLUMNS)


def o_streamed_recommendations():
    from tripforge.plans.registry import o_recommend
    return o_recommend()


QUERIES.update({"streamed_recommendations": (q_streamed_recommendations, o_streamed_recommendations)})


# ------------------------------------------------------------ S4, S8, J9
def q_geocode(spark, sf):
    from tripforge.sources.incremental import geocode
    dest = standins.destinations(spark, sf).drop("latitude", "longitude")
    return geocode(dest, standins.gazetteer(spark, sf)).select("destination_id", "search_name", "country",
                                                                "latitude", "longitude")


def o_geocode():
    return f"""WITH g AS ({standins.GAZETTEER_SQL}),
r AS (SELECT lower(trim(search_name)) AS n, lower(trim(country)) AS c, lat, lon,
             row_number() OVER (PARTITION BY lower(trim(search_name)), lower(trim(country))
                                ORDER BY importance DESC, lat ASC, lon ASC) AS rk FROM g)
SELECT d.destination_id, d.search_name, d.country, r.lat AS latitude, r.lon AS longitude
FROM ({standins.DESTINATIONS_SQL}) d LEFT JOIN r ON r.rk = 1 AND r.n = lower(trim(d.search_name))
     AND r.c = lower(trim(d.country))"""


def q_incremental_poi_counts(spark, sf):
    """A stored run made with an older radius table (regions 1500 km)
    and failed collections for mountains; only those rows are recomputed."""
    from tripforge import rules
    from tripforge.operators.features import resolve_destination_type
    from tripforge.operators.spatial import poi_counts
    from tripforge.sources.incremental import pending, upsert
    base = standins.destinations(spark, sf)
    old_radius = dict(standins.STANDIN_TYPE_RADIUS_M, region=1_500_000)
    prev_dest = resolve_destination_type(base, radius_by_type=old_radius)
    prev = poi_counts(prev_dest, standins.pois(spark, sf))
    failed = F.col("destination_type") == "mountain"
    prev = prev.select("destination_id", "destination_type", "search_radius_m",
                       F.col("latitude").alias("place_latitude"), F.col("longitude").alias("place_longitude"),
                       *[F.when(failed, F.lit(None).cast("long")).otherwise(F.col(c)).alias(c)
                         for c in rules.PLACE_COUNT_COLUMNS], F.lit(1).alias("run_id"))
    cur = resolve_destination_type(base, radius_by_type=standins.STANDIN_TYPE_RADIUS_M)
    todo = pending(cur, prev)
    fresh = poi_counts(todo, standins.pois(spark, sf)).select(
        "destination_id", "destination_type", "search_radius_m", F.col("latitude").alias("place_latitude"),
        F.col("longitude").alias("place_longitude"), *rules.PLACE_COUNT_COLUMNS, F.lit(2).alias("run_id"))
    return upsert(prev, fresh).select("destination_id", "search_radius_m", *rules.PLACE_COUNT_COLUMNS)


def o_incremental_poi_counts():
    from tripforge.plans.registry import o_poi_counts
    return o_poi_counts()


def q_similar(spark, sf):
    from tripforge.operators.joins import similar_in_group
    cat = _cat(spark, sf)
    out = similar_in_group(cat, "cluster_profile", "destination_name", "overall_score", KEY, k=3)
    return out.select(*KEY, "cluster_profile", F.array_join("similar_destinations", "|").alias("similar_destinations"))


def o_similar():
    from tripforge.plans import oracle
    return f"""WITH {oracle.catalog_ctes()},
r AS (SELECT cluster_profile, destination_name,
             row_number() OVER (PARTITION BY cluster_profile ORDER BY overall_score DESC NULLS LAST, destination_name) AS rk
      FROM catalog)
SELECT c.destination_name, c.country, c.cluster_profile,
       coalesce(array_to_string(list(r.destination_name ORDER BY r.rk)[1:3], '|'), '') AS similar_destinations
FROM catalog c LEFT JOIN r ON r.cluster_profile = c.cluster_profile
     AND r.destination_name <> c.destination_name
GROUP BY c.destination_name, c.country, c.cluster_profile"""


QUERIES.update({
    "geocode_gazetteer": (q_geocode, o_geocode),
    "incremental_poi_counts": (q_incremental_poi_counts, o_incremental_poi_counts),
    "similar_destinations": (q_similar, o_similar),
})


# -------------------------------------------------------------- L1-L4
GUIDE_TEXTS, GUIDE_LISTS = ("airport", "stay", "best_months"), ("dont_miss", "highlights", "good_to_know")


def q_enriched(spark, sf):
    """Cards with all six guide fields."""
    from tripforge.operators.enrich import enrich_recommendations
    from tripforge.plans.registry import _recs
    e = enrich_recommendations(_recs(spark, sf), "Solo", standins.guides(spark, sf))
    facts = F.array_join(F.transform("facts", lambda f: F.concat_ws(":", f.level, f.label, f.detail)), "|")
    return e.select("request_id", "rank", F.array_join("tags", "|").alias("tags"), facts.alias("facts"),
                    "travel_story", "rating", "match_percent", "friendly_profile", "best_for",
                    *[F.col(f"guide.{f}").alias(f"guide_{f}") for f in GUIDE_TEXTS],
                    *[F.array_join(f"guide.{f}", "|").alias(f"guide_{f}") for f in GUIDE_LISTS])


def _level_sql(x, levels, default):
    arms = " ".join(f"WHEN {x} >= {b} THEN '{lab}'" for b, lab in levels)
    return f"CASE {arms} ELSE '{default}' END"


def o_enriched():
    from tripforge import rules
    from tripforge.plans import oracle
    R = oracle.R
    rw, rb, rf = R("weather_score"), R("budget_match_score"), R("food_recommendation_signal")
    rbe, rc = R("beach_recommendation_signal"), R("culture_recommendation_signal")
    rn, rni = R("nature_recommendation_signal"), R("nightlife_recommendation_signal")
    tag_list = (f"list_filter([CASE WHEN {rbe} >= 80 THEN 'Excellent beaches' WHEN {rbe} >= 60 THEN 'Beach friendly' END, "
                f"CASE WHEN {rf} >= 80 THEN 'Amazing food' WHEN {rf} >= 60 THEN 'Great food' END, "
                f"CASE WHEN {rw} >= 80 THEN 'Excellent weather' WHEN {rw} >= 60 THEN 'Good weather' END, "
                f"CASE WHEN {rn} >= 80 THEN 'Nature escapes' WHEN {rc} >= 80 THEN 'Culture rich' "
                f"WHEN {rni} >= 80 THEN 'Nightlife' END], lambda x: x IS NOT NULL)")
    tags = f"CASE WHEN len({tag_list}) = 0 THEN 'Balanced match' ELSE array_to_string(({tag_list})[1:3], '|') END"
    beach_lvl = _level_sql("coalesce(nearby_beach_count, 0)", rules.BEACH_ACCESS_LEVELS, rules.BEACH_ACCESS_DEFAULT)
    km = "(search_radius_m / 1000.0)"
    radius = (f"CASE WHEN search_radius_m IS NULL OR search_radius_m <= 0 THEN 'adaptive radius' "
              f"WHEN {km} = floor({km}) THEN printf('within %d km', CAST(floor({km}) AS BIGINT)) "
              f"ELSE printf('within %s km', {oracle.sql_fmt1(km)}) END")
    food_lvl = _level_sql(f"coalesce({rf}, 0.0)", rules.SCORE_LEVELS, rules.SCORE_LEVEL_DEFAULT)
    cult_lvl = _level_sql(f"coalesce({rc}, 0.0)", rules.SCORE_LEVELS, rules.SCORE_LEVEL_DEFAULT)
    bud_lvl = _level_sql(f"coalesce({rb}, 0.0)", rules.BUDGET_LEVELS, rules.BUDGET_LEVEL_DEFAULT)
    wx_lvl = _level_sql(f"coalesce({rw}, 0.0)", rules.WEATHER_LEVELS, rules.WEATHER_LEVEL_DEFAULT)
    facts = (f"{beach_lvl} || ':Beach access:' || {radius} || '|' || {food_lvl} || ':Food scene:restaurants and cafes|' || "
             f"{cult_lvl} || ':Culture:museums nearby|' || {bud_lvl} || ':Budget fit:' || "
             f"printf('Destination cost: %s<br>Cost-of-living proxy', coalesce(cost_level, 'Unknown')) || '|' || "
             f"{wx_lvl} || ':Summer weather:' || printf('%sC, %s mm rain/day', "
             f"{oracle.sql_fmt1('summer_avg_temp')}, {oracle.sql_fmt1('summer_avg_daily_rain')})")
    friendly = "CASE " + " ".join(f"WHEN cluster_profile = '{k}' THEN '{v}'" for k, v in rules.FRIENDLY_CLUSTER_LABELS.items()) + " ELSE cluster_profile END"
    best_for = "CASE " + " ".join(f"WHEN cluster_profile = '{k}' THEN '{v}'" for k, v in rules.BEST_FOR_TEXT.items()) + f" ELSE '{rules.BEST_FOR_DEFAULT}' END"
    default = rules.GUIDE_DEFAULT
    stay = f"coalesce(g.stay, {oracle._lit(default['stay'])})"
    guide = ", ".join([f"coalesce(g.{f}, {oracle._lit(default[f])}) AS guide_{f}" for f in GUIDE_TEXTS]
                      + [f"array_to_string(coalesce(g.{f}, {standins._sql_list(default[f])}), '|') AS guide_{f}" for f in GUIDE_LISTS])
    story = (f"printf('%s is a strong choice if you want a %s with %s beach access, a %s food scene, and %s seasonal weather. "
             f"It works especially well for %s travellers who want a trip that feels easy to plan but still has "
             f"enough variety for %s.', destination_name, lower({friendly}), lower({beach_lvl}), lower({food_lvl}), "
             f"lower({wx_lvl}), lower('Solo'), {stay})")
    return (f"WITH {oracle.scored_ctes()}\nSELECT request_id, rank, {tags} AS tags, {facts} AS facts, {story} AS travel_story, "
            f"4.0 + recommendation_score / 100.0 AS rating, CAST(round_even(recommendation_score, 0) AS INTEGER) AS match_percent, "
            f"{friendly} AS friendly_profile, {best_for} AS best_for, {guide} FROM top LEFT JOIN ({standins.guides_sql()}) g USING (destination_name)")


QUERIES.update({"recommendation_cards": (q_enriched, o_enriched)})


# ------------------------------------------------------------------------ L7
CHECK_MEASURES = ["food_recommendation_signal", "beach_recommendation_signal", "culture_recommendation_signal",
                  "summer_avg_temp", "summer_avg_daily_rain", "cost_of_living_index", "overall_score"]


def q_check_report(spark, sf):
    """Destinations ranked first for at least one request (semi-join, J4)
    against the whole catalogue (A20)."""
    from tripforge.operators.reports import cohort_vs_population
    from tripforge.plans.registry import _recs
    cat = _cat(spark, sf)
    top1 = _recs(spark, sf).where(F.col("rank") == 1).select(*KEY).distinct()
    flagged = cat.join(top1.withColumn("recommended", F.lit(True)), KEY, "left").fillna({"recommended": False})
    return cohort_vs_population(flagged, F.col("recommended"), CHECK_MEASURES)


def o_check_report():
    from tripforge.plans import oracle
    parts = []
    for m in CHECK_MEASURES:
        c, p = f"avg(CASE WHEN recommended THEN {m} END)", f"avg({m})"
        parts.append(f"SELECT '{m}' AS measure, {oracle.R(c)} AS cohort_mean, {oracle.R(p)} AS population_mean, "
                     f"{oracle.R(f'{c} - {p}')} AS difference FROM flagged")
    return (f"WITH {oracle.scored_ctes()},\n"
            "flagged AS (SELECT c.*, (c.destination_name, c.country) IN "
            "(SELECT (destination_name, country) FROM top WHERE rank = 1) AS recommended FROM catalog c)\n"
            + "\nUNION ALL\n".join(parts))


QUERIES.update({"recommendation_check_report": (q_check_report, o_check_report)})


def q_ward(spark, sf):
    from tripforge.operators.cluster import ward_clusters
    return ward_clusters(_cat(spark, sf), 3)


QUERIES.update({"ward_clusters_k3": (q_ward, None)})
