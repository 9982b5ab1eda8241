"""DuckDB oracle SQL for the registered queries.

The oracle is an independent, brute-force formulation over the same driver
tables: whole-table windows instead of the bucketed rank, an all-pairs
distance filter instead of the grid join. It shares only the stand-in input
expressions and the rounding formula (``round_even(x * 100, 0) / 100``).
"""

from __future__ import annotations

from tripforge import rules
from tripforge.functions.expr import sql_fmt1, sql_haversine_m, sql_round  # noqa: F401
from tripforge.operators.lloyd import sql_lloyd
from tripforge.operators.ranking import sql_pct_rank_avg
from tripforge.operators.terms import WORD, sql_close, sql_ratcliff
from tripforge.plans.catalog import PROFILE_ITERATIONS, PROFILE_K
from tripforge.sources import standins

R = sql_round


def _case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {expr} = {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {arms} ELSE {default} END"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _season_case(month_expr: str) -> str:
    arms = " ".join(f"WHEN {month_expr} IN ({', '.join(map(str, ms))}) THEN '{s}'"
                    for s, ms in rules.SEASON_MONTHS.items())
    return f"CASE {arms} END"


def _tag_rules_values() -> str:
    rows = ", ".join(f"({_lit(f)}, {_lit(k)}, {_lit(v)})" for f, (k, v) in rules.PLACE_FEATURES.items())
    return f"(VALUES {rows}) AS tr(feature, tag_key, tag_value)"


def places_ctes() -> str:
    radius = _case_map("destination_type", standins.STANDIN_TYPE_RADIUS_M, str(standins.STANDIN_DEFAULT_RADIUS_M))
    weather_cols = []
    for s, months in rules.SEASON_MONTHS.items():
        cond = f"month(day) IN ({', '.join(map(str, months))})"
        weather_cols.append(f"{R(f'avg(CASE WHEN {cond} THEN temperature_2m_mean END)')} AS {s}_avg_temp")
        weather_cols.append(f"{R(f'avg(CASE WHEN {cond} THEN precipitation_sum END)')} AS {s}_avg_daily_rain")
    counts = ",\n       ".join(
        f"count(*) FILTER (WHERE pf.feature = '{f}') AS {f}" for f in rules.PLACE_COUNT_COLUMNS)
    coalesced = ", ".join(f"CAST(coalesce(c.{f}, 0) AS BIGINT) AS {f}" for f in rules.PLACE_COUNT_COLUMNS)
    dist = sql_haversine_m("d.latitude", "d.longitude", "pf.lat", "pf.lon")
    score_raw = {s: " + ".join(cols) for s, cols in rules.SCORE_FEATURES.items()}
    maxes = ", ".join(f"max({raw}) AS mx_{s}" for s, raw in score_raw.items())
    scores = ", ".join(
        f"CASE WHEN mx.mx_{s} IS NULL OR mx.mx_{s} = 0 THEN 0.0 ELSE {R(f'({raw}) / CAST(mx.mx_{s} AS DOUBLE) * 100.0')} END AS {s}"
        for s, raw in score_raw.items())
    return f"""
dest0 AS ({standins.DESTINATIONS_SQL}),
dest AS (SELECT *, CAST({radius} AS INTEGER) AS search_radius_m FROM dest0),
daily AS ({standins.DAILY_WEATHER_SQL}),
weather AS (SELECT destination_id, {', '.join(weather_cols)} FROM daily GROUP BY destination_id),
poi AS ({standins.POIS_SQL}),
pf AS (SELECT poi.lat, poi.lon, tr.feature FROM poi JOIN {_tag_rules_values()}
       ON poi.tag_key = tr.tag_key AND poi.tag_value = tr.tag_value),
counts AS (SELECT d.destination_id, {counts}
       FROM dest d JOIN pf ON {dist} <= d.search_radius_m GROUP BY d.destination_id),
places0 AS (SELECT d.*, {', '.join(f'w.{s}_avg_temp, w.{s}_avg_daily_rain' for s in rules.SEASONS)}, {coalesced}
       FROM dest d LEFT JOIN weather w USING (destination_id) LEFT JOIN counts c USING (destination_id)),
places AS (SELECT places0.*, {scores} FROM places0, (SELECT {maxes} FROM places0) mx)"""


def catalog_ctes() -> str:
    """CTE chain ending in ``catalog`` (one row per destination)."""
    st, wt = "summer_avg_temp", "winter_avg_temp"
    rains = ", ".join(f"{s}_avg_daily_rain" for s in rules.SEASONS)
    climate = (f"CASE WHEN coalesce({st} >= {rules.WARM_SUMMER_TEMP} AND {wt} >= {rules.CLIMATE_WARM_WINTER}, false) THEN 'Warm' "
               f"WHEN coalesce({st} < {rules.CLIMATE_COOL_SUMMER} OR {wt} < {rules.CLIMATE_COOL_WINTER}, false) THEN 'Cool' ELSE 'Mild' END")
    coastal = ", ".join(_lit(t) for t in rules.COASTAL_TYPES)
    urban = "(restaurant_count + cafe_count + bar_count + museum_count)"
    mm_specs = {
        "food_scene_intensity": "(restaurant_count + cafe_count)",
        "nightlife_intensity": "bar_count",
        "cultural_density": "museum_count",
        "nature_density": "(park_count + nearby_beach_count)",
    }
    mm_stats = ", ".join(f"min({e}) AS lo_{n}, max({e}) AS hi_{n}" for n, e in mm_specs.items())
    mm_cols = ", ".join(
        f"CASE WHEN mm.lo_{n} = mm.hi_{n} THEN 0.0 ELSE {R(f'({e} - mm.lo_{n}) / CAST(mm.hi_{n} - mm.lo_{n} AS DOUBLE) * 100.0')} END AS {n}"
        for n, e in mm_specs.items())
    sc = rules.SCORE_COLUMNS
    mean = f"((0.0 + {' + '.join(sc)}) / 5)"
    std = f"sqrt((0.0 + {' + '.join(f'({c} - {mean}) * ({c} - {mean})' for c in sc)}) / 4)"
    fn = "((food_score + nightlife_score) / 2)"
    best = f"greatest(beach_score, nature_score, culture_score, {fn})"
    second = f"list_sort([beach_score, nature_score, culture_score, {fn}], 'DESC')[2]"
    best_label = (f"CASE WHEN beach_score = {best} THEN 'Beach' WHEN nature_score = {best} THEN 'Nature' "
                  f"WHEN culture_score = {best} THEN 'Culture' ELSE 'Food & Nightlife' END")
    style = f"CASE WHEN {best} - {second} <= {rules.STYLE_MARGIN} THEN 'Balanced' ELSE {best_label} END"
    col_level = ("CASE WHEN cost_of_living_index IS NULL THEN 'Unknown' WHEN cost_of_living_index < 45 THEN 'Budget' "
                 "WHEN cost_of_living_index <= 65 THEN 'Mid-range' ELSE 'Luxury' END")
    signals = {
        "food_recommendation_signal": "(restaurant_count + cafe_count)",
        "nightlife_recommendation_signal": "bar_count",
        "culture_recommendation_signal": "museum_count",
        "nature_recommendation_signal": "(park_count + nearby_beach_count)",
        "beach_recommendation_signal": "nearby_beach_count",
    }
    sig_cols = ", ".join(f"{sql_pct_rank_avg(e)} AS {n}" for n, e in signals.items())
    return f"""{places_ctes()},
feat1 AS (SELECT *,
       coalesce({st} >= {rules.WARM_SUMMER_TEMP}, false) AS warm_destination,
       coalesce({wt} < {rules.COLD_WINTER_TEMP}, false) AS cold_destination,
       coalesce({st} >= {rules.WARM_SUMMER_TEMP} AND summer_avg_daily_rain <= {rules.SUMMER_MAX_RAIN}, false) AS summer_destination,
       coalesce({wt} < {rules.COLD_WINTER_TEMP}, false) AS winter_destination,
       coalesce(greatest({rains}) > {rules.RAIN_RISK_RAIN}, false) AS rain_risk,
       {climate} AS climate_category,
       coalesce(destination_type, 'city') = 'island' AS island_destination,
       coalesce(destination_type, 'city') = 'mountain' AS mountain_destination,
       coalesce(destination_type, 'city') IN ({coastal}) AS coastal_destination,
       coalesce({sql_pct_rank_avg(urban, digits=None, scale=1.0)} >= {rules.CITY_PERCENTILE}, false) AS city_destination
     FROM places),
feat2 AS (SELECT feat1.*, {mm_cols},
       {R(mean)} AS overall_score, {R(std)} AS score_balance_std,
       coalesce({R(std)} <= {rules.BALANCED_STD}, false) AS balanced_destination,
       {style} AS dominant_travel_style
     FROM feat1, (SELECT {mm_stats} FROM feat1) mm),
living AS ({standins.LIVING_COSTS_SQL}),
feat3 AS (SELECT feat2.*, living.cost_of_living_index, CASE WHEN living.country IS NOT NULL THEN 'stand-in from account balance' END AS cost_data_note,
       {col_level} AS cost_of_living_level, {col_level} AS cost_level
     FROM feat2 LEFT JOIN living USING (destination_name, country)),
{label_ctes()},
catalog AS (SELECT feat3.*, {sig_cols}, lab.cluster, lab.cluster_profile
     FROM feat3 LEFT JOIN labels lab USING (destination_name, country))"""


KEY = ["destination_name", "country"]


def label_ctes(k_values=(PROFILE_K,), name: str = "labels", n_init: int = rules.N_INIT, max_iter: int = PROFILE_ITERATIONS) -> str:
    """CTEs ending in ``name`` (k, key, cluster, cluster_profile, x, inertia): the K-means
    runs over ``feat3`` and the names of their clusters."""
    urban = "restaurant_count + cafe_count + bar_count + museum_count"
    return f"""{sql_lloyd("feat3", KEY, rules.MODEL_FEATURES, k_values, n_init, max_iter, f"{name}_km")},
{name}_mean AS (SELECT k, cluster, avg({urban}) AS u, avg(summer_avg_temp) AS t FROM {name}_km_labels JOIN feat3 USING (destination_name, country) GROUP BY k, cluster),
{name}_urban AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY u DESC, cluster) AS ru FROM {name}_mean),
{name}_names AS (SELECT k, cluster, CASE WHEN ru = 1 THEN '{rules.PROFILE_URBAN}'
       WHEN row_number() OVER (PARTITION BY k, ru = 1 ORDER BY t DESC NULLS LAST, cluster) = 1 THEN '{rules.PROFILE_WARM_COASTAL}'
       ELSE '{rules.PROFILE_COOL_NATURE}' END AS cluster_profile FROM {name}_urban),
{name} AS (SELECT * FROM {name}_km_labels JOIN {name}_names USING (k, cluster))"""


CATALOG_COLUMNS = [
    "destination_id", "destination_name", "country", "destination_type", "search_radius_m",
    *[f"{s}_avg_temp" for s in rules.SEASONS], *[f"{s}_avg_daily_rain" for s in rules.SEASONS],
    *rules.PLACE_COUNT_COLUMNS, *rules.SCORE_COLUMNS,
    "warm_destination", "cold_destination", "summer_destination", "winter_destination", "rain_risk",
    "climate_category", "island_destination", "mountain_destination", "coastal_destination",
    "city_destination", "food_scene_intensity", "nightlife_intensity", "cultural_density",
    "nature_density", "overall_score", "score_balance_std", "balanced_destination",
    "dominant_travel_style", "cost_of_living_index", "cost_of_living_level", "cost_level",
    *rules.PREFERENCE_COLUMNS.values(), "cluster", "cluster_profile",
]


# ------------------------------------------------------------------ requests
def valid_requests_ctes(requests_sql: str = standins.REQUESTS_SQL) -> str:
    months = ", ".join(m.title() for m in rules.MONTH_TO_SEASON)
    season = _case_map("lower(trim(month))", rules.MONTH_TO_SEASON)
    pref_err = " , ".join(
        f"CASE WHEN {p} IS NULL OR {p} < 0 OR {p} > 10 OR isnan({p}) THEN '{p} must be between 0 and 10' END"
        for p in ["food", "beach", "culture", "nature", "nightlife"])
    return f"""
req0 AS ({requests_sql}),
req1 AS (SELECT request_id, food, beach, culture, nature, nightlife, month,
       coalesce(budget, '{rules.DEFAULT_BUDGET}') AS budget,
       coalesce(weather_preference, '{rules.DEFAULT_WEATHER_PREFERENCE}') AS weather_preference,
       coalesce(top_n, 5) AS top_n, {season} AS season FROM req0),
req2 AS (SELECT *, array_to_string(list_filter([{pref_err},
       CASE WHEN month IS NULL THEN 'month is required' END,
       CASE WHEN month IS NOT NULL AND season IS NULL THEN printf('Invalid month ''%s''. Use one of: {months}.', month) END,
       CASE WHEN top_n < 1 OR top_n > 20 THEN 'top_n must be between 1 and 20' END], lambda x: x IS NOT NULL), '; ') AS error
     FROM req1),
valid AS (SELECT * EXCLUDE (error) FROM req2 WHERE error = '')"""


def _weather_sql(temp: str, rain: str, mode: str, beach: str) -> str:
    rain_score = f"CASE WHEN {rain} IS NULL THEN NULL ELSE least(greatest(100.0 - {rain} * 20.0, 0.0), 100.0) END"
    ideal = f"CASE WHEN {beach} >= 7 THEN 27.0 ELSE 22.0 END"
    linear = f"CASE WHEN {temp} IS NULL THEN NULL ELSE least(greatest(100.0 - (abs({temp} - {ideal}) / 12.0 * 100.0), 0.0), 100.0) END"
    arms = []
    for name, prof in rules.WEATHER_COMFORT_PROFILES.items():
        dist = f"(({temp} - {float(prof['ideal_temp'])!r}) / {float(prof['tolerance'])!r})"
        gauss = R(f"exp(-0.5 * ({dist} * {dist})) * 100.0")
        arms.append(f"WHEN {mode} = '{name}' THEN {R(f'0.75 * {gauss} + 0.25 * {rain_score}')}")
    return f"CASE {' '.join(arms)} ELSE {R(f'0.7 * {linear} + 0.3 * {rain_score}')} END"


def _budget_sql(budget: str, level: str) -> str:
    arms = []
    for b, levels in rules.BUDGET_MATCH_MATRIX.items():
        for lv, score in levels.items():
            arms.append(f"WHEN {budget} = {_lit(b)} AND {level} = {_lit(lv)} THEN {score}")
    known = ", ".join(_lit(b) for b in rules.BUDGET_MATCH_MATRIX)
    for lv, score in rules.BUDGET_MATCH_MATRIX[rules.DEFAULT_BUDGET].items():
        arms.append(f"WHEN ({budget} IS NULL OR {budget} NOT IN ({known})) AND {level} = {_lit(lv)} THEN {score}")
    return f"CAST(CASE {' '.join(arms)} ELSE {rules.UNKNOWN_LEVEL_BUDGET_SCORE} END AS DOUBLE)"


def scored_ctes(requests_sql: str = standins.REQUESTS_SQL) -> str:
    """Valid requests x catalogue with all R2-R8 columns (brute force)."""
    total = "(r.food + r.beach + r.culture + r.nature + r.nightlife)"
    w = {p: f"(CASE WHEN {total} = 0 THEN {1.0 / 5!r} ELSE r.{p} / {total} END)"
         for p in ["food", "beach", "culture", "nature", "nightlife"]}
    pref = "(0.0" + "".join(f" + c.{sig} * {w[p]}" for p, sig in rules.PREFERENCE_COLUMNS.items()) + ")"
    temp = "CASE r.season " + " ".join(f"WHEN '{s}' THEN c.{s}_avg_temp" for s in rules.SEASONS) + " END"
    rain = "CASE r.season " + " ".join(f"WHEN '{s}' THEN c.{s}_avg_daily_rain" for s in rules.SEASONS) + " END"
    bonus = (f"CAST(CASE WHEN c.cluster_profile = '{rules.PROFILE_WARM_COASTAL}' AND r.beach >= 7 THEN 5 "
             f"WHEN c.cluster_profile = '{rules.PROFILE_URBAN}' AND (r.food + r.culture + r.nightlife) / 3 >= 7 THEN 5 "
             f"WHEN c.cluster_profile = '{rules.PROFILE_COOL_NATURE}' AND r.nature >= 7 THEN 5 ELSE 0 END AS DOUBLE)")
    pen = "0.0"
    for p, sig in rules.PREFERENCE_COLUMNS.items():
        pen += (f" + CASE WHEN r.{p} >= 7 AND c.{sig} < 40.0 THEN 30.0 * ((40.0 - c.{sig}) / 40.0) * (r.{p} / 10.0) ELSE 0.0 END")
    pen += f" + CASE WHEN r.beach >= 7 AND NOT coalesce(c.cluster_profile = '{rules.PROFILE_WARM_COASTAL}', false) THEN 8.0 ELSE 0.0 END"
    pen += f" + CASE WHEN r.nature >= 7 AND coalesce(c.cluster_profile = '{rules.PROFILE_URBAN}', false) THEN 6.0 ELSE 0.0 END"
    final = R('0.6 * preference_score + 0.2 * weather_score + 0.15 * budget_match_score + cluster_bonus - must_have_penalty')
    return f"""{catalog_ctes()},
{valid_requests_ctes(requests_sql)},
pairs AS (SELECT r.request_id, r.season, r.top_n, r.food AS p_food, r.beach AS p_beach, r.culture AS p_culture,
       r.nature AS p_nature, r.nightlife AS p_nightlife, c.*,
       {pref} AS preference_score,
       {_weather_sql(temp, rain, 'lower(trim(r.weather_preference))', 'r.beach')} AS weather_score,
       {_budget_sql('r.budget', 'c.cost_level')} AS budget_match_score,
       {bonus} AS cluster_bonus,
       {R(pen)} AS must_have_penalty
     FROM valid r, catalog c),
scored AS (SELECT *, budget_match_score AS cost_score,
       CASE WHEN {final} > 100 THEN 100.0 ELSE {final} END AS recommendation_score
     FROM pairs),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY recommendation_score DESC NULLS LAST,
       destination_name, country, destination_id) AS INTEGER) AS rank FROM scored),
top AS (SELECT * FROM ranked WHERE rank <= top_n)"""


def explanation_sql() -> str:
    frags = [f"CASE WHEN p_{p} >= 7 AND {sig} >= 60 THEN 'strong {p} match' END"
             for p, sig in rules.PREFERENCE_COLUMNS.items()]
    temp = "CASE season " + " ".join(f"WHEN '{s}' THEN {s}_avg_temp" for s in rules.SEASONS) + " END"
    rain = "CASE season " + " ".join(f"WHEN '{s}' THEN {s}_avg_daily_rain" for s in rules.SEASONS) + " END"
    frags.append(f"CASE WHEN weather_score >= 75 THEN printf('good %s weather (%sC, %s mm rain/day)', season, "
                 f"{sql_fmt1(temp)}, {sql_fmt1(rain)}) END")
    frags.append("CASE WHEN cluster_profile IS NOT NULL THEN 'belongs to ' || cluster_profile END")
    lst = f"list_filter([{', '.join(frags)}], lambda x: x IS NOT NULL)"
    return (f"CASE WHEN len({lst}) = 0 THEN 'balanced match across the selected preferences' "
            f"ELSE array_to_string({lst}[1:4], '; ') END")


def natural_reason_sql() -> str:
    main = f"list_filter([{', '.join(f'CASE WHEN p_{p} >= 7 THEN {_lit(p)} END' for p in rules.REQUEST_PREFERENCE_ORDER)}], lambda x: x IS NOT NULL)"
    main_text = f"CASE WHEN len({main}) = 0 THEN 'your selected preferences' ELSE array_to_string({main}, ' and ') END"
    strengths = [
        "CASE WHEN weather_score >= 75 THEN 'good seasonal weather' END",
        "CASE WHEN food_recommendation_signal >= 60 THEN 'a strong food scene' END",
        "CASE WHEN beach_recommendation_signal >= 60 THEN 'strong beach availability' END",
        "CASE WHEN nature_recommendation_signal >= 60 THEN 'good nature access' END",
        "CASE WHEN culture_recommendation_signal >= 60 THEN 'strong cultural attractions' END",
        "CASE WHEN nightlife_recommendation_signal >= 60 THEN 'good nightlife' END",
        "CASE WHEN budget_match_score >= 80 THEN 'a ' || coalesce(cost_level, 'balanced') || ' cost profile' END",
    ]
    lst = f"list_filter([{', '.join(strengths)}], lambda x: x IS NOT NULL)"
    st_text = f"CASE WHEN len({lst}) = 0 THEN 'a balanced profile across the selected criteria' ELSE array_to_string({lst}[1:3], ', ') END"
    return (f"printf('%s was recommended because it matches %s, with %s, and belongs to the %s profile for %s travel.', "
            f"destination_name, {main_text}, {st_text}, coalesce(cluster_profile, 'None'), season)")


# ------------------------------------------------------------- text signals
def text_signal_ctes(texts: str, keywords: dict, weather: dict, ratio: float = rules.FUZZY_RATIO,
                     min_len: int = rules.FUZZY_MIN_TERM_LENGTH) -> str:
    """CTEs (for WITH RECURSIVE) ending in ``signals`` (id, matched array of groups, w_*, vote)
    of ``texts`` (id, text): every text against every term."""
    groups = [(g, i, t) for i, (g, cfg) in enumerate(keywords.items()) for t in cfg["terms"]]
    votes = [(g, i, t) for i, (g, ts) in enumerate(weather.items()) for t in ts]
    values = ", ".join(f"('k', {_lit(g)}, {i}, {_lit(t)})" for g, i, t in groups) + ", " + ", ".join(f"('w', {_lit(g)}, {i}, {_lit(t)})" for g, i, t in votes)
    weights = ", ".join(
        f"coalesce(sum(CASE grp {' '.join(f'WHEN {_lit(g)} THEN {cfg['weights'].get(p, 0)}' for g, cfg in keywords.items())} END), 0) AS w_{p}"
        for p in ("food", "beach", "culture", "nature", "nightlife"))
    return f"""rule(kind, grp, place, term) AS (VALUES {values}),
low AS (SELECT id, lower(coalesce(text, '')) AS t FROM {texts}),
tokens AS (SELECT DISTINCT id, unnest(regexp_extract_all(t, '[a-zA-Z]+')) AS word FROM low),
close AS (SELECT DISTINCT word, term FROM (SELECT DISTINCT word FROM tokens), (SELECT DISTINCT term FROM rule WHERE NOT contains(term, ' ') AND length(term) >= {min_len})
     WHERE {sql_close(ratio)}),
{sql_ratcliff("close")},
matched AS (
  SELECT DISTINCT id, term FROM low, (SELECT DISTINCT term FROM rule) WHERE CASE WHEN contains(term, ' ') THEN contains(t, term)
         ELSE list_contains(regexp_extract_all(t, '[{WORD}]+'), term) END
  UNION SELECT id, term FROM tokens JOIN ratcliff USING (word) WHERE ratio >= {ratio}),
fired AS (SELECT DISTINCT id, grp, place FROM matched JOIN rule USING (term) WHERE kind = 'k'),
weighed AS (SELECT id, list(grp ORDER BY place) AS matched, {weights} FROM fired GROUP BY id),
voted AS (SELECT id, arg_min(grp, (-n, place)) AS vote FROM (SELECT id, grp, place, count(DISTINCT term) AS n FROM matched JOIN rule USING (term) WHERE kind = 'w'
     GROUP BY id, grp, place) GROUP BY id),
signals AS (SELECT low.id, coalesce(matched, []) AS matched, {', '.join(f'coalesce(w_{p}, 0) AS w_{p}' for p in ("food", "beach", "culture", "nature", "nightlife"))}, vote
     FROM low LEFT JOIN weighed USING (id) LEFT JOIN voted USING (id))"""


def translated_ctes() -> str:
    """CTEs (for WITH RECURSIVE) ending in ``translated``: the stand-in answers as preferences."""
    unknown = "list_filter(activities, lambda x: NOT list_contains([" + ", ".join(map(_lit, rules.ACTIVITY_WEIGHTS)) + "], x))"
    prefs = []
    for p in ("food", "beach", "culture", "nature", "nightlife"):
        def pick(expr, table, p=p):
            return "CASE " + expr + " " + " ".join(f"WHEN {_lit(k)} THEN {v.get(p, 0)}" for k, v in table.items()) + " END"
        steps = f"list_concat([{pick('companion', rules.TRAVEL_COMPANION_WEIGHTS)}], list_transform(activities, lambda x: {pick('x', rules.ACTIVITY_WEIGHTS)}), [CAST(w_{p} AS INTEGER)])"
        start = pick("trip_style", rules.TRIP_STYLES)
        prefs.append(f"CASE WHEN error = '' THEN CAST(list_reduce(list_concat([{start}], {steps}), lambda x, d: least(greatest(x + d, {rules.PREFERENCE_MIN}), {rules.PREFERENCE_MAX})) AS DOUBLE) END AS {p}")
    return f"""answers AS ({standins.ANSWERS_SQL}),
{text_signal_ctes("(SELECT answer_id AS id, trip_description AS text FROM answers)", standins.STANDIN_KEYWORD_WEIGHTS, standins.STANDIN_WEATHER_KEYWORDS)},
checked AS (SELECT a.*, s.*, array_to_string(list_filter([
       CASE WHEN trip_style NOT IN ({', '.join(map(_lit, rules.TRIP_STYLES))}) THEN printf('unknown trip style ''%s''', trip_style) END,
       CASE WHEN companion NOT IN ({', '.join(map(_lit, rules.TRAVEL_COMPANION_WEIGHTS))}) THEN printf('unknown companion ''%s''', companion) END,
       CASE WHEN len({unknown}) > 0 THEN 'unknown activities: ' || array_to_string({unknown}, ', ') END], lambda x: x IS NOT NULL), '; ') AS error
     FROM answers a JOIN signals s ON a.answer_id = s.id),
translated AS (SELECT answer_id, {', '.join(prefs)}, CASE WHEN climate_preference <> 'Any' THEN climate_preference ELSE coalesce(vote, climate_preference) END AS weather_preference,
       array_to_string(matched, ',') AS matched_keywords, error, month, budget, top_n
     FROM checked JOIN (SELECT answer_id AS own_id, {_sql_answer_extras()} FROM ({standins.ANSWERS_SQL})) e ON e.own_id = answer_id)"""


def _sql_answer_extras() -> str:
    months = standins._sql_list(standins.MONTH_NAMES)
    budgets = standins._sql_list(list(rules.BUDGET_MATCH_MATRIX))
    return f"{months}[(answer_id % 12) + 1] AS month, {budgets}[(answer_id % 3) + 1] AS budget, 3 AS top_n"
