"""Recommender R1-R12 and top-N T1.

``recommend(requests, catalog)`` scores every destination of the catalogue for
every valid request, keeps the top ``top_n`` per request and only then builds
the texts. Scoring a request means scoring the whole catalogue (that is the
semantics), so the plan keeps that pass cheap:

* requests are first reduced to distinct *signatures* (same preferences,
  season, budget, weather choice, top_n -> same ranking), and the signature's
  own columns are the key, so nothing has to be written to fix an id;
* signatures and destinations meet in blocks of a constant size, an equi-join on
  (season, signature block, destination block). The *number* of blocks and of
  tasks comes from the data, so no task grows with either side;
* the best of some blocks bound the others' scores from below, so that only pairs
  that reach the bound are sorted; all are scored;
* score expressions are plain column arithmetic (whole-stage codegen), and only
  key, score and the tie-break columns leave a pair. A cell keeps its best 20 per
  signature without another exchange; the final top-N reads at most
  20 x destination blocks rows per signature;
* scores in detail and texts are built for those rows only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import clamp, fmt1, join_fragments, round_half_even
from tripforge.session import cut_lineage
from tripforge.sources.requests import MAX_TOP_N, PREFS

OUTPUT_COLUMNS = [
    "destination_name", "country", "recommendation_score", "preference_score", "weather_score",
    "cost_score", "budget_match_score", "cost_of_living_index", "cost_level", "cluster_profile",
    "dominant_travel_style", "climate_category", "summer_avg_temp", "summer_avg_daily_rain",
    "search_radius_m", "restaurant_count", "museum_count", "nearby_beach_count",
    "explanation", "natural_reason", "reason",
]

SCORING_COLUMNS = [
    "destination_id", "destination_name", "country", *rules.PREFERENCE_COLUMNS.values(),
    *[f"{s}_avg_temp" for s in rules.SEASONS], *[f"{s}_avg_daily_rain" for s in rules.SEASONS],
    "cost_level", "cluster_profile",
]

SIGNATURE = ["food", "beach", "culture", "nature", "nightlife", "season", "budget",
             "weather_preference", "top_n"]


def _r(name: str) -> Column:
    return F.col(f"r_{name}")


# ------------------------------------------------------------------------ R1
def preference_weights(prefs: Mapping[str, Column]) -> dict[str, Column]:
    total = None
    for p in PREFS:
        total = prefs[p] if total is None else total + prefs[p]
    equal = F.lit(1.0 / len(PREFS))
    return {p: F.when(total == 0, equal).otherwise(prefs[p] / total) for p in PREFS}


def seasonal_value(kind: str, season: Column) -> Column:
    """Pick ``{season}_avg_temp`` / ``{season}_avg_daily_rain`` by the request season."""
    suffix = "avg_temp" if kind == "temp" else "avg_daily_rain"
    expr = None
    for s in rules.SEASONS:
        cond = season == s
        v = F.col(f"{s}_{suffix}")
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


# ------------------------------------------------------------------- R3, R4
def weather_score(temp: Column, rain: Column, weather_pref: Column, beach_pref: Column,
                  profiles: Mapping[str, Mapping[str, float]] = rules.WEATHER_COMFORT_PROFILES) -> Column:
    """Comfort profile score (Warm/Mild/Cool) else the beach-driven default.

    Missing temperature -> null score (sorted last), not the reference's 100.
    """
    rain_score = clamp(F.lit(100.0) - rain * 20.0)
    mode = F.lower(F.trim(weather_pref))
    ideal_default = F.when(beach_pref >= 7, F.lit(27.0)).otherwise(F.lit(22.0))
    linear = clamp(F.lit(100.0) - (F.abs(temp - ideal_default) / 12.0 * 100.0))
    default_score = round_half_even(0.7 * linear + 0.3 * rain_score, 2)
    expr = None
    for name, prof in profiles.items():
        dist = (temp - F.lit(float(prof["ideal_temp"]))) / F.lit(float(prof["tolerance"]))
        gauss = round_half_even(F.exp(F.lit(-0.5) * (dist * dist)) * 100.0, 2)
        score = round_half_even(0.75 * gauss + 0.25 * rain_score, 2)
        expr = F.when(mode == name, score) if expr is None else expr.when(mode == name, score)
    return expr.otherwise(default_score)


def temperature_comfort_score(temp: Column, ideal: float, tolerance: float) -> Column:
    dist = (temp - F.lit(float(ideal))) / F.lit(float(tolerance))
    return round_half_even(F.exp(F.lit(-0.5) * (dist * dist)) * 100.0, 2)


# ------------------------------------------------------------------------ R5
def budget_match_score(budget: Column, cost_level: Column,
                       matrix: Mapping[str, Mapping[str, int]] = rules.BUDGET_MATCH_MATRIX) -> Column:
    default_row = matrix[rules.DEFAULT_BUDGET]
    expr = None
    for b, levels in matrix.items():
        for level, score in levels.items():
            cond = (budget == b) & (cost_level == level)
            expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    # Unknown budget -> Medium row.
    in_matrix = budget.isin(list(matrix))
    for level, score in default_row.items():
        expr = expr.when((~in_matrix | budget.isNull()) & (cost_level == level), F.lit(score))
    return expr.otherwise(F.lit(rules.UNKNOWN_LEVEL_BUDGET_SCORE)).cast("double")


# ------------------------------------------------------------------------ R6
def cluster_bonus(profile: Column, prefs: Mapping[str, Column]) -> Column:
    urban_avg = (prefs["food"] + prefs["culture"] + prefs["nightlife"]) / 3
    return (F.when((profile == rules.PROFILE_WARM_COASTAL) & (prefs["beach"] >= 7), F.lit(rules.CLUSTER_BONUS))
            .when((profile == rules.PROFILE_URBAN) & (urban_avg >= 7), F.lit(rules.CLUSTER_BONUS))
            .when((profile == rules.PROFILE_COOL_NATURE) & (prefs["nature"] >= 7), F.lit(rules.CLUSTER_BONUS))
            .otherwise(F.lit(0))).cast("double")


# ------------------------------------------------------------------------ R7
def must_have_penalty(profile: Column, prefs: Mapping[str, Column]) -> Column:
    total = F.lit(0.0)
    floor = float(rules.MUST_HAVE_SIGNAL_FLOOR)
    for p, sig in rules.PREFERENCE_COLUMNS.items():
        s = F.col(sig)
        term = (F.lit(float(rules.MUST_HAVE_PENALTY_SCALE)) * ((F.lit(floor) - s) / floor)
                * (prefs[p] / 10.0))
        total = total + F.when((prefs[p] >= rules.MUST_HAVE_THRESHOLD) & (s < floor), term).otherwise(F.lit(0.0))
    total = total + F.when((prefs["beach"] >= 7) & ~F.coalesce(profile == rules.PROFILE_WARM_COASTAL, F.lit(False)),
                           F.lit(float(rules.BEACH_PROFILE_PENALTY))).otherwise(F.lit(0.0))
    total = total + F.when((prefs["nature"] >= 7) & F.coalesce(profile == rules.PROFILE_URBAN, F.lit(False)),
                           F.lit(float(rules.NATURE_URBAN_PENALTY))).otherwise(F.lit(0.0))
    return round_half_even(total, 2)


# ------------------------------------------------------------------- R9-R11
def explanation(prefs: Mapping[str, Column], season: Column) -> Column:
    frags = []
    for p, sig in rules.PREFERENCE_COLUMNS.items():
        frags.append(F.when((prefs[p] >= 7) & (F.col(sig) >= 60), F.lit(f"strong {p.replace('_', ' ')} match")))
    temp, rain = F.col("temp"), F.col("rain")
    frags.append(F.when(F.col("weather_score") >= 75, F.format_string(
        "good %s weather (%sC, %s mm rain/day)", season, fmt1(temp), fmt1(rain))))
    frags.append(F.when(F.col("cluster_profile").isNotNull(),
                        F.concat(F.lit("belongs to "), F.col("cluster_profile"))))
    return join_fragments(frags, "; ", first_k=4, default="balanced match across the selected preferences")


def reason_struct() -> Column:
    parts = [("weather", "weather_score"), ("budget", "budget_match_score"),
             ("food", "food_recommendation_signal"), ("beach", "beach_recommendation_signal"),
             ("culture", "culture_recommendation_signal"), ("nature", "nature_recommendation_signal"),
             ("nightlife", "nightlife_recommendation_signal"), ("cluster_bonus", "cluster_bonus"),
             ("must_have_penalty", "must_have_penalty")]
    return F.struct(*[round_half_even(F.col(c).cast("double"), 2).alias(n) for n, c in parts])


def natural_reason(prefs: Mapping[str, Column], season: Column) -> Column:
    main = join_fragments([F.when(prefs[p] >= 7, F.lit(p)) for p in rules.REQUEST_PREFERENCE_ORDER],
                          " and ", default="your selected preferences")
    strengths = [
        F.when(F.col("weather_score") >= 75, F.lit("good seasonal weather")),
        F.when(F.col("food_recommendation_signal") >= 60, F.lit("a strong food scene")),
        F.when(F.col("beach_recommendation_signal") >= 60, F.lit("strong beach availability")),
        F.when(F.col("nature_recommendation_signal") >= 60, F.lit("good nature access")),
        F.when(F.col("culture_recommendation_signal") >= 60, F.lit("strong cultural attractions")),
        F.when(F.col("nightlife_recommendation_signal") >= 60, F.lit("good nightlife")),
        F.when(F.col("budget_match_score") >= 80,
               F.format_string("a %s cost profile", F.coalesce(F.col("cost_level"), F.lit("balanced")))),
    ]
    text = join_fragments(strengths, ", ", first_k=3, default="a balanced profile across the selected criteria")
    return F.format_string("%s was recommended because it matches %s, with %s, and belongs to the %s profile for %s travel.",
                           F.col("destination_name"), main, text,
                           F.coalesce(F.col("cluster_profile"), F.lit("None")), season)


# ------------------------------------------------------------------ R12, T1
# Requests that must rank identically share one canonical signature: the five
# preferences, season, budget row (unknown -> default row), weather mode
# (comfort profile, else the beach-driven default) and top_n. Codes are small
# ints so the (signature x destination) pass compares numbers, not strings.
MODES = ["warm", "mild", "cool", "default27", "default22"]
BUDGETS = list(rules.BUDGET_MATCH_MATRIX)
LEVELS = list(rules.BUDGET_MATCH_MATRIX[rules.DEFAULT_BUDGET])
PROFILES = [rules.PROFILE_WARM_COASTAL, rules.PROFILE_URBAN, rules.PROFILE_COOL_NATURE]
CODE_COLS = ["season_code", "budget_code", "mode_code"]
SIG_COLS = [*PREFS, *CODE_COLS, "top_n"]


def _code(c: Column, values: list[str], default: int) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(c == v, F.lit(i)) if expr is None else expr.when(c == v, F.lit(i))
    return expr.otherwise(F.lit(default))


def canonical_requests(valid: DataFrame) -> DataFrame:
    """Valid requests + canonical signature codes."""
    mode = F.lower(F.trim(F.col("weather_preference")))
    mode_code = (F.when(mode == "warm", 0).when(mode == "mild", 1).when(mode == "cool", 2)
                 .when(F.col("beach") >= 7, 3).otherwise(4))
    # adding 0.0 turns -0.0 into 0.0, so equal preferences hash alike
    out = valid.select(*[(F.col(c) + F.lit(0.0)).alias(c) if c in PREFS else F.col(c) for c in valid.columns],
                       _code(F.col("season"), rules.SEASONS, -1).alias("season_code"),
                       _code(F.col("budget"), BUDGETS, BUDGETS.index(rules.DEFAULT_BUDGET)).alias("budget_code"),
                       mode_code.alias("mode_code"))
    return out


def destination_seasons(catalog: DataFrame) -> DataFrame:
    """Destination x season (4 rows per destination) with every request-
    independent part of the score: the five possible weather scores and the
    must-have shortfall factor per signal. Weather work is done 4 x D times,
    not requests x D times."""
    seasons = F.explode(F.array(*[
        F.struct(F.lit(i).alias("season_code"), F.col(f"{s}_avg_temp").alias("temp"),
                 F.col(f"{s}_avg_daily_rain").alias("rain")) for i, s in enumerate(rules.SEASONS)]))
    base = catalog.select("destination_id", "destination_name", "country",
                          _code(F.col("cost_level"), LEVELS, len(LEVELS)).alias("level_code"),
                          _code(F.col("cluster_profile"), PROFILES, len(PROFILES)).alias("profile_code"),
                          *rules.PREFERENCE_COLUMNS.values(), seasons.alias("__s"))
    temp, rain = F.col("__s.temp"), F.col("__s.rain")
    rain_score = clamp(F.lit(100.0) - rain * 20.0)
    cols = {}
    for name, prof in rules.WEATHER_COMFORT_PROFILES.items():
        cols[f"w_{name}"] = round_half_even(
            0.75 * temperature_comfort_score(temp, prof["ideal_temp"], prof["tolerance"]) + 0.25 * rain_score, 2)
    for ideal in (27.0, 22.0):
        linear = clamp(F.lit(100.0) - (F.abs(temp - F.lit(ideal)) / 12.0 * 100.0))
        cols[f"w_default{int(ideal)}"] = round_half_even(0.7 * linear + 0.3 * rain_score, 2)
    floor = float(rules.MUST_HAVE_SIGNAL_FLOOR)
    for p, sig in rules.PREFERENCE_COLUMNS.items():
        cols[f"m_{p}"] = F.when(F.col(sig) < floor, (F.lit(floor) - F.col(sig)) / floor)
    return base.select("*", F.col("__s.season_code").alias("season_code"), temp.alias("temp"),
                       rain.alias("rain"), *[v.alias(k) for k, v in cols.items()]).drop("__s")


def signatures(canon: DataFrame) -> DataFrame:
    """Distinct canonical signatures (r_ prefix)."""
    return canon.select(*[F.col(c).alias(f"r_{c}") for c in SIG_COLS]).distinct()


def with_weights(sigs: DataFrame) -> DataFrame:
    """Preference weights and flags, pure functions of the signature columns."""
    w = preference_weights({p: _r(p) for p in PREFS})
    urban_avg = (_r("food") + _r("culture") + _r("nightlife")) / 3
    return sigs.select("*", *[w[p].alias(f"r_w_{p}") for p in PREFS], (urban_avg >= 7).alias("r_urban7"))


def pair_scores() -> dict[str, Column]:
    """R2-R8 over a (signature, destination-season) row, same arithmetic as
    the per-row formulas (bit-identical results)."""
    pref_score = F.lit(0.0)
    for p, sig in rules.PREFERENCE_COLUMNS.items():
        pref_score = pref_score + F.col(sig) * F.col(f"r_w_{p}")
    mode = F.col("r_mode_code")
    weather = F.when(mode == 0, F.col("w_warm")).when(mode == 1, F.col("w_mild")).when(
        mode == 2, F.col("w_cool")).when(mode == 3, F.col("w_default27")).otherwise(F.col("w_default22"))
    table = [float(rules.BUDGET_MATCH_MATRIX[b][lv]) for b in BUDGETS for lv in LEVELS]
    lvl = F.col("level_code")
    budget_score = F.when(lvl >= len(LEVELS), F.lit(float(rules.UNKNOWN_LEVEL_BUDGET_SCORE))).otherwise(
        F.element_at(F.array(*[F.lit(v) for v in table]), F.col("r_budget_code") * len(LEVELS) + lvl + 1))
    prof = F.col("profile_code")
    bonus = (F.when((prof == 0) & (_r("beach") >= 7), F.lit(rules.CLUSTER_BONUS))
             .when((prof == 1) & F.col("r_urban7"), F.lit(rules.CLUSTER_BONUS))
             .when((prof == 2) & (_r("nature") >= 7), F.lit(rules.CLUSTER_BONUS))
             .otherwise(F.lit(0))).cast("double")
    penalty = F.lit(0.0)
    for p in rules.PREFERENCE_COLUMNS:
        m = F.col(f"m_{p}")
        penalty = penalty + F.when((_r(p) >= rules.MUST_HAVE_THRESHOLD) & m.isNotNull(),
                                   F.lit(float(rules.MUST_HAVE_PENALTY_SCALE)) * m * (_r(p) / 10.0)).otherwise(F.lit(0.0))
    penalty = penalty + F.when((_r("beach") >= 7) & (prof != 0), F.lit(float(rules.BEACH_PROFILE_PENALTY))).otherwise(F.lit(0.0))
    penalty = penalty + F.when((_r("nature") >= 7) & (prof == 1), F.lit(float(rules.NATURE_URBAN_PENALTY))).otherwise(F.lit(0.0))
    return {"preference_score": pref_score, "weather_score": weather, "budget_match_score": budget_score,
            "cluster_bonus": bonus, "must_have_penalty": round_half_even(penalty, 2)}


def final_score() -> Column:
    sw = rules.SCORE_WEIGHTS
    final = round_half_even(F.lit(sw["preference"]) * F.col("preference_score")
                            + F.lit(sw["weather"]) * F.col("weather_score")
                            + F.lit(sw["cost"]) * F.col("budget_match_score")
                            + F.col("cluster_bonus") - F.col("must_have_penalty"), 2)
    return F.when(final > 100, F.lit(100.0)).otherwise(final)


#: Signatures and destinations of a cell, and pairs a task is meant to score.
SIG_BLOCK, DEST_BLOCK, PAIRS_PER_TASK = 512, 2048, 4_000_000
SIG_KEY = [f"r_{c}" for c in SIG_COLS]
TIE_BREAK = ["destination_name", "country", "destination_id"]


def _spread(blocks: int) -> list[int]:
    """Numbers of destination blocks that are scored one after the other: one, some, all."""
    return sorted({1, math.ceil(math.sqrt(blocks)), blocks})


def _blocked_top(sigs: DataFrame, dest_seasons: DataFrame, sig_block: int, dest_block: int) -> DataFrame:
    """(signature, destination_id, rank): the best destinations of each signature's season.

    The signature's ``MAX_TOP_N``-th score among some blocks is a lower bound of the one
    among all, so that of the other blocks only pairs that reach it are sorted; every pair
    is scored. Without such a bound (fewer destinations, scores missing) all pairs are."""
    sigs = cut_lineage(sigs, "signatures")
    seasons = [r["count"] for r in sigs.groupBy("r_season_code").count().collect()]  # a row per season
    n_sigs, n_dest = sum(seasons), dest_seasons.count() // len(rules.SEASONS)
    # a cell has one season's signatures
    sig_blocks, dest_blocks = max(1, -(-max(seasons, default=0) // sig_block)), max(1, -(-n_dest // dest_block))
    cores = sigs.sparkSession.sparkContext.defaultParallelism
    cell = ["season_code", "sig_block", "dest_block"]
    order = [F.col("__score").desc_nulls_last(), *TIE_BREAK]
    per_sig = Window.partitionBy("sig_hash", *SIG_KEY).orderBy(*order)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = (with_weights(sigs).withColumn("season_code", _r("season_code")).withColumn("sig_hash", F.xxhash64(*SIG_KEY))
            .withColumn("sig_block", F.pmod("sig_hash", F.lit(sig_blocks).cast("long"))))
    right = dest_seasons.withColumn("dest_block", F.pmod(F.xxhash64("destination_id"), F.lit(dest_blocks).cast("long")))
    floors, top = None, None
    for blocks in _spread(dest_blocks):
        tasks = max(cores * 2, -(-n_sigs * n_dest * blocks // dest_blocks // PAIRS_PER_TASK))
        known = left.withColumn("__floor", F.lit(None).cast("double")) if floors is None else left.join(floors, [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in SIG_KEY], "left").drop(*[f"f_{k}" for k in SIG_KEY])
        asked = known.withColumn("dest_block", each(blocks)).repartition(tasks, *cell)
        offered = right.filter(F.col("dest_block") < blocks).withColumn("sig_block", each(sig_blocks)).repartition(tasks, *cell)
        scored = (asked.join(offered.hint("shuffle_hash"), cell)
                  .select("*", *[v.alias(k) for k, v in pair_scores().items()])
                  .select("sig_hash", *cell, *SIG_KEY, *TIE_BREAK, "__floor", final_score().alias("__score"))
                  .filter(F.col("__floor").isNull() | (F.col("__score") >= F.col("__floor"))).drop("__floor"))
        # the join's partitioning already keeps a cell together: no exchange here;
        # the hash comes first so that most sort comparisons end at their prefix
        best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("sig_hash", *cell, *SIG_KEY).orderBy(*order)))
        best = best.where(F.col("rank") <= MAX_TOP_N).drop("rank")
        top = best.withColumn("rank", F.row_number().over(per_sig))
        if blocks < dest_blocks:
            floors = cut_lineage(top.where(F.col("rank") == MAX_TOP_N).select(*[F.col(k).alias(f"f_{k}") for k in SIG_KEY], F.col("__score").alias("__floor")), "floors")
    return top.where((F.col("rank") <= MAX_TOP_N) & (F.col("rank") <= _r("top_n"))).select(*SIG_KEY, "season_code", "destination_id", "rank")


def recommend(valid_requests: DataFrame, catalog: DataFrame, dest_seasons: DataFrame | None = None,
              with_texts: bool = True, sig_block: int = SIG_BLOCK, dest_block: int = DEST_BLOCK) -> DataFrame:
    """Top ``top_n`` destinations per valid request with scores and texts.

    ``dest_seasons`` is ``destination_seasons`` of the catalogue when the caller
    has it already (a stream builds it once, not per batch).
    """
    canon = canonical_requests(valid_requests)
    if dest_seasons is None:
        dest_seasons = destination_seasons(catalog.select(*SCORING_COLUMNS))
    top = _blocked_top(signatures(canon), dest_seasons, sig_block, dest_block)
    # details of the kept rows only
    top = with_weights(top).join(dest_seasons.drop("destination_name", "country"), ["destination_id", "season_code"])
    top = top.select("*", *[v.alias(k) for k, v in pair_scores().items()])
    top = top.select("*", final_score().alias("recommendation_score"), F.col("budget_match_score").alias("cost_score"),
                     F.element_at(F.array(*[F.lit(s) for s in rules.SEASONS]), _r("season_code") + 1).alias("r_season"))
    extra = [c for c in OUTPUT_COLUMNS if c in catalog.columns and c not in top.columns]
    top = top.join(catalog.select("destination_id", *extra), "destination_id")
    if with_texts:
        prefs = {p: _r(p) for p in PREFS}
        top = top.select("*", explanation(prefs, _r("season")).alias("explanation"),
                         natural_reason(prefs, _r("season")).alias("natural_reason"),
                         reason_struct().alias("reason"))
    keep = [c for c in OUTPUT_COLUMNS if c in top.columns]
    top = top.select(*SIG_KEY, "rank", "cluster_bonus", "must_have_penalty", *keep)
    requests = canon.select("request_id", *[F.col(c).alias(f"r_{c}") for c in SIG_COLS])
    return requests.join(top, SIG_KEY).drop(*SIG_KEY)
