"""Preference translation (X1-X8) and the fuzzy term matcher (UD1).

Answers (trip style, companion, activities, climate choice, free text) become
five preference weights and a weather choice, as Spark expressions:

* base vector and deltas are literal map lookups (unknown keys -> rejected row);
* the sequential update with a clamp after every step is ``aggregate`` over the
  ordered delta array ``[companion] + activities + [text]``;
* text signals: rule terms meet the words of a text in joins (``operators.terms``):
  whole words, substrings for terms of several words, and similar words. Whole
  texts are read; nothing is cut.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.operators.terms import all_terms, exact_matches, fuzzy_matches, term_table
from tripforge.sources.requests import PREFS


def _vec(d: Mapping[str, int]) -> Column:
    return F.struct(*[F.lit(int(d.get(p, 0))).alias(p) for p in PREFS])


def _vec_map(table: Mapping[str, Mapping[str, int]]) -> Column:
    pairs = []
    for k, v in table.items():
        pairs += [F.lit(k), _vec(v)]
    return F.create_map(*pairs)


# ------------------------------------------------------------------ X4, X5
def text_terms(texts: DataFrame, id_col: str, text_col: str,
               keywords: Mapping[str, Mapping] = rules.KEYWORD_WEIGHTS,
               weather: Mapping[str, list] = rules.TEXT_WEATHER_KEYWORDS,
               fuzzy: bool = True, ratio: float = rules.FUZZY_RATIO,
               min_len: int = rules.FUZZY_MIN_TERM_LENGTH) -> DataFrame:
    """(id, matched_terms array<string>): every rule term found in the text,
    exactly or fuzzily; an empty array where none is."""
    terms = term_table(texts.sparkSession, all_terms(keywords, weather))
    found = exact_matches(texts, id_col, text_col, terms)
    if fuzzy:
        found = found.unionByName(fuzzy_matches(texts, id_col, text_col, terms, ratio, min_len))
    found = found.groupBy("id").agg(F.collect_set("term").alias("found"))  # at most one entry per rule term
    ids = texts.select(F.col(id_col).alias("own")).distinct()
    out = ids.join(found, F.col("own").eqNullSafe(F.col("id")), "left")
    return out.select(F.col("own").alias(id_col), F.coalesce("found", F.array().cast("array<string>")).alias("matched_terms"))


def text_signals(terms_df: DataFrame, keywords: Mapping[str, Mapping] = rules.KEYWORD_WEIGHTS,
                 weather: Mapping[str, list] = rules.TEXT_WEATHER_KEYWORDS) -> DataFrame:
    """Groups fired, summed weights (a struct of five ints) and weather vote."""
    m = F.col("matched_terms")
    fired = {g: F.arrays_overlap(m, F.array(*[F.lit(t) for t in cfg["terms"]])) for g, cfg in keywords.items()}
    weights = {}
    for p in PREFS:
        total = F.lit(0)
        for g, cfg in keywords.items():
            w = cfg["weights"].get(p, 0)
            if w:
                total = total + F.when(fired[g], F.lit(w)).otherwise(F.lit(0))
        weights[p] = total
    groups = F.filter(F.array(*[F.when(fired[g], F.lit(g)) for g in keywords]), lambda x: x.isNotNull())
    votes = {label: F.size(F.array_intersect(m, F.array(*[F.lit(t) for t in ts]))) for label, ts in weather.items()}
    best = F.greatest(*votes.values())
    vote = None
    for label, v in votes.items():  # first label with the best count wins ties
        vote = F.when(v == best, F.lit(label)) if vote is None else vote.when(v == best, F.lit(label))
    vote = F.when(best > 0, vote)
    return terms_df.select("*", F.struct(*[weights[p].alias(p) for p in PREFS]).alias("text_weights"),
                           groups.alias("matched_keywords"), vote.alias("text_weather"))


# --------------------------------------------------------------- X1-X3, X6
def translate_answers(answers: DataFrame, id_col: str = "answer_id", fuzzy: bool = True,
                      keywords: Mapping[str, Mapping] = rules.KEYWORD_WEIGHTS,
                      weather: Mapping[str, list] = rules.TEXT_WEATHER_KEYWORDS) -> DataFrame:
    """Answers -> five clamped preferences, weather choice, matched groups,
    and ``error`` (non-empty when a style/companion/activity is unknown)."""
    sig = text_signals(text_terms(answers, id_col, "trip_description", keywords, weather, fuzzy), keywords, weather)
    a = answers.join(sig.select(id_col, "text_weights", "matched_keywords", "text_weather"), id_col, "left")
    base = F.element_at(_vec_map(rules.TRIP_STYLES), F.col("trip_style"))
    comp = F.element_at(_vec_map(rules.TRAVEL_COMPANION_WEIGHTS), F.col("companion"))
    acts = F.transform(F.coalesce(F.col("activities"), F.array().cast("array<string>")),
                       lambda x: F.element_at(_vec_map(rules.ACTIVITY_WEIGHTS), x))
    steps = F.concat(F.array(comp), acts, F.array(F.col("text_weights")))
    lo, hi = rules.PREFERENCE_MIN, rules.PREFERENCE_MAX

    def step(acc, d):
        return F.struct(*[F.least(F.greatest(acc[p] + d[p], F.lit(lo)), F.lit(hi)).alias(p) for p in PREFS])

    final = F.aggregate(steps, base, step)
    unknown_acts = F.filter(F.coalesce(F.col("activities"), F.array().cast("array<string>")),
                            lambda x: ~x.isin(list(rules.ACTIVITY_WEIGHTS)))
    error = F.array_join(F.filter(F.array(
        F.when(base.isNull(), F.format_string("unknown trip style '%s'", F.col("trip_style"))),
        F.when(comp.isNull(), F.format_string("unknown companion '%s'", F.col("companion"))),
        F.when(F.size(unknown_acts) > 0, F.concat(F.lit("unknown activities: "), F.array_join(unknown_acts, ", "))),
    ), lambda x: x.isNotNull()), "; ")
    ok = error == ""
    chosen = F.when(F.col("climate_preference") != "Any", F.col("climate_preference")).otherwise(
        F.coalesce(F.col("text_weather"), F.col("climate_preference")))
    return a.select("*", *[F.when(ok, final[p]).cast("double").alias(p) for p in PREFS],
                    chosen.alias("weather_preference"), error.alias("error")).drop("text_weights")


def answers_to_requests(translated: DataFrame, id_col: str = "answer_id", month: str = "month",
                        budget: str = "budget", top_n: str = "top_n") -> DataFrame:
    """Valid translated answers as recommendation requests."""
    return translated.where(F.col("error") == "").select(
        F.col(id_col).alias("request_id"), *PREFS, F.col(month).alias("month"), F.col(budget).alias("budget"),
        "weather_preference", F.col(top_n).cast("int").alias("top_n"))
