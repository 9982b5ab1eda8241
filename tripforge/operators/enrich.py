"""Result enrichment (L1-L6, P12, F5, F7): columns the product shows, built as
projections over recommendation rows or the catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import clamp, fmt1, level_from_lower, map_lookup, round_half_even
from tripforge.operators.joins import JoinValidationError, duplicate_keys


# ------------------------------------------------------------------------ P12
def beach_access_level(c) -> Column:
    return level_from_lower(c, rules.BEACH_ACCESS_LEVELS, rules.BEACH_ACCESS_DEFAULT)


def score_level(c) -> Column:
    return level_from_lower(c, rules.SCORE_LEVELS, rules.SCORE_LEVEL_DEFAULT)


def weather_level(c) -> Column:
    return level_from_lower(c, rules.WEATHER_LEVELS, rules.WEATHER_LEVEL_DEFAULT)


def budget_level(c) -> Column:
    return level_from_lower(c, rules.BUDGET_LEVELS, rules.BUDGET_LEVEL_DEFAULT)


# ------------------------------------------------------------------------- F5
def radius_label(radius_m) -> Column:
    r = F.col(radius_m) if isinstance(radius_m, str) else radius_m
    km = r / 1000.0
    return (F.when(r.isNull() | (r <= 0), F.lit("adaptive radius"))
            .when(km == F.floor(km), F.format_string("within %d km", F.floor(km).cast("long")))
            .otherwise(F.format_string("within %s km", fmt1(km))))


# ------------------------------------------------------------------------- F7
def star_rating(score) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    filled = F.rint(s / 20.0).cast("int")
    return F.concat(F.expr("repeat('*', 0)"), F.repeat(F.lit("*"), filled), F.repeat(F.lit("."), F.lit(5) - filled))


# ------------------------------------------------------------------------- L1
def tags_from_reason(reason: str = "reason") -> Column:
    r = F.col(reason)
    frags = [
        F.when(r.beach >= 80, F.lit("Excellent beaches")).when(r.beach >= 60, F.lit("Beach friendly")),
        F.when(r.food >= 80, F.lit("Amazing food")).when(r.food >= 60, F.lit("Great food")),
        F.when(r.weather >= 80, F.lit("Excellent weather")).when(r.weather >= 60, F.lit("Good weather")),
        F.when(r.nature >= 80, F.lit("Nature escapes")).when(r.culture >= 80, F.lit("Culture rich"))
        .when(r.nightlife >= 80, F.lit("Nightlife")),
    ]
    arr = F.slice(F.filter(F.array(*frags), lambda x: x.isNotNull()), 1, 3)
    return F.when(F.size(arr) == 0, F.array(F.lit("Balanced match"))).otherwise(arr)


# ------------------------------------------------------------------------- L2
def recommendation_facts(reason: str = "reason") -> Column:
    r = F.col(reason)
    fact = lambda level, label, detail: F.struct(level.alias("level"), F.lit(label).alias("label"), detail.alias("detail"))
    return F.array(
        fact(beach_access_level(F.coalesce(F.col("nearby_beach_count"), F.lit(0))), "Beach access",
             radius_label(F.col("search_radius_m"))),
        fact(score_level(F.coalesce(r.food, F.lit(0.0))), "Food scene", F.lit("restaurants and cafes")),
        fact(score_level(F.coalesce(r.culture, F.lit(0.0))), "Culture", F.lit("museums nearby")),
        fact(budget_level(F.coalesce(r.budget, F.lit(0.0))), "Budget fit",
             F.format_string("Destination cost: %s<br>Cost-of-living proxy", F.coalesce(F.col("cost_level"), F.lit("Unknown")))),
        fact(weather_level(F.coalesce(r.weather, F.lit(0.0))), "Summer weather",
             F.format_string("%sC, %s mm rain/day", fmt1(F.col("summer_avg_temp")), fmt1(F.col("summer_avg_daily_rain")))),
    )


# ------------------------------------------------------------------- J6, L3
def friendly_profile(profile: str = "cluster_profile") -> Column:
    return F.coalesce(map_lookup(rules.FRIENDLY_CLUSTER_LABELS, profile), F.col(profile))


def best_for_text(profile: str = "cluster_profile") -> Column:
    return map_lookup(rules.BEST_FOR_TEXT, profile, rules.BEST_FOR_DEFAULT)


GUIDE_FIELDS = tuple(rules.GUIDE_DEFAULT)


def guide_table(spark: SparkSession, guides: Mapping[str, Mapping] = rules.DESTINATION_GUIDES) -> DataFrame:
    """(destination_name, six fields) of a dictionary of guides; a field may be missing."""
    kinds = ["string" if isinstance(rules.GUIDE_DEFAULT[f], str) else "array<string>" for f in GUIDE_FIELDS]
    schema = "destination_name string, " + ", ".join(f"{f} {k}" for f, k in zip(GUIDE_FIELDS, kinds))
    return spark.createDataFrame([(name, *[g.get(f) for f in GUIDE_FIELDS]) for name, g in guides.items()], schema)


def with_guide(df: DataFrame, guides: DataFrame, default: Mapping = rules.GUIDE_DEFAULT, name: str = "destination_name", out: str = "guide") -> DataFrame:
    """``df`` with the struct ``out`` of six fields: the guide of that name, and
    the default in every field that is missing. Duplicate names are refused."""
    if dups := duplicate_keys(guides, ["destination_name"]):
        raise JoinValidationError(f"duplicate guides: {dups}")
    table = guides.select(F.col("destination_name").alias("__guide_name"), F.struct(*GUIDE_FIELDS).alias("__guide"))
    fields = [F.coalesce(F.col(f"__guide.{f}"), F.lit(default[f]) if isinstance(default[f], str) else F.array(*map(F.lit, default[f]))).alias(f)
              for f in GUIDE_FIELDS]
    joined = df.join(table, F.col(name) == F.col("__guide_name"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.struct(*fields).alias(out))


def travel_story(companion: Column, reason: str = "reason") -> Column:
    r = F.col(reason)
    return F.format_string(
        "%s is a strong choice if you want a %s with %s beach access, a %s food scene, and %s seasonal weather. "
        "It works especially well for %s travellers who want a trip that feels easy to plan but still has "
        "enough variety for %s.",
        F.col("destination_name"), F.lower(friendly_profile()),
        F.lower(beach_access_level(F.coalesce(F.col("nearby_beach_count"), F.lit(0)))),
        F.lower(score_level(F.coalesce(r.food, F.lit(0.0)))), F.lower(weather_level(F.coalesce(r.weather, F.lit(0.0)))),
        F.lower(companion), F.col("guide.stay"))


# ------------------------------------------------------------------------- L4
def rating(score: str = "recommendation_score") -> Column:
    return F.lit(4.0) + F.col(score) / 100.0


def match_percent(score: str = "recommendation_score") -> Column:
    return F.rint(F.col(score)).cast("int")


def enrich_recommendations(recs: DataFrame, companion: str | Column = "Solo", guides: DataFrame | None = None) -> DataFrame:
    """J6, L1-L4 on recommendation rows (needs ``reason`` and the fact columns)."""
    comp = F.lit(companion) if isinstance(companion, str) else companion
    recs = with_guide(recs, guide_table(recs.sparkSession) if guides is None else guides)
    return recs.select("*", tags_from_reason().alias("tags"), recommendation_facts().alias("facts"),
                       travel_story(comp).alias("travel_story"), rating().alias("rating"),
                       match_percent().alias("match_percent"), friendly_profile().alias("friendly_profile"),
                       best_for_text().alias("best_for"))


# ------------------------------------------------------------------------- L5
def summer_weather_score() -> Column:
    """R3 fixed at summer with ideal 27 (the map's weather layer)."""
    t, r = F.col("summer_avg_temp"), F.col("summer_avg_daily_rain")
    temp_score = clamp(F.lit(100.0) - (F.abs(t - F.lit(27.0)) / 12.0 * 100.0))
    rain_score = clamp(F.lit(100.0) - r * 20.0)
    return round_half_even(0.7 * temp_score + 0.3 * rain_score, 2)


def map_markers(catalog: DataFrame) -> DataFrame:
    """One marker row per (destination, layer): score, colour, radius, stars, tooltip."""
    base = catalog.select("destination_name", "country", "latitude", "longitude",
                          summer_weather_score().alias("summer_weather_score"), "beach_score", "culture_score")
    layers = F.explode(F.array(*[F.struct(F.lit(name).alias("layer"), F.col(col).alias("score"),
                                          F.lit(top_colour).alias("top_colour"))
                                 for name, col, top_colour in rules.MAP_LAYERS]))
    m = base.select("destination_name", "country", "latitude", "longitude", layers.alias("l")).select(
        "destination_name", "country", "latitude", "longitude", "l.layer", "l.score", "l.top_colour")
    colour = F.when(F.col("score") >= 80, F.col("top_colour")).when(F.col("score") >= 50, F.lit("orange")).otherwise(F.lit("red"))
    return m.select("destination_name", "country", "latitude", "longitude", "layer", "score",
                    colour.alias("colour"), (F.lit(6.0) + F.col("score") / 100.0 * 9.0).alias("marker_radius"),
                    star_rating(F.col("score")).alias("stars"),
                    F.format_string("%s - %s/100", F.col("destination_name"), fmt1(F.col("score"))).alias("tooltip"))


# ------------------------------------------------------------------------- L6
LISTING_COLUMNS = ["destination_name", "country", "cluster_profile", "dominant_travel_style", "cost_level",
                   "cost_of_living_index", "food_score", "beach_score", "culture_score", "nature_score",
                   "summer_avg_temp", "summer_avg_daily_rain"]


def catalog_listing(catalog: DataFrame) -> DataFrame:
    return catalog.select(*LISTING_COLUMNS)
