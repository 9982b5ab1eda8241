"""Catalogue features: seasonal weather (A1), scores (A2, A3), climate (P4, P5),
type (P6, P7), experience (P8-P10), bucketisers (P11) and the feature chain (C4).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import rules
from tripforge.functions.expr import (
    argmax_with_margin, bucketize_upper, flag, map_lookup, nan_to_null,
    round_half_even, row_mean, row_std_sample, row_sum_min_count,
    row_sum_null_as_zero, season_from_month_number,
)
from tripforge.operators.ranking import pct_rank_avg

KEY = ["destination_name", "country"]


def global_stats(df: DataFrame, aggs: Sequence[Column]) -> tuple:
    """One aggregation job, one row back: bounded scalars (like MinMaxScaler's
    summary). Spark does the partial aggregation per partition."""
    row = df.agg(*aggs).first()
    return tuple(row) if row is not None else tuple(None for _ in aggs)


# ------------------------------------------------------------------------ A1
def seasonal_features(daily: DataFrame, key: Sequence[str] = ("destination_id",),
                      day_col: str = "day", temp_col: str = "temperature_2m_mean",
                      rain_col: str = "precipitation_sum", digits: int | None = 2) -> DataFrame:
    """Mean temperature and mean daily rain per season, pooled over all years.

    One hash aggregate with conditional averages (a pivot over the four fixed
    seasons); partial aggregation happens before the shuffle on ``key``.
    """
    season = season_from_month_number(F.month(F.col(day_col)))
    d = daily.select(*key, season.alias("__season"),
                     nan_to_null(temp_col).alias("__t"), nan_to_null(rain_col).alias("__r"))
    aggs = []
    for s in rules.SEASONS:
        for src, name in (("__t", f"{s}_avg_temp"), ("__r", f"{s}_avg_daily_rain")):
            a = F.avg(F.when(F.col("__season") == s, F.col(src)))
            aggs.append((round_half_even(a, digits) if digits is not None else a).alias(name))
    return d.groupBy(*key).agg(*aggs)


# ------------------------------------------------------------------------ A2
def add_scores(df: DataFrame, score_features: Mapping[str, Sequence[str]] = rules.SCORE_FEATURES) -> DataFrame:
    """Score = row sum of its counts (null only if all null) / column max * 100.

    Max null or 0 -> constant 0. One global aggregate for all maxima.
    """
    raws = {s: row_sum_min_count(cols) for s, cols in score_features.items()}
    maxima = global_stats(df, [F.max(r).alias(s) for s, r in raws.items()])
    new = {}
    for (s, raw), mx in zip(raws.items(), maxima):
        if mx is None or mx == 0:
            new[s] = F.lit(0.0)
        else:
            new[s] = round_half_even(raw / F.lit(float(mx)) * 100.0, 2)
    return df.withColumns(new)


# ------------------------------------------------------------------------ A3
def min_max_scores(df: DataFrame, specs: Mapping[str, Column], null_if_degenerate: bool = False) -> DataFrame:
    """``(x - min) / (max - min) * 100`` rounded 2 for several columns at once.

    Degenerate (constant) column: 0 (A3) or all null (A4, ``null_if_degenerate``).
    """
    stats = global_stats(df, [f(e) for e in specs.values() for f in (F.min, F.max)])
    new = {}
    for i, (name, e) in enumerate(specs.items()):
        lo, hi = stats[2 * i], stats[2 * i + 1]
        if lo is None or hi is None:
            v = F.lit(None).cast("double")
        elif lo == hi:
            v = F.lit(None).cast("double") if null_if_degenerate else F.lit(0.0)
        else:
            v = round_half_even((e - F.lit(float(lo))) / F.lit(float(hi - lo)) * 100.0, 2)
        new[name] = v
    return df.withColumns(new)


# ------------------------------------------------------------------- P4, P5
def add_climate_features(df: DataFrame) -> DataFrame:
    st, wt = F.col("summer_avg_temp"), F.col("winter_avg_temp")
    rains = [F.col(f"{s}_avg_daily_rain") for s in rules.SEASONS]
    climate = (F.when(flag((st >= rules.WARM_SUMMER_TEMP) & (wt >= rules.CLIMATE_WARM_WINTER)), F.lit("Warm"))
               .when(flag((st < rules.CLIMATE_COOL_SUMMER) | (wt < rules.CLIMATE_COOL_WINTER)), F.lit("Cool"))
               .otherwise(F.lit("Mild")))
    return df.select(
        "*",
        flag(st >= rules.WARM_SUMMER_TEMP).alias("warm_destination"),
        flag(wt < rules.COLD_WINTER_TEMP).alias("cold_destination"),
        flag((st >= rules.WARM_SUMMER_TEMP) & (F.col("summer_avg_daily_rain") <= rules.SUMMER_MAX_RAIN)).alias("summer_destination"),
        flag(wt < rules.COLD_WINTER_TEMP).alias("winter_destination"),
        flag(F.greatest(*rains) > rules.RAIN_RISK_RAIN).alias("rain_risk"),
        climate.alias("climate_category"),
    )


# ------------------------------------------------------------------------ P7
def resolve_destination_type(df: DataFrame, overrides: Mapping[str, str] = rules.DESTINATION_TYPE_OVERRIDES,
                             radius_by_type: Mapping[str, int] = rules.DESTINATION_TYPE_RADIUS_METERS,
                             default_radius: int = rules.SEARCH_RADIUS_METERS) -> DataFrame:
    """Type = given (non-empty) else name override else city; radius by type."""
    given = F.col("destination_type") if "destination_type" in df.columns else F.lit(None).cast("string")
    resolved = F.coalesce(F.nullif(given, F.lit("")), map_lookup(overrides, "destination_name"), F.lit("city"))
    out = df.withColumn("destination_type", resolved)
    return out.withColumn("search_radius_m",
                          map_lookup(radius_by_type, "destination_type", default_radius).cast("int"))



# ------------------------------------------------------------------------ P6
def row_key(df: DataFrame) -> list[str]:
    return ["destination_id"] if "destination_id" in df.columns else list(KEY)


def add_destination_type_features(df: DataFrame, rank_method: str = "bucketed") -> DataFrame:
    if "destination_type" in df.columns:
        t = F.coalesce(F.col("destination_type"), F.lit("city"))
        out = df.select("*", (t == "island").alias("island_destination"),
                        (t == "mountain").alias("mountain_destination"),
                        t.isin(rules.COASTAL_TYPES).alias("coastal_destination"))
    else:
        n = F.col("destination_name")
        out = df.select("*", flag(n.isin(rules.ISLAND_DESTINATIONS)).alias("island_destination"),
                        flag(n.isin(rules.MOUNTAIN_DESTINATIONS)).alias("mountain_destination"),
                        flag(n.isin(rules.COASTAL_DESTINATIONS)).alias("coastal_destination"))
    urban = row_sum_null_as_zero(["restaurant_count", "cafe_count", "bar_count", "museum_count"])
    out = pct_rank_avg(out, row_key(out), urban, "__city_pct", scale=1.0, digits=None, method=rank_method)
    return out.withColumn("city_destination", flag(F.col("__city_pct") >= rules.CITY_PERCENTILE)).drop("__city_pct")


# ------------------------------------------------------------- P8, P9, P10
def add_experience_features(df: DataFrame) -> DataFrame:
    c = F.col
    out = min_max_scores(df, {
        "food_scene_intensity": c("restaurant_count") + c("cafe_count"),
        "nightlife_intensity": c("bar_count").cast("double"),
        "cultural_density": c("museum_count").cast("double"),
        "nature_density": c("park_count") + c("nearby_beach_count"),
    })
    std = round_half_even(row_std_sample(rules.SCORE_COLUMNS), 2)
    style = argmax_with_margin([
        ("Beach", c("beach_score")),
        ("Nature", c("nature_score")),
        ("Culture", c("culture_score")),
        ("Food & Nightlife", (c("food_score") + c("nightlife_score")) / 2),
    ], rules.STYLE_MARGIN)
    return out.select(
        "*",
        round_half_even(row_mean(rules.SCORE_COLUMNS), 2).alias("overall_score"),
        std.alias("score_balance_std"),
        flag(std <= rules.BALANCED_STD).alias("balanced_destination"),
        style.alias("dominant_travel_style"),
    )


# ------------------------------------------------------------------------ P11
def cost_of_living_level(c) -> Column:
    return bucketize_upper(c, rules.COST_OF_LIVING_LEVELS, rules.COST_OF_LIVING_DEFAULT,
                           null_label=rules.UNKNOWN_LEVEL)


# ------------------------------------------------------------------------ P13
def round_numeric(df: DataFrame, digits: int = 2, exclude: Sequence[str] = ()) -> DataFrame:
    """Round every float/double column (half-even after scaling, like pandas)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude:
            cols.append(round_half_even(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
