"""Cost features: price payloads (S6, S7), keyword prices (A5), hotel stats (A6),
nullable min-max (A4), weighted index (A7), travel level (A8), coverage (A9),
cost records (C1), travel-cost table (C2) and catalogue cost features (C3).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import rules
from tripforge.functions.expr import bucketize_upper, round_half_even
from tripforge.operators.features import cost_of_living_level, min_max_scores
from tripforge.operators.joins import left_join_1to1

PRICE_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("contributors", T.IntegerType()),
    T.StructField("prices", T.ArrayType(T.StructType([
        T.StructField("item_name", T.StringType()),
        T.StructField("average_price", T.DoubleType()),
    ]))),
])

HOTEL_OFFERS_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("offers", T.ArrayType(T.StructType([
            T.StructField("price", T.StructType([T.StructField("total", T.StringType())])),
        ]))),
    ]))),
])

PRICE_COLUMNS = ["median_hotel_price_eur", "restaurant_meal_price_eur", "cappuccino_price_eur",
                 "groceries_basket_price_eur", "museum_or_attraction_price_eur", "local_transport_price_eur"]


# ------------------------------------------------------------------- S6 + A5
def keyword_prices(payloads: DataFrame, key: Sequence[str], payload_col: str = "payload",
                   keywords: Mapping[str, Sequence[str]] = rules.PRICE_ITEM_KEYWORDS) -> DataFrame:
    """Price payload JSON -> one column per keyword group: mean of the item
    prices whose name contains any keyword (case-insensitive), round 2.

    Items are exploded (one row per item) and tested against the small keyword
    list with ``contains``; each item counts once per column. Missing payload
    -> all-null columns. Also returns the city name and contributors.
    """
    parsed = payloads.select(*key, F.from_json(F.col(payload_col), PRICE_PAYLOAD_SCHEMA).alias("__p"))
    items = parsed.select(*key, F.col("__p.name").alias("__name"), F.col("__p.contributors").alias("__contributors"),
                          F.explode_outer("__p.prices").alias("__it"))
    name = F.lower(F.coalesce(F.col("__it.item_name"), F.lit("")))
    price = F.col("__it.average_price")
    aggs = []
    for column, words in keywords.items():
        hit = None
        for w in words:
            h = name.contains(w.lower())
            hit = h if hit is None else hit | h
        aggs.append(round_half_even(F.avg(F.when(hit & price.isNotNull(), price)), 2).alias(column))
    aggs += [F.max("__name").alias("numbeo_city_name"), F.max("__contributors").alias("numbeo_contributors")]
    return items.groupBy(*key).agg(*aggs)


# ------------------------------------------------------------------- S7 + A6
def hotel_price_stats(offers: DataFrame, key: Sequence[str], payload_col: str = "payload",
                      hotel_rank_col: str = "hotel_rank", max_hotels: int = rules.MAX_HOTELS) -> DataFrame:
    """Hotel offer JSON (one row per hotel) -> mean, exact median, sample size.

    Only the first ``max_hotels`` hotels (1-based rank) of a destination count;
    offers without a total are skipped; a malformed record is skipped like a
    failed hotel call. When the rank comes from a ``dense_rank`` window, the
    ``<=`` filter lets Spark cut each group to the limit before the shuffle.
    """
    first = offers.where(F.col(hotel_rank_col) <= max_hotels)
    parsed = first.select(*key, F.from_json(F.col(payload_col), HOTEL_OFFERS_SCHEMA).alias("__o"))
    totals = (parsed.select(*key, F.explode_outer("__o.data").alias("__h"))
              .select(*key, F.explode_outer("__h.offers").alias("__of"))
              .select(*key, F.col("__of.price.total").try_cast("double").alias("__total")))
    stats = totals.groupBy(*key).agg(
        round_half_even(F.avg("__total"), 2).alias("avg_hotel_price_eur"),
        round_half_even(F.median("__total"), 2).alias("median_hotel_price_eur"),
        F.count("__total").cast("int").alias("hotel_sample_size"),
    )
    return stats


# ----------------------------------------------------------------------- F8
def representative_check_in(month: Column, as_of: Column) -> Column:
    """15th of the named month, in the year after ``as_of``."""
    m = F.month(F.to_date(F.concat(F.lit("2000 "), F.initcap(F.trim(month)), F.lit(" 1")), "yyyy MMMM d"))
    return F.make_date(F.year(as_of) + 1, m, F.lit(15))


# ----------------------------------------------------------------- A4, A7-A9
def travel_cost_level(index: Column) -> Column:
    return bucketize_upper(index, rules.TRAVEL_COST_LEVELS, rules.TRAVEL_COST_DEFAULT,
                           null_label=rules.UNKNOWN_LEVEL)


def add_travel_cost_index(df: DataFrame, weights: Mapping[str, float] = rules.TRAVEL_COST_WEIGHTS,
                          sources: Mapping[str, str] = rules.TRAVEL_COST_SCORE_SOURCES) -> DataFrame:
    """Six nullable min-max scores, weighted index over available scores,
    level, and coverage of the six price columns."""
    out = min_max_scores(df, {s: F.col(src).cast("double") for s, src in sources.items()},
                         null_if_degenerate=True)
    num, den = F.lit(0.0), F.lit(0.0)
    for s, w in weights.items():
        num = num + F.coalesce(F.col(s), F.lit(0.0)) * F.lit(w)
        den = den + F.when(F.col(s).isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    index = F.when(den > 0, round_half_even(num / den, 2))
    coverage = None
    for c in PRICE_COLUMNS:
        t = F.col(c).isNotNull().cast("double")
        coverage = t if coverage is None else coverage + t
    return out.select("*", index.alias("travel_cost_index"),
                      travel_cost_level(index).alias("travel_cost_level"),
                      round_half_even(coverage / len(PRICE_COLUMNS), 2).alias("cost_data_coverage"))


# ----------------------------------------------------------------------- C1
def cost_records(destinations: DataFrame, prices: DataFrame, hotels: DataFrame, key: Sequence[str],
                 month: str, radius_km: float) -> DataFrame:
    """One cost row per destination: hotel stats, keyword prices, attraction placeholder."""
    out = destinations.select(*key).join(hotels, list(key), "left").join(prices, list(key), "left")
    return out.select(
        *key, F.lit(month).alias("month"), F.lit(float(radius_km)).alias("hotel_search_radius_km"),
        "avg_hotel_price_eur", "median_hotel_price_eur",
        F.coalesce(F.col("hotel_sample_size"), F.lit(0)).alias("hotel_sample_size"),
        "restaurant_meal_price_eur", "cappuccino_price_eur", "groceries_basket_price_eur",
        "local_transport_price_eur", "numbeo_city_name", "numbeo_contributors",
        F.lit(None).cast("double").alias("museum_or_attraction_price_eur"),
        F.lit(rules.ATTRACTION_COVERAGE_NOTE).alias("attraction_price_coverage"),
    )


TRAVEL_COST_JOIN_COLUMNS = [
    "month", "avg_hotel_price_eur", "median_hotel_price_eur", "hotel_sample_size",
    "restaurant_meal_price_eur", "cappuccino_price_eur", "groceries_basket_price_eur",
    "museum_or_attraction_price_eur", "local_transport_price_eur", "travel_cost_index",
    "travel_cost_level", "cost_data_coverage",
]


# ----------------------------------------------------------------------- C3
def add_cost_features(df: DataFrame, living_costs: DataFrame | None,
                      travel_costs: DataFrame | None = None,
                      key: Sequence[str] = ("destination_name", "country"),
                      validate: bool = True) -> DataFrame:
    """Join travel costs (if any) and living costs (if any), derive both levels
    and the final ``cost_level`` (travel level wins when present, not Unknown
    and coverage > 0). Without living costs: ``Unknown`` unless already there.
    """
    out = df
    key = list(key)
    if travel_costs is not None:
        cols = [c for c in TRAVEL_COST_JOIN_COLUMNS if c in travel_costs.columns and c not in key]
        join_key = key + (["month"] if "month" in cols and "month" in df.columns else [])
        cols = [c for c in cols if c not in join_key]
        out = left_join_1to1(out, travel_costs.select(*join_key, *cols), join_key, validate=validate)
    if living_costs is None:
        if "cost_level" not in out.columns:
            out = out.withColumn("cost_level", F.lit(rules.UNKNOWN_LEVEL))
        return out
    out = left_join_1to1(out, living_costs, key, validate=validate)
    living_level = cost_of_living_level(F.col("cost_of_living_index"))
    out = out.withColumn("cost_of_living_level", living_level)
    if "travel_cost_level" in out.columns:
        has = F.col("travel_cost_level").isNotNull() & (F.col("travel_cost_level") != rules.UNKNOWN_LEVEL)
        if "cost_data_coverage" in out.columns:
            has = has & (F.coalesce(F.col("cost_data_coverage"), F.lit(0.0)) > 0)
        return out.withColumn("cost_level", F.when(has, F.col("travel_cost_level")).otherwise(F.col("cost_of_living_level")))
    return out.withColumn("cost_level", F.col("cost_of_living_level"))
