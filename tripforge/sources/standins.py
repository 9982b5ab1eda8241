"""Catalogue stand-ins derived from the driver tables.

The driver ships TPC-H-like tables, not travel data. These builders turn them
into the tables our operators consume, with the same deterministic expressions
as the oracle SQL fragments below (``*_SQL``), so that Spark and DuckDB see the
same inputs. Everything stays a DataFrame expression over whole tables: work
grows with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.sources.catalog_io import read_table

MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]

# Stand-in POI tags: (market segment, custkey parity) -> (tag key, tag value).
POI_TAGS = {
    ("AUTOMOBILE", 0): ("amenity", "restaurant"),
    ("AUTOMOBILE", 1): ("amenity", "cafe"),
    ("BUILDING", 0): ("amenity", "bar"),
    ("BUILDING", 1): ("tourism", "museum"),
    ("FURNITURE", 0): ("leisure", "park"),
    ("FURNITURE", 1): ("natural", "beach"),
    ("HOUSEHOLD", 0): ("amenity", "restaurant"),
    ("HOUSEHOLD", 1): ("natural", "beach"),
    ("MACHINERY", 0): ("shop", "supermarket"),
    ("MACHINERY", 1): ("amenity", "cafe"),
}

# The driver coordinates are spread over the whole globe, so the stand-in uses
# the type radii scaled up by this factor (3 km city -> 600 km).
STANDIN_RADIUS_SCALE = 200
STANDIN_TYPE_RADIUS_M = {t: r * STANDIN_RADIUS_SCALE
                         for t, r in rules.DESTINATION_TYPE_RADIUS_METERS.items()}
STANDIN_DEFAULT_RADIUS_M = rules.SEARCH_RADIUS_METERS * STANDIN_RADIUS_SCALE

BUDGET_BY_SEGMENT = {
    "AUTOMOBILE": "Low (Essential)",
    "BUILDING": "Low (Essential)",
    "FURNITURE": "Medium (Comfort)",
    "HOUSEHOLD": "High (Luxury)",
    "MACHINERY": "Premium",  # not in the matrix: falls back to the Medium row
}
WEATHER_CHOICES = ["Any", "Warm", "Mild", "Cool", "Sunny"]
COMPANIONS = list(rules.TRAVEL_COMPANION_WEIGHTS)
TRIP_STYLE_NAMES = list(rules.TRIP_STYLES)
ACTIVITY_NAMES = list(rules.ACTIVITY_WEIGHTS)
CLIMATE_CHOICES = ["Warm", "Mild", "Cool", "Any"]


def _arr(values):
    return F.array(*[F.lit(v) for v in values])


def _sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# ------------------------------------------------------------------ destinations
def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    return (
        s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner")
        .select(
            k.alias("destination_id"),
            F.col("s_name").alias("destination_name"),
            F.col("s_name").alias("search_name"),
            F.col("n_name").alias("country"),
            F.element_at(_arr(rules.DESTINATION_TYPES), (k % 5 + 1).cast("int")).alias("destination_type"),
            ((k * 3701) % 16000 / 100.0 - 80.0).alias("latitude"),
            ((k * 10103) % 34000 / 100.0 - 170.0).alias("longitude"),
        )
    )


DESTINATIONS_SQL = f"""
SELECT s_suppkey AS destination_id, s_name AS destination_name, s_name AS search_name,
       n_name AS country,
       {_sql_list(rules.DESTINATION_TYPES)}[(s_suppkey % 5) + 1] AS destination_type,
       ((s_suppkey * 3701) % 16000) / 100.0 - 80.0 AS latitude,
       ((s_suppkey * 10103) % 34000) / 100.0 - 170.0 AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


# ---------------------------------------------------------------------- POIs
def _tag_case(part: int):
    expr = None
    for (segment, parity), tag in POI_TAGS.items():
        cond = (F.col("c_mktsegment") == segment) & (F.col("c_custkey") % 2 == parity)
        expr = F.when(cond, F.lit(tag[part])) if expr is None else expr.when(cond, F.lit(tag[part]))
    return expr


def _sql_tag_case(part: int) -> str:
    arms = " ".join(
        f"WHEN c_mktsegment = '{seg}' AND c_custkey % 2 = {par} THEN '{tag[part]}'"
        for (seg, par), tag in POI_TAGS.items())
    return f"CASE {arms} END"


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POI table: poi_id, lat, lon, element, tags map<string,string>."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        k.alias("poi_id"),
        ((k * 7919) % 16000 / 100.0 - 80.0).alias("lat"),
        ((k * 104729) % 34000 / 100.0 - 170.0).alias("lon"),
        F.element_at(_arr(["node", "way", "relation"]), (k % 3 + 1).cast("int")).alias("element"),
        F.create_map(_tag_case(0), _tag_case(1)).alias("tags"),
    )


POIS_SQL = f"""
SELECT c_custkey AS poi_id,
       ((c_custkey * 7919) % 16000) / 100.0 - 80.0 AS lat,
       ((c_custkey * 104729) % 34000) / 100.0 - 170.0 AS lon,
       {_sql_tag_case(0)} AS tag_key, {_sql_tag_case(1)} AS tag_value
FROM customer
"""


# -------------------------------------------------------------- daily weather
def daily_weather(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per (destination, day): temperature_2m_mean, precipitation_sum."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_tax", *extra)
    k = F.col("l_suppkey")
    m = F.month("l_shipdate")
    return li.select(
        k.alias("destination_id"),
        F.to_date("l_shipdate").alias("day"),
        (F.col("l_quantity") - (k % 8)
         - F.when(m.isin(12, 1, 2), k % 30).otherwise(F.lit(0))).alias("temperature_2m_mean"),
        (F.col("l_tax") * 100 * (k % 10) / 10).alias("precipitation_sum"), *extra,
    )


DAILY_WEATHER_SQL = """
SELECT l_suppkey AS destination_id, CAST(l_shipdate AS DATE) AS day,
       l_quantity - (l_suppkey % 8)
         - CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN l_suppkey % 30 ELSE 0 END AS temperature_2m_mean,
       l_tax * 100 * (l_suppkey % 10) / 10 AS precipitation_sum
FROM lineitem
"""


# ---------------------------------------------------------------- living costs
def living_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cost table: key + cost_of_living_index (acctbal min-max onto 30..100)."""
    from tripforge.functions.expr import round_half_even
    from tripforge.operators.features import global_stats

    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lo, hi = global_stats(s, [F.min("s_acctbal"), F.max("s_acctbal")])
    span = (hi - lo) if (lo is not None and hi is not None and hi != lo) else None
    idx = (F.lit(30.0) + (F.col("s_acctbal") - F.lit(lo)) / F.lit(span) * 70.0) if span else F.lit(None).cast("double")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.col("s_name").alias("destination_name"),
        F.col("n_name").alias("country"),
        round_half_even(idx, 2).alias("cost_of_living_index"),
        F.lit("stand-in from account balance").alias("cost_data_note"),
    )


LIVING_COSTS_SQL = """
SELECT s_name AS destination_name, n_name AS country,
       round_even((30.0 + (s_acctbal - mm.lo) / (mm.hi - mm.lo) * 70.0) * 100.0, 0) / 100.0 AS cost_of_living_index
FROM supplier JOIN nation ON s_nationkey = n_nationkey,
     (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier) mm
"""


# -------------------------------------------------------------------- requests
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw recommendation requests (some invalid on purpose: food 11, bad month)."""
    return requests_from_customers(read_table(spark, sf_dir, "customer"))


def requests_from_customers(customers: DataFrame) -> DataFrame:
    """Request columns from customer rows (works on batch and streaming frames)."""
    c = customers.select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    budget = None
    for seg, b in BUDGET_BY_SEGMENT.items():
        cond = F.col("c_mktsegment") == seg
        budget = F.when(cond, F.lit(b)) if budget is None else budget.when(cond, F.lit(b))
    return c.select(
        k.alias("request_id"),
        ((k * 3) % 12).cast("double").alias("food"),
        ((k * 7) % 11).cast("double").alias("beach"),
        ((k * 5) % 11).cast("double").alias("culture"),
        ((k * 13) % 11).cast("double").alias("nature"),
        ((k * 17) % 11).cast("double").alias("nightlife"),
        F.when(k % 53 == 0, F.lit(" Smarch ")).otherwise(
            F.element_at(_arr(MONTH_NAMES), (k % 12 + 1).cast("int"))).alias("month"),
        budget.alias("budget"),
        F.element_at(_arr(WEATHER_CHOICES), (k % 5 + 1).cast("int")).alias("weather_preference"),
        (k % 7 + 1).cast("int").alias("top_n"),
    )


def _sql_budget_case() -> str:
    arms = " ".join(f"WHEN c_mktsegment = '{s}' THEN '{b}'" for s, b in BUDGET_BY_SEGMENT.items())
    return f"CASE {arms} END"


REQUESTS_SQL = f"""
SELECT c_custkey AS request_id,
       CAST((c_custkey * 3) % 12 AS DOUBLE) AS food,
       CAST((c_custkey * 7) % 11 AS DOUBLE) AS beach,
       CAST((c_custkey * 5) % 11 AS DOUBLE) AS culture,
       CAST((c_custkey * 13) % 11 AS DOUBLE) AS nature,
       CAST((c_custkey * 17) % 11 AS DOUBLE) AS nightlife,
       CASE WHEN c_custkey % 53 = 0 THEN ' Smarch ' ELSE {_sql_list(MONTH_NAMES)}[(c_custkey % 12) + 1] END AS month,
       {_sql_budget_case()} AS budget,
       {_sql_list(WEATHER_CHOICES)}[(c_custkey % 5) + 1] AS weather_preference,
       CAST(c_custkey % 7 + 1 AS INTEGER) AS top_n
FROM customer
"""


# --------------------------------------------------------------------- answers
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planner answers: style, companion, activities, climate choice, free text."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    acts = _arr(ACTIVITY_NAMES)
    activities = F.when(k % 10 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.element_at(acts, (k % 8 + 1).cast("int")),
                F.element_at(acts, ((k / 8).cast("long") % 8 + 1).cast("int"))))
    return p.select(
        k.alias("answer_id"),
        F.element_at(_arr(TRIP_STYLE_NAMES), (k % 6 + 1).cast("int")).alias("trip_style"),
        activities.alias("activities"),
        F.element_at(_arr(COMPANIONS), (k % 4 + 1).cast("int")).alias("companion"),
        F.element_at(_arr(CLIMATE_CHOICES), ((k / 4).cast("long") % 4 + 1).cast("int")).alias("climate_preference"),
        F.col("p_name").alias("trip_description"),
        F.element_at(_arr(MONTH_NAMES), (k % 12 + 1).cast("int")).alias("month"),
        F.element_at(_arr(list(rules.BUDGET_MATCH_MATRIX)), (k % 3 + 1).cast("int")).alias("budget"),
        F.lit(3).alias("top_n"),
    )


ANSWERS_SQL = f"""
SELECT p_partkey AS answer_id,
       {_sql_list(TRIP_STYLE_NAMES)}[(p_partkey % 6) + 1] AS trip_style,
       CASE WHEN p_partkey % 10 = 0 THEN []::VARCHAR[]
            ELSE [{_sql_list(ACTIVITY_NAMES)}[(p_partkey % 8) + 1],
                  {_sql_list(ACTIVITY_NAMES)}[((p_partkey // 8) % 8) + 1]] END AS activities,
       {_sql_list(COMPANIONS)}[(p_partkey % 4) + 1] AS companion,
       {_sql_list(CLIMATE_CHOICES)}[((p_partkey // 4) % 4) + 1] AS climate_preference,
       p_name AS trip_description
FROM part
"""


# Text rules whose terms occur in the texts at hand (part names, conversation
# turns): whole words, terms of several words, and words that only look alike.
STANDIN_KEYWORD_WEIGHTS = {
    "beach": {"terms": ["blue", "rings", "blue bolt", "there"], "weights": {"beach": 3}},
    "food": {"terms": ["plates", "hot plate", "der"], "weights": {"food": 3}},
    "culture": {"terms": ["old", "anvils", "that the", "mention"], "weights": {"culture": 3}},
    "nature": {"terms": ["rod", "cold rod", "from"], "weights": {"nature": 3}},
    "nightlife": {"terms": ["gizmos", "red", "with the"], "weights": {"nightlife": 3}},
    "relax": {"terms": ["small", "new gear", "this is", "widgets"], "weights": {"beach": 1, "nature": 1}},
}
STANDIN_WEATHER_KEYWORDS = {
    "Warm": ["hot", "red", "hot gear", "other"],
    "Mild": ["new", "old bolt", "that", "la que"],
    "Cool": ["cold", "blue", "cold ring", "and the"],
}


# ------------------------------------------------------------------------ guides
BEST_MONTHS = ["May, June, September", "April, May, September", "June, September"]


def guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guides of two thirds of the destinations; some lack a field."""
    d = destinations(spark, sf_dir).select("destination_id", "destination_name", "country").filter("destination_id % 3 <> 0")
    k = F.col("destination_id")
    return d.select(
        "destination_name", F.when(k % 5 != 0, F.concat("country", F.lit(" Airport"))).alias("airport"),
        F.format_string("%d-%d days", k % 4 + 2, k % 4 + 5).alias("stay"), F.element_at(_arr(BEST_MONTHS), (k % 3 + 1).cast("int")).alias("best_months"),
        F.array(F.concat("country", F.lit(" old town")), F.format_string("Viewpoint %d", k)).alias("dont_miss"),
        F.when(k % 7 != 0, F.array(F.lit("Food"), F.lit("Walks"))).alias("highlights"),
        F.array(F.format_string("Budget: %d", k % 3)).alias("good_to_know"))


def guides_sql() -> str:
    return f"""
SELECT destination_name, CASE WHEN destination_id % 5 <> 0 THEN country || ' Airport' END AS airport,
       printf('%d-%d days', destination_id % 4 + 2, destination_id % 4 + 5) AS stay, {_sql_list(BEST_MONTHS)}[(destination_id % 3) + 1] AS best_months,
       [country || ' old town', 'Viewpoint ' || destination_id] AS dont_miss,
       CASE WHEN destination_id % 7 <> 0 THEN ['Food', 'Walks'] END AS highlights, ['Budget: ' || (destination_id % 3)] AS good_to_know
FROM ({DESTINATIONS_SQL}) WHERE destination_id % 3 <> 0
"""


# ----------------------------------------------------------------- daily payloads
def weather_payloads(spark: SparkSession, sf_dir: str, shortened: bool = False) -> DataFrame:
    """One JSON payload with parallel arrays per destination and month of the year;
    ``shortened``: every seventh destination's payloads lack the last day's rain."""
    days = daily_weather(spark, sf_dir, ("l_orderkey", "l_linenumber"))
    rows = days.groupBy("destination_id", F.month("day").alias("m")).agg(F.array_sort(F.collect_list(
        F.struct("day", "l_orderkey", "l_linenumber", "temperature_2m_mean", "precipitation_sum"))).alias("rows"))  # a month of a destination
    t, r = F.transform("rows", lambda x: x["temperature_2m_mean"]), F.transform("rows", lambda x: x["precipitation_sum"])
    if shortened:
        r = F.when(F.col("destination_id") % 7 == 0, F.slice(r, 1, F.greatest(F.size("rows") - 1, F.lit(0)))).otherwise(r)
    time = F.transform("rows", lambda x: x["day"].cast("string"))
    return rows.select("destination_id", F.to_json(F.struct(F.struct(time.alias("time"), t.alias("temperature_2m_mean"),
                                                                     r.alias("precipitation_sum")).alias("daily"))).alias("payload"))


# ------------------------------------------------------- price / hotel payloads
# Keyword rules for the stand-in items (part names), same shape as the
# reference's price keyword table.
STANDIN_PRICE_KEYWORDS = {
    "restaurant_meal_price_eur": ["ring"],
    "cappuccino_price_eur": ["widget"],
    "local_transport_price_eur": ["bolt"],
    "groceries_basket_price_eur": ["gear", "plate", "rod"],
}


def _dest_key_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                      "l_quantity", "l_extendedprice")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dest = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", F.col("s_name").alias("destination_name"), F.col("n_name").alias("country"))
    return li.join(dest, li.l_suppkey == dest.s_suppkey)


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price payload JSON per lineitem: the part as an item with its unit price."""
    li = _dest_key_lineitems(spark, sf_dir)
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    payload = F.to_json(F.struct(
        F.col("country").alias("name"), F.col("l_linenumber").alias("contributors"),
        F.array(F.struct(F.col("p_name").alias("item_name"),
                         (F.col("l_extendedprice") / F.col("l_quantity")).alias("average_price"))).alias("prices")))
    return j.select("destination_name", "country", payload.alias("payload"))


def hotel_offer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders act as hotels (rank = 1-based order rank within the supplier), each
    lineitem an offer; line 7 carries no total (skipped like a missing price)."""
    from pyspark.sql import Window
    li = _dest_key_lineitems(spark, sf_dir).select("destination_name", "country", "l_orderkey", "l_linenumber", "l_extendedprice")
    total = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(
        F.col("l_extendedprice").cast("string"))
    payload = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.struct(total.alias("total")).alias("price")))
                                                  .alias("offers"))).alias("data")))
    w = Window.partitionBy("destination_name", "country").orderBy("l_orderkey")
    # ranked on narrow rows; the payload is written only for hotels that a reader keeps
    ranked = li.withColumn("hotel_rank", F.dense_rank().over(w))
    return ranked.select("destination_name", "country", "hotel_rank", payload.alias("payload"))


PRICE_ITEMS_SQL = """
SELECT s_name AS destination_name, n_name AS country, n_name AS numbeo_city_name, l_linenumber AS numbeo_contributors,
       lower(p_name) AS item_name, l_extendedprice / l_quantity AS average_price
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN part ON l_partkey = p_partkey
"""

HOTEL_OFFERS_SQL = """
SELECT s_name AS destination_name, n_name AS country,
       dense_rank() OVER (PARTITION BY s_name, n_name ORDER BY l_orderkey) AS hotel_rank,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS total
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""


# ------------------------------------------------------------------ gazetteer
def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate places: every lineitem proposes a point for its supplier's
    name (written in upper case with padding, so matching must normalise)."""
    li = _dest_key_lineitems(spark, sf_dir)
    return li.select(F.concat(F.lit("  "), F.upper("destination_name"), F.lit(" ")).alias("search_name"),
                     F.upper("country").alias("country"),
                     ((F.col("l_orderkey") * 13) % 17000 / 100.0 - 85.0).alias("lat"),
                     ((F.col("l_orderkey") * 7) % 36000 / 100.0 - 180.0).alias("lon"),
                     F.col("l_extendedprice").alias("importance"))


GAZETTEER_SQL = """
SELECT '  ' || upper(s_name) || ' ' AS search_name, upper(n_name) AS country,
       ((l_orderkey * 13) % 17000) / 100.0 - 85.0 AS lat, ((l_orderkey * 7) % 36000) / 100.0 - 180.0 AS lon,
       l_extendedprice AS importance
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""
