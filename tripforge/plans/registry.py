"""Registered queries (one per operator family) and their DuckDB oracles.

Every query reads the driver tables of ``sf_dir`` (or what Spark derives from
them) in full; none runs on made-up input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.plans import oracle
from tripforge.plans.catalog import build_catalog
from tripforge.sources import standins
from tripforge.sources.requests import parse_requests

_CATALOGS: dict[tuple[str, str], tuple[tuple, DataFrame]] = {}
#: The tables that a catalogue is built from.
CATALOG_TABLES = ("supplier", "nation", "customer", "lineitem")


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size and last change of the input files, from their listing alone."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in CATALOG_TABLES])
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue is built once per session and state of the input folder (checkpointed)."""
    from tripforge.session import apply_runtime_defaults
    apply_runtime_defaults(spark)
    key, state = (spark.sparkContext.applicationId, sf_dir), _state_of(spark, sf_dir)
    if key not in _CATALOGS or _CATALOGS[key][0] != state:
        _CATALOGS[key] = (state, build_catalog(spark, sf_dir))
    return _CATALOGS[key][1]


REC_COLUMNS = [
    "request_id", "rank", "destination_name", "country", "recommendation_score", "preference_score",
    "weather_score", "cost_score", "budget_match_score", "cluster_bonus", "must_have_penalty",
    "cost_of_living_index", "cost_level", "cluster_profile", "dominant_travel_style", "climate_category",
    "summer_avg_temp", "summer_avg_daily_rain", "search_radius_m", "restaurant_count", "museum_count",
    "nearby_beach_count", "explanation", "natural_reason",
]
REASON_FIELDS = ["weather", "budget", "food", "beach", "culture", "nature", "nightlife",
                 "cluster_bonus", "must_have_penalty"]


# ----------------------------------------------------------------- queries
def q_catalog(spark, sf_dir):
    return catalog(spark, sf_dir).select(*oracle.CATALOG_COLUMNS)


def q_seasonal_weather(spark, sf_dir):
    from tripforge.operators.features import seasonal_features
    return seasonal_features(standins.daily_weather(spark, sf_dir))


def q_poi_counts(spark, sf_dir):
    from tripforge.operators.features import resolve_destination_type
    from tripforge.operators.spatial import poi_counts
    dest = resolve_destination_type(standins.destinations(spark, sf_dir),
                                    radius_by_type=standins.STANDIN_TYPE_RADIUS_M,
                                    default_radius=standins.STANDIN_DEFAULT_RADIUS_M)
    out = poi_counts(dest, standins.pois(spark, sf_dir))
    return out.select("destination_id", "search_radius_m", *rules.PLACE_COUNT_COLUMNS)


def _recs(spark, sf_dir):
    from tripforge.operators.recommend import recommend
    valid, _ = parse_requests(standins.requests(spark, sf_dir))
    return recommend(valid, catalog(spark, sf_dir))


def q_recommend(spark, sf_dir):
    return _recs(spark, sf_dir).select(*REC_COLUMNS)


def q_recommend_reason(spark, sf_dir):
    recs = _recs(spark, sf_dir)
    return recs.select("request_id", "rank", *[F.col(f"reason.{f}").alias(f"reason_{f}") for f in REASON_FIELDS])


def q_rejected_requests(spark, sf_dir):
    _, rejected = parse_requests(standins.requests(spark, sf_dir))
    return rejected.select("request_id", "month", "season", "error")


# ------------------------------------------------------------------ oracles
def o_catalog() -> str:
    return f"WITH {oracle.catalog_ctes()}\nSELECT {', '.join(oracle.CATALOG_COLUMNS)} FROM catalog"


def o_seasonal_weather() -> str:
    ctes = oracle.places_ctes()
    cols = ", ".join(f"{s}_avg_temp, {s}_avg_daily_rain" for s in rules.SEASONS)
    return f"WITH {ctes}\nSELECT destination_id, {cols} FROM weather"


def o_poi_counts() -> str:
    cols = ", ".join(rules.PLACE_COUNT_COLUMNS)
    return f"WITH {oracle.places_ctes()}\nSELECT destination_id, search_radius_m, {cols} FROM places0"


def o_recommend() -> str:
    cols = [c for c in REC_COLUMNS if c not in ("explanation", "natural_reason")]
    return (f"WITH {oracle.scored_ctes()}\nSELECT {', '.join(cols)}, {oracle.explanation_sql()} AS explanation, "
            f"{oracle.natural_reason_sql()} AS natural_reason FROM top")


def o_recommend_reason() -> str:
    src = {"weather": "weather_score", "budget": "budget_match_score", "food": "food_recommendation_signal",
           "beach": "beach_recommendation_signal", "culture": "culture_recommendation_signal",
           "nature": "nature_recommendation_signal", "nightlife": "nightlife_recommendation_signal",
           "cluster_bonus": "cluster_bonus", "must_have_penalty": "must_have_penalty"}
    cols = ", ".join(f"{oracle.R(src[f])} AS reason_{f}" for f in REASON_FIELDS)
    return f"WITH {oracle.scored_ctes()}\nSELECT request_id, rank, {cols} FROM top"


def o_rejected_requests() -> str:
    return f"WITH {oracle.valid_requests_ctes()}\nSELECT request_id, month, season, error FROM req2 WHERE error <> ''"


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], Callable[[], str] | None]] = {
    "catalog_features": (q_catalog, o_catalog),
    "seasonal_weather": (q_seasonal_weather, o_seasonal_weather),
    "poi_radius_counts": (q_poi_counts, o_poi_counts),
    "recommend_top_n": (q_recommend, o_recommend),
    "recommend_reason": (q_recommend_reason, o_recommend_reason),
    "rejected_requests": (q_rejected_requests, o_rejected_requests),
}


def _all():
    from tripforge.plans import registry_collect, registry_more, registry_reports
    out = dict(QUERIES)
    out.update(registry_reports.QUERIES)
    out.update(registry_more.QUERIES)
    out.update(registry_collect.QUERIES)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: fn for k, (fn, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: o() for k, (_, o) in _all().items() if o is not None}
