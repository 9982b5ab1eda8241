"""Catalogue build (C4 + R13): destinations -> weather -> places -> scores ->
features -> costs -> recommendation signals -> profile.

Built once, persisted, then reused by every request (the reference rebuilt it
per request). ``build_catalog`` works on the driver-table stand-ins;
``feature_chain`` is the reusable C4 part for any "with places" table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.cluster import cluster_labels
from tripforge.operators.costs import add_cost_features
from tripforge.operators.features import (
    add_climate_features, add_destination_type_features, add_experience_features,
    add_scores, resolve_destination_type, seasonal_features,
)
from tripforge.operators.ranking import pct_ranks
from tripforge.operators.spatial import poi_counts
from tripforge.session import checkpoint_dir, cut_lineage
from tripforge.sources import standins
from tripforge.sources.labels import publish_labels, read_labels


def add_recommendation_signals(df: DataFrame, rank_method: str = "bucketed") -> DataFrame:
    """Five average-tie percentile signals (a+b is null if either is null)."""
    c = F.col
    specs = {
        "food_recommendation_signal": c("restaurant_count") + c("cafe_count"),
        "nightlife_recommendation_signal": c("bar_count"),
        "culture_recommendation_signal": c("museum_count"),
        "nature_recommendation_signal": c("park_count") + c("nearby_beach_count"),
        "beach_recommendation_signal": c("nearby_beach_count"),
    }
    key = ["destination_id"] if "destination_id" in df.columns else ["destination_name", "country"]
    return pct_ranks(df, key, specs, method=rank_method)


def feature_chain(with_places: DataFrame, living_costs: DataFrame | None,
                  travel_costs: DataFrame | None = None, rank_method: str = "bucketed",
                  validate: bool = True) -> DataFrame:
    """C4: climate -> type -> experience -> cost."""
    out = add_climate_features(with_places)
    out = add_destination_type_features(out, rank_method=rank_method)
    out = add_experience_features(out)
    return add_cost_features(out, living_costs, travel_costs, validate=validate)


def with_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in 'with places' table: coordinates, seasonal weather, radius,
    six POI counts and five scores."""
    dest = resolve_destination_type(standins.destinations(spark, sf_dir),
                                    radius_by_type=standins.STANDIN_TYPE_RADIUS_M,
                                    default_radius=standins.STANDIN_DEFAULT_RADIUS_M)
    weather = seasonal_features(standins.daily_weather(spark, sf_dir))
    dest = dest.join(weather, "destination_id", "left")
    counted = poi_counts(dest, standins.pois(spark, sf_dir))
    # Reliable checkpoint: later global statistics and ranks re-read this
    # small table instead of re-running the radius join and weather scan.
    return add_scores(cut_lineage(counted, "with_places"))


#: Clusters of the catalogue's profile, and most iterations of a restart.
PROFILE_K, PROFILE_ITERATIONS = 3, 20


def catalog_labels(features: DataFrame, version: int = 1, key: tuple[str, ...] = ("destination_name", "country")) -> DataFrame:
    """Cluster the feature table, publish the labels as ``version``, read them back."""
    path = f"{checkpoint_dir(features.sparkSession).rstrip('/')}/tables/labels-{uuid.uuid4().hex}"
    labels = cluster_labels(features, [PROFILE_K], max_iter=PROFILE_ITERATIONS, key=key)
    publish_labels(labels, path, version, key)
    return read_labels(features.sparkSession, path, version)


def build_catalog(spark: SparkSession, sf_dir: str, rank_method: str = "bucketed", persist: bool = True,
                  validate: bool = True, labels: DataFrame | None = None) -> DataFrame:
    """Features, cluster labels (``labels``, or those of a clustering of the
    features) and recommendation signals of every destination."""
    places = with_places(spark, sf_dir)
    living = standins.living_costs(spark, sf_dir)
    feats = cut_lineage(feature_chain(places, living, None, rank_method=rank_method, validate=validate), "features")
    cat = assemble_catalog(feats, catalog_labels(feats) if labels is None else labels, rank_method=rank_method)
    if persist:
        cat = cut_lineage(cat, "catalog")
    return cat


def assemble_catalog(features: DataFrame, clustered: DataFrame,
                     key: tuple[str, ...] = ("destination_name", "country"), rank_method: str = "bucketed") -> DataFrame:
    """When the clustered table lacks the scoring columns, join its cluster
    labels onto the full feature table (validated one-to-one), then add the
    recommendation signals. Built once and persisted, not per request."""
    from tripforge.operators.joins import left_join_1to1
    labels = clustered.select(*key, *[c for c in ("cluster", "cluster_profile") if c in clustered.columns])
    base = features.drop(*[c for c in ("cluster", "cluster_profile") if c in features.columns])
    return add_recommendation_signals(left_join_1to1(base, labels, list(key)), rank_method=rank_method)
