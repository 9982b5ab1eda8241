"""S4 geocoding as a gazetteer join; S8/U1 incremental collection.

* ``geocode``: normalised equi-join of (search_name, country) to a gazetteer,
  best candidate = highest importance (ties: smallest lat, then lon), chosen by
  a ``max`` over a struct, which aggregates partially before the shuffle, so a
  name with a huge candidate list never lands whole in one task.
* ``pending``: destinations without a complete stored result made with the same
  type, radius and coordinates (4 decimals) - a ``left_anti`` join.
* ``upsert``: union of stored and fresh rows; the latest run wins per key
  (``max_by``, again partially aggregated).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge import rules


def _norm(c) -> F.Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def geocode(destinations: DataFrame, gazetteer: DataFrame, name_col: str = "search_name",
            country_col: str = "country") -> DataFrame:
    """Add latitude/longitude (null when no candidate). ``search_name``
    defaults to ``destination_name`` when missing."""
    dest = destinations
    if name_col not in dest.columns:
        dest = dest.withColumn(name_col, F.col("destination_name"))
    dest = dest.withColumn(name_col, F.coalesce(F.col(name_col), F.col("destination_name")))
    best = (gazetteer.select(_norm("search_name").alias("__n"), _norm("country").alias("__c"),
                             F.struct(F.col("importance"), (-F.col("lat")).alias("nlat"),
                                      (-F.col("lon")).alias("nlon")).alias("__k"))
            .groupBy("__n", "__c").agg(F.max("__k").alias("__best")))
    out = dest.drop("latitude", "longitude").join(
        best, (_norm(name_col) == F.col("__n")) & (_norm(country_col) == F.col("__c")), "left")
    return out.select(*[c for c in dest.columns if c not in ("latitude", "longitude")],
                      (-F.col("__best.nlat")).alias("latitude"), (-F.col("__best.nlon")).alias("longitude"))


def pending(destinations: DataFrame, done: DataFrame, key: Sequence[str] = ("destination_id",),
            counts: Sequence[str] = rules.PLACE_COUNT_COLUMNS) -> DataFrame:
    """Destinations whose stored result is missing, incomplete or stale."""
    complete = done
    for c in counts:
        complete = complete.where(F.col(c).isNotNull())
    cur = destinations.select("*", F.round("latitude", 4).alias("__lat"), F.round("longitude", 4).alias("__lon"))
    prev = complete.select(*key, "destination_type", "search_radius_m",
                           F.round("place_latitude", 4).alias("__lat"), F.round("place_longitude", 4).alias("__lon"))
    cond = [*key, "destination_type", "search_radius_m", "__lat", "__lon"]
    return cur.join(prev, cond, "left_anti").drop("__lat", "__lon")


def upsert(done: DataFrame, fresh: DataFrame, key: Sequence[str] = ("destination_id",),
           order_col: str = "run_id") -> DataFrame:
    """Latest row per key over stored + fresh rows."""
    allrows = done.unionByName(fresh, allowMissingColumns=True)
    cols = [c for c in allrows.columns if c not in key]
    best = allrows.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("__r"))
    return best.select(*key, *[F.col(f"__r.{c}").alias(c) for c in cols])


def new_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns present in ``after`` but not in ``before`` (schema only)."""
    names = [f.name for f in after.schema.fields if f.name not in before.columns]
    types = {f.name: f.dataType.simpleString() for f in after.schema.fields}
    return after.sparkSession.createDataFrame([(n, types[n]) for n in names], "column string, type string")
