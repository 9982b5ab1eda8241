"""Radius join with per-category counts, and the grids it runs on.

For every destination, count the POIs of each tag rule within the
destination's own radius (node, way and relation all count; no hit -> 0).

Plan (no cross join, no all-pairs):

1. Radii fall into classes, one per power of two, and each class that occurs has
   a grid of its own whose cells are about as wide as its radii. So a destination
   with a small radius looks into small cells, whatever the largest radius is.
2. POIs: explode the tag map, equi-join a small rule table (one row per feature),
   pre-aggregate identical (location, feature) rows, and give each its single
   cell ``(level, band, lon_cell)`` per class.
3. Destinations: explode only the cells of their class that the radius can touch
   (latitude band range, exact spherical longitude extent, wrap across +-180, whole
   band when the cap reaches a pole).
4. Cells are counted on both sides. A cell with more than ``cell_rows`` points (a dense
   city) or ``dest_rows`` destinations is cut into as many parts as it needs; only its
   rows are repeated, and no key has more than ``cell_rows * dest_rows`` pairs.
5. Equi-join on ``(level, band, lon_cell, part, dest_part)`` over as many tasks as the
   pairs ask for, not as few bytes would do with. Each POI sits in one cell of a class,
   so no pair appears twice.
6. Distance by the chord between unit vectors, the haversine formula where a chord is
   within rounding of the radius; then one conditional aggregate per feature
   (partial aggregation before the shuffle), left-joined back, missing -> 0.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import haversine_m
from tripforge.session import cut_lineage

M_PER_DEG = math.pi * rules.EARTH_RADIUS_M / 180.0


def tag_rules_frame(spark: SparkSession,
                    place_features: Mapping[str, tuple[str, str]] = rules.PLACE_FEATURES) -> DataFrame:
    rows = [(feature, key, value) for feature, (key, value) in place_features.items()]
    return spark.createDataFrame(rows, "feature string, tag_key string, tag_value string")


#: Smallest radius class in metres; points and destinations of a cell that go to one part; pairs a task is meant to compare.
LEAST_RADIUS_M, CELL_ROWS, DEST_ROWS, PAIRS_PER_TASK = 1000.0, 50_000, 400, 20_000_000
#: Far beyond the rounding of a squared half chord, which is 1 at most.
CHORD_ROUNDING = 1e-12


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def radius_level(radius_m) -> Column:
    """The class of a radius: the least n with ``LEAST_RADIUS_M * 2**n`` at least as large."""
    r = _col(radius_m)
    return F.greatest(F.ceil(F.log2(r / F.lit(LEAST_RADIUS_M)) - F.lit(1e-9)), F.lit(0)).cast("int")


def level_cell_deg(level) -> Column:
    """Width in degrees of a class's cells."""
    return F.least(F.lit(LEAST_RADIUS_M / M_PER_DEG) * F.pow(F.lit(2.0), level), F.lit(180.0))


def band_of(lat: Column, cell_deg) -> Column:
    c = _col(cell_deg)
    return F.least(F.floor((lat + F.lit(90.0)) / c), F.ceil(F.lit(180.0) / c) - 1).cast("int")


def lon_cells_in_band(band: Column, cell_deg) -> Column:
    """Number of longitude cells of a band: cells are at least ``cell_deg``
    wide at the band's pole-side edge."""
    c = _col(cell_deg)
    lo = band * c - F.lit(90.0)
    hi = lo + c
    max_abs = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
    n = F.floor(F.lit(360.0) * F.cos(F.radians(max_abs)) / c)
    return F.greatest(n, F.lit(1)).cast("int")


def lon_cell_of(lon: Column, band: Column, cell_deg) -> Column:
    n = lon_cells_in_band(band, cell_deg)
    width = F.lit(360.0) / n
    return F.least(F.floor((lon + F.lit(180.0)) / width), n - 1).cast("int")


def poi_features(pois: DataFrame, tag_rules: DataFrame) -> DataFrame:
    """(poi_id, lat, lon, tags map) -> (lat, lon, feature) per matching tag."""
    exploded = pois.select("lat", "lon", F.explode("tags").alias("tag_key", "tag_value"))
    return exploded.join(tag_rules, ["tag_key", "tag_value"]).select("lat", "lon", "feature")


CELL = ["level", "band", "lon_cell"]


def destination_cells(dest: DataFrame, lat: str = "latitude", lon: str = "longitude", radius: str = "search_radius_m") -> DataFrame:
    """Explode each destination (with its ``level`` and ``cell_deg``) into the (level, band, lon_cell) it can reach."""
    la, lo_, r = F.col(lat), F.col(lon), F.col(radius).cast("double")
    cell_deg = F.col("cell_deg")
    dlat = r / F.lit(M_PER_DEG)
    b_lo = band_of(F.greatest(la - dlat, F.lit(-90.0)), cell_deg)
    b_hi = band_of(F.least(la + dlat, F.lit(90.0)), cell_deg)
    ratio = F.sin(r / F.lit(rules.EARTH_RADIUS_M)) / F.cos(F.radians(la))
    # Cap reaching a pole (or ratio >= 1): every longitude; else exact extent.
    all_lon = (F.abs(la) + dlat >= F.lit(90.0)) | (ratio >= F.lit(1.0)) | ratio.isNull()
    dlon = F.when(all_lon, F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)))
    banded = dest.select("*", F.explode(F.sequence(b_lo, b_hi)).alias("band"), dlon.alias("__dlon"))
    n = lon_cells_in_band(F.col("band"), cell_deg)
    width = F.lit(360.0) / n
    c_lo = F.floor((lo_ - F.col("__dlon") + F.lit(180.0)) / width).cast("int")
    c_hi = F.floor((lo_ + F.col("__dlon") + F.lit(180.0)) / width).cast("int")
    cells = F.when(c_hi - c_lo + 1 >= n, F.sequence(F.lit(0), n - 1)).otherwise(
        F.transform(F.sequence(c_lo, c_hi), lambda c: F.pmod(c, n)))
    return banded.select("*", F.explode(F.array_distinct(cells)).alias("lon_cell")).drop("__dlon")


def candidate_pairs(dest: DataFrame, pois: DataFrame, tag_rules: DataFrame | None = None,
                    place_features: Mapping[str, tuple[str, str]] = rules.PLACE_FEATURES,
                    key: str = "destination_id", cell_rows: int = CELL_ROWS, cell_m: float | None = None,
                    dest_rows: int = DEST_ROWS) -> DataFrame:
    """Destinations beside the points (lat, lon, feature, n) of the cells they reach.
    ``cell_m``: one grid of that width for all radii instead of one per class."""
    tag_rules = tag_rules if tag_rules is not None else tag_rules_frame(dest.sparkSession, place_features)
    d = dest.select(key, "latitude", "longitude", "search_radius_m").dropna().filter("search_radius_m >= 0")
    if cell_m is None:
        d = d.withColumn("level", radius_level(F.greatest(F.col("search_radius_m"), F.lit(1)).cast("double"))).withColumn("cell_deg", level_cell_deg(F.col("level")))
    else:
        d = d.select("*", F.lit(0).alias("level"), F.lit(min(cell_m / M_PER_DEG, 180.0)).alias("cell_deg"))
    d = cut_lineage(d, "reaching")  # narrow; read three times
    levels = [(r["level"], r["cell_deg"]) for r in d.select("level", "cell_deg").distinct().collect()]  # a few classes: the globe has 25

    # Identical points count together: exact, and shrinks dense duplicates early.
    points = cut_lineage(poi_features(pois, tag_rules).groupBy("lat", "lon", "feature").agg(F.count(F.lit(1)).alias("n")), "points")
    grids = F.array(*[F.struct(F.lit(lv).alias("level"), F.lit(deg).alias("cell_deg")) for lv, deg in sorted(levels)]) if levels else F.lit(None).cast("array<struct<level:int,cell_deg:double>>")
    placed = points.select("*", F.explode(grids).alias("g")).select("lat", "lon", "feature", "n", "g.level", "g.cell_deg")
    placed = placed.withColumn("band", band_of(F.col("lat"), F.col("cell_deg"))).withColumn("lon_cell", lon_cell_of(F.col("lon"), F.col("band"), F.col("cell_deg"))).drop("cell_deg")
    reach = destination_cells(d).drop("cell_deg")
    # cells that both sides have, with their parts and pairs
    met = (placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("points"))
           .join(reach.groupBy(*CELL).agg(F.count(F.lit(1)).alias("dests")), CELL))
    met = cut_lineage(met.select(*CELL, F.ceil(F.col("points") / F.lit(cell_rows)).cast("int").alias("parts"),
                                 F.ceil(F.col("dests") / F.lit(dest_rows)).cast("int").alias("dest_parts"),
                                 (F.col("points") * F.col("dests")).alias("pairs")), "cells")
    pairs = met.agg(F.sum("pairs")).first()[0] or 0
    tasks = max(dest.sparkSession.sparkContext.defaultParallelism * 2, -(-int(pairs) // PAIRS_PER_TASK))
    crowded = met.select(*CELL, "parts", "dest_parts")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    placed = placed.join(crowded, CELL).withColumn("part", F.pmod(F.xxhash64("lat", "lon", "feature"), F.col("parts")).cast("int"))
    placed = placed.withColumn("dest_part", each("dest_parts")).drop("parts", "dest_parts")
    reach = reach.join(crowded, CELL).withColumn("dest_part", F.pmod(F.xxhash64(key), F.col("dest_parts")).cast("int"))
    reach = reach.withColumn("part", each("parts")).drop("parts", "dest_parts")
    block = [*CELL, "part", "dest_part"]
    half = F.sin(F.least(F.col("search_radius_m") / F.lit(2.0 * rules.EARTH_RADIUS_M), F.lit(math.pi / 2)))
    reach = reach.select("*", *half_unit("latitude", "longitude", "dest_"), (half * half).alias("reach_h"))
    placed = placed.select("*", *half_unit("lat", "lon", "poi_"))
    return reach.repartition(tasks, *block).join(placed.repartition(tasks, *block).hint("shuffle_hash"), block)


def half_unit(lat: str, lon: str, prefix: str) -> list[Column]:
    """Half the unit vector of a place: a squared distance of two is the haversine of their angle."""
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return [(F.cos(la) * F.cos(lo) * 0.5).alias(f"{prefix}x"), (F.cos(la) * F.sin(lo) * 0.5).alias(f"{prefix}y"), (F.sin(la) * 0.5).alias(f"{prefix}z")]


def within_radius() -> Column:
    """Of a candidate pair: no further apart than the radius, by the chord, and by
    ``haversine_m`` where rounding could decide."""
    d = [F.col(f"dest_{x}") - F.col(f"poi_{x}") for x in "xyz"]
    gap = d[0] * d[0] + d[1] * d[1] + d[2] * d[2] - F.col("reach_h")
    exact = haversine_m("latitude", "longitude", "lat", "lon") <= F.col("search_radius_m")
    return F.when(gap < -CHORD_ROUNDING, F.lit(True)).when(gap > CHORD_ROUNDING, F.lit(False)).otherwise(exact)


def poi_counts(dest: DataFrame, pois: DataFrame, tag_rules: DataFrame | None = None,
               place_features: Mapping[str, tuple[str, str]] = rules.PLACE_FEATURES,
               key: str = "destination_id", cell_rows: int = CELL_ROWS, dest_rows: int = DEST_ROWS) -> DataFrame:
    """Add one count column per feature to ``dest`` (columns: key, latitude,
    longitude, search_radius_m)."""
    features = list(place_features)
    pairs = candidate_pairs(dest, pois, tag_rules, place_features, key, cell_rows, dest_rows=dest_rows)
    near = pairs.where(within_radius())
    counts = near.groupBy(key).agg(*[
        F.sum(F.when(F.col("feature") == f, F.col("n"))).alias(f) for f in features])
    out = dest.drop(*[f for f in features if f in dest.columns]).join(counts, key, "left")
    # an unknown place has no counts, not zero places around it
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("search_radius_m").isNotNull()
    return out.select(*[c for c in out.columns if c not in features],
                      *[F.when(known, F.coalesce(F.col(f), F.lit(0))).cast("long").alias(f) for f in features])
