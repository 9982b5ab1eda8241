import random

import pytest
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.functions.expr import haversine_m
from tripforge.operators.spatial import candidate_pairs, poi_counts, poi_features, tag_rules_frame


def poi_counts_brute_force(dest, pois, key="destination_id"):
    """All pairs, for small fixtures."""
    features = list(rules.PLACE_FEATURES)
    pf = poi_features(pois, tag_rules_frame(dest.sparkSession))
    near = dest.select(key, "latitude", "longitude", "search_radius_m").crossJoin(pf).where(
        haversine_m("latitude", "longitude", "lat", "lon") <= F.col("search_radius_m"))
    counts = near.groupBy(key).agg(*[F.sum(F.when(F.col("feature") == f, 1)).alias(f) for f in features])
    out = dest.join(counts, key, "left")
    return out.select(*[c for c in out.columns if c not in features], *[F.coalesce(F.col(f), F.lit(0)).cast("long").alias(f) for f in features])


@pytest.mark.parametrize("cell_rows", [50_000, 7])
def test_grid_join_equals_brute_force(spark, cell_rows):
    """Radii of every class from none to half the globe; with 7 rows a cell many are cut into parts."""
    rnd = random.Random(3)
    tags = [("amenity", "restaurant"), ("amenity", "cafe"), ("amenity", "bar"), ("tourism", "museum"),
            ("leisure", "park"), ("natural", "beach"), ("shop", "bakery")]
    dest = []
    for i in range(60):
        lat = rnd.choice([rnd.uniform(-89.9, 89.9), rnd.uniform(80, 89.99), rnd.uniform(-40, 40)])
        lon = rnd.choice([rnd.uniform(-180, 180), rnd.uniform(175, 180), rnd.uniform(-180, -175)])
        dest.append((i, lat, lon, rnd.choice([0, 900, 1000, 1001, 50_000, 64_000, 300_000, 1_500_000, 9_000_000, 21_000_000])))
    pois = []
    for j in range(3000):
        lat = rnd.uniform(-90, 90) if j % 3 else dest[j % 60][1] + rnd.uniform(-2, 2)
        lon = rnd.uniform(-180, 180) if j % 3 else dest[j % 60][2] + rnd.uniform(-2, 2)
        lat, lon = max(-90.0, min(90.0, lat)), ((lon + 180) % 360) - 180
        k, v = rnd.choice(tags)
        pois.append((j, lat, lon, "node", {k: v}))
    pois.append((9999, dest[0][1], dest[0][2], "way", {"amenity": "restaurant", "tourism": "museum"}))
    d = spark.createDataFrame(dest, "destination_id long, latitude double, longitude double, search_radius_m int")
    p = spark.createDataFrame(pois, "poi_id long, lat double, lon double, element string, tags map<string,string>")
    cols = ["destination_id", "restaurant_count", "cafe_count", "bar_count", "museum_count", "park_count",
            "nearby_beach_count"]
    fast = sorted(tuple(r) for r in poi_counts(d, p, cell_rows=cell_rows).select(*cols).collect())
    slow = sorted(tuple(r) for r in poi_counts_brute_force(d, p).select(*cols).collect())
    assert fast == slow
    assert sum(sum(r[1:]) for r in fast) > 0


def test_destination_without_pois_counts_zero(spark):
    d = spark.createDataFrame([(1, 0.0, 0.0, 1000)], "destination_id long, latitude double, longitude double, search_radius_m int")
    p = spark.createDataFrame([(1, 10.0, 10.0, "node", {"amenity": "bar"})],
                              "poi_id long, lat double, lon double, element string, tags map<string,string>")
    row = poi_counts(d, p).first()
    assert row.bar_count == 0 and row.restaurant_count == 0


def test_classes_meet_fewer_candidates_than_one_grid(spark):
    """Most radii are small and one is large: one grid as wide as the largest pairs many more."""
    rnd = random.Random(5)
    d = spark.createDataFrame([(i, rnd.uniform(40, 50), rnd.uniform(0, 10), 2000 if i else 200_000) for i in range(300)],
                              "destination_id long, latitude double, longitude double, search_radius_m int")
    p = spark.createDataFrame([(j, rnd.uniform(40, 50), rnd.uniform(0, 10), "node", {"amenity": "bar"}) for j in range(4000)],
                              "poi_id long, lat double, lon double, element string, tags map<string,string>")
    by_class, one = candidate_pairs(d, p), candidate_pairs(d, p, cell_m=200_000.0)
    assert 20 * by_class.count() < one.count()

    def near(c):
        c = c.where(haversine_m("latitude", "longitude", "lat", "lon") <= F.col("search_radius_m"))
        return sorted(tuple(r) for r in c.select("destination_id", "lat", "lon").collect())
    assert near(by_class) == near(one) and near(one)
    assert candidate_pairs(d.limit(0), p).count() == 0


def test_a_crowded_cell_is_cut_alone(spark):
    """A third of all points lies in one cell: it has parts, the others have one."""
    rnd = random.Random(6)
    pois = [(j, 45.0 + rnd.uniform(0, 0.001), 5.0 + rnd.uniform(0, 0.001), "node", {"amenity": "bar"}) for j in range(500)]
    pois += [(1000 + j, rnd.uniform(40, 44), rnd.uniform(0, 10), "node", {"amenity": "bar"}) for j in range(1000)]
    p = spark.createDataFrame(pois, "poi_id long, lat double, lon double, element string, tags map<string,string>")
    d = spark.createDataFrame([(1, 45.0, 5.0, 1000), (2, 42.0, 5.0, 1000)], "destination_id long, latitude double, longitude double, search_radius_m int")
    pairs = candidate_pairs(d, p, cell_rows=50)
    parts = {r.destination_id: r.n for r in pairs.groupBy("destination_id").agg(F.countDistinct("part").alias("n")).collect()}
    assert parts[1] >= 8 and parts.get(2, 1) == 1
    assert poi_counts(d, p, cell_rows=50).filter("destination_id = 1").first().bar_count == 500


def test_pairs_are_dealt_by_their_number(spark):
    """Many destinations and points in few bytes: as many tasks as the pairs ask for, no key with more
    than a block of them; a place at the very edge counts as by the formula."""
    rnd = random.Random(8)
    near = [(i, 45.0 + rnd.uniform(0, 0.01), 5.0 + rnd.uniform(0, 0.01), 2000) for i in range(900)]
    d = spark.createDataFrame(near, "destination_id long, latitude double, longitude double, search_radius_m int")
    p = spark.createDataFrame([(j, 45.0 + rnd.uniform(0, 0.01), 5.0 + rnd.uniform(0, 0.01), "node", {"amenity": "bar"}) for j in range(700)],
                              "poi_id long, lat double, lon double, element string, tags map<string,string>")
    pairs = candidate_pairs(d, p, cell_rows=100, dest_rows=90)
    assert max(r[-1] for r in pairs.groupBy("level", "band", "lon_cell", "part", "dest_part").count().collect()) < 4 * 100 * 90
    used = {r[0] for r in pairs.select(F.spark_partition_id()).distinct().collect()}
    assert len(used) >= 4
    assert sorted(map(tuple, poi_counts(d, p, cell_rows=100, dest_rows=90).select("destination_id", "bar_count").collect())) == sorted(
        map(tuple, poi_counts_brute_force(d, p).select("destination_id", "bar_count").collect()))
