"""Ranks without exchange reuse, unknown places, repeated names, missing features."""

from pyspark.sql import functions as F


def test_bucketed_ranks_do_not_depend_on_exchange_reuse(spark):
    from tripforge.operators.ranking import pct_ranks
    df = spark.range(1_000_000).select("id", (F.xxhash64("id") % 900_000_007).cast("double").alias("x"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        a = pct_ranks(df, ["id"], {"p": F.col("x")}, digits=None)
        b = pct_ranks(df, ["id"], {"q": F.col("x")}, digits=None, method="window")
        assert a.join(b, "id").filter("abs(p - q) > 1e-9 or p is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_unknown_place_has_no_counts(spark):
    from tripforge.operators.spatial import poi_counts
    dest = spark.createDataFrame([(1, 10.0, 10.0, 1000), (2, None, 10.0, 1000)], "destination_id int, latitude double, longitude double, search_radius_m int")
    poi = spark.createDataFrame([(1, 10.0, 10.0, {"amenity": "cafe"})], "poi_id int, lat double, lon double, tags map<string,string>")
    rows = {r["destination_id"]: r for r in poi_counts(dest, poi).collect()}
    assert rows[1]["cafe_count"] is not None and rows[2]["cafe_count"] is None


def test_similar_lists_are_full_when_names_repeat(spark):
    from tripforge.operators.joins import similar_in_group
    rows = [("A", "x"), ("A", "y"), ("A", "z"), ("B", "x"), ("C", "x"), ("D", "x")]
    df = spark.createDataFrame([(n, c, "g") for n, c in rows], "name string, country string, grp string")
    out = {(r["name"], r["country"]): r["similar_destinations"] for r in similar_in_group(df, "grp", "name", None, ["name", "country"]).collect()}
    assert out[("A", "x")] == ["B", "C", "D"] and out[("B", "x")] == ["A", "A", "A"]


def test_missing_feature_keeps_the_row(spark, sample):
    from tripforge.operators.cluster import pca_2d
    feats = ["latitude", "longitude", "summer_avg_temp"]
    first = sample.orderBy("destination_name").first()["destination_name"]
    df = sample.withColumn("summer_avg_temp", F.when(F.col("destination_name") != first, F.col("summer_avg_temp")))
    out, _ = pca_2d(df, feats)
    assert out.count() == sample.count() and out.filter("PC1 is null").count() == df.filter("summer_avg_temp is null").count() > 0
