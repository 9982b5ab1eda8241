"""Incremental collection into a stored table, column report, guides, payloads, semi-join then attach."""

import pytest
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.operators.enrich import GUIDE_FIELDS, guide_table, with_guide
from tripforge.operators.joins import JoinValidationError, semi_then_attach
from tripforge.sources.catalog_io import explode_daily
from tripforge.sources.collection import collect_run, column_report, stored_rows

DEST = "destination_id long, destination_type string, search_radius_m int, latitude double, longitude double"
COUNTS = rules.PLACE_COUNT_COLUMNS


def places(spark, rows):
    return spark.createDataFrame(rows, DEST)


def counting(calls, value=1, skip=()):
    """A collector that notes what it was asked for and leaves ``skip`` without counts."""
    def collect(todo):
        calls.append(sorted(r.destination_id for r in todo.select("destination_id").collect()))
        ok = ~F.col("destination_id").isin(list(skip)) if skip else F.lit(True)
        return todo.select("*", *[F.when(ok, F.lit(value)).cast("long").alias(c) for c in COUNTS])
    return collect


def test_runs_collect_only_what_changed(spark, tmp_path):
    path, calls = str(tmp_path / "places"), []
    rows = [(i, "city", 1000, 10.0 + i, 20.0) for i in range(12)] + [(90, None, 1000, None, 3.0)]
    assert stored_rows(spark, path) is None
    assert collect_run(places(spark, rows), counting(calls, 1, skip=(4,)), path, 1) == 13
    # 4 failed; 5 moved by 20 m, 6 by a millimetre, 7 has a new radius, 8 a new type, 20 is new
    rows[5], rows[6] = (5, "city", 1000, 15.0002, 20.0), (6, "city", 1000, 16.00000001, 20.0)
    rows[7], rows[8] = (7, "city", 2000, 17.0, 20.0), (8, "island", 1000, 18.0, 20.0)
    rows.append((20, "city", 1000, 0.0, 0.0))
    now = places(spark, rows)
    assert collect_run(now, counting(calls, 2), path, 2) == 5 and calls[-1] == [4, 5, 7, 8, 20]
    assert collect_run(now, counting(calls, 3), path, 3) == 0 and len(calls) == 2
    got = {r.destination_id: (r.run_id, r[COUNTS[0]]) for r in stored_rows(spark, path).collect()}
    assert got == {i: (2, 2) if i in (4, 5, 7, 8, 20) else (1, 1) for i in [*range(12), 20, 90]}


def test_a_failed_run_is_repeated(spark, tmp_path):
    path, calls = str(tmp_path / "places"), []
    d = places(spark, [(i, "city", 1000, 1.0 * i, 0.0) for i in range(5)])
    collect_run(d.filter("destination_id < 3"), counting(calls), path, 1)

    def breaks(todo):
        raise RuntimeError("the source is away")
    with pytest.raises(RuntimeError):
        collect_run(d, breaks, path, 2)
    assert stored_rows(spark, path).count() == 3
    for _ in range(2):
        collect_run(d, counting(calls, 7), path, 2)
    assert sorted((r.destination_id, r.run_id) for r in stored_rows(spark, path).collect()) == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)]
    assert collect_run(d.limit(0), counting(calls), path, 3) == 0


def test_column_report(spark):
    a = spark.createDataFrame([(1, "x", 1.0)], "id long, gone string, same double")
    b = spark.createDataFrame([(1, 1.0, True)], "id int, same double, fresh boolean")
    got = {tuple(r) for r in column_report(a, b).collect()}
    assert got == {("id", "bigint", "int", "kept"), ("gone", "string", None, "gone"), ("same", "double", "double", "kept"), ("fresh", None, "boolean", "new")}


def test_guides_have_six_fields_and_defaults_for_each(spark):
    d = spark.createDataFrame([("Nice", 1), ("Nowhere", 2), (None, 3), ("Half", 4)], "destination_name string, guide int")
    g = guide_table(spark).unionByName(guide_table(spark, {"Half": {"airport": "Half Airport", "highlights": ["One"]}}))
    got = {r.destination_name: r.guide for r in with_guide(d, g).collect()}
    assert {f: got["Nice"][f] for f in GUIDE_FIELDS} == rules.DESTINATION_GUIDES["Nice"]
    assert got["Nowhere"].asDict() == got[None].asDict() == rules.GUIDE_DEFAULT
    assert got["Half"].asDict() == {**rules.GUIDE_DEFAULT, "airport": "Half Airport", "highlights": ["One"]}
    assert all(set(v) == set(GUIDE_FIELDS) for v in rules.DESTINATION_GUIDES.values())
    with pytest.raises(JoinValidationError):
        with_guide(d, g.union(g))


def test_payload_arrays_of_unequal_length(spark):
    p = [(1, '{"daily":{"time":["2024-01-01","2024-01-02"],"temperature_2m_mean":[1.5],"precipitation_sum":[0.1,0.2]}}'),
         (2, '{"daily":{"time":[],"temperature_2m_mean":[],"precipitation_sum":[]}}'), (3, None), (4, "{}"), (5, "no json"),
         (6, '{"daily":{"time":["2024-02-29"],"precipitation_sum":[0.3]}}')]
    rows = explode_daily(spark.createDataFrame(p, "id long, payload string"), ["id"]).orderBy("id", "day").collect()
    assert [(r.id, str(r.day), r.month, r.temperature_2m_mean, r.precipitation_sum) for r in rows] == [
        (1, "2024-01-01", 1, 1.5, 0.1), (1, "2024-01-02", 1, None, 0.2), (6, "2024-02-29", 2, None, 0.3)]


def test_semi_join_then_attach(spark):
    cat = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "n string, v int")
    names = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "n string")
    scores = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("b", 0.1)], "n string, s double")
    assert sorted((tuple(r) for r in semi_then_attach(cat, names, scores, ["n"]).collect()), key=str) == [("a", 1, 0.5), ("a", 1, 0.7), ("c", 3, None)]
