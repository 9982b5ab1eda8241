"""Incremental collection with a stored table (S8, U1): who made a row, and with what.

A collected row carries a fingerprint of what it was made with: type, radius and
coordinates at four decimals. A run asks the stored table for rows that are complete
and have the current fingerprint (an anti-join), collects only the rest, and
replaces the buckets of the table that hold such rows. Buckets are partitions by key
hash, overwritten dynamically: a run that failed can be repeated, and a run with
nothing to collect writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.session import cut_lineage
from tripforge.sources.incremental import upsert

BUCKET, FINGERPRINT, RUN = "collection_bucket", "fingerprint", "run_id"


def fingerprint(kind: str = "destination_type", radius: str = "search_radius_m", lat: str = "latitude", lon: str = "longitude") -> Column:
    """Text of type, radius and coordinates; a missing one is written as such."""
    parts = [F.col(kind), F.col(radius).cast("long").cast("string"), F.format_string("%.4f", F.round(lat, 4) + 0.0), F.format_string("%.4f", F.round(lon, 4) + 0.0)]
    missing = [F.lit(None), F.lit(None), F.col(lat), F.col(lon)]
    return F.concat_ws("|", *[F.when(m.isNull(), F.lit("-")).otherwise(p) if i > 1 else F.coalesce(p, F.lit("-"))
                              for i, (p, m) in enumerate(zip(parts, missing))])


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The collected table, or None before the first run."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def pending_rows(destinations: DataFrame, done: DataFrame | None, key: str, measures: Sequence[str]) -> DataFrame:
    """Destinations without a complete stored row of the current fingerprint."""
    current = destinations.withColumn(FINGERPRINT, fingerprint())
    if done is None:
        return current
    complete = done.dropna(subset=list(measures)).select(key, FINGERPRINT)
    return current.join(complete, [key, FINGERPRINT], "left_anti")


def collect_run(destinations: DataFrame, collect: Callable[[DataFrame], DataFrame], path: str, run_id: int, key: str = "destination_id",
                measures: Sequence[str] = rules.PLACE_COUNT_COLUMNS, buckets: int = 16) -> int:
    """Collect what is pending and store it as run ``run_id``; returns how many rows
    that were. ``collect`` adds the measures to the pending destinations."""
    spark = destinations.sparkSession
    done = stored_rows(spark, path)
    todo = cut_lineage(pending_rows(destinations, done, key, measures), "pending")
    n = todo.count()
    if not n:
        return 0
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    fresh = collect(todo).select(key, FINGERPRINT, *measures, F.lit(run_id).alias(RUN)).withColumn(BUCKET, bucket)
    if done is not None:
        touched = todo.select(bucket.alias(BUCKET)).distinct()  # at most ``buckets`` rows
        kept = done.join(F.broadcast(touched), BUCKET, "left_semi")
        fresh = upsert(kept, fresh, [key, BUCKET], RUN)
    # written first: the table it is read from is about to be replaced in part
    rows = cut_lineage(fresh, "collected")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return n


def column_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per column of either table: its types and whether it is new, gone or kept."""
    old, new = ({f.name: f.dataType.simpleString() for f in d.schema.fields} for d in (before, after))
    rows = [(c, old.get(c), new.get(c), "new" if c not in old else "gone" if c not in new else "kept") for c in dict.fromkeys([*old, *new])]
    return after.sparkSession.createDataFrame(rows, "column string, type_before string, type_after string, change string")
