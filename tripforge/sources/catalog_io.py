"""Sources and sinks (S1-S3): schema-first reads, optional inputs, stage writes."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver parquet table ``{sf_dir}/{name}.parquet`` (column pruning and
    filter pushdown happen at the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_catalog(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str | None = None) -> DataFrame:
    """Read a catalogue stage with an explicit schema, never inferred.

    CSV (header) for hand-made exports, Parquet for everything else.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)


def read_optional(spark: SparkSession, path: str | None, schema: T.StructType,
                  fmt: str | None = None) -> DataFrame | None:
    """The table if it exists, else ``None`` (callers fall back)."""
    if not path:
        return None
    if "://" not in path and not os.path.exists(path):
        return None
    try:
        df = read_catalog(spark, path, schema, fmt)
        df.schema  # noqa: B018 - forces path resolution
        return df
    except AnalysisException:
        return None


def write_stage(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> str:
    """S3: overwrite one table per stage. Parquet by default; CSV export option."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


WEATHER_PAYLOAD_SCHEMA = T.StructType([T.StructField("daily", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
    T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
]))])


def explode_daily(payloads: DataFrame, key: list[str], payload_col: str = "payload") -> DataFrame:
    """Weather payload JSON (parallel arrays) -> one row per day with date
    and month. Each payload is exploded where it lies (no shuffle). A missing or too
    short array gives null measures, a payload without days no row."""
    from pyspark.sql import functions as F
    p = payloads.select(*key, F.from_json(F.col(payload_col), WEATHER_PAYLOAD_SCHEMA).alias("__p"))

    def measures(name):
        return F.coalesce(F.col(f"__p.daily.{name}"), F.array().cast("array<double>"))

    z = p.select(*key, F.inline(F.arrays_zip(F.col("__p.daily.time").alias("__time"), measures("temperature_2m_mean").alias("__t"),
                                             measures("precipitation_sum").alias("__r")))).filter("__time IS NOT NULL")
    day = F.to_date("__time")
    return z.select(*key, day.alias("day"), F.month(day).alias("month"),
                    F.col("__t").alias("temperature_2m_mean"), F.col("__r").alias("precipitation_sum"))
