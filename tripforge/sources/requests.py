"""S9 request ingest/validation and S10 result serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import rules
from tripforge.functions.expr import season_from_month_name

PREFS = ["food", "beach", "culture", "nature", "nightlife"]

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    *[T.StructField(p, T.DoubleType()) for p in PREFS],
    T.StructField("month", T.StringType()),
    T.StructField("budget", T.StringType()),
    T.StructField("weather_preference", T.StringType()),
    T.StructField("top_n", T.IntegerType()),
])

MAX_TOP_N = 20


def requests_from_json(df: DataFrame, json_col: str = "body") -> DataFrame:
    """JSON request bodies -> typed request columns (schema given, not inferred)."""
    parsed = F.from_json(F.col(json_col), REQUEST_SCHEMA)
    return df.select(parsed.alias("__r")).select("__r.*")


def _error_expr() -> Column:
    checks = []
    for p in PREFS:
        c = F.col(p)
        checks.append(F.when(c.isNull() | (c < 0) | (c > 10) | F.isnan(c),
                             F.lit(f"{p} must be between 0 and 10")))
    checks.append(F.when(F.col("month").isNull(), F.lit("month is required")))
    months = ", ".join(m.title() for m in rules.MONTH_TO_SEASON)
    checks.append(F.when(F.col("month").isNotNull() & F.col("season").isNull(),
                         F.format_string(f"Invalid month '%s'. Use one of: {months}.", F.col("month"))))
    checks.append(F.when((F.col("top_n") < 1) | (F.col("top_n") > MAX_TOP_N),
                         F.lit(f"top_n must be between 1 and {MAX_TOP_N}")))
    return F.array_join(F.filter(F.array(*checks), lambda x: x.isNotNull()), "; ")


def validate_requests(df: DataFrame) -> DataFrame:
    """Defaults + season + ``error`` (empty string when valid)."""
    out = df.select(
        "request_id", *[F.col(p).cast("double").alias(p) for p in PREFS], "month",
        F.coalesce(F.col("budget"), F.lit(rules.DEFAULT_BUDGET)).alias("budget"),
        F.coalesce(F.col("weather_preference"), F.lit(rules.DEFAULT_WEATHER_PREFERENCE)).alias("weather_preference"),
        F.coalesce(F.col("top_n").cast("int"), F.lit(5)).alias("top_n"),
        season_from_month_name("month").alias("season"),
    )
    return out.withColumn("error", _error_expr())


def parse_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows keep their input and an ``error`` text."""
    checked = validate_requests(df)
    valid = checked.where(F.col("error") == "").drop("error")
    rejected = checked.where(F.col("error") != "")
    return valid, rejected


def recommendations_to_json(recs: DataFrame, group_key: str = "request_id") -> DataFrame:
    """One JSON document per request, ``reason`` as an object, ranked list."""
    item = F.struct(*[F.col(c) for c in recs.columns if c not in (group_key,)])
    grouped = recs.groupBy(group_key).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").alias("__k"), item.alias("v")))).alias("__items"))
    return grouped.select(group_key, F.to_json(F.struct(
        F.col(group_key), F.transform("__items", lambda x: x["v"]).alias("recommendations"))).alias("json"))
