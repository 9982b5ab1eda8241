"""The versioned table of cluster labels.

A clustering publishes its labels (key, cluster, cluster_profile) as one version of a
Parquet table, partitioned by version; a catalogue build reads one version, the
latest unless told otherwise. A version is written once: publishing it again
replaces its own partition only, so a failed run can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.joins import JoinValidationError, duplicate_keys, require_columns

LABELS = ("cluster", "cluster_profile")
VERSION = "label_version"


def publish_labels(labels: DataFrame, path: str, version: int, key: Sequence[str] = ("destination_name", "country")) -> None:
    """Write ``labels`` as ``version``; duplicate keys are refused before anything is written."""
    require_columns(labels, [*key, *LABELS])
    if dups := duplicate_keys(labels, key):
        raise JoinValidationError(f"duplicate keys in the labels: {dups}")
    rows = labels.select(*key, *LABELS, F.lit(int(version)).alias(VERSION))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(path)


def label_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the table, oldest first (read from its partitions)."""
    return sorted(r[0] for r in spark.read.parquet(path).select(VERSION).distinct().collect())


def read_labels(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The labels of ``version``, or of the latest one."""
    versions = label_versions(spark, path)
    if version is None and versions:
        version = versions[-1]
    if version not in versions:
        raise ValueError(f"no label version {version}; there are {versions}")
    return spark.read.parquet(path).filter(F.col(VERSION) == version).drop(VERSION)
