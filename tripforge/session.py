"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods above 8000 bytecodes; let Spark split a
    # stage whose generated code would exceed that instead of running it
    # in the bytecode interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "tripforge",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TRIPFORGE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


RUNTIME_DEFAULTS = {
    # (setting, value we want, Spark's default): only a setting still at its
    # default is changed, so an explicit choice of the caller is kept.
    "spark.sql.codegen.hugeMethodLimit": ("8000", "65535"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "true"),
}


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the plans rely on, for sessions we did not build."""
    for key, (want, spark_default) in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, spark_default) == spark_default:
            spark.conf.set(key, want)


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset (local runs, tests) do we create a scratch folder,
    remembered per application (the setting itself cannot be changed at
    runtime).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        app = spark.sparkContext.applicationId
        configured = _LOCAL_CKPT.get(app)
        if configured is None:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            configured = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="tripforge-ckpt-")
            _LOCAL_CKPT[app] = configured
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df, name: str = "stage"):
    """Cut lineage by writing a Parquet table into the shared checkpoint
    folder and reading it back.

    One job (``Dataset.checkpoint`` computes its input twice), the table
    survives executor loss, and the re-read plan is a small scan whose size
    statistics the optimizer can use for join choices.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
