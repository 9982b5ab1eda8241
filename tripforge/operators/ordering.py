"""Total order over several keys with a global row number, in no single task.

Rows are dealt to ranges of the sort keys, sorted within each, and written; a
row's number is the number of rows in earlier ranges (one row per range) plus its
place. A hash of the whole row is the last sort key, so a key that holds many
rows is still split over ranges, and only rows equal in every column are
interchangeable. Nulls come last in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.session import cut_lineage


def ordered(df: DataFrame, keys: Sequence[tuple[str, bool]], out: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: 1, 2, 3... in the order of ``keys``, pairs of a column and
    whether it ascends."""
    spark = df.sparkSession
    columns = [F.col(f"`{c}`") for c in df.columns if c != out]
    # the row is one struct beside its sort keys, so that no names clash
    base = df.select(F.struct(*columns).alias("row"), *[F.col(f"`{c}`").alias(f"k{i}") for i, (c, _) in enumerate(keys)],
                     F.xxhash64(*columns).alias("tie"))
    order = [F.col(f"k{i}").asc_nulls_last() if up else F.col(f"k{i}").desc_nulls_last() for i, (_, up) in enumerate(keys)] + [F.col("tie")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.select("row", F.spark_partition_id().alias("part"),
                                     F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), "ordered")
    run, offsets = 0, []
    for part, rows in sorted(tuple(r) for r in dealt.groupBy("part").count().collect()):  # one row per range
        offsets.append((part, run))
        run += rows
    offset = spark.createDataFrame(offsets, "part int, offset long")
    return dealt.join(F.broadcast(offset), "part").select("row.*", (F.col("offset") + F.col("place") + 1).alias(out))
