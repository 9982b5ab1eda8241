"""ST1: a stream of recommendation requests scored against the static catalogue.

``readStream`` -> request validation -> per micro-batch ``recommend`` (window
top-N is a batch operation, so it runs inside ``foreachBatch``). Each batch is
written to its own ``batch_id=`` folder with overwrite, so a replayed batch
after a failure rewrites the same output (exactly-once results). The stream is
stateless: no watermark is needed; the catalogue is a static table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripforge.session import checkpoint_dir


def start_request_stream(stream: DataFrame, catalog: DataFrame, sink: str, checkpoint: str,
                         available_now: bool = True, with_texts: bool = True):
    """Start the scoring query. ``stream`` holds raw request columns."""
    from tripforge.operators.recommend import SCORING_COLUMNS, destination_seasons, recommend
    from tripforge.sources.requests import parse_requests

    dest_seasons = destination_seasons(catalog.select(*SCORING_COLUMNS)).persist()  # once for all batches

    def process(batch: DataFrame, batch_id: int) -> None:
        valid, rejected = parse_requests(batch)
        recs = recommend(valid, catalog, dest_seasons, with_texts=with_texts)
        recs.write.mode("overwrite").parquet(os.path.join(sink, "recommendations", f"batch_id={batch_id}"))
        rejected.write.mode("overwrite").parquet(os.path.join(sink, "rejected", f"batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def customer_request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's customer table read as a file stream, mapped to requests."""
    from tripforge.sources.standins import requests_from_customers
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet")
           .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    return requests_from_customers(raw)


def run_to_completion(spark: SparkSession, sf_dir: str, catalog: DataFrame, run_name: str) -> str:
    """Run the stream over everything available and return the sink folder."""
    base = os.path.join(checkpoint_dir(spark).rstrip("/"), "streams", run_name)
    sink, ckpt = os.path.join(base, "sink"), os.path.join(base, "checkpoint")
    q = start_request_stream(customer_request_stream(spark, sf_dir), catalog, sink, ckpt)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sink


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sink, "recommendations")).drop("batch_id")


__all__ = ["start_request_stream", "customer_request_stream", "run_to_completion", "read_sink"]
