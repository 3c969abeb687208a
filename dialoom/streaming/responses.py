"""Replies as a stream: new manifest files in, finished lines appended once, resumed from the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_manifests(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def append_replies(manifests: DataFrame, reply: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Runs ``reply`` on each batch and writes it under the batch's number, so that a batch tried twice is written once."""

    def write(batch: DataFrame, number: int) -> None:
        reply(batch).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return manifests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def usage_by_window(calls: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Calls and tokens by window and model over a stream of call logs with a ``ts``; late rows up to ``late`` count."""
    return (
        calls.withWatermark("ts", late).groupBy(F.window("ts", width), "model")
        .agg(F.count(F.lit(1)).alias("calls"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("total_tokens"))
    )
