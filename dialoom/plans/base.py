"""How the test tables stand in for the domain's, in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as turns: a user's events are a recording, the event's type speaks for ``value`` seconds."""
    start = (F.unix_micros(F.col("ts").cast("timestamp"))) / F.lit(1e6)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("audio_id"), start.alias("start"), (start + F.col("value")).alias("end"), F.col("event_type").alias("speaker_label"), "event_id"
    )


TURNS = """turns AS (SELECT user_id AS audio_id, epoch_us(ts) / 1e6 AS "start", epoch_us(ts) / 1e6 + value AS "end", event_type AS speaker_label, event_id FROM events)"""

#: Parameters under which every branch of the turn and dialog operators is taken on events.
MERGE_GAP, GLITCH_MAX, GLITCH_GAP, SHORTEST, LONGEST = 86_400.0, 60.0, 86_400.0, 10.0, 120.0
MAX_GAP, THRESHOLD, MAX_TURNS = 259_200.0, 0.35, 6


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; only a local session may go without that."""
    import tempfile
    import uuid

    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
