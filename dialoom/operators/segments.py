"""Candidate segments: bounds, ids, child filter, slices and stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def child_filter(segments: DataFrame, threshold: float = 0.6) -> DataFrame:
    return segments.filter(F.col("p_child") >= threshold)


def child_trace(segments: DataFrame, threshold: float = 0.6) -> DataFrame:
    """All segments with ``kept``."""
    return segments.withColumn("kept", F.coalesce(F.col("p_child") >= threshold, F.lit(False)))


def clip_bounds(segments: DataFrame, rate: int = 16_000) -> DataFrame:
    """Clamped bounds and sample bounds within ``n_samples``; clips without samples are dropped."""
    start = F.greatest(F.lit(0.0), F.col("start"))
    rows = segments.withColumn("_s", start).withColumn("_e", F.greatest("_s", "end"))
    rows = rows.withColumns(
        {
            "start": F.col("_s"), "end": F.col("_e"),
            "first_sample": F.greatest(F.lit(0).cast("long"), (F.col("_s") * rate).cast("long")),
            "last_sample": F.least(F.col("n_samples").cast("long"), (F.col("_e") * rate).cast("long")),
        }
    )
    return rows.filter("last_sample > first_sample").drop("_s", "_e")


def segment_id(audio: Column, index: Column, start: Column, end: Column) -> Column:
    """Recording, index and bounds in truncated milliseconds."""
    return F.format_string("%s_%04d_%d_%d", audio.cast("string"), index, (start * 1000).cast("long"), (end * 1000).cast("long"))


def clip_plan(segments: DataFrame, floor: float = 0.05) -> DataFrame:
    """(segment_id, start, seconds) for a clip cutter; no clip is shorter than the floor."""
    return segments.select("segment_id", "start", F.greatest(F.lit(floor), F.col("end") - F.col("start")).alias("seconds"))


def range_trace(segments: DataFrame) -> DataFrame:
    return segments.select("audio_id", "segment_id", "start", "end", (F.col("end") - F.col("start")).alias("duration"), "speaker_label")


def nonempty(rows: DataFrame, content: str = "content") -> DataFrame:
    from ..functions.text import pytrim

    return rows.filter(F.length(pytrim(F.col(content))) > 0)


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    if not rows.limit(1).count():
        raise ValueError(f"no {what} left")
    return rows


def ordered_slice(rows: DataFrame, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` in an order, all to the end without a limit.

    Spark keeps only the first ``offset + limit`` rows of each task.
    """
    ordered = rows.orderBy(*order)
    ordered = ordered.offset(offset) if offset else ordered
    return ordered if limit is None else ordered.limit(limit)


def candidate_index(rows: DataFrame, group: str, order: list[str], name: str = "candidate_index") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1)


def stage_summary(**stages: DataFrame) -> DataFrame:
    """(stage, n) of each named stage."""
    out = None
    for name, rows in stages.items():
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def audio_views(files: DataFrame, views: tuple[str, ...] = ("raw", "separated", "enhanced")) -> DataFrame:
    """A row a file and view."""
    return files.withColumn("view", F.explode(F.array(*map(F.lit, views))))
