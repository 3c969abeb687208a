"""Neighbouring segments of a recording linked into dialogs by a weighted time, speaker and meaning score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of time, speaker and meaning.
WEIGHTS = (0.40, 0.35, 0.25)
ORDER = ("start", "end", "clip_name", "line_no")


def _along(order=ORDER):
    return Window.partitionBy("audio_id").orderBy(*order)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null where either is null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def link_scores(
    segments: DataFrame, max_gap: float = 30.0, threshold: float = 0.7, order: tuple[str, ...] = ORDER,
    semantic: Column | None = None, weights: tuple[float, float, float] = WEIGHTS,
) -> DataFrame:
    """Each segment with its score against the one before it in its recording; the first of each has nulls.

    ``semantic`` replaces the clipped cosine of ``sem_embedding`` with the previous one.
    """
    w = _along(order)
    before = lambda c: F.lag(c).over(w)
    rows = segments.withColumns({"prev_segment_id": before("segment_id"), "_prev_end": before("end"), "_prev_label": before("speaker_label")})
    if semantic is None:
        rows = segments.withColumns(
            {"prev_segment_id": before("segment_id"), "_prev_end": before("end"), "_prev_label": before("speaker_label"), "_prev_vector": before("sem_embedding")}
        )
        semantic = F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine(F.col("_prev_vector"), F.col("sem_embedding"))))
    has = F.col("_prev_end").isNotNull()
    same = F.col("_prev_label").eqNullSafe(F.col("speaker_label"))
    rows = rows.withColumns(
        {
            "gap_seconds": F.greatest(F.lit(0.0), F.col("start") - F.col("_prev_end")),
            "same_speaker": F.when(has, same),
            "semantic_score": F.when(has, semantic),
        }
    ).withColumn("gap_seconds", F.when(has, F.col("gap_seconds")))
    rows = rows.withColumns(
        {
            "time_score": F.when(has, F.greatest(F.lit(0.0), 1.0 - F.col("gap_seconds") / F.lit(float(max_gap)))),
            "speaker_score": F.when(has, F.when(same, 1.0).otherwise(0.0)),
        }
    )
    time, speaker, meaning = weights
    score = F.lit(time) * F.col("time_score") + F.lit(speaker) * F.col("speaker_score") + F.lit(meaning) * F.col("semantic_score")
    return (
        rows.withColumn("score", score)
        .withColumn("linked", F.coalesce(F.col("score") >= threshold, F.lit(False)))
        .drop("_prev_end", "_prev_label", "_prev_vector")
    )


def link_components(scored: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Adds ``component``: links join neighbours only, so a running count of breaks numbers them."""
    return scored.withColumn("component", F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(_along(order)))


def chunk_components(members: DataFrame, max_turns: int = 6, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Adds ``chunk`` and ``position`` (0-based) within components cut to ``max_turns`` segments."""
    w = Window.partitionBy("audio_id", "component").orderBy(*order)
    number = F.row_number().over(w) - 1
    return members.withColumn("_n", number).withColumns(
        {"chunk": F.floor(F.col("_n") / max_turns).cast("long"), "position": (F.col("_n") % max_turns).cast("int")}
    ).drop("_n")


def number_dialogs(chunked: DataFrame) -> DataFrame:
    """Adds ``dialog_id`` in the order of recording, component and chunk.

    Dialogs are counted by recording, and only the recordings' offsets are ordered as a whole.
    """
    own = Window.partitionBy("audio_id").orderBy("component", "chunk")
    ranked = chunked.withColumn("_rank", F.dense_rank().over(own))
    sizes = ranked.groupBy("audio_id").agg(F.max("_rank").alias("n"))
    before = Window.orderBy("audio_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("audio_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    numbered = ranked.join(offsets, "audio_id").withColumn("dialog_number", F.col("_offset") + F.col("_rank") - 1)
    return numbered.withColumn("dialog_id", F.format_string("dialog_%04d", "dialog_number")).drop("_rank", "_offset")


def build_dialogs(segments: DataFrame, max_gap: float = 30.0, threshold: float = 0.7, max_turns: int = 6, order: tuple[str, ...] = ORDER, semantic: Column | None = None) -> DataFrame:
    """Segments with ``dialog_id`` and ``position``."""
    scored = link_scores(segments, max_gap, threshold, order, semantic)
    return number_dialogs(chunk_components(link_components(scored, order), max_turns, order))


def collect_dialogs(members: DataFrame) -> DataFrame:
    """A row a dialog, with the arrays of its segments in order."""
    row = F.struct("position", "segment_id", "clip_path", "transcript")
    grouped = members.groupBy("dialog_id", "audio_id").agg(F.array_sort(F.collect_list(row)).alias("s"))
    return grouped.select(
        "dialog_id", "audio_id", F.size("s").alias("num_turns"), F.col("s.segment_id").alias("segment_ids"),
        F.col("s.clip_path").alias("audio_clips"), F.col("s.transcript").alias("transcripts"),
    )


def segments_from_labels(labels: DataFrame, root: str = "", files: DataFrame | None = None) -> DataFrame:
    """Labels as segments: blank contents dropped, defaults filled, relative paths under ``root``.

    With ``files`` (a listing with ``path``), labels whose clip is not listed are dropped.
    """
    from ..functions.text import pytrim

    path = F.replace("file_path", F.lit("\\"), F.lit("/"))
    full = F.when(path.startswith("/") | (F.lit(root) == ""), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
    p_child = F.coalesce("p_child", F.lit(1.0)) if "p_child" in labels.columns else F.lit(1.0)
    rows = labels.filter(F.length(pytrim(F.col("content"))) > 0).withColumns(
        {
            "transcript": pytrim(F.col("content")), "clip_path": full, "p_child": p_child,
            "speaker_label": F.coalesce("speaker_label", F.lit("")), "clip_name": F.element_at(F.split(path, "/"), -1),
        }
    )
    return rows.join(files.select(F.col("path").alias("clip_path")).distinct(), "clip_path", "left_semi") if files is not None else rows


def source_conflicts(labels: DataFrame) -> DataFrame:
    """(audio_id, n_sources) of recordings that name more than one source."""
    return labels.groupBy("audio_id").agg(F.count_distinct("source_audio").alias("n_sources")).filter("n_sources > 1")


def require_one_source(labels: DataFrame) -> DataFrame:
    """The labels; raises if a recording names two sources."""
    found = [r["audio_id"] for r in source_conflicts(labels).limit(5).collect()]
    if found:
        raise ValueError(f"recordings with more than one source: {found}")
    return labels


def label_template(segments: DataFrame) -> DataFrame:
    """Rows to be filled in by a transcriber: the content is empty and the child score is left out."""
    return segments.select("audio_id", F.lit("").alias("content"), "end", "file_path", "segment_id", "source_audio", "speaker_label", "start")
