"""Ordered speaker turns: normalise, merge, bridge, drop, keep and split, with an audit log of each step.

Turns have ``audio_id, start, end, speaker_label`` (seconds) and whatever ``ties`` names to order equal ones. One exchange
by ``audio_id`` serves every step: its windows and groups all refine that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("start", "end", "speaker_label")
_TURN = "struct<start:double,end:double,speaker_label:string>"


def normalize_turns(turns: DataFrame) -> DataFrame:
    """Turns of positive length, blanks in labels as underscores."""
    return turns.filter(F.col("end") > F.col("start")).withColumn("speaker_label", F.replace("speaker_label", F.lit(" "), F.lit("_")))


def select_annotation(exclusive: Column, speaker: Column, raw: Column) -> Column:
    """The first annotation that a diariser offers."""
    return F.coalesce(exclusive, speaker, raw)


def duration() -> Column:
    return F.greatest(F.lit(0.0), F.col("end") - F.col("start"))


def _pause(later: Column, earlier: Column) -> Column:
    return F.greatest(F.lit(0.0), later - earlier)


def islands(turns: DataFrame, gap: float, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``run`` (of one speaker), ``island`` (merged turn within it), ``reach`` (largest end before, in the run)."""
    order = [*ORDER, *ties]
    whole = Window.partitionBy("audio_id").orderBy(*order)
    new_run = F.when(F.lag("speaker_label").over(whole).eqNullSafe(F.col("speaker_label")), 0).otherwise(1)
    runs = turns.withColumn("_new", new_run).withColumn("run", F.sum("_new").over(whole))
    within = Window.partitionBy("audio_id", "run").orderBy(*order)
    reach = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("reach", reach)
    starts = F.when(F.col("reach").isNull() | (_pause(F.col("start"), F.col("reach")) > gap), 1).otherwise(0)
    return marked.withColumn("_new", starts).withColumn("island", F.sum("_new").over(within)).drop("_new")


def merge_turns(turns: DataFrame, gap: float = 0.35, ties: tuple[str, ...] = ()) -> DataFrame:
    """Turns of one speaker joined over pauses up to ``gap``; ``n_merged`` turns each."""
    return (
        islands(turns, gap, ties)
        .groupBy("audio_id", "run", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("speaker_label").alias("speaker_label"), F.count(F.lit(1)).alias("n_merged"))
        .select("audio_id", "start", "end", "speaker_label", "n_merged", "run", "island")
    )


def _bridges(stack: Column, turn: Column, longest: float, gap: float) -> Column:
    """Whether the turn and the top two of the stack are a speaker, a blip of another, and the speaker again."""
    left, middle = F.get(stack, F.size(stack) - 2), F.get(stack, F.size(stack) - 1)
    return F.coalesce(
        (F.size(stack) >= 2)
        & (left["speaker_label"] == turn["speaker_label"])
        & (left["speaker_label"] != middle["speaker_label"])
        & (_pause(middle["end"], middle["start"]) <= longest)
        & (_pause(middle["start"], left["end"]) <= gap)
        & (_pause(turn["start"], middle["end"]) <= gap),
        F.lit(False),
    )


def _fold(stack: Column, turn: Column, longest: float, gap: float) -> Column:
    left = F.get(stack, F.size(stack) - 2)
    joined = F.struct(left["start"].alias("start"), turn["end"].alias("end"), left["speaker_label"].alias("speaker_label"))
    return F.when(
        _bridges(stack, turn, longest, gap), F.concat(F.slice(stack, 1, F.size(stack) - 2), F.array(joined))
    ).otherwise(F.concat(stack, F.array(turn)))


def bridge_turns(turns: DataFrame, longest: float = 0.25, gap: float = 0.2, order: tuple[str, ...] = ORDER, grouped: bool = False) -> DataFrame:
    """Turns with short blips of another speaker bridged; a bridged turn ends where its right part ends.

    A fold over each audio's turns in order, as an expression. ``grouped`` runs it in Python workers instead, which
    costs linear time where single recordings hold very many turns.
    """
    if grouped:
        schema = f"audio_id {turns.schema['audio_id'].dataType.simpleString()}, start double, end double, speaker_label string"
        return turns.groupBy("audio_id").applyInPandas(_bridge_pandas(longest, gap, list(order)), schema)
    row = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_{c}") for c in ORDER])
    listed = turns.groupBy("audio_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    plain = F.transform("t", lambda x: F.struct(x["_start"].alias("start"), x["_end"].alias("end"), x["_speaker_label"].alias("speaker_label")))
    folded = F.aggregate(plain, F.array().cast(f"array<{_TURN}>"), lambda s, x: _fold(s, x, longest, gap))
    return listed.select("audio_id", F.explode(folded).alias("x")).select("audio_id", "x.start", "x.end", "x.speaker_label")


def _bridge_pandas(longest: float, gap: float, order: list[str]):
    def fold(frame):
        import pandas as pd

        stack: list[tuple[float, float, str]] = []
        for x in frame.sort_values(order)[list(ORDER)].itertuples(index=False, name=None):
            if len(stack) > 1:
                (a, b, who), (c, d, other) = stack[-2:]
                if who == x[2] and who != other and max(0.0, d - c) <= longest and max(0.0, c - b) <= gap and max(0.0, x[0] - d) <= gap:
                    stack[-2:] = [(a, x[1], who)]
                    continue
            stack.append(x)
        out = pd.DataFrame(stack, columns=list(ORDER))
        out.insert(0, "audio_id", frame["audio_id"].iloc[0])
        return out

    return fold


def bridge_audit(turns: DataFrame, longest: float = 0.25, gap: float = 0.2, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(audio_id, before, after, left_gap, right_gap) of each bridge."""
    row = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_{c}") for c in ORDER])
    listed = turns.groupBy("audio_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    plain = F.transform("t", lambda x: F.struct(x["_start"].alias("start"), x["_end"].alias("end"), x["_speaker_label"].alias("speaker_label")))
    record = f"struct<before:array<{_TURN}>,after:{_TURN},left_gap:double,right_gap:double>"
    start = F.struct(F.array().cast(f"array<{_TURN}>").alias("stack"), F.array().cast(f"array<{record}>").alias("log"))

    def step(s: Column, x: Column) -> Column:
        stack = s["stack"]
        left, middle = F.get(stack, F.size(stack) - 2), F.get(stack, F.size(stack) - 1)
        done = F.struct(
            F.array(left, middle, x).alias("before"),
            F.struct(left["start"].alias("start"), x["end"].alias("end"), left["speaker_label"].alias("speaker_label")).alias("after"),
            _pause(middle["start"], left["end"]).alias("left_gap"),
            _pause(x["start"], middle["end"]).alias("right_gap"),
        )
        log = F.when(_bridges(stack, x, longest, gap), F.concat(s["log"], F.array(done))).otherwise(s["log"])
        return F.struct(_fold(stack, x, longest, gap).alias("stack"), log.alias("log"))

    return listed.select("audio_id", F.explode(F.aggregate(plain, start, step)["log"]).alias("x")).select("audio_id", "x.*")


def clean_turns(turns: DataFrame, shortest: float = 0.35, longest: float = 20.0) -> DataFrame:
    """Turns neither too short nor too long."""
    return turns.filter((duration() >= shortest) & (duration() <= longest))


def split_turns(turns: DataFrame, shortest: float = 0.35, longest: float = 20.0) -> DataFrame:
    """Drops short turns and cuts long ones into equal pieces; adds ``chunk_index``, ``num_chunks`` (1 if whole)."""
    pieces = F.when(duration() <= longest, F.lit(1)).otherwise(F.greatest(F.lit(2), F.ceil(duration() / longest).cast("int")))
    step = duration() / F.col("num_chunks")
    rows = turns.filter(duration() >= shortest).withColumn("num_chunks", pieces)
    rows = rows.withColumn("_step", step).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("num_chunks") - 1)))
    last = F.col("chunk_index") == F.col("num_chunks") - 1
    return rows.withColumns(
        {
            "start": F.col("start") + F.col("chunk_index") * F.col("_step"),
            "end": F.when(last, F.col("end")).otherwise(F.col("start") + (F.col("chunk_index") + 1) * F.col("_step")),
        }
    ).drop("_step")


def cleanup_turns(
    raw: DataFrame, merge_gap: float = 0.35, glitch_max: float = 0.25, glitch_gap: float = 0.2,
    shortest: float = 0.35, longest: float = 20.0, ties: tuple[str, ...] = (),
) -> DataFrame:
    """All steps, raw turns to final ones."""
    merged = merge_turns(normalize_turns(raw), merge_gap, ties).drop("n_merged")
    return split_turns(bridge_turns(merged, glitch_max, glitch_gap, ("run", "island")), shortest, longest)


def audit_turns(
    raw: DataFrame, merge_gap: float = 0.35, glitch_max: float = 0.25, glitch_gap: float = 0.2,
    shortest: float = 0.35, longest: float = 20.0, ties: tuple[str, ...] = (),
) -> DataFrame:
    """(audio_id, action, before, after, gaps, chunk_index, num_chunks, reason): what each step did."""
    turn = lambda s, e: F.struct(s.alias("start"), e.alias("end"), F.col("speaker_label").alias("speaker_label"))
    none_turn, none_gap, none_int = F.lit(None).cast(_TURN), F.array().cast("array<double>"), F.lit(None).cast("int")

    def rows(df, action, before, after, gaps, reason, index=none_int, count=none_int):
        return df.select(
            "audio_id", F.lit(action).alias("action"), before.alias("before"), after.alias("after"), gaps.alias("gaps"),
            index.alias("chunk_index"), count.alias("num_chunks"), F.lit(reason).alias("reason"),
        )

    marked = islands(normalize_turns(raw), merge_gap, ties)
    order = Window.partitionBy("audio_id", "run", "island").orderBy(*ORDER, *ties)
    prefix = order.rowsBetween(Window.unboundedPreceding, -1)
    steps = marked.withColumns({"_s": F.min("start").over(prefix), "_e": F.max("end").over(prefix)}).filter("_s is not null")
    merges = rows(
        steps, "merge_same_speaker_gap", F.array(turn(F.col("_s"), F.col("_e")), turn(F.col("start"), F.col("end"))),
        turn(F.col("_s"), F.greatest("_e", "end")), F.array(_pause(F.col("start"), F.col("_e"))), "one speaker, short pause",
    )
    merged = merge_turns(normalize_turns(raw), merge_gap, ties)
    log = bridge_audit(merged, glitch_max, glitch_gap, ("run", "island"))
    bridges = rows(log, "bridge_micro_turn", F.col("before"), F.col("after"), F.array("left_gap", "right_gap"), "short blip of another speaker")
    bridged = bridge_turns(merged, glitch_max, glitch_gap, ("run", "island"))
    own = turn(F.col("start"), F.col("end"))
    dropped = rows(bridged.filter(duration() < shortest), "drop_short_turn", F.array(own), none_turn, none_gap, "below the least length")
    kept = rows(clean_turns(bridged, shortest, longest), "keep_turn", F.array().cast(f"array<{_TURN}>"), own, none_gap, "kept")
    long = bridged.filter(duration() > longest).withColumn("_whole", own)
    pieces = split_turns(long, shortest, longest)
    split = rows(pieces, "split_long_turn", F.array("_whole"), own, none_gap, "over the greatest length", F.col("chunk_index"), F.col("num_chunks"))
    return merges.unionByName(bridges).unionByName(dropped).unionByName(kept).unionByName(split)


def extract_turns(audio: DataFrame, diarize, **limits) -> DataFrame:
    """Diarises with an injected function (DataFrame to turns) and cleans up what it finds."""
    return cleanup_turns(diarize(audio), **limits)


def rttm_lines(turns: DataFrame) -> DataFrame:
    """One text line a turn in the standard diarisation format; null where the turn lacks a part of it."""
    line = F.format_string("SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>", F.col("audio_id").cast("string"), F.col("start"), duration(), F.col("speaker_label"))
    whole = F.col("audio_id").isNotNull() & (F.col("end") >= F.col("start")).isNotNull() & F.col("speaker_label").isNotNull()
    return turns.select(F.when(whole, line).alias("value"))
