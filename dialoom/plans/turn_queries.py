"""Queries of the turn, dialog and segment operators over events and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dialogs, segments, turns
from . import base
from .base import GLITCH_GAP, GLITCH_MAX, LONGEST, MAX_GAP, MAX_TURNS, MERGE_GAP, SHORTEST, THRESHOLD, TURNS

_MILLIS = lambda: [F.floor(F.col(n) * 1000 + 0.3137).cast("long").alias(f"{n}_ms") for n in ("start", "end")]
_ROUND = lambda *names: [F.round(n, 6).alias(n) for n in names]

NORMAL = f"""{TURNS},
n AS (SELECT audio_id, "start", "end", replace(speaker_label, ' ', '_') AS speaker_label, event_id FROM turns WHERE "end" > "start")"""
MERGED = f"""{NORMAL},
r AS (SELECT *, sum(CASE WHEN speaker_label IS NOT DISTINCT FROM before THEN 0 ELSE 1 END) OVER (PARTITION BY audio_id ORDER BY "start", "end", speaker_label, event_id) AS run FROM
  (SELECT *, lag(speaker_label) OVER (PARTITION BY audio_id ORDER BY "start", "end", speaker_label, event_id) AS before FROM n)),
e AS (SELECT *, max("end") OVER (PARTITION BY audio_id, run ORDER BY "start", "end", speaker_label, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR greatest(0, "start" - reach) > {MERGE_GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY audio_id, run ORDER BY "start", "end", speaker_label, event_id) AS island FROM e),
merged AS (SELECT audio_id, run, island, min("start") AS "start", max("end") AS "end", first(speaker_label) AS speaker_label, count(*)::BIGINT AS n_merged FROM i GROUP BY audio_id, run, island)"""
# the fold over each recording's turns: a list of the stack's turns, one turn long for each element
BRIDGED = f"""{MERGED},
l AS (SELECT audio_id, list([{{'s': "start", 'e': "end", 'w': speaker_label}}] ORDER BY run, island) AS t FROM merged GROUP BY audio_id),
f AS (SELECT audio_id, list_reduce(t, lambda a, x: CASE
  WHEN len(a) >= 2 AND a[-2].w = x[1].w AND a[-2].w <> a[-1].w AND greatest(0, a[-1].e - a[-1].s) <= {GLITCH_MAX}
    AND greatest(0, a[-1].s - a[-2].e) <= {GLITCH_GAP} AND greatest(0, x[1].s - a[-1].e) <= {GLITCH_GAP}
  THEN list_concat(a[1:len(a) - 2], [{{'s': a[-2].s, 'e': x[1].e, 'w': a[-2].w}}]) ELSE list_concat(a, x) END) AS t FROM l),
bridged AS (SELECT audio_id, x.s AS "start", x.e AS "end", x.w AS speaker_label FROM (SELECT audio_id, unnest(t) AS x FROM f))"""


def split_sql(source: str) -> str:
    return f"""split AS (SELECT audio_id, speaker_label, k AS chunk_index, n AS num_chunks, "start" + k * ((e - "start") / n) AS "start",
  CASE WHEN k = n - 1 THEN e ELSE "start" + (k + 1) * ((e - "start") / n) END AS "end" FROM
  (SELECT *, unnest(range(0, n))::INT AS k FROM (SELECT audio_id, speaker_label, "start", "end" AS e,
    CASE WHEN "end" - "start" <= {LONGEST} THEN 1 ELSE greatest(2, ceil(("end" - "start") / {LONGEST}))::INT END AS n FROM {source} WHERE greatest(0, "end" - "start") >= {SHORTEST})))"""


#: Off the halves, where two engines' last bits would decide.
MILLIS = 'floor("start" * 1000 + 0.3137)::BIGINT AS start_ms, floor("end" * 1000 + 0.3137)::BIGINT AS end_ms'


def _merged(spark, d):
    return turns.merge_turns(turns.normalize_turns(base.turns(spark, d)), MERGE_GAP, ("event_id",))


def _bridged(spark, d):
    return turns.bridge_turns(_merged(spark, d), GLITCH_MAX, GLITCH_GAP, ("run", "island"))


def turns_normalize(spark, d):
    return turns.normalize_turns(base.turns(spark, d)).select("event_id", "audio_id", "start", "end", "speaker_label")


def turn_merge(spark, d):
    return _merged(spark, d).select("audio_id", "start", "end", "speaker_label", "n_merged")


def turn_bridge(spark, d):
    return _bridged(spark, d)


def turn_clean(spark, d):
    return turns.clean_turns(turns.normalize_turns(base.turns(spark, d)), SHORTEST, LONGEST).select("audio_id", "start", "end", "speaker_label")


def turn_split(spark, d):
    rows = turns.split_turns(turns.normalize_turns(base.turns(spark, d)), SHORTEST, LONGEST)
    return rows.select("audio_id", "speaker_label", *_MILLIS(), "chunk_index", "num_chunks")


def turn_cleanup(spark, d):
    rows = turns.cleanup_turns(base.turns(spark, d), MERGE_GAP, GLITCH_MAX, GLITCH_GAP, SHORTEST, LONGEST, ("event_id",))
    return rows.select("audio_id", "speaker_label", *_MILLIS(), "chunk_index", "num_chunks")


def turn_audit_counts(spark, d):
    log = turns.audit_turns(base.turns(spark, d), MERGE_GAP, GLITCH_MAX, GLITCH_GAP, SHORTEST, LONGEST, ("event_id",))
    return log.groupBy("audio_id", "action").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.aggregate("gaps", F.lit(0.0), lambda s, x: s + x)), 3).alias("gap"))


AUDIT = f"""WITH {BRIDGED}, {split_sql('bridged')},
steps AS (SELECT audio_id, 'merge_same_speaker_gap' AS action, greatest(0, "start" - p) AS gap FROM
  (SELECT *, max("end") OVER (PARTITION BY audio_id, run, island ORDER BY "start", "end", speaker_label, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM i) WHERE p IS NOT NULL
  UNION ALL SELECT audio_id, 'drop_short_turn', 0 FROM bridged WHERE greatest(0, "end" - "start") < {SHORTEST}
  UNION ALL SELECT audio_id, 'keep_turn', 0 FROM bridged WHERE greatest(0, "end" - "start") BETWEEN {SHORTEST} AND {LONGEST}
  UNION ALL SELECT audio_id, 'split_long_turn', 0 FROM split WHERE num_chunks > 1),
o AS (SELECT audio_id, list([{{'s': "start", 'e': "end", 'w': speaker_label, 'g': 0.0::DOUBLE, 'n': 0}}] ORDER BY run, island) AS t FROM merged GROUP BY audio_id),
bridges AS (SELECT audio_id, list_reduce(t, lambda a, x: CASE
  WHEN len(a) >= 2 AND a[-2].w = x[1].w AND a[-2].w <> a[-1].w AND greatest(0, a[-1].e - a[-1].s) <= {GLITCH_MAX}
    AND greatest(0, a[-1].s - a[-2].e) <= {GLITCH_GAP} AND greatest(0, x[1].s - a[-1].e) <= {GLITCH_GAP}
  THEN list_concat(a[1:len(a) - 2], [{{'s': a[-2].s, 'e': x[1].e, 'w': a[-2].w, 'g': a[-2].g + a[-1].g + x[1].g + greatest(0, a[-1].s - a[-2].e) + greatest(0, x[1].s - a[-1].e), 'n': a[-2].n + a[-1].n + 1}}])
  ELSE list_concat(a, x) END) AS t FROM o),
b AS (SELECT audio_id, sum(x.n)::BIGINT AS n, sum(x.g) AS gap FROM (SELECT audio_id, unnest(t) AS x FROM bridges) GROUP BY audio_id)
SELECT audio_id, action, count(*)::BIGINT AS n, round(sum(gap), 3) AS gap FROM steps GROUP BY audio_id, action
UNION ALL SELECT audio_id, 'bridge_micro_turn', n, round(gap, 3) FROM b WHERE n > 0"""


def _segments(spark, d):
    rows = turns.normalize_turns(base.turns(spark, d))
    return rows.withColumnRenamed("event_id", "segment_id").withColumn("clip_name", F.lit("")).withColumn("line_no", F.col("segment_id"))


def _dialogs(spark, d):
    return dialogs.build_dialogs(_segments(spark, d), MAX_GAP, THRESHOLD, MAX_TURNS, semantic=F.lit(0.0))


SCORED = f"""{NORMAL},
p AS (SELECT *, lag(event_id) OVER w AS prev_segment_id, lag("end") OVER w AS pe, lag(speaker_label) OVER w AS pl FROM n WINDOW w AS (PARTITION BY audio_id ORDER BY "start", "end", event_id)),
g AS (SELECT *, greatest(0, "start" - pe) AS gap_seconds, (pl = speaker_label) AS same_speaker FROM p),
t AS (SELECT *, greatest(0, 1.0::DOUBLE - gap_seconds / {MAX_GAP}) AS time_score FROM g),
scored AS (SELECT *, 0.40::DOUBLE * time_score + 0.35::DOUBLE * (CASE WHEN same_speaker THEN 1.0 ELSE 0.0 END)::DOUBLE AS score FROM t),
linked AS (SELECT *, coalesce(pe IS NOT NULL AND score >= {THRESHOLD}, false) AS linked FROM scored)"""
COMPONENTS = f"""{SCORED},
c AS (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY audio_id ORDER BY "start", "end", event_id)::BIGINT AS component FROM linked),
k AS (SELECT *, (row_number() OVER (PARTITION BY audio_id, component ORDER BY "start", "end", event_id) - 1) AS rn FROM c),
chunked AS (SELECT *, (rn // {MAX_TURNS})::BIGINT AS chunk, (rn % {MAX_TURNS})::INT AS position FROM k),
dialogs AS (SELECT *, printf('dialog_%04d', dense_rank() OVER (ORDER BY audio_id, component, chunk) - 1) AS dialog_id FROM chunked)"""


def link_scores(spark, d):
    rows = dialogs.link_scores(_segments(spark, d), MAX_GAP, THRESHOLD, semantic=F.lit(0.0)).filter("prev_segment_id is not null")
    return rows.select("segment_id", "prev_segment_id", *_ROUND("gap_seconds", "time_score", "score"), "same_speaker", "linked")


def dialog_components(spark, d):
    scored = dialogs.link_scores(_segments(spark, d), MAX_GAP, THRESHOLD, semantic=F.lit(0.0))
    return dialogs.link_components(scored).groupBy("audio_id", "component").agg(F.count(F.lit(1)).alias("n"), F.min("segment_id").alias("first_id"))


def dialog_chunks(spark, d):
    scored = dialogs.link_scores(_segments(spark, d), MAX_GAP, THRESHOLD, semantic=F.lit(0.0))
    return dialogs.chunk_components(dialogs.link_components(scored), MAX_TURNS).select("audio_id", "component", "chunk", "position", "segment_id")


def dialog_members(spark, d):
    rows = _dialogs(spark, d).withColumn("clip_path", F.col("segment_id").cast("string")).withColumn("transcript", F.col("speaker_label"))
    listed = dialogs.collect_dialogs(rows)
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return listed.select("dialog_id", "audio_id", F.col("num_turns").cast("long").alias("num_turns"), join("segment_ids"), join("transcripts"))


def all_dialogs(spark, d):
    return _dialogs(spark, d).select("dialog_id", "audio_id", "position", "segment_id")


def adjacent_cosine(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy("vec_id")
    rows = base.table(spark, d, "embeddings").withColumn("before", F.lag("embedding").over(w)).filter("before is not null")
    return rows.select("vec_id", "label", F.round(dialogs.cosine(F.col("before"), F.col("embedding")), 6).alias("cosine"))


def segments_from_labels(spark, d):
    rows = _labels(spark, d)
    made = dialogs.segments_from_labels(rows, "/clips")
    return made.select("segment_id", "clip_path", "clip_name", "p_child", "speaker_label", F.length("transcript").cast("long").alias("n"))


def _labels(spark, d):
    """Documents as labels: some contents blank, some speakers missing."""
    return base.table(spark, d, "documents").select(
        F.concat(F.lit("a"), (F.col("doc_id") % 7).cast("string")).alias("audio_id"),
        F.when(F.col("doc_id") % 5 == 0, F.lit(" 　\t")).otherwise(F.col("text")).alias("content"),
        F.col("doc_id").alias("segment_id"), F.concat(F.lit("c\\"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("file_path"),
        F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("speaker_label"),
        F.concat(F.lit("s"), (F.col("doc_id") % 14).cast("string")).alias("source_audio"), F.col("doc_id").cast("double").alias("start"), (F.col("doc_id") + 1.0).alias("end"),
    )


LABELS = """labels_ AS (SELECT 'a' || (doc_id % 7) AS audio_id, CASE WHEN doc_id % 5 = 0 THEN ' 　' || chr(9) ELSE text END AS content, doc_id AS segment_id,
  'c/' || doc_id || '.wav' AS file_path, CASE WHEN doc_id % 3 > 0 THEN source END AS speaker_label, 's' || (doc_id % 14) AS source_audio, doc_id::DOUBLE AS "start", doc_id + 1.0::DOUBLE AS "end" FROM documents),
filled AS (SELECT *, regexp_replace(regexp_replace(content, '^[\\s　]+', ''), '[\\s　]+$', '') AS transcript FROM labels_)"""


def nonempty_labels(spark, d):
    return segments.nonempty(_labels(spark, d)).select("segment_id", "audio_id")


def source_conflicts(spark, d):
    return dialogs.source_conflicts(_labels(spark, d))


def label_template(spark, d):
    return dialogs.label_template(_labels(spark, d)).select("segment_id", "audio_id", "content", "source_audio", "speaker_label", "start", "end")


def child_filter(spark, d):
    rows = base.table(spark, d, "events").select("event_id", (F.col("value") / 500).alias("p_child"))
    return segments.child_filter(rows).select("event_id", F.round("p_child", 6).alias("p_child"))


def child_trace(spark, d):
    rows = base.table(spark, d, "events").select("event_id", (F.col("value") / 500).alias("p_child"))
    return segments.child_trace(rows).select("event_id", "kept")


def clip_bounds(spark, d):
    rows = base.table(spark, d, "events").select("event_id", (F.col("value") - 5).alias("start"), (F.col("value") - 5 + F.col("event_id") % 3 - 1).alias("end"), F.lit(4_000_000).alias("n_samples"))
    return segments.clip_bounds(rows).select("event_id", *_ROUND("start", "end"), "first_sample", "last_sample")


def clip_plan(spark, d):
    rows = base.table(spark, d, "events").select(F.col("event_id").alias("segment_id"), F.lit(1.0).alias("start"), (1.0 + F.col("value") / 1000).alias("end"))
    return segments.clip_plan(rows).select("segment_id", F.round("seconds", 6).alias("seconds"))


def segment_id(spark, d):
    start = F.col("value") / 7
    rows = base.table(spark, d, "events")
    return rows.select("event_id", segments.segment_id(F.col("event_type"), F.col("user_id").cast("int"), start, start + 1.5).alias("segment_id"))


def ordered_slice(spark, d):
    return segments.ordered_slice(base.table(spark, d, "documents").select("doc_id", "source"), ["source", "doc_id"], 37, 200)


def turn_index(spark, d):
    rows = base.table(spark, d, "conversations").filter("role <> 'system'")
    return segments.candidate_index(rows, "conv_id", ["turn"], "turn_index").select("conv_id", "turn", (F.col("turn_index") + 1).cast("long").alias("turn_index"))


def stage_summary(spark, d):
    candidates = base.turns(spark, d)
    clean = turns.clean_turns(turns.normalize_turns(candidates), SHORTEST, LONGEST)
    kept = _dialogs(spark, d)
    return segments.stage_summary(candidate=candidates, cleaned=clean, dialogs=kept.select("dialog_id").distinct())


def rttm(spark, d):
    # as in SQL, the double times 100 is what is rounded; F.round takes the decimals that a double is printed with
    short = lambda n: (F.round(F.col(n) * 100, 0) / 100).alias(n)
    return turns.rttm_lines(_merged(spark, d).select("audio_id", short("start"), short("end"), "speaker_label"))


QUERIES = {
    "dialogs": (all_dialogs, f"WITH {COMPONENTS} SELECT dialog_id, audio_id, position, event_id AS segment_id FROM dialogs"),
    "turns_normalize": (turns_normalize, f'WITH {NORMAL} SELECT event_id, audio_id, "start", "end", speaker_label FROM n'),
    "turn_merge": (turn_merge, f'WITH {MERGED} SELECT audio_id, "start", "end", speaker_label, n_merged FROM merged'),
    "turn_bridge": (turn_bridge, f'WITH {BRIDGED} SELECT audio_id, "start", "end", speaker_label FROM bridged'),
    "turn_clean": (turn_clean, f'WITH {NORMAL} SELECT audio_id, "start", "end", speaker_label FROM n WHERE "end" - "start" BETWEEN {SHORTEST} AND {LONGEST}'),
    "turn_split": (turn_split, f"WITH {NORMAL}, {split_sql('n')} SELECT audio_id, speaker_label, {MILLIS}, chunk_index, num_chunks FROM split"),
    "turn_cleanup": (turn_cleanup, f"WITH {BRIDGED}, {split_sql('bridged')} SELECT audio_id, speaker_label, {MILLIS}, chunk_index, num_chunks FROM split"),
    "turn_audit_counts": (turn_audit_counts, AUDIT),
    "link_scores": (link_scores, f"WITH {SCORED} SELECT event_id AS segment_id, prev_segment_id, round(gap_seconds, 6) AS gap_seconds, round(time_score, 6) AS time_score, round(score, 6) AS score, same_speaker, score >= {THRESHOLD} AS linked FROM scored WHERE pe IS NOT NULL"),
    "dialog_components": (dialog_components, f"WITH {COMPONENTS} SELECT audio_id, component, count(*)::BIGINT AS n, min(event_id) AS first_id FROM chunked GROUP BY audio_id, component"),
    "dialog_chunks": (dialog_chunks, f"WITH {COMPONENTS} SELECT audio_id, component, chunk, position, event_id AS segment_id FROM chunked"),
    "dialog_members": (dialog_members, f"WITH {COMPONENTS} SELECT dialog_id, audio_id, count(*)::BIGINT AS num_turns, string_agg(event_id::VARCHAR, ',' ORDER BY position) AS segment_ids, string_agg(speaker_label, ',' ORDER BY position) AS transcripts FROM dialogs GROUP BY dialog_id, audio_id"),
    "adjacent_cosine": (adjacent_cosine, "SELECT vec_id, label, round(list_cosine_similarity(before::DOUBLE[], embedding::DOUBLE[]), 6) AS cosine FROM (SELECT *, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM embeddings) WHERE before IS NOT NULL"),
    "segments_from_labels": (segments_from_labels, f"WITH {LABELS} SELECT segment_id, '/clips/' || file_path AS clip_path, segment_id || '.wav' AS clip_name, 1.0::DOUBLE AS p_child, coalesce(speaker_label, '') AS speaker_label, length(transcript)::BIGINT AS n FROM filled WHERE transcript <> ''"),
    "nonempty_labels": (nonempty_labels, f"WITH {LABELS} SELECT segment_id, audio_id FROM filled WHERE transcript <> ''"),
    "source_conflicts": (source_conflicts, f"WITH {LABELS} SELECT audio_id, count(DISTINCT source_audio)::BIGINT AS n_sources FROM labels_ GROUP BY audio_id HAVING count(DISTINCT source_audio) > 1"),
    "label_template": (label_template, f"""WITH {LABELS} SELECT segment_id, audio_id, '' AS content, source_audio, speaker_label, "start", "end" FROM labels_"""),
    "child_filter": (child_filter, "SELECT event_id, round(value / 500, 6) AS p_child FROM events WHERE value / 500 >= 0.6"),
    "child_trace": (child_trace, "SELECT event_id, value / 500 >= 0.6 AS kept FROM events"),
    "clip_bounds": (clip_bounds, """WITH b AS (SELECT event_id, greatest(0, value - 5) AS s, value - 5 + event_id % 3 - 1 AS e0 FROM events), c AS (SELECT event_id, s, greatest(s, e0) AS e FROM b),
m AS (SELECT event_id, s, e, greatest(0, trunc(s * 16000)::BIGINT) AS first_sample, least(4000000, trunc(e * 16000)::BIGINT) AS last_sample FROM c)
SELECT event_id, round(s, 6) AS "start", round(e, 6) AS "end", first_sample, last_sample FROM m WHERE last_sample > first_sample"""),
    "clip_plan": (clip_plan, "SELECT event_id AS segment_id, round(greatest(0.05, (1.0 + value / 1000) - 1.0), 6) AS seconds FROM events"),
    "segment_id": (segment_id, "SELECT event_id, event_type || '_' || printf('%04d', user_id) || '_' || trunc(value / 7 * 1000)::BIGINT || '_' || trunc((value / 7 + 1.5) * 1000)::BIGINT AS segment_id FROM events"),
    "ordered_slice": (ordered_slice, "SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 200 OFFSET 37"),
    "turn_index": (turn_index, "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_index FROM conversations WHERE role <> 'system'"),
    "stage_summary": (stage_summary, f"""WITH {COMPONENTS} SELECT 'candidate' AS stage, count(*)::BIGINT AS n FROM turns UNION ALL SELECT 'cleaned', count(*)::BIGINT FROM n WHERE "end" - "start" BETWEEN {SHORTEST} AND {LONGEST}
UNION ALL SELECT 'dialogs', count(DISTINCT dialog_id)::BIGINT FROM dialogs"""),
    "rttm_lines": (rttm, f"""WITH {MERGED} SELECT printf('SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>', audio_id::VARCHAR, round("start", 2), round("end", 2) - round("start", 2), speaker_label) AS value FROM merged"""),
}
