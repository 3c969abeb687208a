"""Queries of judges, speech, sound files, log folders and the meaning term of dialogs, with deterministic stand-ins for models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import chat, text
from ..functions.lenient import parse_audio_verdict, parse_text_verdict
from ..operators import dialogs, media, models, segments, turns, usage
from ..sources import jsonl
from . import base
from .base import scratch, table
from .dialog_queries import CALLS, _calls
from .turn_queries import _ROUND, NORMAL, _segments

SYSTEM = "You judge."


def _texts(spark, d):
    return table(spark, d, "conversations").filter("text is not null").select("conv_id", "turn", "role", F.col("text").alias("prompt"))


def text_judge():
    """Passes texts of even length; a third of the texts with a 7 in their length are refused."""

    def judge(system, prompt):
        n = len(prompt)
        if n % 7 == 0:
            raise ValueError(f"400 refused at {n}")
        return f'```json\n{{"passed": {"true" if n % 2 == 0 else "false"}, "summary": "{len(system or "")}:{n}", "issues": []}}\n```'

    return judge


def judge_texts(spark, d):
    done = media.judge_texts(_texts(spark, d), text_judge, system=SYSTEM)
    return done.withColumn("v", parse_text_verdict(F.col("verdict_text"))).select("conv_id", "turn", "v.passed", "v.summary", "api_error")


def sound_judge():
    """Knows no system field for prompts of odd length; fails for every eleventh length."""

    def judge(system, prompt, uri):
        n = len(prompt)
        if system is not None and n % 2:
            raise ValueError("HTTP 400: Unknown name systemInstruction")
        if n % 11 == 0:
            raise RuntimeError("boom")
        return f'{{"is_pass": {"true" if system is None else "false"}, "review_summary": "{n}:{len(uri)}"}}'

    return judge


def judge_sounds(spark, d):
    rows = _texts(spark, d).withColumns({"content": F.encode("prompt", "UTF-8"), "tts_audio": F.lit("a/b.wav")})
    done = media.judge_sounds(rows, sound_judge, SYSTEM)
    return done.withColumn("v", parse_audio_verdict(F.col("verdict_text"))).select("conv_id", "turn", "v.is_pass", "v.review_summary", "api_error")


def object_model():
    def model(system, prompt):
        if system is not None and len(prompt) % 3 == 0:
            raise ValueError("invalid field")
        return f'Here: {{"n": {len(prompt)}}}' if len(prompt) % 5 else "nothing"

    return model


def generate_objects(spark, d):
    return media.generate_objects(_texts(spark, d), object_model, SYSTEM).select("conv_id", "turn", "object", "error")


class WordSpeaker:
    """Two samples a character, in pieces of a word."""

    rate = 16_000

    def __call__(self, words, mode, **given):
        for w in words.split(" "):
            yield [0.5, -0.5] * len(w)


def _plan(spark, d):
    blank = F.when(F.col("turn") % 4 == 3, F.lit(None).cast("string")).otherwise(F.col("prompt"))
    path = F.when(blank.isNotNull(), F.concat(F.lit("m"), "conv_id", F.lit("_t"), "turn", F.lit(".wav")))
    return _texts(spark, d).select("conv_id", "turn", blank.alias("tts_text"), path.alias("tts_audio"), F.when(blank.isNull(), F.lit("skip_no_text")).alias("tts_error"))


def speak_turns(spark, d):
    done = media.speak(_plan(spark, d), WordSpeaker, media.Voice(reference="ref.wav", reference_text="said"))
    return done.select("conv_id", "turn", "tts_audio", "tts_error", F.length("wav").cast("long").alias("size"))


def speak_without_voice(spark, d):
    from dataclasses import replace

    done = media.speak(_plan(spark, d), WordSpeaker, media.Voice(), replace(media.SPEECH, pause=0.0))
    return done.select("conv_id", "turn", "tts_audio", "tts_error", F.length("wav").cast("long").alias("size"))


def speak_mock(spark, d):
    done = media.speak(_plan(spark, d), WordSpeaker, media.Voice(mock=True))
    return done.select("conv_id", "turn", "tts_audio", "tts_error", F.md5("wav").alias("digest"))


def decode_audio(spark, d):
    """Vectors as sound files and back: what is read is what 16 bits hold."""
    waves = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("wave"))
    files = media.to_pcm(waves).select("vec_id", F.when(F.col("vec_id") % 9 > 0, F.col("wav")).otherwise(F.encode(F.lit("RIFF"), "UTF-8")).alias("content"))
    read = media.decode_audio(files, media.pcm_decoder(16_000))
    total = F.aggregate("wave", F.lit(0).cast("long"), lambda s, x: s + F.round(x * 32768).cast("long"))
    return read.select("vec_id", "rate", F.size("wave").cast("long").alias("n"), total.alias("total"), F.col("error").isNotNull().alias("failed"))


def channels_of(spark, d):
    split = media.channels_of(F.col("embedding").cast("array<double>"), 2)
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), 6)
    return table(spark, d, "embeddings").select("vec_id", total(F.get(split, F.lit(0))).alias("left"), total(F.get(split, F.lit(1))).alias("right"))


def model_row_errors(spark, d):
    """One failing row fails no other of its batch, and a plainer model takes over after an error of form."""

    def factory():
        def run(rows):
            if any(k % 10 == 0 for (k,) in rows):
                raise ValueError("400 bad form")
            if any(k % 10 == 1 for (k,) in rows):
                raise RuntimeError("broken")
            return [2 * k for (k,) in rows]

        return run

    done = models.apply_model(table(spark, d, "supplier").select("s_suppkey"), factory, ["s_suppkey"], T.StructField("v", T.LongType()), plainer=lambda: lambda rows: [-k for (k,) in rows])
    return done.select("s_suppkey", "v", "error", F.col("attempts").cast("long").alias("attempts"))


def embed_vectors(spark, d):
    done = models.apply_model(table(spark, d, "documents").select("doc_id", "text"), models.hash_embedder(4), ["text"], T.StructField("v", T.ArrayType(T.DoubleType())))
    return done.select("doc_id", *[F.round(F.get("v", F.lit(k)), 6).alias(f"v{k}") for k in range(4)])


def jsonl_scan(spark, d):
    """Suppliers as lines of one file, some blank and some broken; line numbers count the non-blank ones."""
    place, key = scratch(spark, "lines"), F.col("s_suppkey")
    line = F.when(key % 7 == 0, F.concat(F.lit("{broken "), key)).otherwise(F.to_json(F.struct("s_suppkey", "s_name")))
    lines = F.concat(F.when(key % 5 == 0, F.lit("  \n")).otherwise(F.lit("")), line)
    jsonl.write_lines(table(spark, d, "supplier").select("s_suppkey", lines.alias("value")).coalesce(1).sortWithinPartitions("s_suppkey"), place)
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])
    return jsonl.jsonl_scan(spark, place, schema, "skip").select("s_suppkey", "s_name", F.col("line_no").cast("long").alias("line_no"))


def _logged(spark, d):
    """The calls of all events, written as logs; users have underscores and blanks."""
    place = scratch(spark, "logs")
    user = F.concat(F.lit("stage_2 "), (F.col("user") % 3).cast("string"))
    rows = _calls(spark, d).withColumns({"timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "user": user})
    for c, f in ((f.name, f.dataType) for f in jsonl.CALLS):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(f))
    jsonl.write_calls(rows.select(*[f.name for f in jsonl.CALLS]).repartition("model", "user"), place)
    return place


def stats_logs(spark, d):
    rows = usage.usage_by(jsonl.stats_logs(spark, _logged(spark, d)), "model", "user")
    return rows.withColumn("success_rate", F.round("success_rate", 6))


def call_logs(spark, d):
    rows = jsonl.call_logs(spark, _logged(spark, d))
    return rows.groupBy("model", "user").agg(F.count(F.lit(1)).alias("calls"), F.sum("total_tokens").alias("total_tokens"), F.min("timestamp").alias("first"), F.max("line_no").isNotNull().alias("numbered"))


_LOGGED = CALLS.replace("user_id AS user,", "'stage_2 ' || (user_id % 3) AS user,")
_SUMS = """count(*)::BIGINT AS calls, (count(*) FILTER (WHERE ok))::BIGINT AS succeeded, (count(*) FILTER (WHERE NOT ok))::BIGINT AS failed, (count(*) FILTER (WHERE coalesce(c, 0) = 0))::BIGINT AS zero_output,
  sum(p)::BIGINT AS prompt_tokens, coalesce(sum(c), 0)::BIGINT AS completion_tokens, sum(t)::BIGINT AS total_tokens, round((count(*) FILTER (WHERE ok)) / count(*) * 100, 6) AS success_rate"""


def usage_export_whole(spark, d):
    return usage.export_rows(_calls(spark, d).withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))


def prompt_chars_shapes(spark, d):
    """Texts that begin like a list, lists of parts, parts without text, messages without content."""
    rows = table(spark, d, "conversations").filter("text is not null")
    message = lambda c: F.to_json(F.struct(F.array(F.struct(c.alias("content"))).alias("messages")))
    shapes = [
        message(F.concat(F.lit("[breath] "), "text")), message(F.lit("[1, 2]")), message(F.array(F.struct("text"), F.struct("text"))),
        F.lit('{"messages": [{"content": [{"type": "image"}, {"text": "abc"}, "x"]}, {"role": "user"}, {"content": 5}, {"content": "de"}]}'), F.lit('{"messages": null, "prompt": "12345"}'),
    ]
    request = F.get(F.array(*shapes), (F.col("turn") % len(shapes)).cast("int"))
    return rows.select("conv_id", "turn", chat.prompt_chars(request).alias("n"))


def request_of(spark, d):
    kwargs = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"model":"'), "event_type", F.lit('"}'))).otherwise(F.lit("{}"))
    args = F.concat(F.lit('[{"id":'), "event_id", F.lit("},5]"))
    return table(spark, d, "events").select("event_id", chat.request_of(args, kwargs).alias("request"))


SETTINGS = (' "quoted" ', "'single'", "plain ", '"open', "", "a 'b' c", "\"'both'\"")


def clean_setting(spark, d):
    value = F.get(F.array(*map(F.lit, SETTINGS)), F.pmod("doc_id", F.lit(len(SETTINGS))).cast("int"))
    return table(spark, d, "documents").select("doc_id", text.clean_setting(value).alias("v"))


def select_annotation(spark, d):
    pick = lambda k, name: F.when(F.col("event_id") % k == 0, F.lit(name))
    return table(spark, d, "events").select("event_id", turns.select_annotation(pick(2, "exclusive"), pick(3, "speaker"), F.col("event_type")).alias("a"))


def range_trace(spark, d):
    rows = segments.range_trace(_segments(spark, d))
    return rows.select("audio_id", "segment_id", F.round("duration", 6).alias("duration"), "speaker_label")


def audio_views(spark, d):
    return segments.audio_views(table(spark, d, "supplier").select("s_suppkey")).select("s_suppkey", "view")


MAX_GAP, THRESHOLD, MAX_TURNS = base.MAX_GAP, 0.40, base.MAX_TURNS


def _meant(spark, d):
    """Segments with a vector each, four in a row by number with the same one."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("v"), F.col("embedding").alias("sem_embedding"))
    rows = _segments(spark, d).withColumn("v", F.floor(F.col("segment_id") / 4) % 100)
    return rows.join(vectors, "v", "left").drop("v")


def semantic_links(spark, d):
    rows = dialogs.link_scores(_meant(spark, d), MAX_GAP, THRESHOLD).filter("prev_segment_id is not null")
    return rows.select("segment_id", "prev_segment_id", *_ROUND("semantic_score", "score"), "linked")


def semantic_dialogs(spark, d):
    return dialogs.build_dialogs(_meant(spark, d), MAX_GAP, THRESHOLD, MAX_TURNS).select("dialog_id", "audio_id", "position", "segment_id")


MEANT = f"""{NORMAL},
m AS (SELECT n.*, embedding::DOUBLE[] AS e FROM n LEFT JOIN embeddings ON vec_id = (event_id // 4) % 100),
p AS (SELECT *, lag(event_id) OVER w AS prev_segment_id, lag("end") OVER w AS pe, lag(speaker_label) OVER w AS pl, lag(e) OVER w AS pv FROM m WINDOW w AS (PARTITION BY audio_id ORDER BY "start", "end", event_id)),
g AS (SELECT *, greatest(0, "start" - pe) AS gap_seconds, least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN pv IS NOT NULL AND e IS NOT NULL THEN list_sum(list_transform(list_zip(pv, e), lambda x: x[1] * x[2])) / (sqrt(list_sum(list_transform(pv, lambda x: x * x))) * sqrt(list_sum(list_transform(e, lambda x: x * x)))) END)) AS s0,
  pv IS NOT NULL AND e IS NOT NULL AS known FROM p),
scored AS (SELECT *, CASE WHEN known THEN s0 ELSE 0 END AS semantic_score, 0.40::DOUBLE * greatest(0, 1.0::DOUBLE - gap_seconds / {MAX_GAP}) + 0.35::DOUBLE * (CASE WHEN pl = speaker_label THEN 1.0 ELSE 0.0 END)::DOUBLE + 0.25::DOUBLE * CASE WHEN known THEN s0 ELSE 0 END AS score FROM g),
linked AS (SELECT *, coalesce(pe IS NOT NULL AND score >= {THRESHOLD}, false) AS linked FROM scored),
c AS (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY audio_id ORDER BY "start", "end", event_id)::BIGINT AS component FROM linked),
k AS (SELECT *, (row_number() OVER (PARTITION BY audio_id, component ORDER BY "start", "end", event_id) - 1) AS rn FROM c),
dialogs AS (SELECT *, (rn % {MAX_TURNS})::INT AS position, printf('dialog_%04d', dense_rank() OVER (ORDER BY audio_id, component, rn // {MAX_TURNS}) - 1) AS dialog_id FROM k)"""

_TALK = "FROM (SELECT *, length(text) AS n FROM conversations WHERE text IS NOT NULL)"
_FOLDED = len(media.folded(SYSTEM, ""))
_SPOKEN = "CASE WHEN turn % 4 < 3 THEN 'm' || conv_id || '_t' || turn || '.wav' END AS tts_audio, CASE WHEN turn % 4 = 3 THEN 'skip_no_text' END AS tts_error"
_NO_VOICE = "RuntimeError: no voice: neither a reference sound nor a speaker"


def _silence() -> str:
    import hashlib

    return hashlib.md5(media.silence()).hexdigest()


QUERIES = {
    "judge_texts": (judge_texts, f"""SELECT conv_id, turn, CASE WHEN n % 7 > 0 THEN n % 2 = 0 END AS passed, CASE WHEN n % 7 > 0 THEN '{len(SYSTEM)}:' || n ELSE '' END AS summary,
  CASE WHEN n % 7 = 0 THEN 'ValueError: 400 refused at ' || n END AS api_error {_TALK}"""),
    "judge_sounds": (judge_sounds, f"""SELECT conv_id, turn, CASE WHEN NOT bad THEN folded END AS is_pass, CASE WHEN NOT bad THEN m || ':' || (length('data:audio/wav;base64,') + length(to_base64(encode(text)))) ELSE '' END AS review_summary,
  CASE WHEN bad THEN 'RuntimeError: boom' END AS api_error FROM (SELECT *, m % 11 = 0 AS bad FROM (SELECT *, n % 2 = 1 AS folded, CASE WHEN n % 2 = 1 THEN n + {_FOLDED} ELSE n END AS m {_TALK}))"""),
    "generate_objects": (generate_objects, f"""SELECT conv_id, turn, CASE WHEN m % 5 > 0 THEN '{{"n": ' || m || '}}' END AS object, CASE WHEN m % 5 = 0 THEN 'ValueError: no JSON object in model text' END AS error
  FROM (SELECT *, CASE WHEN n % 3 = 0 THEN n + {_FOLDED} ELSE n END AS m {_TALK})"""),
    "speak_turns": (speak_turns, f"""SELECT conv_id, turn, CASE WHEN turn % 4 < 3 AND c > 0 THEN 'm' || conv_id || '_t' || turn || '.wav' END AS tts_audio,
  CASE WHEN turn % 4 = 3 THEN 'skip_no_text' WHEN c = 0 THEN 'RuntimeError: the synthesiser returned no sound' END AS tts_error, CASE WHEN turn % 4 < 3 AND c > 0 THEN 44 + 4 * c END::BIGINT AS size
  FROM (SELECT *, length(replace(text, ' ', '')) AS c {_TALK})"""),
    "speak_without_voice": (speak_without_voice, f"SELECT conv_id, turn, NULL::VARCHAR AS tts_audio, CASE WHEN turn % 4 = 3 THEN 'skip_no_text' ELSE '{_NO_VOICE}' END AS tts_error, NULL::BIGINT AS size {_TALK}"),
    "speak_mock": (speak_mock, f"SELECT conv_id, turn, {_SPOKEN}, CASE WHEN turn % 4 < 3 THEN '{_silence()}' END AS digest {_TALK}"),
    "decode_audio": (decode_audio, """SELECT vec_id, CASE WHEN vec_id % 9 > 0 THEN 16000 END AS rate, CASE WHEN vec_id % 9 > 0 THEN len(embedding) END::BIGINT AS n,
  CASE WHEN vec_id % 9 > 0 THEN list_sum(list_transform(embedding::DOUBLE[], lambda x: round(least(1, greatest(-1, x)) * 32767)::BIGINT)) END::BIGINT AS total, vec_id % 9 = 0 AS failed FROM embeddings"""),
    "channels_of": (channels_of, """SELECT vec_id, round(list_sum(list_filter(embedding::DOUBLE[], lambda x, i: i % 2 = 1)), 6) AS "left", round(list_sum(list_filter(embedding::DOUBLE[], lambda x, i: i % 2 = 0)), 6) AS "right" FROM embeddings"""),
    "model_row_errors": (model_row_errors, """SELECT s_suppkey, CASE s_suppkey % 10 WHEN 0 THEN -s_suppkey WHEN 1 THEN NULL ELSE 2 * s_suppkey END::BIGINT AS v, CASE WHEN s_suppkey % 10 = 1 THEN 'RuntimeError: broken' END AS error,
  CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END::BIGINT AS attempts FROM supplier"""),
    "embed_vectors": (embed_vectors, """WITH b AS (SELECT doc_id, list_transform(range(0, 4), lambda k: ('0x' || substr(sha256(coalesce(text, '')), 2 * k + 1, 2))::INT - 127.5::DOUBLE) AS v FROM documents),
x AS (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) AS l FROM b) SELECT doc_id, round(v[1] / l, 6) AS v0, round(v[2] / l, 6) AS v1, round(v[3] / l, 6) AS v2, round(v[4] / l, 6) AS v3 FROM x"""),
    "jsonl_scan": (jsonl_scan, "SELECT s_suppkey, s_name, line_no FROM (SELECT s_suppkey::BIGINT AS s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS line_no FROM supplier) WHERE s_suppkey % 7 > 0"),
    "stats_logs": (stats_logs, f'WITH {_LOGGED} SELECT model, "user", {_SUMS} FROM calls GROUP BY model, "user"'),
    "call_logs": (call_logs, f"""WITH {_LOGGED} SELECT model, "user", count(*)::BIGINT AS calls, sum(t)::BIGINT AS total_tokens, min(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS first, true AS numbered FROM calls GROUP BY model, "user\""""),
    "usage_export_whole": (usage_export_whole, f"""WITH {CALLS} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS 时间戳, model AS 模型, "user" AS 用户, p AS 输入Tokens, coalesce(c, 0) AS 输出Tokens, t AS 总Tokens, value AS "耗时(ms)", CASE WHEN ok THEN '是' ELSE '否' END AS 成功 FROM calls"""),
    "prompt_chars_shapes": (prompt_chars_shapes, "SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 9 + length(text) WHEN 1 THEN 6 WHEN 2 THEN 2 * length(text) WHEN 3 THEN 5 ELSE 0 END::BIGINT AS n FROM conversations WHERE text IS NOT NULL"),
    "request_of": (request_of, """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"model":"' || event_type || '"}' ELSE '{"id":' || event_id || '}' END AS request FROM events"""),
    "clean_setting": (clean_setting, "SELECT doc_id, ['quoted', 'single', 'plain', '\"open', '', 'a ''b'' c', 'both'][(doc_id % 7) + 1] AS v FROM documents"),
    "select_annotation": (select_annotation, "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'exclusive' WHEN event_id % 3 = 0 THEN 'speaker' ELSE event_type END AS a FROM events"),
    "range_trace": (range_trace, f"""WITH {NORMAL} SELECT audio_id, event_id AS segment_id, round("end" - "start", 6) AS duration, speaker_label FROM n"""),
    "audio_views": (audio_views, "SELECT s_suppkey, unnest(['raw', 'separated', 'enhanced']) AS view FROM supplier"),
    "semantic_links": (semantic_links, f"WITH {MEANT} SELECT event_id AS segment_id, prev_segment_id, round(semantic_score, 6) AS semantic_score, round(score, 6) AS score, linked FROM linked WHERE pe IS NOT NULL"),
    "semantic_dialogs": (semantic_dialogs, f"WITH {MEANT} SELECT dialog_id, audio_id, position, event_id AS segment_id FROM dialogs"),
}
