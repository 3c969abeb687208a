"""Queries of the nested, gate, resume, usage and model operators over conversations, events, labels and documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gates, models, nested, resume, usage
from .base import table


def _messages(spark, d):
    """A row a conversation: its messages in order, its user texts and one audio name for each."""
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    rows = rows.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("messages"))
    users = nested.user_transcripts(F.col("messages"))
    rows = rows.withColumn("transcripts", users)
    clip = lambda x, i: F.concat(F.lit("clips/"), F.col("conv_id").cast("string"), F.lit("_"), i.cast("string"))
    return rows.withColumn("audio_clips", F.transform("transcripts", clip))


USERS = """u AS (SELECT conv_id, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'user'),
convs AS (SELECT DISTINCT conv_id FROM conversations),
ut AS (SELECT conv_id, list(text ORDER BY k) AS t FROM u GROUP BY conv_id),
us AS (SELECT conv_id, coalesce(t, []) AS t FROM convs LEFT JOIN ut USING (conv_id))"""
_STRIP = "regexp_replace(regexp_replace({0}, '^[\\s　]+', ''), '[\\s　]+$', '')"


def user_transcripts(spark, d):
    return _messages(spark, d).select("conv_id", F.size("transcripts").cast("long").alias("n"), F.array_join("transcripts", "|").alias("texts"))


def manifest_messages(spark, d):
    rows = nested.manifest(_messages(spark, d))
    return rows.select("conv_id", F.size("messages").cast("long").alias("n"), F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "|").alias("messages"))


def manifest_wide(spark, d):
    rows = nested.widen(_messages(spark, d), "transcripts", "audio_clips", 6)
    return rows.select("conv_id", *[nested.wide_key(n, k) for k in (1, 2, 6) for n in ("user", "audio", "assistant")])


def wide_keys(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", nested.key_for_turn("audio", F.col("turn")).alias("k"))


def manifest_turns(spark, d):
    rows = _messages(spark, d)
    messages = F.when(F.col("conv_id") % 3 > 0, F.col("messages"))
    turns = nested.manifest_turns(messages, F.col("audio_clips"), F.lit("single"))
    return rows.select("conv_id", F.posexplode(turns).alias("i", "x")).select("conv_id", F.col("i").cast("long").alias("i"), "x.audio", "x.transcript")


def nth_turn(spark, d):
    return _messages(spark, d).select("conv_id", *[nested.nth_turn(F.col("transcripts"), F.lit(k)).alias(f"t{k}") for k in (1, 3, 9)])


def history_text(spark, d):
    rows = _messages(spark, d).withColumn("replies", F.transform("transcripts", lambda t, i: F.concat(F.lit("r"), i.cast("string"))))
    rows = rows.filter(F.size("transcripts") > 0).select("*", F.explode(F.sequence(F.lit(1), F.size("transcripts"))).alias("k"))
    return rows.select("conv_id", F.col("k").cast("long").alias("k"), F.md5(nested.history_text(F.col("transcripts"), F.col("replies"), F.col("k"))).alias("history"))


def running_history(spark, d):
    rows = table(spark, d, "conversations").filter("role = 'user'").withColumn("reply", F.concat(F.lit("r"), F.col("turn").cast("string")))
    return nested.running_history(rows, "conv_id", "turn", "text", "reply").select("conv_id", "turn", F.md5("history").alias("history"))


HEADER, TASK = "So far:", "Answer as JSON."
JUDGE = "Text: {plain}\nEmotion: {emotion}\n"


def prompt_assembly(spark, d):
    rows = table(spark, d, "conversations")
    return rows.select("conv_id", "turn", F.md5(nested.prompt(F.when(F.col("turn") > 0, F.col("text")), TASK, HEADER)).alias("prompt"))


def judge_prompt(spark, d):
    rows = table(spark, d, "conversations")
    return rows.select("conv_id", "turn", F.md5(nested.judge_prompt(JUDGE, F.col("text"), F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(F.lit(" ")))).alias("prompt"))


def judge_payload(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("turn_index"), F.col("event_type").alias("query"), F.lit('a "b"\n').alias("plain_text"), F.lit(None).cast("string").alias("semantic_content"), F.lit("é").alias("acoustic_emotion"), F.lit(None).cast("string").alias("error")))).alias("turns")
    )
    return rows.select("user_id", F.md5(nested.judge_payload(F.col("turns"))).alias("payload"))


_TURN = "struct<turn_index:int,plain_text:string,error:string>"


def _turns(spark, d):
    """Users' events as answered turns: some failed, some blank, some numbers missing."""
    w = F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value")))
    rows = table(spark, d, "events").groupBy("user_id").agg(w.alias("e"))
    turn = lambda x, i: F.struct(
        F.when(x["event_id"] % 11 > 0, i + 1).cast("int").alias("turn_index"),
        F.when(x["event_id"] % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" <strong>"), x["event_type"], F.lit("</strong>[sigh] "))).alias("plain_text"),
        F.when((x["event_type"] == "error") & (x["event_id"] % 2 == 0), F.concat(F.lit("e"), x["event_id"].cast("string"))).alias("error"),
    )
    return rows.select("user_id", F.transform("e", turn).alias("turns"))


TURN_ROWS = """e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
t AS (SELECT user_id, i, CASE WHEN event_id % 11 > 0 THEN i END AS turn_index, CASE WHEN event_id % 7 = 0 THEN ' ' ELSE ' <strong>' || event_type || '</strong>[sigh] ' END AS plain_text,
  event_type, event_id % 7 = 0 AS blank, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'e' || event_id END AS error FROM e)"""


def qc_eligible(spark, d):
    rows = _turns(spark, d).withColumn("turns", F.when(F.col("user_id") % 3 == 0, F.slice("turns", 1, 0)).when(F.col("user_id") % 3 == 1, F.col("turns")))
    return nested.qc_eligible(rows).select("user_id")


def tts_plan(spark, d):
    rows = nested.speech_plan(_turns(spark, d), "user_id").select("user_id", F.posexplode("turns").alias("i", "t"))
    return rows.select("user_id", (F.col("i") + 1).cast("long").alias("i"), "t.tts_text", "t.tts_audio", "t.tts_error")


def line_error(spark, d):
    return _turns(spark, d).select("user_id", gates.line_error(F.col("turns")).alias("line_error"))


def resume_state(spark, d):
    existing = _turns(spark, d).filter("user_id % 4 > 0").withColumnRenamed("user_id", "manifest_line")
    existing = existing.withColumn("turns", F.when(F.col("manifest_line") % 4 == 1, F.slice("turns", 1, 3)).otherwise(F.col("turns")))
    plan = table(spark, d, "events").groupBy(F.col("user_id").alias("manifest_line")).agg(F.least(F.count(F.lit(1)), F.lit(5)).cast("int").alias("total_turns"))
    out = resume.resume_state(plan, existing)
    return out.select("manifest_line", F.col("next_turn").cast("long").alias("next_turn"), F.coalesce(F.array_join("prior", "|"), F.lit("")).alias("prior"))


RESUME = f"""WITH {TURN_ROWS},
x AS (SELECT user_id AS manifest_line, turn_index, trim(plain_text) AS p FROM t WHERE user_id % 4 > 0 AND (user_id % 4 <> 1 OR i <= 3) AND error IS NULL AND NOT blank AND turn_index IS NOT NULL),
s AS (SELECT manifest_line, turn_index, p, row_number() OVER (PARTITION BY manifest_line ORDER BY turn_index) AS n, count(*) OVER (PARTITION BY manifest_line) AS c FROM x),
pre AS (SELECT manifest_line, max(c) AS c, count(*) FILTER (WHERE n = turn_index) AS pref, string_agg(p, '|' ORDER BY turn_index) FILTER (WHERE n = turn_index) AS prior FROM s GROUP BY manifest_line),
plan AS (SELECT user_id AS manifest_line, least(count(*), 5) AS total FROM events GROUP BY user_id)
SELECT manifest_line, CASE WHEN coalesce(c, 0) >= total OR coalesce(pref, 0) >= total THEN NULL ELSE coalesce(pref, 0) + 1 END::BIGINT AS next_turn,
  CASE WHEN coalesce(c, 0) >= total OR coalesce(pref, 0) >= total THEN '' ELSE coalesce(prior, '') END AS prior FROM plan LEFT JOIN pre USING (manifest_line)"""


def contiguous_prefix(spark, d):
    rows = table(spark, d, "events").select("user_id", (F.col("event_id") % 13 + 1).alias("k"), (F.col("event_type") != "error").alias("ok"))
    return resume.contiguous_prefix(rows, "user_id", "k", "ok")


def resume_skip_single(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("manifest_line"), F.concat(F.lit("a"), (F.col("doc_id") % 50).cast("string")).alias("audio"))
    lines = table(spark, d, "labels").select(F.col("doc_id").alias("manifest_line")).distinct()
    audios = table(spark, d, "nation").select(F.concat(F.lit("a"), F.col("n_nationkey").cast("string")).alias("audio"))
    return resume.skip_done(rows, lines, audios)


def resume_merge(spark, d):
    rows = _turns(spark, d).withColumn("turns", F.filter("turns", lambda t: t["turn_index"].isNotNull()))
    new = F.array(*[F.struct(F.lit(k).cast("int").alias("turn_index"), F.lit("new").alias("plain_text"), F.lit(None).cast("string").alias("error")) for k in (4, 3)])
    merged = resume.resume_merge(F.when(F.col("user_id") % 2 == 0, F.col("turns")), new, F.lit(3))
    return rows.select("user_id", F.array_join(F.transform(merged, lambda t: F.concat(t["turn_index"].cast("string"), F.lit(":"), F.trim(t["plain_text"]))), "|").alias("turns"))


def latest_by_key(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return resume.latest_by_key(rows, "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


def legacy_regroup(spark, d):
    flat = table(spark, d, "conversations").select(
        F.col("conv_id").alias("manifest_line"), (F.col("turn") + 1).cast("int").alias("turn_index"), F.col("turn").alias("line_no"),
        F.col("role").alias("query"), F.col("text").alias("plain_text"), F.lit(None).cast("string").alias("error"),
    )
    turn = F.struct(F.lit(1).cast("int").alias("turn_index"), F.lit("q").alias("query"), F.lit("nested").alias("plain_text"), F.lit(None).cast("string").alias("error"))
    old = table(spark, d, "conversations").filter("conv_id % 4 = 0").select(F.col("conv_id").alias("manifest_line")).distinct().withColumn("turns", F.array(turn))
    out = resume.regroup_legacy(flat, old)
    return out.select("manifest_line", F.size("turns").cast("long").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t["turn_index"].cast("string"), F.lit(":"), t["query"])), "|").alias("turns"))


def _verdicts(spark, d):
    judged = table(spark, d, "labels").select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("passed"))
    return table(spark, d, "documents").select("doc_id", "source").join(judged, "doc_id", "left")


def gate_text(spark, d):
    return gates.gate(_verdicts(spark, d)).select("doc_id")


def gate_audio(spark, d):
    verdicts = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("line_passed"))
    return gates.gate_by(table(spark, d, "documents").select("doc_id", "lang"), verdicts, "doc_id", "line_passed")


def line_passed(spark, d):
    small = _verdicts(spark, d).groupBy((F.col("doc_id") % 97).alias("k"), "source").agg(F.collect_list(F.struct(F.col("passed").alias("is_pass"))).alias("turns_qc"))
    return small.select("k", "source", gates.line_passed(F.col("turns_qc")).alias("line_passed"))


def qc_batch_status(spark, d):
    return gates.batch_status(_verdicts(spark, d), F.col("passed")).withColumn("exit_code", F.col("exit_code").cast("int"))


def run_status(spark, d):
    rows = table(spark, d, "events").select(
        gates.row_status(F.col("event_id") % 5 == 0, F.when(F.col("event_type") == "error", F.lit("x"))).alias("status"), F.get_json_object("props", "$.k").cast("long").alias("n_api")
    )
    return gates.run_status(rows)


def turn_qc(spark, d):
    rows = table(spark, d, "conversations").select(
        F.col("conv_id").alias("manifest_line"), (F.col("turn") + 1).alias("turn_index"),
        F.when(F.col("turn") % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit("f"), F.col("turn").cast("string"))).alias("tts_audio"), "turn",
    )
    raw = F.when(F.col("turn") % 5 == 3, F.lit(" [error] x")).when(F.col("manifest_line") % 2 == 0, F.lit('{"is_pass": true}')).otherwise(F.lit('{"is_pass": "no"}'))
    judged = nested.judge_turns(rows, raw, F.col("turn") % 5 != 1, F.when(F.col("turn") % 5 == 2, F.lit("boom")))
    lines = nested.regroup_turns(judged.select("manifest_line", "turn_index", "is_pass", "error"))
    errors = F.array_join(F.transform("turns_qc", lambda t: F.coalesce(t["error"], F.lit("-"))), "|")
    return lines.select("manifest_line", gates.line_passed(F.col("turns_qc")).alias("line_passed"), errors.alias("errors"))


def _calls(spark, d):
    ok = F.when(F.col("event_id") % 9 > 0, F.col("event_type") != "error")
    tokens = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("model"), F.col("user_id").alias("user"), tokens.alias("prompt_tokens"),
        F.when(F.col("event_id") % 4 > 0, tokens % 3).alias("completion_tokens"), (tokens + 1).alias("total_tokens"), F.col("value").alias("duration_ms"), ok.alias("success"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyy-MM")).alias("stem"), F.col("ts").alias("ts"),
    )


CALLS = """calls AS (SELECT event_id, event_type AS model, user_id AS user, json_extract(props, '$.k')::BIGINT AS p, CASE WHEN event_id % 4 > 0 THEN json_extract(props, '$.k')::BIGINT % 3 END AS c,
  json_extract(props, '$.k')::BIGINT + 1 AS t, coalesce(CASE WHEN event_id % 9 > 0 THEN event_type <> 'error' END, true) AS ok, user_id || '_' || strftime(ts, '%Y-%m') AS stem, ts, value FROM events)"""
_SUMS = """count(*)::BIGINT AS calls, (count(*) FILTER (WHERE ok))::BIGINT AS succeeded, (count(*) FILTER (WHERE NOT ok))::BIGINT AS failed, (count(*) FILTER (WHERE coalesce(c, 0) = 0))::BIGINT AS zero_output,
  sum(p)::BIGINT AS prompt_tokens, coalesce(sum(c), 0)::BIGINT AS completion_tokens, sum(t)::BIGINT AS total_tokens"""
_RATE = "round((count(*) FILTER (WHERE ok)) / count(*) * 100, 6) AS success_rate"


def _rated(rows):
    return rows.withColumn("success_rate", F.round("success_rate", 6))


def usage_total(spark, d):
    return usage.usage_total(_calls(spark, d))


def usage_by_model(spark, d):
    return _rated(usage.usage_by(_calls(spark, d), "model"))


def usage_by_user(spark, d):
    return _rated(usage.usage_by(_calls(spark, d), "user"))


def usage_grouping_sets(spark, d):
    return usage.usage_sets(_calls(spark, d))


def usage_month(spark, d):
    return usage.usage_total(usage.in_month(_calls(spark, d), "2024-01"))


def usage_of_model(spark, d):
    return usage.usage_total(usage.of_model(_calls(spark, d), "view"))


def recent_calls(spark, d):
    rows = _calls(spark, d).withColumns({"file_time": F.to_date("ts"), "path": F.col("model"), "line_no": F.col("event_id")})
    return usage.recent_calls(rows, 50).select("event_id", "model")


def usage_export(spark, d):
    return usage.export_rows(_calls(spark, d), {"event_id": "id", "model": "model", "total_tokens": "tokens", "success": "ok"})


def echo_replies(spark, d):
    rows = _messages(spark, d).select(F.col("conv_id").alias("manifest_line"), "transcripts", F.lit(1).alias("next_turn"), F.array().cast("array<string>").alias("prior"))
    done = models.converse(rows, models.echo_model, lambda said, replies: "\n".join(said))
    return done.select("manifest_line", F.array_join(F.transform("new_turns", lambda t: t["plain_text"]), "|").alias("replies"), F.col("n_api").cast("long").alias("n_api"))


def embed_documents(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("t"))
    done = models.apply_model(rows, models.hash_embedder(8), ["t"], T.StructField("v", T.ArrayType(T.DoubleType())))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return done.select("doc_id", F.round(norm, 6).alias("norm"), F.size("v").cast("long").alias("width"), "error")


def embedder_retry_rows(spark, d):
    """A model that always fails transiently gives its error and its last attempt."""
    rows = table(spark, d, "region").select("r_regionkey")

    def factory():
        def fail(_):
            raise RuntimeError("HTTP 503")

        return fail

    done = models.apply_model(rows, factory, ["r_regionkey"], T.StructField("v", T.StringType()), models.Retry(attempts=3, pause=0.0))
    return done.select("r_regionkey", "v", "error", F.col("attempts").cast("long").alias("attempts"))


QUERIES = {
    "user_transcripts": (user_transcripts, f"WITH {USERS} SELECT conv_id, len(t)::BIGINT AS n, array_to_string(t, '|') AS texts FROM us"),
    "manifest_messages": (manifest_messages, f"WITH {USERS} SELECT conv_id, 2 * len(t)::BIGINT AS n, array_to_string(list_transform(t, lambda x: 'user:' || x || '|assistant:'), '|') AS messages FROM us"),
    "manifest_wide": (manifest_wide, f"""WITH {USERS} SELECT conv_id, {', '.join(f"t[{k}] AS user{s}, CASE WHEN len(t) >= {k} THEN 'clips/' || conv_id || '_{k - 1}' END AS audio{s}, CASE WHEN len(t) >= {k} THEN '' END AS assistant{s}" for k, s in ((1, ''), (2, '_2'), (6, '_6')))} FROM us""".replace("AS user,", 'AS "user",')),
    "wide_keys": (wide_keys, "SELECT conv_id, turn, CASE WHEN turn = 1 THEN 'audio' WHEN turn > 1 THEN 'audio_' || turn END AS k FROM conversations"),
    "manifest_turns": (manifest_turns, f"""WITH {USERS}, x AS (SELECT conv_id, CASE WHEN conv_id % 3 > 0 THEN t WHEN len(t) > 0 THEN ['single'] ELSE [] END AS t FROM us)
SELECT conv_id, (i - 1)::BIGINT AS i, 'clips/' || conv_id || '_' || (i - 1) AS audio, t[i] AS transcript FROM (SELECT conv_id, t, unnest(range(1, len(t) + 1)) AS i FROM x)"""),
    "nth_turn": (nth_turn, f"WITH {USERS} SELECT conv_id, {', '.join(f'coalesce({_STRIP.format(f"t[{k}]")}, {chr(39) * 2}) AS t{k}' for k in (1, 3, 9))} FROM us"),
    "history_text": (history_text, f"""WITH {USERS} SELECT conv_id, k::BIGINT AS k, md5(string_agg('{nested.CHILD}' || {_STRIP.format('p.text')} || CASE WHEN p.k < u.k THEN chr(10) || '{nested.COMPANION}r' || (p.k - 1) ELSE '' END, chr(10) ORDER BY p.k)) AS history
FROM u JOIN u AS p USING (conv_id) WHERE p.k <= u.k GROUP BY conv_id, u.k""".replace("SELECT conv_id, k::BIGINT", "SELECT conv_id, u.k::BIGINT")),
    "running_history": (running_history, f"""WITH {USERS}, l AS (SELECT conv_id, turn, '{nested.CHILD}' || {_STRIP.format('text')} AS line FROM u)
SELECT l.conv_id, l.turn, md5(coalesce((SELECT string_agg(b.line || chr(10) || '{nested.COMPANION}r' || b.turn, chr(10) ORDER BY b.turn) FROM l b WHERE b.conv_id = l.conv_id AND b.turn < l.turn) || chr(10), '') || l.line) AS history FROM l"""),
    "prompt_assembly": (prompt_assembly, f"SELECT conv_id, turn, md5(CASE WHEN turn > 0 AND {_STRIP.format('text')} <> '' THEN '{HEADER}' || chr(10) || {_STRIP.format('text')} || repeat(chr(10), 3) ELSE '' END || '{TASK}') AS prompt FROM conversations"),
    "judge_prompt": (judge_prompt, f"SELECT conv_id, turn, md5('Text: ' || coalesce(nullif({_STRIP.format('text')}, ''), '{nested.NONE}') || chr(10) || 'Emotion: ' || CASE WHEN turn % 2 = 0 THEN role ELSE '{nested.NONE}' END || chr(10)) AS prompt FROM conversations"),
    "judge_payload": (judge_payload, """SELECT user_id, md5(string_agg('{"turn_index": ' || event_id || ', "query": "' || event_type || '", "plain_text": "a \\"b\\"\\n", "semantic_content": null, "acoustic_emotion": "é", "error": null}', chr(10) ORDER BY event_id)) AS payload FROM events GROUP BY user_id"""),
    "qc_eligible": (qc_eligible, "SELECT DISTINCT user_id FROM events WHERE user_id % 3 = 1"),
    "tts_plan": (tts_plan, f"""WITH {TURN_ROWS} SELECT user_id, i, CASE WHEN error IS NULL AND NOT blank THEN event_type END AS tts_text,
  CASE WHEN error IS NULL AND NOT blank THEN 'outputs/tts_generated/m' || user_id || '_t' || coalesce(turn_index, i) || '.wav' END AS tts_audio, CASE WHEN error IS NULL AND blank THEN 'skip_no_text' END AS tts_error FROM t"""),
    "line_error": (line_error, f"WITH {TURN_ROWS} SELECT user_id, min_by(error, i) FILTER (WHERE error IS NOT NULL) AS line_error FROM t GROUP BY user_id"),
    "resume_state": (resume_state, RESUME),
    "contiguous_prefix": (contiguous_prefix, "SELECT user_id, (count(*) FILTER (WHERE k = n))::BIGINT AS prefix FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY k) AS n FROM (SELECT DISTINCT user_id, event_id % 13 + 1 AS k FROM events WHERE event_type <> 'error')) GROUP BY user_id"),
    "resume_skip_single": (resume_skip_single, "SELECT doc_id AS manifest_line, 'a' || (doc_id % 50) AS audio FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND 'a' || (doc_id % 50) NOT IN (SELECT 'a' || n_nationkey FROM nation)"),
    "resume_merge": (resume_merge, f"""WITH {TURN_ROWS}, m AS (SELECT user_id, turn_index, trim(plain_text) AS p FROM t WHERE user_id % 2 = 0 AND turn_index < 3 UNION ALL SELECT user_id, k, 'new' FROM (SELECT DISTINCT user_id FROM events), (VALUES (3), (4)) v(k))
SELECT user_id, string_agg(turn_index || ':' || p, '|' ORDER BY turn_index) AS turns FROM m GROUP BY user_id"""),
    "latest_by_key": (latest_by_key, "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"),
    "legacy_regroup": (legacy_regroup, "SELECT conv_id AS manifest_line, CASE WHEN conv_id % 4 = 0 THEN 1 ELSE count(*) END::BIGINT AS n, CASE WHEN conv_id % 4 = 0 THEN '1:q' ELSE string_agg((turn + 1) || ':' || role, '|' ORDER BY turn) END AS turns FROM conversations GROUP BY conv_id"),
    "gate_text": (gate_text, "SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0"),
    "gate_audio": (gate_audio, "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"),
    "line_passed": (line_passed, "SELECT doc_id % 97 AS k, source, bool_and(coalesce(quality = 1 AND toxic = 0, false)) AS line_passed FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id % 97, source"),
    "qc_batch_status": (qc_batch_status, "SELECT n, passed, n - passed AS failed, CASE WHEN n > 0 AND passed = 0 THEN 2 WHEN n = 0 THEN 1 ELSE 0 END AS exit_code FROM (SELECT count(*)::BIGINT AS n, (count(*) FILTER (WHERE quality = 1 AND toxic = 0))::BIGINT AS passed FROM documents LEFT JOIN labels USING (doc_id))"),
    "run_status": (run_status, "SELECT CASE WHEN event_id % 5 = 0 THEN 'skip' WHEN event_type = 'error' THEN 'err' ELSE 'ok' END AS status, count(*)::BIGINT AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS calls FROM events GROUP BY 1"),
    "turn_qc": (turn_qc, """SELECT conv_id AS manifest_line, bool_and(turn % 5 = 4 AND conv_id % 2 = 0) AS line_passed,
  string_agg(CASE turn % 5 WHEN 0 THEN 'missing tts_audio' WHEN 1 THEN 'TTS 文件不存在: f' || turn WHEN 2 THEN 'api_error: boom' WHEN 3 THEN 'gemini error payload' ELSE '-' END, '|' ORDER BY turn) AS errors FROM conversations GROUP BY conv_id"""),
    "usage_total": (usage_total, f"WITH {CALLS} SELECT {_SUMS} FROM calls"),
    "usage_by_model": (usage_by_model, f"WITH {CALLS} SELECT model, {_SUMS}, {_RATE} FROM calls GROUP BY model"),
    "usage_by_user": (usage_by_user, f'WITH {CALLS} SELECT "user", {_SUMS}, {_RATE} FROM calls GROUP BY "user"'),
    "usage_grouping_sets": (usage_grouping_sets, f"""WITH {CALLS} SELECT model, "user", {_SUMS}, CASE WHEN grouping(model) = 1 AND grouping("user") = 1 THEN 'total' WHEN grouping("user") = 1 THEN 'model' ELSE 'user' END AS level FROM calls GROUP BY GROUPING SETS ((), (model), ("user"))"""),
    "usage_month": (usage_month, f"WITH {CALLS} SELECT {_SUMS} FROM calls WHERE contains(stem, '2024-01')"),
    "usage_of_model": (usage_of_model, f"WITH {CALLS} SELECT {_SUMS} FROM calls WHERE model = 'view'"),
    "recent_calls": (recent_calls, f"WITH {CALLS} SELECT event_id, model FROM calls ORDER BY ts::DATE DESC, model DESC, event_id DESC LIMIT 50"),
    "usage_export": (usage_export, f"WITH {CALLS} SELECT event_id AS id, model, t AS tokens, CASE WHEN ok THEN '是' ELSE '否' END AS ok FROM calls"),
    "echo_replies": (echo_replies, f"WITH {USERS} SELECT conv_id AS manifest_line, array_to_string(list_transform(t, lambda x: 'reply to ' || length(x) || ' characters'), '|') AS replies, len(t)::BIGINT AS n_api FROM us"),
    "embed_documents": (embed_documents, "SELECT doc_id, 1.0::DOUBLE AS norm, 8::BIGINT AS width, NULL::VARCHAR AS error FROM documents"),
    "embedder_retry_rows": (embedder_retry_rows, "SELECT r_regionkey, NULL::VARCHAR AS v, 'RuntimeError: HTTP 503' AS error, 3::BIGINT AS attempts FROM region"),
}
