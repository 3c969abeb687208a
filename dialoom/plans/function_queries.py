"""Queries of the string, JSON and vector functions over documents, events, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat, lenient, text, vectors
from .base import table

_BOOLS = ("true", "false", "null", '"TRUE"', '" yes "', '"通过"', '"不"', '"不通过"', '"No"', '"maybe"', "1", "0", "1.0", "2", "0.5", '"1"', '"0"', '""')
_INTS = ("4", "4.0", "4.5", "true", '"12"', '"-3"', '" 7 "', '"x"', "null", '"-"', "-1", '"4.0"')


def _pick(values):
    return F.get(F.array(*map(F.lit, values)), F.pmod("doc_id", F.lit(len(values))).cast("int"))


def _sql_pick(values, key="doc_id"):
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{listed}][({key} % {len(values)}) + 1]"


def _docs(spark, d):
    return table(spark, d, "documents")


VERDICTS = (
    '{"passed": true, "summary": " %s ", "issues": ["a", null, "b"]}',
    '```json\n{"passed": "yes", "summary": "%s"}\n```',
    'Sure: {"passed": false, "issues": ["x"], "summary": "%s"} done',
    '{"passed": true或false, "summary": "%s"}',
    '{"passed": false或true, "summary": "%s"}',
    '{"summary": "%s"}',
    '{"passed": true, "summary": "%s"',
    "no json here %s",
    "",
    '{"passed": 2, "summary": "%s", "issues": "none"}',
)


def _raw():
    branches = F.lit("")
    for i, v in enumerate(VERDICTS):
        a, _, b = v.partition("%s")
        made = F.concat(F.lit(a), F.substring("source", 1, 20), F.lit(b)) if "%s" in v else F.lit(v)
        branches = F.when(F.pmod("doc_id", F.lit(len(VERDICTS))) == i, made).otherwise(branches)
    return branches


#: What each of the shapes above reads as: verdict, whether the summary survives, issues, error.
_READ = (
    ("true", True, "a,b", None), ("true", True, "", None), ("false", True, "x", None), ("false", True, "", None), ("true", True, "", None),
    ("NULL", True, "", "missing passed field"), ("true", False, "", "regex passed fallback only"),
    ("NULL", False, "", "failed to parse QC JSON from model text"), ("NULL", False, "", "empty model text"), ("NULL", True, "", "missing passed field"),
)


def _read_sql() -> str:
    case = lambda f: "CASE doc_id % 10 " + " ".join(f"WHEN {i} THEN {f(r)}" for i, r in enumerate(_READ)) + " END"
    quote = lambda s: "NULL" if s is None else f"'{s}'"
    return (
        f"SELECT doc_id, {case(lambda r: r[0])}::BOOLEAN AS passed, {case(lambda r: 'source' if r[1] else quote(''))} AS summary, "
        f"{case(lambda r: quote(r[2]))} AS issues, {case(lambda r: quote(r[3]))} AS parse_error FROM documents"
    )


AUDIO = (
    '{"is_pass": true, "scores": {"clarity": 4, "emotion": "5", "naturalness": 4.0}, "audio_issues": [], "review_summary": "ok"}',
    '{"is_pass": false, // no\n "scores": {"clarity": true, "emotion": 4.5, "naturalness": "-1"}, "audio_issues": ["hiss"]}',
    '{"is_pass": true, "review_summary": "see http://x.y"}',
    '{"scores": 3}',
    "",
    'text "is_pass": FALSE',
)
_AUDIO_READ = (
    ("true", "4,5,4", "", "ok", None), ("false", ",,-1", "hiss", "", None), ("true", ",,", "", "", "regex is_pass fallback only"),
    ("NULL", ",,", "", "", "missing is_pass field"), ("NULL", ",,", "", "", "empty model text"), ("false", ",,", "", "", "regex is_pass fallback only"),
)


def _audio_sql() -> str:
    case = lambda i: "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN {('NULL' if r[i] is None else r[i] if i == 0 else chr(39) + r[i] + chr(39))}" for k, r in enumerate(_AUDIO_READ)) + " END"
    return f"SELECT doc_id, {case(0)}::BOOLEAN AS is_pass, {case(1)} AS scores, {case(2)} AS issues, {case(3)} AS review, {case(4)} AS parse_error FROM documents"


def qc_parse_text(spark, d):
    rows = _docs(spark, d).select("doc_id", lenient.parse_text_verdict(_raw()).alias("v"))
    return rows.select("doc_id", "v.passed", "v.summary", F.array_join("v.issues", ",").alias("issues"), "v.parse_error")


def qc_parse_audio(spark, d):
    rows = _docs(spark, d).select("doc_id", lenient.parse_audio_verdict(_pick(AUDIO)).alias("v"))
    score = F.concat_ws(",", *[F.coalesce(F.col(f"v.scores.{k}").cast("string"), F.lit("")) for k in lenient.SCORES])
    return rows.select("doc_id", "v.is_pass", score.alias("scores"), F.array_join("v.audio_issues", ",").alias("issues"), F.col("v.review_summary").alias("review"), "v.parse_error")


OBJECTS = ('{"b": 1, "a": "%s"}', '```JSON\n{"a": "%s"}\n```', 'x {"a": {"c": 1}} y', "[1, 2]", "nothing", "", "null", '{"a": 1} {"b": 2}')
_OBJECT_READ = (
    '{"a": "%s", "b": 1}', '{"a": "%s"}', '{"a": {"c": 1}}', "E parsed JSON is not an object", "E no JSON object in model text",
    "E no JSON object in model text", "E parsed JSON is not an object", "E no JSON object in model text",
)


def parse_json_object(spark, d):
    return _docs(spark, d).select("doc_id", lenient.parse_json_object(_pick([o.replace("%s", "q") for o in OBJECTS])).alias("v")).select("doc_id", "v.object", "v.error")


def _object_sql() -> str:
    objects = [o.replace("%s", "q") for o in _OBJECT_READ]
    picked = _sql_pick(objects)
    return f"SELECT doc_id, CASE WHEN {picked} NOT LIKE 'E %' THEN {picked} END AS object, CASE WHEN {picked} LIKE 'E %' THEN substring({picked}, 3) END AS error FROM documents"


REPLIES = ('{"plain_text": " hi ", "semantic_content": "s", "acoustic_emotion": null}', '{"plain_text": "  "}', '{"semantic_content": "x"}', '{"plain_text": "ok"}')


def reply_normalize(spark, d):
    return _docs(spark, d).select("doc_id", lenient.normalize_reply(_pick(REPLIES)).alias("r")).select("doc_id", "r.*")


FENCES = ("```json\n{}\n```", "``` x ```", "  plain ", "```JSON{}```", "a ``` b", "```\n\n```")


def strip_fence(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_fence(F.concat(_pick(FENCES), F.lit("  "))).alias("t"))


def qc_typo_fix(spark, d):
    return _docs(spark, d).select("doc_id", text.fix_choice_typos(_pick(('{"passed" : true或false}', '{"Passed": FALSE或true}', '{"passed": true}', '"passed":true或true "passed":false或false'))).alias("t"))


def qc_regex_fallback(spark, d):
    return _docs(spark, d).select("doc_id", text.regex_verdict(_pick(("passed: TRUE", "'passed' : false,", "passed=true", "Passed: trueish", '"is_pass": true'))).alias("passed"))


def strip_comments(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_comments(_pick(('{"a": 1} // c\n{}', '"http://x"', "none", "//"))).alias("t"))


TAGGED = ("a <strong>bold</strong> b", "[Breath] hi　[laughter]  there", "<STRONG>x</strong>[sigh][gasp]y", "<strong>a<b></strong>", "")


def strip_tags(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_tags(_pick(TAGGED)).alias("t"))


def strip_html_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(text.strip_tags(F.col("html"))).cast("long").alias("n"))


def prompt_prefix(spark, d):
    return _docs(spark, d).select("doc_id", text.prompt_prefix(_pick((" hello ", "x<|endofprompt|>y", "")), "You speak.<|endofprompt|>").alias("t"))


PATHS = ("a/b.WAV", "c.m4a", "d.x/e", "f.mp3", ".ogg", "g.tar.flac", "h.", "i.mpga", "j.m4b")


def mime_type(spark, d):
    p = _pick(PATHS)
    return _docs(spark, d).select("doc_id", *[text.mime_type(p, k).alias(k) for k in text.MIME])


def _mime_sql() -> str:
    columns = []
    for profile, known in text.MIME.items():
        value = [known.get(p.rsplit("/", 1)[-1].rpartition(".")[2].lower() if p.rsplit("/", 1)[-1].rpartition(".")[0] else "", "audio/mpeg") for p in PATHS]
        columns.append(f"{_sql_pick(value)} AS {profile}")
    return f"SELECT doc_id, {', '.join(columns)} FROM documents"


def data_uri(spark, d):
    """Whole texts as data URIs: the length and digest of each."""
    uri = text.data_uri(F.encode("text", "UTF-8"), F.lit("audio/wav"))
    return _docs(spark, d).select("doc_id", uri.alias("uri")).select("doc_id", F.length("uri").cast("long").alias("n"), F.md5("uri").alias("digest"))


def token_estimate(spark, d):
    return _docs(spark, d).select("doc_id", text.token_estimate(F.concat(F.col("text"), F.repeat(F.lit("孩子！"), (F.col("doc_id") % 4).cast("int")))).alias("n"))


def format_count(spark, d):
    return _docs(spark, d).select("doc_id", text.format_count(F.col("doc_id") * F.col("doc_id") * 50 + 50).alias("t"))


def call_cost(spark, d):
    return table(spark, d, "events").select("event_id", F.round(text.call_cost(F.col("event_id") * 10, F.col("user_id"), 2.5, 10.0), 9).alias("cost"))


def truncate_text(spark, d):
    return _docs(spark, d).select("doc_id", text.truncate_text(F.col("text"), 40).alias("t"))


MODELS = ("gpt-4-turbo-2024-04-09", "claude-3-5", "a-b-c-7", "plain", "x-y-z-w", "m-1-2-3-4")


def short_model(spark, d):
    return _docs(spark, d).select("doc_id", text.short_model(_pick(MODELS)).alias("m"))


STEMS = ("amy_2024-01", "stage2_5_qc_2024-01", "x", "a_b", "_2024-02")


def user_from_stem(spark, d):
    s = _pick(STEMS)
    return _docs(spark, d).select("doc_id", text.user_from_stem(s).alias("user"), text.user_from_stem(s, exact=True).alias("exact_user"))


ERRORS = ("HTTP 429", "failed to generate", "Resource Exhausted now", "bad request 400", "Unknown name", "timeout", "ok", "system field", "503")


def error_retryable(spark, d):
    return _docs(spark, d).select("doc_id", text.error_retryable(_pick(ERRORS)).alias("retryable"))


def error_recoverable(spark, d):
    return _docs(spark, d).select("doc_id", text.error_recoverable(_pick(ERRORS)).alias("recoverable"))


def coerce_bool(spark, d):
    return _docs(spark, d).select("doc_id", lenient.coerce_bool(_pick(_BOOLS)).alias("v"))


def coerce_int(spark, d):
    return _docs(spark, d).select("doc_id", lenient.coerce_int(_pick(_INTS)).alias("v"))


def _conv_json(spark, d):
    rows = table(spark, d, "conversations").filter("text is not null")
    return rows.select("conv_id", "turn", F.to_json(F.struct(F.array(F.struct(F.struct(F.col("role"), F.col("text").alias("content")).alias("message"))).alias("choices"))).alias("response"), "text")


def chat_content(spark, d):
    return _conv_json(spark, d).select("conv_id", "turn", chat.chat_content(F.col("response")).alias("content"))


def completion_chars(spark, d):
    extra = F.when(F.col("turn") % 3 == 0, F.lit('{"content": "abc"}')).when(F.col("turn") % 3 == 1, F.lit('{"choices": [{"text": "four"}, {"index": 1}]}')).otherwise(F.col("response"))
    return _conv_json(spark, d).select("conv_id", "turn", chat.completion_chars(extra).alias("n"))


def prompt_chars(spark, d):
    rows = table(spark, d, "conversations").filter("text is not null")
    content = F.to_json(F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")))
    listed = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.col("text"))).alias("content"))).alias("messages")))
    request = F.when(F.col("turn") % 3 == 0, content).when(F.col("turn") % 3 == 1, listed).otherwise(F.lit('{"prompt": "12345"}'))
    return rows.select("conv_id", "turn", chat.prompt_chars(request).alias("n"))


def token_usage(spark, d):
    k = F.get_json_object("props", "$.k")
    made = F.when(
        F.col("event_id") % 3 == 0, F.concat(F.lit('{"usageMetadata": {"promptTokenCount": '), k, F.lit(', "totalTokenCount": 9}, "usage": {"prompt_tokens": 1}}'))
    ).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"usage": {"prompt_tokens": '), k, F.lit(', "completion_tokens": null}}'))).otherwise(F.lit('{"usage": 5}'))
    return table(spark, d, "events").select("event_id", chat.token_usage(made).alias("u")).select("event_id", "u.*")


def safe_get(spark, d):
    return table(spark, d, "events").select("event_id", chat.safe_get(F.col("props"), "k").alias("k"), chat.safe_get(F.col("props"), "a", "b", default="none").alias("missing"))


def candidate_text(spark, d):
    rows = table(spark, d, "conversations").filter("text is not null")
    part = F.struct(F.col("text"))
    made = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(part, F.struct(F.col("role").alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    response = F.when(F.col("turn") % 4 == 3, F.lit('{"error": 1}')).otherwise(made)
    return rows.select("conv_id", "turn", chat.candidate_text(response).alias("t"))


def sse_concat(spark, d):
    rows = table(spark, d, "conversations").filter("text is not null")
    line = F.concat(F.lit("data: "), F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("delta"))).alias("choices"))))
    lines = F.array_append(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), F.lit("data: [DONE]"))
    return rows.groupBy("conv_id").agg(lines.alias("lines")).select("conv_id", chat.sse_concat(F.concat(F.array(F.lit(": ping")), F.col("lines"))).alias("content"))


def vector_summary(spark, d):
    s = vectors.summary(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", s.alias("s")).select("vec_id", "s.num_samples", F.round("s.peak", 6).alias("peak"), F.round("s.rms", 6).alias("rms"))


def sanitize_vector(spark, d):
    odd = F.transform("embedding", lambda x, i: F.when(i % 7 == 0, F.lit(float("nan"))).when(i % 7 == 1, F.lit(float("-inf"))).otherwise(x.cast("double")))
    clean = vectors.sanitize(odd)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(clean, F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.size(F.filter(clean, lambda x: x == 0)).cast("long").alias("zeros"))


def _doc(expression: str, name: str) -> str:
    return f"SELECT doc_id, {expression} AS {name} FROM documents"


QUERIES = {
    "qc_parse_text": (qc_parse_text, _read_sql()),
    "qc_parse_audio": (qc_parse_audio, _audio_sql()),
    "parse_json_object": (parse_json_object, _object_sql()),
    "reply_normalize": (reply_normalize, f"""SELECT doc_id, nullif(p, '') AS plain_text, {_sql_pick(('s', '', 'x', ''))} AS semantic_content, '' AS acoustic_emotion,
  CASE WHEN p = '' THEN 'plain_text missing or empty' END AS error FROM (SELECT doc_id, {_sql_pick(('hi', '', '', 'ok'))} AS p FROM documents)"""),
    "strip_fence": (strip_fence, _doc(_sql_pick(("{}", "x", "plain", "{}", "a ``` b", "")), "t")),
    "qc_typo_fix": (qc_typo_fix, _doc(_sql_pick(('{"passed": false}', '{"passed": true}', '{"passed": true}', '"passed": true "passed": false')), "t")),
    "qc_regex_fallback": (qc_regex_fallback, _doc("CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN false END", "passed")),
    "strip_comments": (strip_comments, _doc("['{\"a\": 1} ' || chr(10) || '{}', '\"http:', 'none', ''][(doc_id % 4) + 1]", "t")),
    "strip_tags": (strip_tags, _doc(_sql_pick(("a bold b", "hi there", "x y", "<strong>a<b></strong>", "")), "t")),
    "strip_html_tags": (strip_html_tags, "SELECT page_id, length(trim(regexp_replace(regexp_replace(html, '<strong>([^<]*)</strong>', '\\1', 'gi'), '[\\s　 ]+', ' ', 'g')))::BIGINT AS n FROM pages"),
    "prompt_prefix": (prompt_prefix, _doc(_sql_pick(("You speak.<|endofprompt|>hello", "x<|endofprompt|>y", "You speak.<|endofprompt|>")), "t")),
    "mime_type": (mime_type, _mime_sql()),
    "data_uri": (data_uri, "SELECT doc_id, length(uri)::BIGINT AS n, md5(uri) AS digest FROM (SELECT doc_id, 'data:audio/wav;base64,' || to_base64(encode(text)) AS uri FROM documents)"),
    "token_estimate": (token_estimate, "SELECT doc_id, trunc(c / 2 + (length(t) - c) / 4)::BIGINT AS n FROM (SELECT doc_id, t, length(regexp_replace(t, '[^一-鿿]', '', 'g')) AS c FROM (SELECT doc_id, text || repeat('孩子！', doc_id % 4) AS t FROM documents))"),
    "format_count": (format_count, "SELECT doc_id, CASE WHEN n < 1000 THEN n::VARCHAR WHEN n < 1000000 THEN printf('%.1f', round_even(n / 1000, 1)) || 'K' ELSE printf('%.1f', round_even(n / 1000000, 1)) || 'M' END AS t FROM (SELECT doc_id, doc_id * doc_id * 50 + 50 AS n FROM documents)"),
    "call_cost": (call_cost, "SELECT event_id, round(event_id * 10 / 1000000 * 2.5::DOUBLE + user_id / 1000000 * 10.0::DOUBLE, 9) AS cost FROM events"),
    "truncate_text": (truncate_text, _doc("CASE WHEN length(text) <= 40 THEN text ELSE substring(text, 1, 37) || '...' END", "t")),
    "short_model": (short_model, _doc(_sql_pick(("gpt-4-turbo", "claude-3-5", "a", "plain", "x-y-z-w", "m-1")), "m")),
    "user_from_stem": (user_from_stem, f"SELECT doc_id, {_sql_pick(('amy', 'stage2_5', 'x', 'a', ''))} AS user, {_sql_pick(('amy', 'stage2_5_qc', 'x', 'a', ''))} AS exact_user FROM documents"),
    "error_retryable": (error_retryable, _doc(f"regexp_matches(lower({_sql_pick(ERRORS)}), '{text.RETRYABLE}')", "retryable")),
    "error_recoverable": (error_recoverable, _doc(f"regexp_matches(lower({_sql_pick(ERRORS)}), '{text.RECOVERABLE}')", "recoverable")),
    "coerce_bool": (coerce_bool, _doc("[true, false, NULL, true, true, true, false, false, false, NULL, true, false, true, NULL, NULL, true, false, NULL][(doc_id % 18) + 1]", "v")),
    "coerce_int": (coerce_int, _doc("[4, 4, NULL, NULL, 12, -3, 7, NULL, NULL, NULL, -1, NULL][(doc_id % 12) + 1]::BIGINT", "v")),
    "chat_content": (chat_content, "SELECT conv_id, turn, text AS content FROM conversations WHERE text IS NOT NULL"),
    "completion_chars": (completion_chars, "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE length(text) END::BIGINT AS n FROM conversations WHERE text IS NOT NULL"),
    "prompt_chars": (prompt_chars, "SELECT conv_id, turn, CASE turn % 3 WHEN 2 THEN 5 ELSE length(text) END::BIGINT AS n FROM conversations WHERE text IS NOT NULL"),
    "token_usage": (token_usage, "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN json_extract(props, '$.k')::BIGINT ELSE 0 END AS prompt_tokens, 0::BIGINT AS completion_tokens, CASE WHEN event_id % 3 = 0 THEN 9 ELSE 0 END::BIGINT AS total_tokens FROM events"),
    "safe_get": (safe_get, "SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS missing FROM events"),
    "candidate_text": (candidate_text, "SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '' ELSE text || chr(10) || role END AS t FROM conversations WHERE text IS NOT NULL"),
    "sse_concat": (sse_concat, "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content FROM conversations WHERE text IS NOT NULL GROUP BY conv_id"),
    "vector_summary": (vector_summary, "SELECT vec_id, len(embedding)::BIGINT AS num_samples, round(list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))), 6) AS peak, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) / len(embedding)), 6) AS rms FROM embeddings"),
    "sanitize_vector": (sanitize_vector, "SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN (i - 1) % 7 < 2 THEN 0 ELSE x END)), 6) AS total, len(list_filter(list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN (i - 1) % 7 < 2 THEN 0 ELSE x END), lambda x: x = 0))::BIGINT AS zeros FROM embeddings"),
}
