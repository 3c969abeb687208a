"""String functions as Column expressions, equal to Python's where that matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's strip() takes: Unicode white space and four control characters that Java leaves out.
_SPACE = r"[\s\x1c-\x1f\x85]"


def pytrim(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def strip_fence(x: Column) -> Column:
    """Without the code fence around it, if it starts with one."""
    t = pytrim(x)
    opened = F.regexp_replace(t, rf"(?iU)\A```(?:json)?{_SPACE}*", "")
    return pytrim(F.when(t.startswith("```"), F.regexp_replace(opened, rf"(?U){_SPACE}*```{_SPACE}*\z", "")).otherwise(t))


def fix_choice_typos(x: Column) -> Column:
    """Judges that copy both choices of the prompt: the second one counts. The four spellings."""
    for a, b in (("true", "false"), ("true", "true"), ("false", "true"), ("false", "false")):
        x = F.regexp_replace(x, rf'(?i)"passed"\s*:\s*{a}或{b}', f'"passed": {b}')
    return x


def regex_verdict(x: Column, field: str = "passed") -> Column:
    """The first true or false after the field's name, however malformed the rest is."""
    found = F.regexp_extract(x, rf"""(?i)["']?{field}["']?\s*:\s*(true|false)\b""", 1)
    return F.when(found != "", F.lower(found) == "true")


def strip_comments(x: Column) -> Column:
    """Without what follows ``//`` on each line, inside strings too."""
    return F.regexp_replace(x, r"//[^\n]*", "")


def strip_tags(x: Column) -> Column:
    """Spoken text without emphasis marks and breath tags, white space collapsed."""
    t = F.regexp_replace(x, r"(?i)<strong>([^<]*)</strong>", "$1")
    t = F.regexp_replace(t, r"(?i)\[breath\]|\[laughter\]|\[sigh\]|\[gasp\]", " ")
    return pytrim(F.regexp_replace(t, rf"(?U){_SPACE}+", " "))


def prompt_prefix(x: Column, prefix: str, sentinel: str = "<|endofprompt|>") -> Column:
    """A voice prompt, with the prefix unless it has the sentinel."""
    t = pytrim(x)
    return F.when(F.contains(t, F.lit(sentinel)), t).otherwise(F.concat(F.lit(prefix), t))


#: Which suffix is which type, for the judge, the transcriber and the general client.
MIME = {
    "judge": {"wav": "audio/wav", "m4a": "audio/mp4", "mp4": "audio/mp4", "m4b": "audio/mp4", "mp3": "audio/mpeg", "mpga": "audio/mpeg", "flac": "audio/flac", "ogg": "audio/ogg"},
    "transcriber": {"mp3": "audio/mpeg", "mpga": "audio/mpeg", "wav": "audio/wav", "flac": "audio/flac", "ogg": "audio/ogg"},
    "client": {"mp3": "audio/mpeg", "mpga": "audio/mpeg", "wav": "audio/wav", "flac": "audio/flac", "ogg": "audio/ogg", "m4a": "audio/mp4"},
}


def suffix(path: Column) -> Column:
    """A path's suffix in lower case without its dot, empty if none."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))


def mime_type(path: Column, profile: str = "judge") -> Column:
    known = F.create_map(*[F.lit(x) for pair in MIME[profile].items() for x in pair])
    return F.coalesce(F.try_element_at(known, suffix(path)), F.lit("audio/mpeg"))


def base64_text(data: Column) -> Column:
    """Base64 in one line, whatever the session's setting on line breaks."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def data_uri(data: Column, mime: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), base64_text(data))


def token_estimate(x: Column) -> Column:
    """Two CJK characters or four others a token, truncated."""
    t = F.coalesce(x, F.lit(""))
    cjk = F.length(F.regexp_replace(t, r"[^\x{4e00}-\x{9fff}]", ""))
    return (cjk / 2 + (F.length(t) - cjk) / 4).cast("long")


def format_count(n: Column) -> Column:
    """999, 1.2K, 1.5M; halves round to even."""
    tenth = lambda d, unit: F.concat(F.format_string("%.1f", F.bround(n / d, 1)), F.lit(unit))
    return F.when(n < 1000, n.cast("string")).when(n < 1_000_000, tenth(1000, "K")).otherwise(tenth(1_000_000, "M"))


def call_cost(prompt: Column, completion: Column, input_price: float, output_price: float) -> Column:
    """Prices are by the million tokens."""
    return (prompt / F.lit(1_000_000)) * F.lit(input_price) + (completion / F.lit(1_000_000)) * F.lit(output_price)


def truncate_text(x: Column, most: int = 100, end: str = "...") -> Column:
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.substring(x, 1, most - len(end)), F.lit(end)))


def short_model(name: Column) -> Column:
    """Without the last three of more than three dashed parts where the last is a number."""
    parts = F.split(name, "-")
    dated = (F.size(parts) > 3) & F.element_at(parts, -1).rlike(r"^[0-9]+$")
    return F.when(dated, F.array_join(F.slice(parts, 1, F.size(parts) - 3), "-")).otherwise(name)


def user_from_stem(stem: Column, exact: bool = False) -> Column:
    """The user of a log file named ``{user}_{YYYY-MM}``; a user with an underscore loses its last part unless exact."""
    one = F.regexp_replace(stem, r"_[^_]*$", "")
    return one if exact else F.when(stem.rlike("_.*_"), F.regexp_replace(stem, r"_[^_]*_[^_]*$", "")).otherwise(one)


#: Parts of messages after which a call is tried again, or sent again in a plainer form.
RETRYABLE = "429|resource exhausted|quota|rate|503|timeout|502"
RECOVERABLE = "400|unknown|invalid|field|system"


def error_retryable(message: Column) -> Column:
    return F.lower(message).rlike(RETRYABLE)


def error_recoverable(message: Column) -> Column:
    return F.lower(message).rlike(RECOVERABLE)


def is_error_payload(text: Column) -> Column:
    return F.substring(pytrim(text), 1, 80).rlike(r"^\[error\]")


def clean_setting(x: Column) -> Column:
    """A setting's value without blanks and the quotes around it."""
    t = pytrim(x)
    return F.regexp_replace(F.regexp_replace(t, r"""^"(.*)"$""", "$1"), r"^'(.*)'$", "$1")
