"""Lenient reading of the JSON that models write: verdicts, replies and single values.

The parse step must fail where Python's parser fails, which no JVM parser does, so the ladders run as one Arrow-batched
function over Python's ``json``. Single values are coerced by expressions.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import pytrim

#: Strings that mean yes and no.
YES, NO = ("true", "1", "yes", "通过"), ("false", "0", "no", "不通过", "不")
PASSED, IS_PASS = "passed", "is_pass"
SCORES = ("clarity", "emotion", "naturalness")
TEXT_VERDICT = "passed boolean, summary string, issues array<string>, parse_error string"
AUDIO_VERDICT = (
    "is_pass boolean, scores struct<clarity:long,emotion:long,naturalness:long>, review_summary string, "
    "audio_issues array<string>, parse_error string"
)


def _is_string(x: Column) -> Column:
    return x.startswith('"')


def _string_of(x: Column) -> Column:
    return F.get_json_object(F.concat(F.lit('{"v":'), x, F.lit("}")), "$.v")


def coerce_bool(x: Column) -> Column:
    """A JSON value's text as a boolean: booleans, the strings above and the numbers 0 and 1; else null."""
    word = F.lower(pytrim(F.when(_is_string(x), _string_of(x)).otherwise(x)))
    number = F.when(~_is_string(x), x.try_cast("double"))
    return (
        F.when(x == "true", True).when(x == "false", False)
        .when(_is_string(x) & word.isin(*YES), True).when(_is_string(x) & word.isin(*NO), False)
        .when(number == 1, True).when(number == 0, False)
    )


def coerce_int(x: Column) -> Column:
    """A JSON value's text as an integer: integral numbers and strings of digits, no booleans; else null."""
    word = pytrim(_string_of(x))
    number = x.try_cast("double")
    return F.when(_is_string(x), F.when(word.rlike(r"^-?[0-9]+$"), word.try_cast("long"))).when(
        number == F.floor(number), number.cast("long")
    )


def loads(text: str):
    """A JSON value, or None where Python's parser fails."""
    try:
        return json.loads(text)
    except ValueError:
        return None


def fence_free(text: str) -> str:
    text = text.strip()
    if text[:3] == "```":
        text = re.sub(r"\s*```\s*$", "", re.sub(r"(?i)^```(?:json)?\s*", "", text, count=1), count=1)
    return text.strip()


def _typos(text: str) -> str:
    for a in ("true", "false"):
        for b in ("false", "true"):
            text = re.sub(rf'(?i)"passed"\s*:\s*{a}或{b}', f'"passed": {b}', text)
    return text


def _uncommented(text: str) -> str:
    return re.sub(r"//[^\n]*", "", text)


def first_object(text: str, *forms) -> dict | None:
    """The first object among the whole text and its widest braces, in each of the forms."""
    braces = re.search(r"\{[\s\S]*\}", text)
    for found in (text.strip(), braces and braces[0]):
        for attempt in (form(found) for form in forms) if found else ():
            value = loads(attempt)
            if isinstance(value, dict):
                return value
    return None


def truth(value) -> bool | None:
    if isinstance(value, str):
        word = value.strip().lower()
        return True if word in YES else False if word in NO else None
    return bool(value) if isinstance(value, (bool, int, float)) and value in (0, 1) else None


def whole(value) -> int | None:
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str):
        word = value.strip()
        return int(word) if re.fullmatch(r"-?\d+", word) and word.lstrip("-").isdigit() else None
    if isinstance(value, float):
        return int(value) if value == value and abs(value) != float("inf") and value == int(value) else None
    return value if isinstance(value, int) else None


def _text(value) -> str:
    return value.strip() if isinstance(value, str) else ""


def _list(value) -> list[str]:
    return [str(x) for x in value if x is not None] if isinstance(value, list) else []


def _fallback(field: str, *texts: str) -> bool | None:
    """The field's last hope. A false from the first text lets the second one speak, as yes or no."""
    found = None
    for text in texts:
        m = re.search(rf"""(?i)["']?{field}["']?\s*:\s*(true|false)\b""", text)
        found = None if m is None else m[1].lower() == "true"
        if found:
            break
    return found


def _read(raw: str | None, field: str, mend, what: str, plain=str):
    """(object or None, verdict, parse error)"""
    if not (raw or "").strip():
        return None, None, "empty model text"
    stripped = fence_free(raw)
    found = first_object(stripped, plain, mend)
    if found is not None:
        verdict = truth(found.get(field))
        return found, verdict, None if verdict is not None else f"missing {field} field"
    verdict = _fallback(field, stripped, raw)
    return None, verdict, f"regex {field} fallback only" if verdict is not None else f"failed to parse {what} from model text"


def text_verdict(raw: str | None) -> tuple:
    found, verdict, error = _read(raw, PASSED, _typos, "QC JSON")
    found = found or {}
    return verdict, _text(found.get("summary")), _list(found.get("issues")), error


def audio_verdict(raw: str | None) -> tuple:
    """Comments are cut from every text before it is parsed, inside strings too."""
    found, verdict, error = _read(raw, IS_PASS, _uncommented, "TTS S2S QC JSON", _uncommented)
    found = found or {}
    scores = found.get("scores") if isinstance(found.get("scores"), dict) else {}
    return verdict, tuple(whole(scores.get(k)) for k in SCORES), _text(found.get("review_summary")), _list(found.get("audio_issues")), error


def _batched(read, schema: str, names: tuple[str, ...]):
    @F.pandas_udf(schema)
    def run(raw: pd.Series) -> pd.DataFrame:
        rows = [read(x) for x in raw]
        return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)})

    return run


def parse_text_verdict(raw: Column) -> Column:
    return _batched(text_verdict, TEXT_VERDICT, ("passed", "summary", "issues", "parse_error"))(raw)


def parse_audio_verdict(raw: Column) -> Column:
    def read(x):
        verdict, scores, *rest = audio_verdict(x)
        return verdict, dict(zip(SCORES, scores)), *rest

    return _batched(read, AUDIO_VERDICT, ("is_pass", "scores", "review_summary", "audio_issues", "parse_error"))(raw)


def json_object(raw: str | None) -> tuple[str | None, str | None]:
    """(the object's text, error) of a reply: the whole text without its fence, else its widest braces."""
    text = fence_free(raw or "")
    value = loads(text)
    if value is None and text != "null":
        braces = re.search(r"\{[\s\S]*\}", text)
        value = loads(braces[0]) if braces else None
        if value is None:
            return None, "no JSON object in model text"
    if not isinstance(value, dict):
        return None, "parsed JSON is not an object"
    return json.dumps(value, ensure_ascii=False, sort_keys=True), None


def parse_json_object(raw: Column) -> Column:
    return _batched(json_object, "object string, error string", ("object", "error"))(raw)


def normalize_reply(parsed: Column) -> Column:
    """A struct of a reply's fields from a JSON object's text; a blank ``plain_text`` is an error."""
    field = lambda n: F.coalesce(pytrim(F.when(F.get_json_object(parsed, f"$.{n}").isNotNull(), F.get_json_object(parsed, f"$.{n}"))), F.lit(""))
    plain = field("plain_text")
    return F.struct(
        F.when(plain != "", plain).alias("plain_text"), field("semantic_content").alias("semantic_content"),
        field("acoustic_emotion").alias("acoustic_emotion"),
        F.when(plain == "", F.lit("plain_text missing or empty")).alias("error"),
    )
