"""Requests, responses and event streams of chat APIs, as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import pytrim


def chat_content(response: Column) -> Column:
    return F.get_json_object(response, "$.choices[0].message.content")


def sse_data(line: Column) -> Column:
    """The payload of an event line; null for other lines and the end mark."""
    t = pytrim(line)
    data = pytrim(F.substring(t, 7, 1 << 30))
    return F.when(t.startswith("data: ") & (data != "[DONE]"), data)


def sse_delta(line: Column, field: str = "content") -> Column:
    found = F.get_json_object(sse_data(line), f"$.choices[0].delta.{field}")
    return F.when(found != "", found)


def sse_concat(lines: Column, field: str = "content") -> Column:
    """What the events of a stream say, from an array of its lines in order."""
    return F.array_join(F.array_compact(F.transform(lines, lambda x: sse_delta(x, field))), "")


def candidate_text(response: Column) -> Column:
    """The texts of the first candidate's parts, a line each; empty if there are none."""
    parts = F.from_json(response, "candidates array<struct<content:struct<parts:array<struct<text:string>>>>>")
    texts = F.transform(F.get(parts["candidates"], F.lit(0))["content"]["parts"], lambda p: p["text"])
    return F.coalesce(F.array_join(F.array_compact(texts), "\n"), F.lit(""))


def _has(doc: Column, field: str) -> Column:
    return F.array_contains(F.coalesce(F.json_object_keys(doc), F.array().cast("array<string>")), field)


def prompt_chars(request: Column) -> Column:
    """Characters of all messages, text or parts with text; of the prompt where there are no messages."""
    listed = "array<variant>"

    def size(message: Column) -> Column:
        content = F.try_variant_get(message, "$.content", "variant")
        kind = F.coalesce(F.schema_of_variant(content), F.lit(""))
        long = lambda v, path: F.coalesce(F.length(F.try_variant_get(v, path, "string")), F.lit(0))
        parts = F.aggregate(F.try_variant_get(content, "$", listed), F.lit(0), lambda s, p: s + long(p, "$.text"))
        return F.when(kind.startswith("ARRAY"), F.coalesce(parts, F.lit(0))).when(kind == "STRING", long(content, "$")).otherwise(F.lit(0))

    messages = F.try_variant_get(F.try_parse_json(request), "$.messages", listed)
    total = F.aggregate(messages, F.lit(0), lambda s, m: s + size(m))
    prompt = F.coalesce(F.length(F.get_json_object(request, "$.prompt")), F.lit(0))
    return F.when(_has(request, "messages"), F.coalesce(total, F.lit(0))).otherwise(prompt).cast("long")


def completion_chars(response: Column) -> Column:
    choices = F.from_json(response, "choices array<struct<message:struct<content:string>,text:string>>")["choices"]
    size = lambda c: F.coalesce(F.length(c["message"]["content"]), F.length(c["text"]), F.lit(0))
    total = F.aggregate(choices, F.lit(0), lambda s, c: s + size(c))
    content = F.coalesce(F.length(F.get_json_object(response, "$.content")), F.lit(0))
    return F.when(_has(response, "choices"), F.coalesce(total, F.lit(0))).otherwise(content).cast("long")


def token_usage(response: Column) -> Column:
    """A struct of prompt, completion and total tokens: as the provider reports them, 0 if it does not."""
    number = lambda path: F.coalesce(F.get_json_object(response, path).try_cast("long"), F.lit(0).cast("long"))
    first = F.get_json_object(response, "$.usageMetadata").isNotNull()
    pick = lambda a, b: F.when(first, number(f"$.usageMetadata.{a}")).otherwise(number(f"$.usage.{b}"))
    return F.struct(
        pick("promptTokenCount", "prompt_tokens").alias("prompt_tokens"),
        pick("candidatesTokenCount", "completion_tokens").alias("completion_tokens"),
        pick("totalTokenCount", "total_tokens").alias("total_tokens"),
    )


def safe_get(doc: Column, *keys: str, default: str | None = None) -> Column:
    """The value at a path of keys, as text."""
    return F.coalesce(F.get_json_object(doc, "$" + "".join(f"['{k}']" for k in keys)), F.lit(default))


def request_of(args: Column, kwargs: Column) -> Column:
    """The request among a call's arguments: the named ones if any, else the first."""
    return F.coalesce(F.when(F.size(F.json_object_keys(kwargs)) > 0, kwargs), F.get_json_object(args, "$[0]"))
