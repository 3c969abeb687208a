"""JSON-lines files as tables: numbered lines, what to do with bad ones, log folders and writers."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import pytrim, user_from_stem

STATS = T.StructType(
    [
        T.StructField("timestamp", T.StringType()), T.StructField("prompt_tokens", T.LongType()), T.StructField("completion_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()), T.StructField("duration_ms", T.DoubleType()), T.StructField("success", T.BooleanType()),
    ]
)
CALLS = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("timestamp", "model", "user", "request", "response")),
        *(T.StructField(n, T.LongType()) for n in ("prompt_chars", "completion_chars", "prompt_tokens", "completion_tokens", "total_tokens")),
        T.StructField("duration_ms", T.DoubleType()), T.StructField("success", T.BooleanType()),
        T.StructField("error", T.StringType()), T.StructField("metadata", T.StringType()),
    ]
)


def numbered_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, file_time, line_no, line) of every line, numbered from 1 in its file, blank ones too.

    A file is read by one task, as its numbers need it whole; many files are read in parallel.
    """
    reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower())
    files = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("file_time"), "value")
    lines = files.select("path", "file_time", F.posexplode(F.split("value", "\r?\n")).alias("i", "line"))
    return lines.select("path", "file_time", (F.col("i") + 1).alias("line_no"), "line")


def _wellformed(line: Column) -> Column:
    """Whether a line is one JSON object and nothing else.

    The parser stops behind the first value. Inside brackets and inside braces it must read on: what closes one of the
    two early cannot close the other.
    """
    inside = lambda a, b: F.try_parse_json(F.concat(F.lit(a), line, F.lit(b))).isNotNull()
    return pytrim(line).startswith("{") & inside("[", "]") & inside('{"line":', "}")


def jsonl_scan(spark: SparkSession, path: str, schema: T.StructType, bad: str = "raise", recursive: bool = False) -> DataFrame:
    """Rows of a JSON-lines file with ``line_no`` among its non-blank lines, path and time.

    ``bad`` lines ``raise`` with their number, are ``skip``ped, keep their number as ``null`` rows with ``error``, or are
    ``drop``ped before lines are numbered.
    """
    lines = numbered_lines(spark, path, recursive).filter(F.length(pytrim(F.col("line"))) > 0)
    good = _wellformed(F.col("line"))
    if bad == "drop":
        lines = lines.filter(good)
    from pyspark.sql import Window

    numbered = lines.withColumn("line_no", F.row_number().over(Window.partitionBy("path").orderBy("line_no")))
    if bad == "skip":
        numbered = numbered.filter(good)
    elif bad == "raise":
        message = F.format_string("%s:%d: invalid JSON", "path", "line_no")
        numbered = numbered.withColumn("line", F.when(good, F.col("line")).otherwise(F.raise_error(message)))
    parsed = numbered.withColumns({"_r": F.from_json("line", schema), "error": F.when(~good, F.lit("invalid JSON"))})
    columns = [F.col(f"_r.{f.name}").alias(f.name) for f in schema if f.name != "line_no"]
    return parsed.select("path", "file_time", "line_no", *columns, *([F.col("error")] if bad == "null" else []))


def _part(path: Column, name: str) -> Column:
    """The value of a folder ``name=value`` in a path; null if there is none.

    The folder's name is escaped, and the path, being an address, is so once more.
    """
    found = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    plain = lambda x: F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))
    return F.when(found != "", plain(plain(found)))


def stats_logs(spark: SparkSession, root: str, exact_users: bool = False) -> DataFrame:
    """Calls under ``stats/{model}/{user}_{YYYY-MM}.jsonl``; model, user and stem come from the path.

    Folders that ``write_calls`` made name model, user and month themselves.
    """
    rows = jsonl_scan(spark, f"{root.rstrip('/')}/stats", STATS, bad="skip", recursive=True)
    path = F.col("path")
    user, month = _part(path, "user"), _part(path, "ym")
    stem = F.coalesce(F.concat(user, F.lit("_"), month), F.regexp_extract("path", r"([^/]*)\.jsonl$", 1))
    model = F.coalesce(_part(path, "model"), F.regexp_extract("path", r"/stats/([^/]*)/", 1))
    named = rows.withColumns({"model": model, "stem": stem, "user": user})
    return named.withColumn("user", F.coalesce("user", user_from_stem(F.col("stem"), exact_users)))


def call_logs(spark: SparkSession, root: str) -> DataFrame:
    """Calls under ``calls/{model}/{YYYY-MM}/{date}.jsonl``, or in folders that ``write_calls`` made."""
    rows = jsonl_scan(spark, f"{root.rstrip('/')}/calls", CALLS, bad="skip", recursive=True)
    return rows.withColumn("model", F.coalesce("model", _part(F.col("path"), "model"), F.regexp_extract("path", r"/calls/([^/]*)/", 1)))


def audio_files(spark: SparkSession, root: str, pattern: str = "*.m4a") -> DataFrame:
    """(name, path, length, content) of audio files in the order of their names; raises if there are none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)
    rows = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "content")
    if not rows.limit(1).count():
        raise FileNotFoundError(f"no {pattern} under {root}")
    return rows.orderBy("name")


def labels_path(explicit: str | None, filled: str, asr: str, exists, manual_review: bool = False) -> str:
    """Which labels file a run reads: the one it is told, the filled one, the transcriber's if nobody reviews, the filled one."""
    if explicit:
        return explicit
    if exists(filled) or manual_review or not exists(asr):
        return filled
    return asr


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", sort_keys: bool = True, nulls: bool = True) -> None:
    """A JSON object a line; keys in order, explicit nulls unless told otherwise."""
    columns = sorted(df.columns) if sort_keys else df.columns
    df.select(*columns).write.mode(mode).option("ignoreNullFields", str(not nulls).lower()).json(path)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("value").write.mode(mode).text(path)


def write_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A run's counts (stage, n) as one JSON object with an indent of two, in the order of their names."""
    entry = F.concat(F.lit('  "'), F.col("stage"), F.lit('": '), F.col("n").cast("string"))
    listed = F.array_join(F.array_sort(F.collect_list(entry)), ",\n")  # one entry a stage
    whole = F.when(F.count(F.lit(1)) > 0, F.concat(F.lit("{\n"), listed, F.lit("\n}"))).otherwise(F.lit("{}"))
    write_lines(summary.agg(whole.alias("value")).coalesce(1), path, mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def write_calls(calls: DataFrame, root: str) -> None:
    """Appends calls and their statistics, in folders by model, user and month that the readers above know."""
    dated = calls.withColumn("ym", F.substring("timestamp", 1, 7))
    dated.write.mode("append").partitionBy("model", "ym").json(f"{root.rstrip('/')}/calls")
    stats = dated.select("model", "user", "ym", *[f.name for f in STATS])
    stats.write.mode("append").partitionBy("model", "user", "ym").json(f"{root.rstrip('/')}/stats")


def log_paths(model: str, user: str, day: str) -> tuple[str, str]:
    """Where a call of a day (YYYY-MM-DD) is logged: (full, statistics)."""
    return (
        str(PurePosixPath("calls", model, day[:7], f"{day}.jsonl")), str(PurePosixPath("stats", model, f"{user}_{day[:7]}.jsonl")),
    )
