"""Rows that hold a dialog's turns as an array: manifests, prompts, speech plans and per-turn verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lenient import parse_audio_verdict
from ..functions.text import is_error_payload, pytrim, strip_tags

#: How a child's and the companion's lines are marked in a history.
CHILD, COMPANION = "孩子：", "【玩伴回复】"
#: The word for a missing field in a judge's prompt; a fixed value.
NONE = "（无）"


def interleave(users: Column) -> Column:
    """Messages of user turns, each followed by an empty slot for the assistant."""
    slot = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("text"))
    return F.flatten(F.transform(users, lambda u: F.array(slot("user", u), slot("assistant", F.lit("")))))


def wide_key(name: str, turn: int) -> str:
    """``audio``, ``audio_2``, …: the first turn has no number."""
    if turn < 1:
        raise ValueError("turns are counted from 1")
    return name if turn == 1 else f"{name}_{turn}"


def key_for_turn(name: str, turn: Column) -> Column:
    return F.when(turn == 1, F.lit(name)).when(turn > 1, F.concat(F.lit(f"{name}_"), turn.cast("string")))


def widen(df: DataFrame, texts: str, audios: str, max_turns: int = 6) -> DataFrame:
    """Columns ``user_k``, ``audio_k`` and ``assistant_k`` of up to ``max_turns`` turns, null beyond a dialog's end."""
    columns = {}
    for k in range(1, max_turns + 1):
        text, audio = F.get(F.col(texts), F.lit(k - 1)), F.get(F.col(audios), F.lit(k - 1))
        columns |= {
            wide_key("user", k): text, wide_key("audio", k): audio,
            wide_key("assistant", k): F.when(F.size(texts) >= k, F.lit("")),
        }
    return df.withColumns(columns)


def manifest(dialogs: DataFrame, max_turns: int = 6) -> DataFrame:
    """Dialogs with ``transcripts`` and ``audio_clips`` as manifest rows: wide columns and messages."""
    return widen(dialogs, "transcripts", "audio_clips", max_turns).withColumn("messages", interleave(F.col("transcripts")))


def user_transcripts(messages: Column) -> Column:
    users = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.transform(users, lambda m: F.coalesce(m["text"], F.lit(""))), F.array().cast("array<string>"))


def manifest_turns(messages: Column, audios: Column, user: Column) -> Column:
    """Turns (audio, transcript) of a manifest row; without user messages, its single turn if it has audio."""
    texts = user_transcripts(messages)
    pair = lambda a, t: F.struct(F.coalesce(a, F.lit("")).alias("audio"), t.alias("transcript"))
    many = F.transform(texts, lambda t, i: pair(F.get(audios, i), t))
    first = F.coalesce(F.get(audios, F.lit(0)), F.lit(""))
    single = F.when(first != "", F.array(pair(first, F.coalesce(user, F.lit(""))))).otherwise(F.array().cast("array<struct<audio:string,transcript:string>>"))
    return F.when(F.size(texts) > 0, many).otherwise(single)


def nth_turn(transcripts: Column, turn: Column) -> Column:
    """The transcript of a turn counted from 1, stripped; empty beyond the last one."""
    return F.coalesce(pytrim(F.get(transcripts, turn - 1)), F.lit(""))


def history_text(transcripts: Column, replies: Column, turn: Column) -> Column:
    """The lines up to a turn: each child's line, and each reply but that of the turn itself."""
    lines = F.transform(
        F.sequence(F.lit(1), turn),
        lambda k: F.concat(
            F.lit(CHILD), nth_turn(transcripts, k),
            F.when(k < turn, F.concat(F.lit("\n" + COMPANION), F.coalesce(F.get(replies, k - 1), F.lit("")))).otherwise(F.lit("")),
        ),
    )
    return F.array_join(lines, "\n")


def running_history(turns: DataFrame, dialog: str, turn: str, child: str, reply: str) -> DataFrame:
    """The same from long form: ``history`` at each turn, built by one ordered window."""
    w = Window.partitionBy(dialog).orderBy(turn)
    line = F.concat(F.lit(CHILD), pytrim(F.coalesce(F.col(child), F.lit(""))))
    full = F.concat(line, F.lit("\n" + COMPANION), F.coalesce(F.col(reply), F.lit("")))
    before = F.collect_list(full).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return turns.withColumn("history", F.array_join(F.concat(before, F.array(line)), "\n"))


def prompt(history: Column, task: str, header: str) -> Column:
    """A request's text: the history under its header if there is one, and the task."""
    t = pytrim(F.coalesce(history, F.lit("")))
    return F.concat(F.when(t != "", F.concat(F.lit(header + "\n"), t, F.lit("\n\n\n"))).otherwise(F.lit("")), F.lit(task))


def judge_prompt(template: str, plain: Column, emotion: Column) -> Column:
    """The template with ``{plain}`` and ``{emotion}`` filled in."""
    out = F.lit(template)
    for mark, value in (("{plain}", plain), ("{emotion}", emotion)):
        text = pytrim(F.coalesce(value, F.lit("")))
        out = F.replace(out, F.lit(mark), F.when(text == "", F.lit(NONE)).otherwise(text))
    return out


#: The fields of a turn that a text judge sees, in their order.
JUDGED = ("turn_index", "query", "plain_text", "semantic_content", "acoustic_emotion", "error")


def judge_payload(turns: Column, fields: tuple[str, ...] = JUDGED) -> Column:
    """A JSON line a turn, nulls kept, with blanks after commas and colons."""

    def line(t: Column) -> Column:
        parts = [
            F.concat(F.lit(f'"{f}": '), F.coalesce(_json_value(t[f]), F.lit("null")))
            for f in fields
        ]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    return F.array_join(F.transform(turns, line), "\n")


def _json_value(x: Column) -> Column:
    """A scalar's JSON text; null for null."""
    text = F.to_json(F.array(x))
    return F.when(x.isNotNull(), F.substr(text, F.lit(2), F.length(text) - 2))


def dialog_arrays(members: DataFrame) -> DataFrame:
    from .dialogs import collect_dialogs

    return collect_dialogs(members)


def qc_eligible(rows: DataFrame, turns: str = "turns") -> DataFrame:
    """Rows with at least one turn that is a record."""
    return rows.filter(F.coalesce(F.exists(F.col(turns), lambda t: t.isNotNull()), F.lit(False)))


def spoken_text(plain: Column, strip: bool = True) -> Column:
    """What is to be spoken of a reply; null if nothing is left."""
    t = pytrim(plain)
    t = strip_tags(t) if strip else t
    return F.when(t != "", t)


def speech_plan(rows: DataFrame, position: str, strip: bool = True, root: str = "outputs/tts_generated") -> DataFrame:
    """Turns with ``tts_text``, ``tts_audio`` or ``tts_error``. The file's name has the row's position, not its line."""

    def plan(t: Column, i: Column) -> Column:
        text = spoken_text(t["plain_text"], strip)
        failed = F.coalesce(t["error"] != "", F.lit(False))
        number = F.when(F.coalesce(t["turn_index"], F.lit(0)) != 0, t["turn_index"]).otherwise(i + 1)
        path = F.concat(F.lit(f"{root}/m"), F.col(position).cast("string"), F.lit("_t"), number.cast("string"), F.lit(".wav"))
        speaks = ~failed & text.isNotNull()
        return (
            t.withField("tts_text", F.when(speaks, text)).withField("tts_audio", F.when(speaks, path))
            .withField("tts_error", F.when(~failed & text.isNull(), F.lit("skip_no_text")))
        )

    return rows.withColumn("turns", F.transform("turns", plan))


def judge_turns(rows: DataFrame, verdicts: Column, audio_exists: Column, api_error: Column) -> DataFrame:
    """(manifest_line, turn_index, is_pass, error, parse_error, …) of every turn in order.

    ``rows`` has one turn a row with ``tts_audio``; the three columns are the judge's text, whether the file is there and
    what the call raised. The first reason that holds fails a turn.
    """
    path = pytrim(F.coalesce(F.col("tts_audio"), F.lit("")))
    error = (
        F.when(path == "", F.lit("missing tts_audio"))
        .when(~F.coalesce(audio_exists, F.lit(False)), F.concat(F.lit("TTS 文件不存在: "), path))
        .when(api_error.isNotNull(), F.concat(F.lit("api_error: "), api_error))
        .when(is_error_payload(verdicts), F.lit("gemini error payload"))
    )
    parsed = rows.withColumns({"error": error, "_v": parse_audio_verdict(verdicts)})
    judged = F.col("error").isNull()
    fields = {n: F.when(judged, F.col(f"_v.{n}")) for n in ("scores", "audio_issues", "review_summary", "parse_error")}
    return parsed.withColumns(fields | {"is_pass": F.when(judged, F.col("_v.is_pass")).otherwise(False)}).drop("_v")


def regroup_turns(turns: DataFrame, key: str = "manifest_line", order: str = "turn_index") -> DataFrame:
    """Back to a row a line with ``turns_qc`` in order."""
    fields = [c for c in turns.columns if c not in (key, order)]
    grouped = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("turns_qc"))
    return grouped
