"""Picking up a run that stopped: what is done, what comes next, and prior output joined with new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pytrim


def latest_by_key(rows: DataFrame, key: str, line: str) -> DataFrame:
    """The last row of each key, complete or not."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), line).alias("r")).select(key, "r.*")


def successes(turns: Column) -> Column:
    """Sorted distinct turn indexes with a reply and no error."""
    good = F.filter(
        turns,
        lambda t: t["error"].isNull() & t["turn_index"].isNotNull() & F.coalesce(F.length(pytrim(t["plain_text"])) > 0, F.lit(False)),
    )
    return F.array_sort(F.array_distinct(F.transform(good, lambda t: t["turn_index"])))


def next_turn(turns: Column, total: Column) -> Column:
    """The first turn without a success, null if the row is complete; 1 without prior turns."""
    done = F.coalesce(successes(turns), F.array().cast("array<int>"))
    positive = F.filter(done, lambda i: i >= 1)
    prefix = F.size(F.filter(positive, lambda i, n: i == n + 1))
    return F.when((F.size(done) >= total) | (prefix >= total), F.lit(None)).otherwise(prefix + 1)


def prior_replies(turns: Column, next_index: Column) -> Column:
    """Replies before a turn, in order; of several successes of a turn the last counts."""

    def last(k: Column) -> Column:
        found = F.filter(
            turns, lambda t: (t["turn_index"] == k) & t["error"].isNull() & F.coalesce(F.length(pytrim(t["plain_text"])) > 0, F.lit(False))
        )
        return pytrim(F.element_at(found, -1)["plain_text"])

    return F.when(next_index > 1, F.transform(F.sequence(F.lit(1), next_index - 1), last)).otherwise(F.array().cast("array<string>"))


def resume_state(manifest: DataFrame, existing: DataFrame, key: str = "manifest_line") -> DataFrame:
    """Manifest rows with ``total_turns`` against prior ``turns``: ``next_turn`` and ``prior``; null when complete."""
    joined = manifest.join(existing.select(key, "turns"), key, "left")
    state = joined.withColumn("next_turn", next_turn(F.col("turns"), F.col("total_turns")))
    return state.withColumn("prior", prior_replies(F.col("turns"), F.col("next_turn")))


def skip_done(manifest: DataFrame, lines: DataFrame, audios: DataFrame) -> DataFrame:
    """Rows neither whose line is done nor whose audio is: two anti joins, for which no pair is compared."""
    return manifest.join(lines, "manifest_line", "left_anti").join(audios, "audio", "left_anti")


def resume_merge(prior: Column, new: Column, start: Column) -> Column:
    """Prior turns before ``start`` and the new ones, by turn."""
    kept = F.filter(prior, lambda t: t["turn_index"] < start)
    return F.array_sort(F.concat(F.coalesce(kept, F.slice(new, 1, 0)), new))


def regroup_legacy(flat: DataFrame, nested: DataFrame, key: str = "manifest_line") -> DataFrame:
    """Flat rows, one a turn, as turn arrays, for lines that have no nested row; nested rows first."""
    row = F.struct("turn_index", "line_no", "query", "plain_text", "error")
    grouped = flat.join(nested.select(key), key, "left_anti").groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("t"))
    fields = lambda x: F.struct(x["turn_index"].alias("turn_index"), x["query"].alias("query"), x["plain_text"].alias("plain_text"), x["error"].alias("error"))
    legacy = grouped.select(key, F.transform("t", fields).alias("turns"))
    return nested.select(key, "turns").unionByName(legacy)


def contiguous_prefix(turns: DataFrame, key: str, index: str, ok: str) -> DataFrame:
    """(key, prefix): how many turns from 1 on succeeded without a gap, from long form."""
    good = turns.filter(F.col(ok) & (F.col(index) >= 1)).select(key, index).distinct()
    numbered = good.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(index)))
    return numbered.groupBy(key).agg(F.count_if(F.col(index) == F.col("_n")).alias("prefix"))
