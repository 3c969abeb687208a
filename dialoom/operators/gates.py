"""Quality gates: verdicts reduced to rows that pass, counts and exit codes. An undecided verdict never passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def passes(verdict: Column) -> Column:
    return F.coalesce(verdict, F.lit(False))


def gate(rows: DataFrame, verdict: str = "passed") -> DataFrame:
    """Rows whose own verdict is true."""
    return rows.filter(passes(F.col(verdict)))


def gate_by(rows: DataFrame, verdicts: DataFrame, key: str, verdict: str) -> DataFrame:
    """Rows for which a table of verdicts has a true one."""
    return rows.join(verdicts.filter(passes(F.col(verdict))).select(key), key, "left_semi")


def line_passed(turns_qc: Column) -> Column:
    """Whether there are turns and every one passes; a null turn or verdict fails the line."""
    return (F.size(turns_qc) > 0) & F.forall(turns_qc, lambda t: passes(t["is_pass"]))


def line_error(turns: Column) -> Column:
    """The first error in turn order."""
    errors = F.filter(F.transform(turns, lambda t: t["error"]), lambda e: F.coalesce(e != "", F.lit(False)))
    return F.get(errors, F.lit(0))


def gate_counts(rows: DataFrame, verdict: Column) -> DataFrame:
    """(n, passed, failed)"""
    ok = F.count_if(passes(verdict))
    return rows.agg(F.count(F.lit(1)).alias("n"), ok.alias("passed"), (F.count(F.lit(1)) - ok).alias("failed"))


def text_gate_exit(n: int, passed: int, any_input: bool, input_exists: bool = True) -> int:
    """1 for missing input or input without a usable row, 2 if rows were judged and none passed, else 0."""
    if not input_exists or (n == 0 and any_input):
        return 1
    return 2 if n and not passed else 0


def audio_gate_exit(input_exists: bool = True) -> int:
    """Rows that all fail are only worth a warning here."""
    return 0 if input_exists else 1


def run_status(rows: DataFrame, status: str = "status", calls: str = "n_api") -> DataFrame:
    """(status, n, calls)"""
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(calls), F.lit(0)).alias("calls"))


def row_status(complete: Column, error: Column) -> Column:
    """skip for rows that were complete before, err with an error, else ok."""
    return F.when(complete, "skip").when(F.coalesce(error != "", F.lit(False)), "err").otherwise("ok")


def reply_exit(ok: int, err: int) -> int:
    return int(ok == 0 and err > 0)


def batch_status(rows: DataFrame, verdict: Column) -> DataFrame:
    """Counts with the text gate's exit code as a column."""
    counts = gate_counts(rows, verdict)
    return counts.withColumn("exit_code", F.when((F.col("n") > 0) & (F.col("passed") == 0), 2).when(F.col("n") == 0, 1).otherwise(0))
