"""Analytics over call logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts() -> list[Column]:
    tokens = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long")
    ok = F.coalesce(F.col("success"), F.lit(True))
    return [
        F.count(F.lit(1)).alias("calls"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
        F.count_if(F.coalesce(F.col("completion_tokens"), F.lit(0)) == 0).alias("zero_output"),
        tokens("prompt_tokens").alias("prompt_tokens"), tokens("completion_tokens").alias("completion_tokens"), tokens("total_tokens").alias("total_tokens"),
    ]


def success_rate(succeeded: Column, calls: Column) -> Column:
    return F.when(calls > 0, succeeded / calls * 100).otherwise(F.lit(0.0))


def usage_total(calls: DataFrame) -> DataFrame:
    return calls.agg(*_counts())


def usage_by(calls: DataFrame, *keys: str) -> DataFrame:
    rows = calls.groupBy(*keys).agg(*_counts())
    return rows.withColumn("success_rate", success_rate(F.col("succeeded"), F.col("calls")))


def usage_sets(calls: DataFrame) -> DataFrame:
    """Totals, by model and by user in one pass; ``level`` says which."""
    rows = calls.groupingSets([[], ["model"], ["user"]], "model", "user").agg(*_counts(), F.grouping_id("model", "user").alias("_g"))
    level = F.when(F.col("_g") == 3, "total").when(F.col("_g") == 1, "model").otherwise("user")
    return rows.withColumn("level", level).drop("_g")


def in_month(calls: DataFrame, month: str, stem: str = "stem") -> DataFrame:
    """Calls of log files whose name contains the month."""
    return calls.filter(F.contains(F.col(stem), F.lit(month)))


def of_model(calls: DataFrame, model: str) -> DataFrame:
    return calls.filter(F.col("model") == model)


def recent_calls(calls: DataFrame, n: int, file_time: str = "file_time", path: str = "path", line: str = "line_no") -> DataFrame:
    """The last n calls: newest file first, last line first, ties by path. Only n rows of each task are kept."""
    return calls.orderBy(F.desc(file_time), F.desc(path), F.desc(line)).limit(n)


#: The columns of a statistics export and their headers.
EXPORT = {
    "timestamp": "时间戳", "model": "模型", "user": "用户", "prompt_tokens": "输入Tokens", "completion_tokens": "输出Tokens",
    "total_tokens": "总Tokens", "duration_ms": "耗时(ms)", "success": "成功",
}


def export_rows(calls: DataFrame, headers: dict[str, str] = EXPORT, yes: str = "是", no: str = "否") -> DataFrame:
    """Columns for a table export under their headers, success in words."""
    counts = ("prompt_tokens", "completion_tokens", "total_tokens")
    word = F.when(F.coalesce(F.col("success"), F.lit(True)), yes).otherwise(no)
    return calls.select(*[(word if c == "success" else F.coalesce(c, F.lit(0)) if c in counts and headers is EXPORT else F.col(c)).alias(h) for c, h in headers.items()])
