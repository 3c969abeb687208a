"""Arrays of samples or components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitize(wave: Column) -> Column:
    """NaN and infinite samples as zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.transform(wave, lambda x: F.when(bad(x), F.lit(0.0)).otherwise(x.cast("double")))


def summary(wave: Column) -> Column:
    """A struct of the number of samples, the peak and the root mean square, 0 for no samples."""
    wide = F.transform(wave, lambda x: x.cast("double"))
    power = F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x)
    some = F.size(wave) > 0
    return F.struct(
        F.size(wave).cast("long").alias("num_samples"),
        F.when(some, F.array_max(F.transform(wide, F.abs))).otherwise(0.0).alias("peak"),
        F.when(some, F.sqrt(power / F.size(wave))).otherwise(0.0).alias("rms"),
    )
