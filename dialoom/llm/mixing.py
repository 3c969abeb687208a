"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's rate is the mean number of copies of its documents: the size of the mix times the source's weight over the
documents that the source has. A document's number of copies inverts the Poisson distribution of that mean at a point
that a seeded hash of its id fixes, so that the same seed gives the same mix on every run and cluster.

Defined cases: a null source is a source of its own; a null id hashes as an empty one; repeated rows get the same
number of copies each, ties in the order are equal rows or rows without id; texts are carried whole, whatever their
length; an empty table gives none; an input column named like an output is replaced, others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table

#: A mean over this is drawn as a sum of as many equal parts, so that exp(-mean) does not vanish.
PART = 16.0
#: Points of a part's distribution that are searched; beyond, its tail is below 1e-16.
TAIL = 80
#: Sources, and characters of their names, up to which their rates are broadcast.
SOURCES, NAMES = 200_000, 8_000_000


def _point(seed: int, key: Column, part: Column) -> Column:
    """A number in (0, 1) that the seed, the key and the part fix."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), part.cast("string")))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _inverse(mean: Column, point: Column) -> Column:
    """The smallest k whose cumulated probability reaches the point."""
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.when(point > F.exp(-mean), 1).otherwise(0).alias("k")
    )

    def step(s: Column, j: Column) -> Column:
        p = s["p"] * mean / j
        return F.struct(
            p.alias("p"), (s["c"] + p).alias("c"), (s["k"] + F.when(point > s["c"] + p, 1).otherwise(0)).alias("k")
        )

    steps = F.sequence(F.lit(1), F.least(F.lit(TAIL), (mean * 4 + 24).cast("int")))
    return F.aggregate(steps, start, step)["k"]


def poisson_counts(rate: Column, key: Column, seed: int) -> Column:
    parts = F.greatest(F.lit(1), F.ceil(rate / PART)).cast("int")
    drawn = F.transform(F.sequence(F.lit(1), parts), lambda i: _inverse(rate / parts, _point(seed, key, i)))
    return F.aggregate(drawn, F.lit(0), lambda a, x: a + x)


def target_rates(df: DataFrame, source: str, weights: dict[str, float] | None, power: float, size: float) -> DataFrame:
    """(source, rate). Without weights, a source's weight is its number of documents to the power."""
    counts = df.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = df.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_source string, w double")
        weighted = counts.join(given, counts["_source"].eqNullSafe(given["_source"]), "left").select(
            counts["_source"], "n", F.coalesce("w", F.lit(0.0)).alias("w")
        )
    whole = weighted.agg(F.sum("n").alias("_n"), F.sum("w").alias("_w")).withColumn("_one", F.lit(1))  # one row
    return weighted.withColumn("_one", F.lit(1)).join(F.broadcast(whole), "_one").select(
        "_source", F.when(F.col("_w") > 0, F.col("_n") * F.lit(size) * F.col("w") / F.col("_w") / F.col("n")).otherwise(F.lit(0.0)).alias("_rate")
    )


def mix_sources(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    weights: dict[str, float] | None = None,
    power: float = 0.7,
    size: float = 1.0,
    seed: int = 7,
    shuffled: bool = True,
) -> DataFrame:
    """The copies of the documents, dealt and ordered by a hash that the seed fixes, with ``rate``, ``copies`` and ``copy`` (from 0).

    ``size`` is the expected number of rows over the number of documents. A source without a given weight gets none, and
    weights of sources that the table lacks are shared by the others.
    """
    names = [f"_{i}" for i in range(len(df.columns))]  # no name of an input column can clash with one of these
    own = dict(zip(df.columns, names))
    docs = df.toDF(*names)
    rates, n = settle(target_rates(docs, own[source], weights, power, size))
    held = rates.agg(F.sum(F.length("_source"))).first()[0] or 0
    # one row a source, counted: broadcast, so that documents are neither shuffled nor gathered by source
    rates = F.broadcast(rates) if n <= SOURCES and held <= NAMES else rates
    joined = docs.join(rates, docs[own[source]].eqNullSafe(rates["_source"]))
    counted = joined.withColumn("copies", poisson_counts(F.col("_rate"), F.col(own[key]), seed)).withColumnRenamed("_rate", "rate")
    copied = counted.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    made = ("rate", "copies", "copy")
    kept = [F.col(c).alias(given) for given, c in own.items() if given not in made]
    if not shuffled:
        return copied.select(*kept, *made)
    # dealt and ordered by a hash: one shuffle, without the pass that finds the ranges of a global sort
    others = [c for c, f in zip(names, df.schema) if c != own[key] and _hashes(f.dataType)]
    copied = copied.withColumn("place", F.xxhash64(F.lit(seed), own[key], "copy", F.when(F.col(own[key]).isNull(), F.xxhash64(*others) if others else F.lit(0))))
    return copied.repartition("place").sortWithinPartitions("place").select(*kept, *made)


def _hashes(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType))


def op6_source_mix(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "copies", "copy")


def mixed_sql(documents: str = "documents", power: float = 0.7, seed: int = 7) -> str:
    """DuckDB SQL of the copies, with the columns of ``documents``; means up to PART, as here."""
    return f"""
WITH base AS (SELECT *, row_number() OVER () AS rid FROM {documents}),
c AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {power}) AS w FROM base GROUP BY source),
r AS (SELECT source, (sum(n) OVER ())::DOUBLE * 1.0 * w / (sum(w) OVER ()) / n AS rate FROM
  (SELECT source, n, w FROM c)),
p AS (SELECT base.*, rate, (('0x' || substr(md5(concat_ws(':', '{seed}', coalesce(doc_id::VARCHAR, ''), '1')), 1, 12))::BIGINT::DOUBLE + 0.5) / {1 << 48} AS u
  FROM base JOIN r ON base.source IS NOT DISTINCT FROM r.source),
k AS (SELECT p.*, (SELECT count(*) FROM (SELECT sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (ORDER BY j) AS cum FROM range(0, 60) t(j)) WHERE p.u > cum)::INT AS copies FROM p),
mixed AS (SELECT * EXCLUDE (rid, u), unnest(range(0, copies))::INT AS copy FROM k WHERE copies > 0)"""


OP6_SQL = mixed_sql() + """
SELECT doc_id, source, copies, copy FROM mixed"""
