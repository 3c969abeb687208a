import hashlib
import math

from pyspark.sql import functions as F

from dialoom.llm.mixing import mix_sources, poisson_counts


def count(rate, key, seed=7):
    """Copies of a document by the definition."""
    parts = max(1, math.ceil(rate / 16))
    total = 0
    for i in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        k, p = 0, math.exp(-rate / parts)
        c = p
        while u > c and k < 80:
            k += 1
            p *= rate / parts / k
            c += p
        total += k
    return total


def test_counts_invert_the_distribution(spark):
    for rate in (0.0, 0.3, 1.0, 7.5, 40.0, 900.0):
        got = spark.range(300).select("id", poisson_counts(F.lit(rate), F.col("id"), 7).alias("n")).collect()
        assert [r.n for r in got] == [count(rate, r.id) for r in got]
        mean = sum(r.n for r in got) / 300
        assert abs(mean - rate) <= 4 * math.sqrt(rate / 300) + 1e-9


def test_weights_copies_and_edges(spark):
    rows = [(i, "a" if i % 3 else "b", "t") for i in range(3000)] + [(None, None, None)] * 2 + [(5, "a", "t")]
    df = spark.createDataFrame(rows, "doc_id long, source string, rate string")
    got = mix_sources(df, weights={"a": 1, "b": 1, "none": 5}, size=2.0)
    n = {r.source: r.n for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {"a", "b"} and all(abs(x - 3003) < 4 * math.sqrt(3003 * 3) for x in n.values())
    per = got.groupBy("doc_id").agg(F.min("copy").alias("low"), F.max("copy").alias("high"), F.max("copies").alias("n")).collect()
    assert all(r.low == 0 and r.high == r.n - 1 for r in per)
    even = mix_sources(df)
    assert abs(even.count() - 3003) < 4 * math.sqrt(3003)
    assert even.orderBy("doc_id", "copy").collect() == mix_sources(df.repartition(7)).orderBy("doc_id", "copy").collect()
    assert mix_sources(df.limit(0)).count() == 0
