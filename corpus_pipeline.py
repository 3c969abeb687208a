"""From raw documents to packed training windows: each stage reads what the one before wrote.

Every stage but the last returns the columns that it was given. ORACLE_SQL is None because neither the near-duplicate
groups nor the packing can be written in SQL; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import mixing, neardup, packing, quality, secrets
from dialoom.llm.common import settle, shared_folder, small


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a text without words goes, rows that repeat stay as often as they occur."""
    own = [f"given_{i}" for i in range(len(docs.columns))]
    judged = quality.quality_rules(docs.toDF(*own), own[docs.columns.index("text")])
    return judged.filter("kept").select(*own).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows without an id, and rows whose id others have too, are judged by themselves: a hash of id and text names them,
    behind all ids, and of rows that agree in both the least one by the other columns stays.
    """
    unsure = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1 or doc_id is null")
    unsure = settle(unsure.select("doc_id"))
    if not unsure[1]:
        kept = neardup.near_duplicates(docs).filter("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    marked = docs.join(small(unsure[0].select(F.col("doc_id").alias("u"), F.lit(True).alias("twice")), unsure[1]), F.expr("doc_id <=> u"), "left")
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = marked.select(F.struct(*docs.columns).alias("given"), "text", F.when(F.col("twice"), own).otherwise(F.col("doc_id").cast("long")).alias("doc_id"))
    kept = neardup.near_duplicates(named.select("doc_id", "text")).filter("kept").select("doc_id").distinct()
    chosen = named.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("given").alias("given"))
    return chosen.select("given.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked; null and empty texts as they are."""
    clean = secrets.redact(secrets.secret_scan(docs))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size("secret_spans") > 0, length).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by their source's rate, shuffled; a null source is one of its own."""
    return mixing.mix_sources(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece of a document in a window; texts of any length are cut, a null text is the end id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next, then removed.

    What the last one wrote stays, in a folder of its own below ``spark.checkpoint.dir``.
    """
    work = f"pipeline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {work} LOCATION '{shared_folder(spark)}/{work}'")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.format("parquet").saveAsTable(f"{work}.{name}")
        docs = spark.table(f"{work}.{name}")
        if number:
            spark.sql(f"DROP TABLE {work}.{STAGES[number - 1][0]}")
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
