"""What several corpus operators share: bindings, checkpoints and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of these separates words; everything else is part of a word.
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only a local session may go without one."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if id(context) not in _LOCAL:
            _LOCAL[id(context)] = tempfile.mkdtemp(prefix="checkpoints-")
            atexit.register(shutil.rmtree, _LOCAL[id(context)], ignore_errors=True)
        named = _LOCAL[id(context)]
    return named.rstrip("/")


_LOCAL: dict[int, str] = {}


@contextmanager
def swept(spark: SparkSession):
    """Frames made and run in here leave no shuffle files behind: what they were for is written when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that later reads survive lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    with swept(spark):
        done = df.select("*").checkpoint(eager=True)
    # A checkpoint keeps its plan's estimated size, and joins multiply estimates: in a loop they outgrow any number.
    # The same rows without an estimate leave the choice of joins to what adaptive execution measures.
    rows = done._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, done._jdf.schema(), False), spark)


@contextmanager
def shelf(spark: SparkSession):
    """A function that writes rows as a table in buckets of a key, in the shared folder, and reads it; gone afterwards.

    Joins on the key read the buckets as they lie and shuffle the other side only.
    """
    name = f"shelf_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")

    def put(df: DataFrame, key: str) -> DataFrame:
        place = f"{name}.t{uuid.uuid4().hex}"
        with swept(spark):
            df.select("*").write.format("parquet").bucketBy(partitions(spark), key).saveAsTable(place)
        return spark.table(place)

    try:
        yield put
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def give_back() -> None:
    """Free memory of a Python worker back to the system, so that idle workers hold only what they remember."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only some C libraries have it
        trim(0)


def lean(body: Callable) -> Callable:
    """``body`` for ``mapInArrow``, whose worker gives its free memory back after each task."""

    def run(batches):
        yield from body(batches)
        give_back()

    return run


#: Rows of a few numbers that one task takes, and that a broadcast may hold: counted first, a few megabytes at most.
ROWS, BROADCAST = 100_000, 100_000


def settle(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows of a few numbers, written like those of ``cut`` and read by as few tasks as their number asks for."""
    done = cut(df)
    n = done.count()
    return done.coalesce(max(1, -(-n // ROWS))), n


def small(df: DataFrame, n: int) -> DataFrame:
    """Broadcast if its n rows are few enough; else joined as Spark sees fit."""
    return F.broadcast(df) if n <= BROADCAST else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def forest(batches):
    """Edges (a, b) of each task, replaced by a spanning forest of theirs: never more rows than nodes."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def flush():
        rows = [(find(x), x) for x in list(parent)]
        rows = [(a, b) for a, b in rows if a != b]
        parent.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], ["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                low, high = min(a, b), max(a, b)
                parent[high] = low
                parent.setdefault(low, low)
        if len(parent) > 2 * EDGES + 100_000:  # the memory of a task stays bounded; the rest is left to the rounds
            yield flush()
    if parent:
        yield flush()


#: Edges that one task reduces to a forest at once; more are dealt to more tasks.
EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component_id) of every node with an edge; the id is the smallest node reachable.

    Each task first replaces its edges by a spanning forest. Where they are few enough for one task, that is the
    answer. Beyond, large-star and small-star rounds hang neighbours under the smallest one, so a chain of n nodes
    needs about log n rounds and no task ever holds a whole component. Each round is checkpointed and a round that
    changes no edge ends the loop: every other one hangs some node under a smaller one, so the rounds are finite.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    pairs = cut(pairs.mapInArrow(lean(forest), "a long, b long"))
    tasks = pairs.rdd.getNumPartitions()
    if tasks > 1:
        tasks = -(-pairs.count() // EDGES)
        pairs = cut(pairs.coalesce(max(tasks, 1)).mapInArrow(lean(forest), "a long, b long"))
    if tasks > 1:
        pairs = _stars(pairs)
        members = pairs.groupBy("a").agg(F.min("b").alias("component_id")).withColumnRenamed("a", "node")
    else:  # a forest hangs every node under the smallest of its tree
        members = pairs.select(F.col("b").alias("node"), F.col("a").alias("component_id"))
        pairs = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return members.unionByName(roots)


def _stars(pairs: DataFrame) -> DataFrame:
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        hung = least.select("a", F.col("m").alias("b"))
        pairs = cut(small.unionByName(hung).distinct())
        now = pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(now) == seen:
            return pairs
        seen = tuple(now)
