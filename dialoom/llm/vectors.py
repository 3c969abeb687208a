"""Near-duplicate embeddings by product quantisation over coarse inverted lists.

Vectors are compared within a label, by cosine. Equal vectors of a label are one class. A coarse quantiser and one
codebook for each subspace of the residuals are fitted on a bounded sample; every class is then coded and put into the
list of its nearest centre. There are about as many centres as the root of the classes of the largest label, so lists and
probes stay short as labels grow. A class probes its own list and those whose side of the plane between the two centres is
near: a step as long as the threshold allows, in a random direction, moves towards a plane by that length over the root of
the width (one deviation), and ``SPREAD`` of these are allowed for. Table lookups give the asymmetric distances to the
codes there, and those that the known coding error cannot rule out are compared exactly: only probes can miss a link, and
tests measure how many are found. With ``spread=None`` every list within reach is probed and none is missed.

Lists are dealt in blocks of bounded size and a block returns, instead of pairs, each class's number of links and a
spanning forest of them. Each pair is compared in one block only.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link
with nothing; vectors of different lengths are not compared; rows without an id count in no component but their own; an
input column named like an output is replaced, others are dropped; components of any finite size take part; ties at the
threshold link; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, forest, partitions, table

COSINE = 0.93
#: Vectors that the quantisers are fitted on at most, and a centre; centres at least and at most, subspaces, codes a
#: subspace, rows in a block.
SAMPLE, A_CENTRE, FEWEST, CENTRES, SUBSPACES, CODES, BLOCK = 65_536, 64, 16, 2048, 8, 64, 1024
#: Deviations of the way towards a plane that probes allow for.
SPREAD = 2.5


@dataclass
class Quantisers:
    centres: np.ndarray  # (lists, width)
    books: np.ndarray  # (subspaces, codes, width of a subspace)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the coding error) of unit vectors."""
        own = distances(x, self.centres).argmin(axis=1)
        rest = x - self.centres[own]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        step, error = self.books.shape[2], np.zeros(len(x))
        for m, book in enumerate(self.books):
            part = rest[:, m * step : (m + 1) * step]
            codes[:, m] = distances(part, book).argmin(axis=1)
            error += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
        return own, codes, np.sqrt(error)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Which lists can hold a vector within the radius: those whose side of the plane between is that near."""
        to = distances(x, self.centres)
        between = np.sqrt(distances(self.centres, self.centres))
        gap = to - to[np.arange(len(x)), own][:, None]
        return gap <= 2 * radius * between[own] + 1e-9

    def lookup(self, x: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Distances of whole vectors to coded ones of one list: a table for each vector and subspace, then lookups."""
        rest, step = x - self.centres[centre], self.books.shape[2]
        total = np.zeros((len(x), len(codes)), np.float32)
        for m, book in enumerate(self.books):
            tables = distances(rest[:, m * step : (m + 1) * step], book).astype(np.float32)
            total += tables[:, codes[:, m]]
        return np.sqrt(total)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0)


def _means(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = distances(x, centres).argmin(axis=1)
        for c in np.unique(own):
            centres[c] = x[own == c].mean(axis=0)
    return centres


def fit(x: np.ndarray, lists: int = FEWEST, seed: int = 3) -> Quantisers:
    rng = np.random.Generator(np.random.PCG64(seed))
    width = x.shape[1]
    centres = _means(x, min(lists, len(x)), rng)
    rest = x - centres[distances(x, centres).argmin(axis=1)]
    parts = next(m for m in range(min(SUBSPACES, width), 0, -1) if width % m == 0)
    step = width // parts
    books = [_means(rest[:, m * step : (m + 1) * step], min(CODES, len(x)), rng) for m in range(parts)]
    return Quantisers(centres, np.array(books))


def unit(column) -> np.ndarray:
    rows = np.array(column.to_pylist(), np.float64)
    rows = rows / np.abs(rows).max(axis=1)[:, None]  # squares of very large or small components stay finite
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def usable(vector: Column, label: Column) -> Column:
    """Whether a row takes part."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    some = F.exists(wide, lambda v: v != 0)
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & some, F.lit(False))


def links(classes: DataFrame, cosine: float, spread: float | None = SPREAD) -> DataFrame:
    """(a, b, linked): for b null, a's number of linked vectors in a block; else an edge of a block's forest.

    ``classes`` has id, label, vector, copies and one length of vectors.
    """
    spark = classes.sparkSession
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    if not largest:
        return spark.createDataFrame([], "a long, b long, linked long")
    lists = int(min(CENTRES, max(FEWEST, round(largest**0.5))))
    chosen = classes.orderBy(F.xxhash64("id")).limit(min(SAMPLE, A_CENTRE * lists)).select("vector").toArrow()["vector"]
    quantisers = fit(unit(chosen), lists)
    shared = spark.sparkContext.broadcast(quantisers)  # of a size that the parameters fix
    radius = float(np.sqrt(2 - 2 * cosine))
    width = quantisers.centres.shape[1]
    reachable = radius * (1.0 if spread is None else min(1.0, spread / float(np.sqrt(width))))

    def code(batches):
        import pyarrow as pa

        q = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                x = unit(batch.column(2))
                own, codes, error = q.encode(x)
                probes = q.probes(x, own, reachable)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i) for i in range(4)),
                        pa.array(own.astype(np.int32)),
                        pa.array([r.tobytes() for r in codes], pa.binary()),
                        pa.array(error),
                        pa.array([np.flatnonzero(r).astype(np.int32) for r in probes], pa.list_(pa.int32())),
                    ],
                    ["id", "label", "vector", "copies", "own", "codes", "error", "probes"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    coded = cut(
        classes.select("id", "label", "vector", "copies").mapInArrow(
            code, f"id long, label {kind}, vector array<double>, copies long, own int, codes binary, error double, probes array<int>"
        )
    )
    # blocks of a list: as many as its size asks for; a row's block is fixed by its id
    sizes = coded.groupBy("label", "own").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = coded.withColumn("centre", F.explode("probes")).join(
        sizes.select("label", F.col("own").alias("centre"), "blocks"), ["label", "centre"]
    )
    listed = coded.withColumn("centre", F.col("own")).join(sizes, ["label", "own"])
    block = F.pmod(F.xxhash64(F.lit("block"), "id"), F.col("blocks").cast("long")).cast("int")
    # those that ask a list are blocked too, by a number that its own size sets
    askers = asked.groupBy("label", "centre").agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK)).cast("int").alias("sides"))
    side = F.pmod(F.xxhash64(F.lit("side"), "id"), F.col("sides").cast("long")).cast("int")
    columns = ["id", "vector", "copies", "own", "codes", "error", "probes", "label", "centre"]
    queries = (
        asked.join(askers, ["label", "centre"]).withColumn("side", side)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*columns, "block", "side", F.lit(True).alias("asks"))
    )
    members = (
        listed.join(askers, ["label", "centre"]).withColumn("block", block)
        .withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .select(*columns, "block", "side", F.lit(False).alias("asks"))
    )

    def compare(whole):
        import pyarrow as pa

        q = shared.value
        asks = np.array(whole["asks"].to_pylist(), bool)
        ids, copies, own = (whole[c].to_numpy() for c in ("id", "copies", "own"))
        x = unit(whole["vector"])
        centre = whole["centre"][0].as_py()
        queries, found = np.flatnonzero(asks), np.flatnonzero(~asks)
        counts: dict[int, int] = {}
        edges = []
        if len(queries) and len(found):
            codes = np.frombuffer(b"".join(whole["codes"].to_pylist()), np.uint8).reshape(len(ids), -1)[found]
            error = whole["error"].to_numpy()[found]
            probes = whole["probes"].to_pylist()
            reach = {int(i): set(probes[i]) for i in found}
            for at in range(0, len(queries), 256):
                rows = queries[at : at + 256]
                near = q.lookup(x[rows], centre, codes) <= radius + error + 1e-5
                i, j = np.nonzero(near)
                i, j = rows[i], found[j]
                # a pair of one list is met twice; one of two lists is left to the lower list if both ask
                once = np.where(own[i] == own[j], ids[i] < ids[j], True)
                i, j = i[once], j[once]
                for low in range(0, len(i), 1 << 15):
                    a, b = i[low : low + (1 << 15)], j[low : low + (1 << 15)]
                    hit = (x[a] * x[b]).sum(axis=1) >= cosine
                    for s, t in zip(a[hit].tolist(), b[hit].tolist()):
                        if own[s] != own[t] and own[s] in reach[t] and own[t] > own[s]:
                            continue
                        counts[ids[s]] = counts.get(ids[s], 0) + int(copies[t])
                        counts[ids[t]] = counts.get(ids[t], 0) + int(copies[s])
                        edges.append((int(ids[s]), int(ids[t])))
                    if len(edges) > 100_000:
                        edges = _thin(edges)
        edges = _thin(edges)
        a = [*counts, *(e[0] for e in edges)]
        b = [None] * len(counts) + [e[1] for e in edges]
        return pa.table(
            {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array([*counts.values(), *[0] * len(edges)], pa.int64())}
        )

    both = queries.unionByName(members)
    return both.groupBy("label", "centre", "block", "side").applyInArrow(compare, "a long, b long, linked long")


def _thin(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    import pyarrow as pa

    if not edges:
        return []
    batch = pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])
    return [e for out in forest([batch]) for e in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
    spread: float | None = SPREAD,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; the key is read as a long."""
    wide = F.col(vector).cast("array<double>")
    rows = df.select(
        F.col(key).cast("long").alias(key), F.col(label).alias("_label"),
        F.when(usable(F.col(vector), F.col(label)), wide).alias("_vector"),
    )
    usable_rows = rows.filter(F.col("_vector").isNotNull())
    classes = cut(
        usable_rows.groupBy(F.col("_label").alias("label"), F.col("_vector").alias("vector"))
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.coalesce("first", F.xxhash64("label", "vector").bitwiseOR(F.lit(-(1 << 63)))))
    )
    lengths = [r[0] for r in classes.groupBy(F.size("vector")).count().select(F.col("size(vector)")).collect()]
    blocks = None
    for n in lengths:  # one, but for broken tables
        part = links(classes.filter(F.size("vector") == n), cosine, spread)
        blocks = part if blocks is None else blocks.unionByName(part)
    if blocks is None:
        return rows.select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    blocks = cut(blocks)
    counts = blocks.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("linked").alias("linked"))
    joined = components(blocks.filter("b is not null").select("a", "b"))
    judged = (
        classes.join(counts, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("label").alias("_l"), F.col("vector").alias("_v"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "id").alias("_c"),
        )
    )
    out = rows.join(judged, (F.col("_label") == F.col("_l")) & (F.col("_vector") == F.col("_v")), "left")
    component = F.when(F.col("_c").isNull() | (F.col("_c") < -(1 << 62)), F.col(key)).otherwise(F.col("_c"))
    return out.select(
        key, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def op3_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
