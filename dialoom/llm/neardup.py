"""Near-duplicate documents by an LSH forest over minhash signatures.

Every document becomes the set of its 5-word shingles. Equal sets are one class, so copies cost nothing beyond.
Each class gets a signature of minima, and each tree of the forest sorts all classes by its own order of the
signature's values. In a sorted order, the classes nearest to one share the longest prefix with it: they are its
candidates as long as that prefix has the least depth. How deep a prefix they share adapts to how crowded their
region of the order is; nothing is enumerated beyond neighbours. Candidates whose signatures agree enough are confirmed
on full sets, the best ones of each class first, then the best one between any two components, then all that would
still join two. A star, whose members resemble only its centre, is larger than any neighbourhood: in each region with
several components all are then held once against the member with most links. Where a region with more members than neighbours
are looked at still has several components, every two members of different ones are compared on their full sets, in blocks
and without a bound on their number: the neighbourhood orders the work, it drops no pair.

Defined cases: null texts and texts without words have an empty set and are linked with nothing; fewer than five words
are one shingle; rows with the same id are one document and share a component; a row without id takes the component of
its class, null if no row there has an id; an input column named like an output is replaced, others are kept.
"""

from __future__ import annotations

from itertools import chain, count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST, components, cut, give_back, lean, partitions, settle, shelf, small, table
from .hashing import mix, shingle_sets

SHINGLE = 5
PERCENT = 75
#: Values in a signature, trees, values in a tree's key, values that candidates share at least, neighbours looked at.
VALUES, TREES, DEPTH, LEAST, NEAR = 120, 24, 10, 3, 3
#: Values in which the signatures of a pair must agree: to be kin at all, and to be confirmed. At a similarity of 0.75 the
#: mean is 90 and the standard deviation 4.7.
KIN, ALIKE = 54, 70
#: Candidates of a class that the first round confirms; parts that the copies of a text are dealt into; about as many pairs
#: of a hub are a part.
FIRST, SALTS, PART = 2, 32, 256
#: About as many members, and as many shingles of theirs, are a block of a crowded region.
MEMBERS, WEIGHT = 2048, 1_000_000


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(29))
    return rng.integers(0, 1 << 31, VALUES, np.uint32) * 2 + 1, rng.integers(0, 1 << 32, VALUES, np.uint32)


def _orders() -> np.ndarray:
    """Each tree's order of the signature's values; the first five of every tree are its own."""
    rng, own = np.random.Generator(np.random.PCG64(31)), VALUES // TREES
    rows = []
    for t in range(TREES):
        first = np.arange(t * own, (t + 1) * own)
        rest = rng.permutation(np.setdiff1d(np.arange(VALUES), first))
        rows.append(np.concatenate([first, rest])[:DEPTH])
    return np.array(rows)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 mixed bits of each minimum over a set, in blocks that stay in the cache.

    The minimum of n hashes is about 2**32 / n, so its upper bits alone vanish for large sets.
    """
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 2048):
        np.minimum(low, (h[at : at + 2048, None] * a + b).min(axis=0), out=low)
    low ^= low >> np.uint32(16)
    low *= np.uint32(0x85EBCA6B)
    return (low >> np.uint32(16)).astype(np.uint16)


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row a document: key, n_shingles, two hashes of the set, signature."""
    schema = T.StructType(
        [T.StructField(key, T.LongType()), T.StructField("n_shingles", T.LongType())]
        + [T.StructField(n, T.LongType()) for n in ("h1", "h2")]
        + [T.StructField("sig", T.BinaryType())]
    )

    def sign(batches):
        import pyarrow as pa

        a, b = _functions()
        for batch in batches:
            n, h1, h2, sig = [], [], [], []
            for _, hashes in shingle_sets(batch.column(1), SHINGLE):
                n.append(len(hashes))
                h1.append(int(hashes.sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix(hashes ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).astype(np.int64)))
                sig.append(signature(hashes, a, b).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sig, pa.binary())],
                schema.names,
            )

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(lean(sign), schema)


def _planted(batches):
    """Classes' signatures to their keys in every tree."""
    import pyarrow as pa

    orders = _orders()
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, VALUES)
            keys = sig[:, orders].astype(">u2").reshape(-1, DEPTH)  # big-endian: bytes sort like numbers
            raw = pa.py_buffer(keys.tobytes())
            key = pa.Array.from_buffers(pa.binary(2 * DEPTH), len(keys), [None, raw]).cast(pa.binary())
            tree = pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(part)))
            yield pa.RecordBatch.from_arrays([tree, key, pa.array(np.repeat(part.column(0).to_numpy(), TREES))], ["tree", "key", "id"])


def _neighbours(seams: bool):
    """Pairs (a, b, shared) of rows in sorted order that share a prefix; with seams, also the rows at a task's ends.

    A region holds the rows that share the least prefix. Where it has no more rows than are looked at, all its pairs are
    found. Members (a) of a larger region (shared) have no b: these are compared whole later on, so that of their pairs
    only those next to each other are found here, one a row.
    """
    reach = NEAR + 1

    def pair(batches):
        import pyarrow as pa

        def out(a=(), b=None, shared=(), tree=None, key=None, ids=None):
            n = len(a) or len(ids if ids is not None else ())
            blank = lambda kind: pa.nulls(n, kind)
            if ids is None:
                columns = [pa.array(a), blank(pa.int64()) if b is None else pa.array(b), pa.array(shared), blank(pa.int32()), blank(pa.binary())]
            else:
                raw = [k.astype(">u2").tobytes() for k in key]  # joined batches are in the machine's byte order
                columns = [pa.array(ids), blank(pa.int64()), blank(pa.int64()), pa.array(tree), pa.array(raw, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "shared", "tree", "key"])

        held, done, edge_made = None, 0, False  # rows that wait or are looked back at; the first ``done`` of them are paired
        for batch in chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                key = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, DEPTH)
                rows = (batch.column(0).to_numpy(), key, batch.column(2).to_numpy())
                held = rows if held is None else tuple(np.concatenate(x) for x in zip(held, rows))
            if held is None:
                return
            tree, key, ids = held
            if seams and not edge_made:
                yield out(tree=tree[:reach], key=key[:reach], ids=ids[:reach])
                edge_made = True
            # the last rows wait for those after them, which tell how large their region is
            stop = len(ids) if batch is None else max(done, len(ids) - reach)
            full = np.zeros(len(ids), bool)
            full[reach:] = (tree[reach:] == tree[:-reach]) & (key[reach:, :LEAST] == key[:-reach, :LEAST]).all(axis=1)
            ends = np.cumsum(full)
            found = []
            for step in range(1, NEAR + 1):
                i = np.arange(max(done, step), stop)
                j = i - step
                i, j = (x[tree[i] == tree[j]] for x in (i, j))
                shared = np.minimum.accumulate(key[i] == key[j], axis=1).sum(axis=1)
                hit = (shared >= LEAST) & (ids[i] != ids[j])
                if step > 1:  # no stretch of a crowded region holds both
                    hit &= ends[np.minimum(j + reach, len(ids) - 1)] == ends[i - 1]
                i, j, shared = i[hit], j[hit], shared[hit]
                found.append((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), shared.astype(np.int64)))
            a, b, shared = (np.concatenate(x) for x in zip(*found))
            if len(a):
                yield out(a, b, shared)
            i = np.flatnonzero(full[done:stop]) + done
            if len(i):
                region = tree.astype(np.int64)
                for k in range(LEAST):
                    region = region << 16 | key[:, k].astype(np.int64)
                rows = np.unique((i[:, None] - np.arange(reach + 1)).ravel())
                yield out(ids[rows], shared=region[rows])
            if batch is None and seams:
                yield out(tree=tree[-reach:], key=key[-reach:], ids=ids[-reach:])
            low = max(0, stop - reach)
            held, done = tuple(x[low:] for x in held), stop - low

    return pair


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b, shared) over classes (id, sig): a < b, shared is the sum over trees of the values they share in front.

    In a region with more than neighbours, only the pairs next to each other.
    """
    return planted(classes)[0]


def planted(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The candidates, and (id, region) of the classes in regions with more than neighbours."""
    n = partitions(classes.sparkSession)
    keys = classes.select("id", "sig").mapInArrow(lean(_planted), "tree int, key binary, id long")
    ordered = keys.repartitionByRange(n, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    schema = "a long, b long, shared long, tree int, key binary"
    rows = cut(ordered.mapInArrow(lean(_neighbours(True)), schema))
    found = rows.filter("tree is null").select("a", "b", "shared")
    # the first and last rows of each task: a few a task, so one task can order them
    ends = rows.filter("tree is not null").select("tree", "key", F.col("a").alias("id")).distinct()
    seams = ends.coalesce(1).sortWithinPartitions("tree", "key", "id").mapInArrow(lean(_neighbours(False)), schema)
    found = found.unionByName(cut(seams.select("a", "b", "shared")))
    pairs = found.filter("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    return pairs, found.filter("b is null").select(F.col("a").alias("id"), F.col("shared").alias("region")).distinct()


def agreement(pairs: DataFrame, leaders: DataFrame, n: int | None = None) -> DataFrame:
    """(a, b, same): in how many values the signatures of each pair agree, for pairs of kin; n is their number, if known."""
    if n is not None:  # few pairs go to the signatures as they lie, and only theirs are moved
        pairs = small(pairs, n)
        ids = small(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), 2 * n)
        leaders = leaders.join(ids, "id", "left_semi")
    both = (
        leaders.select(F.col("id").alias("a"), F.col("sig").alias("x")).join(pairs, "a")
        .join(leaders.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b").select("a", "b", "x", "y")
    )

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, VALUES) for i in (2, 3))
            same = pa.array((x == y).sum(axis=1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), same], ["a", "b", "same"])

    return both.mapInArrow(lean(count), "a long, b long, same long").filter(F.col("same") >= KIN)


def _dealt(pairs: DataFrame, n: int | None) -> DataFrame:
    """(hub, part, other) of each pair (a, b): the hub is the side with more pairs, which are dealt into parts by ``other``."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    hubs = degree.filter(F.col("n") > PART)
    most = BROADCAST + 1 if n is None else 2 * n // PART  # n pairs have no more hubs than that
    named = pairs.join(small(hubs.select(F.col("id").alias("a"), F.col("n").alias("na")), most), "a", "left").join(
        small(hubs.select(F.col("id").alias("b"), F.col("n").alias("nb")), most), "b", "left"
    ).fillna(1, ["na", "nb"])
    first = F.col("na") >= F.col("nb")
    named = named.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"), F.greatest("na", "nb").alias("n"))
    return named.select("hub", F.pmod(F.xxhash64("other"), F.ceil(F.col("n") / PART)).alias("part"), "other")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, n: int | None = None) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have at least ``percent`` of their union in common; texts has id, text.

    A hub's text is sent and hashed once for each part of its pairs, the other side's once a pair. ``n`` is the number of
    pairs, where it is known.
    """
    dealt = _dealt(pairs, n)
    heads = dealt.select("hub", "part").distinct().withColumns({"other": F.lit(None).cast("long"), "id": F.col("hub")})
    wanted = heads.unionByName(dealt.withColumn("id", F.col("other")))
    rows = wanted.join(texts, "id").select("hub", "part", "other", "text")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("other").asc_nulls_first())

    def check(batches):
        import pyarrow as pa

        held, sets = None, []
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, found = whole.slice(at, 256), []
                hub, part, other = (batch.column(i).to_pylist() for i in range(3))
                for i, x in shingle_sets(batch.column(3), SHINGLE):
                    if other[i] is None:  # the head of a part; rows that share its id are heads as well
                        if held != (hub[i], part[i]):
                            held, sets = (hub[i], part[i]), []
                        sets.append(x)
                    elif held == (hub[i], part[i]):
                        common = [len(np.intersect1d(x, y, assume_unique=True)) for y in sets]
                        if any(c and 100 * c >= percent * (len(x) + len(y) - c) for c, y in zip(common, sets)):
                            found.append((min(hub[i], other[i]), max(hub[i], other[i])))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(lean(check), "a long, b long")


def _crossing(pairs: DataFrame, joined: DataFrame | None, n: int) -> DataFrame:
    """The pairs that lie in two components, with these as ca < cb; n is the number of nodes in ``joined``."""
    if joined is None:
        return pairs.withColumns({"ca": F.col("a"), "cb": F.col("b")})
    named = pairs.join(small(joined.select(F.col("node").alias("a"), F.col("component_id").alias("_a")), n), "a", "left").join(
        small(joined.select(F.col("node").alias("b"), F.col("component_id").alias("_b")), n), "b", "left"
    )
    left, right = F.coalesce("_a", "a"), F.coalesce("_b", "b")
    return named.withColumns({"ca": F.least(left, right), "cb": F.greatest(left, right)}).drop("_a", "_b").filter("ca <> cb")


def _best(pairs: DataFrame, number: int) -> DataFrame:
    """The best pairs of each class in the first round, the best of any two components in the next, then all."""
    if number > 1:
        return pairs.select("a", "b")
    top = F.struct("same", F.col("a").alias("x"), F.col("b").alias("y"))
    if number == 1:
        chosen = pairs.groupBy("ca", "cb").agg(F.max(top).alias("t"))
        return chosen.select(F.col("t.x").alias("a"), F.col("t.y").alias("b"))
    kept = F.slice(F.sort_array(F.collect_list("t"), asc=False), 1, FIRST)  # the trees bound the pairs of a class
    sided = pairs.select(F.explode(F.array("a", "b")).alias("id"), top.alias("t"))
    chosen = sided.groupBy("id").agg(kept.alias("t")).select(F.explode("t").alias("t"))
    return chosen.select(F.col("t.x").alias("a"), F.col("t.y").alias("b")).distinct()


def _hub_pairs(leaders: DataFrame, links: DataFrame, joined: DataFrame, n: int) -> DataFrame:
    """(a, b): each member of a region with its most linked member, where they lie in two components."""
    regions = leaders.mapInArrow(lean(_planted), "tree int, key binary, id long").select(
        "tree", F.substring("key", 1, 2 * LEAST).alias("key"), "id"
    )
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    heads = regions.join(small(degree, n), "id").groupBy("tree", "key").agg(F.max(F.struct("n", "id")).alias("h"))
    pairs = regions.join(heads.select("tree", "key", F.col("h.id").alias("hub")), ["tree", "key"]).filter("id <> hub")
    pairs = pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    return _crossing(pairs, joined, n).select("a", "b")


def held_together(x: list, y: list | None, cx: np.ndarray, cy: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (low, high) of components that a pair of sets links, each of ``x`` with each of ``y`` (null: with ``x``).

    Sets are distinct shingle hashes, cx and cy their components. Shingles that many of both sides have are counted by a
    product of matrices, the others by lists of who has them.
    """
    sides = [x] if y is None else [x, y]
    sizes = [np.array([len(s) for s in side], np.int64) for side in sides]
    who = [np.repeat(np.arange(len(side)), n) for side, n in zip(sides, sizes)]
    _, code = np.unique(np.concatenate([np.concatenate(side) for side in sides]), return_inverse=True)
    code = code.ravel()
    codes = [code] if y is None else [code[: len(who[0])], code[len(who[0]) :]]
    have = [np.bincount(c, minlength=code.max() + 1) for c in codes]
    if y is None:
        sizes, who, codes, have = (2 * part for part in (sizes, who, codes, have))
    (nx, ny), work = (len(n) for n in sizes), have[0] * have[1]
    many = work * 512 >= nx * ny
    common = np.zeros((nx, ny), np.float32)  # whole numbers up to 2**24
    dense = np.flatnonzero(many & (work > 0))
    place = np.full(len(work), -1)
    place[dense] = np.arange(len(dense))
    at = [place[c] for c in codes]
    for low in range(0, len(dense), 1024):
        ones = []
        for n, w, k in zip((nx, ny), who, at):
            here = (k >= low) & (k < low + 1024)
            ones.append(np.zeros((n, min(1024, len(dense) - low)), np.float32))
            ones[-1][w[here], k[here] - low] = 1
        common += ones[0] @ ones[1].T
    few = ~many & (work > 0)
    left, right = (np.flatnonzero(few[c]) for c in codes)
    right = right[np.argsort(codes[1][right], kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.where(few, have[1], 0))])
    times = have[1][codes[0][left]]
    ends = np.cumsum(times)
    done = 0
    while done < len(left):  # about four million hits at once
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + (1 << 22), "right")))
        i, t = left[done:stop], times[done:stop]
        within = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        j = right[np.repeat(starts[codes[0][i]], t) + within]
        hits = np.repeat(who[0][i], t) * ny + who[1][j]
        common += np.bincount(hits, minlength=nx * ny).reshape(nx, ny)
        done = stop
    found = []
    for low in range(0, nx, 256):
        c = common[low : low + 256].astype(np.int64)
        union = sizes[0][low : low + 256, None] + sizes[1] - c
        i, j = np.nonzero((c > 0) & (100 * c >= percent * union) & (cx[low : low + 256, None] != cy))
        pairs = np.stack([cx[i + low], cy[j]], axis=1)
        found.append(np.unique(np.sort(pairs, axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def _crowd_links(sized: DataFrame, crowded: DataFrame, joined: DataFrame | None, n: int, texts: DataFrame, percent: int) -> DataFrame | None:
    """(a, b): components linked by any two members of a crowded region, each pair of which is held against its full sets.

    ``crowded`` has id, regions (at most one a tree), ``sized`` id, n_shingles. Members of one component are not compared.
    Regions that share members are a family, which is compared whole where that is less than region by region. Its small
    components are dealt into blocks, and so is each large one, so that a task holds two blocks and never a family.
    """
    named = crowded.withColumn("c", F.col("id"))
    if joined is not None:
        hung = small(joined.select(F.col("node").alias("id"), "component_id"), n)
        named = crowded.join(hung, "id", "left").withColumn("c", F.coalesce("component_id", "id"))
    named = named.select("id", "c", F.explode("regions").alias("region"))
    mixed = named.groupBy("region").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("id").alias("a")).filter("low < high")
    named, rows = settle(named.join(mixed, "region").select("id", "c", "region", "a"))
    if not rows:
        return None
    one = F.count(F.lit(1))
    family = settle(components(named.select("a", F.col("id").alias("b"))))[0].select(F.col("node").alias("id"), F.col("component_id").alias("family"))
    placed = named.join(family, "id")
    apart = placed.groupBy("family", "region").agg(one.alias("m")).groupBy("family").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    whole = family.groupBy("family").agg(one.alias("m")).join(apart, "family").select("family", (F.col("m") * F.col("m") <= F.col("apart")).alias("whole"))
    region = F.when(F.col("whole"), -1).otherwise(F.col("region")).alias("region")
    members = placed.join(whole, "family").select("family", region, "id", "c").distinct()
    weights = sized.groupBy("id").agg(F.sum("n_shingles").alias("w"))
    members, _ = settle(members.join(weights, "id"))
    # a component that fills blocks of its own has a lane; the others share one
    unit = ["family", "region"]
    full = (F.col("m") >= MEMBERS) | (F.col("w") >= WEIGHT)
    lanes = members.groupBy(*unit, "c").agg(one.alias("m"), F.sum("w").alias("w")).withColumn("own", full)
    lanes = lanes.withColumn("lane", F.when(F.col("own"), F.col("c")).otherwise(0))
    parts = lanes.groupBy(*unit, "own", "lane").agg(F.ceil(F.greatest(F.sum("m") / MEMBERS, F.sum("w") / WEIGHT)).alias("parts"))
    named = lanes.select(*unit, "c", "own", "lane").join(parts, [*unit, "own", "lane"])
    block = lambda part: F.struct("own", "lane", part.alias("part")).alias("block")
    members = members.join(named, [*unit, "c"]).select(*unit, block(F.pmod(F.xxhash64("id"), F.col("parts"))), "id", "c")
    blocks = cut(parts.withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(*unit, block(F.col("p"))))
    pairs = blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), unit)
    pairs = pairs.filter("x <= y and not (x.own and y.own and x.lane = y.lane)").withColumn("pair", F.monotonically_increasing_id())
    pairs = cut(pairs)
    sides = pairs.select(*unit, "pair", F.col("x").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.filter("x <> y").select(*unit, "pair", F.col("y").alias("block"), F.lit(1).alias("side"))
    )
    sent, _ = settle(sides.join(members, [*unit, "block"]).select("pair", "side", "c", "id"))
    sent = sent.join(texts, "id").select("pair", "side", "c", "text")

    def compare(rows):
        import pyarrow as pa

        sets, side, c = [[], []], rows.column("side").to_numpy(), rows.column("c").to_numpy()
        of = ([], [])
        at = 0
        for batch in rows.select(["text"]).to_batches(1024):
            for i, x in shingle_sets(batch.column(0), SHINGLE):
                sets[side[at + i]].append(x)
                of[side[at + i]].append(c[at + i])
            at += batch.num_rows
        one = not sets[1]
        x, y = (np.array(k, np.int64) for k in of)
        found = held_together(sets[0], None if one else sets[1], x, x if one else y, percent) if sets[0] else np.zeros((0, 2), np.int64)
        out = pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})
        del sets, found
        give_back()
        return out

    return sent.groupBy("pair").applyInArrow(compare, "a long, b long")


def link(leaders: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(node, component_id) of the linked classes; leaders has id, sig, n_shingles and docs id, text."""
    pairs, crowded = planted(leaders)
    kin, _ = settle(agreement(pairs, leaders))
    crowded, n_crowded = settle(crowded.groupBy("id").agg(F.collect_set("region").alias("regions")))
    ids = kin.select(F.explode(F.array("a", "b")).alias("id")).unionByName(crowded.select("id"))
    members = cut(ids.distinct())
    with shelf(leaders.sparkSession) as put:
        # the one shuffle of texts: from here on they lie in buckets of their id, and rounds bring their pairs to them
        texts = put(docs.join(members, "id", "left_semi"), "id")
        return _rounds(leaders, cut(leaders.join(members, "id", "left_semi")), kin, (crowded, n_crowded), texts, percent)


def _rounds(leaders, relatives, kin, crowded, texts, percent) -> DataFrame | None:
    """Confirms pairs until no one that could join two components is left, then compares crowded regions whole.

    No pair is confirmed twice, and a round without new pairs is the last, so the rounds are finite; lineage and number
    of tasks are the same in each. One round holds members against hubs: it joins stars in linear time, and what it leaves
    is compared pair by pair.
    """
    open_pairs, joined, n_joined, links, tried = kin.filter(F.col("same") >= ALIKE), None, 0, None, None
    open_rows, hubs = 1, False
    for number in count():
        n = 0
        if open_rows:
            open_pairs, open_rows = settle(_crossing(open_pairs.select("a", "b", "same"), joined, n_joined))
            chosen, n = settle(_best(open_pairs, number)) if number < 2 else (open_pairs.select("a", "b"), open_rows)
        if not n:
            if joined is None or hubs:
                break
            hubs = True
            near = _hub_pairs(relatives, links, joined, n_joined)
            near, n = settle(near.join(small(*tried), ["a", "b"], "left_anti"))
            if n:
                chosen, n = settle(agreement(near, leaders, n).filter(F.col("same") >= ALIKE).select("a", "b"))
            if not n:
                break
        found, n_found = settle(confirm(chosen, texts, percent, n))
        if n_found:
            links = found if links is None else settle(links.unionByName(found))[0]
            joined, n_joined = settle(components(links))
        tried = (chosen, n) if tried is None else settle(tried[0].unionByName(chosen))
        if open_rows:
            open_pairs = open_pairs.join(small(chosen, n), ["a", "b"], "left_anti")
            open_rows = max(open_rows - n, 0)
    more = _crowd_links(relatives, crowded[0], joined, n_joined, texts, percent) if crowded[1] else None
    if more is None:
        return joined
    folded = more if joined is None else more.unionByName(joined.select(F.col("component_id").alias("a"), F.col("node").alias("b")))
    return components(folded)


def exact_classes(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``first``, the smallest key among those with an equal set; null where the set is empty.

    A class is dealt into parts by a hash of the key, so that thousands of copies meet in no one task.
    """
    salted = rows.filter("n_shingles > 0").withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    cells = salted.groupBy("h1", "h2", "salt").agg(F.min(key).alias("low"))  # rows without a key are a cell, without low
    firsts = cells.groupBy("h1", "h2").agg(F.min("low").alias("first"), F.collect_list("salt").alias("salts"))
    known = firsts.select("h1", "h2", "first", F.explode("salts").alias("salt"))
    named = salted.join(known, ["h1", "h2", "salt"]).drop("salt")
    return named.unionByName(rows.filter("n_shingles = 0"), allowMissingColumns=True)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; the key is read as a long."""
    rows = cut(signatures(df, key, text))
    named = exact_classes(rows, key)
    leaders = cut(named.filter(F.col(key) == F.col("first")).select(F.col(key).alias("id"), "sig", "n_shingles"))
    joined = link(leaders, df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")), percent)
    # rows that share an id are one document: their classes' leaders are linked through it
    twice = named.filter(F.col("first").isNotNull()).groupBy(key).agg(F.count_distinct("first").alias("n")).filter("n > 1")
    same = named.join(twice.select(key), key, "left_semi").filter(F.col("first") != F.col(key))
    same = cut(same.select(F.col("first").alias("a"), F.col(key).alias("b")))
    if same.limit(1).count():
        folded = joined.select(F.col("component_id").alias("a"), F.col("node").alias("b")) if joined is not None else same.limit(0)
        joined = components(folded.unionByName(same))
    if joined is None:
        joined = named.sparkSession.createDataFrame([], "node long, component_id long")
    out = named.join(joined.withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce(F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "first")), F.col(key))
    return out.select(key, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull())
    )


def op4_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
