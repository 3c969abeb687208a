"""Removal of repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

Texts lie in runs, each a checkpointed row of some megabytes. A 200-byte string is represented by one position in it,
the anchor: the smallest rolling hash of a 100-byte gram among those that start in its first 101 bytes. Equal strings
have the same anchor in the same place, so only suffixes at anchors need sorting, one in about fifty. Anchors whose gram
occurs once in the corpus cannot be in a repeat; each run names its distinct gram hashes once and learns which recur.

The suffixes at the rest (200 bytes, then what precedes the anchor, backwards) are sorted within their run, coded by the
length shared with the suffix before and what follows, and exchanged by gram. A loser tree merges the runs: each
contender carries the length that it shares with the last suffix out, and what is known to be shared is never compared
again. In the merged order, suffixes with a gram in common are neighbours, and how far each matches any other, to the
right and to the left, with at least 200 bytes in all, is what it covers.

Defined cases: null and empty texts have no bytes; invalid surrogates cannot occur in Spark strings; repeated rows and
ids are rows of their own, so a row that occurs twice is removed twice; a very long text is a run of its own; equal strings
are one entry of the order, whatever their number; an empty table gives none; of the input's columns only the key is
carried along, and a key named like an output is not supported.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, partitions, table
from .hashing import values

LENGTH = 200
#: Bytes of text in a run, positions hashed at once, suffixes sorted at once, bytes of text for each bucket of grams.
RUN, CHUNK, SORTED, BUCKET = 8 << 20, 1 << 19, 60_000, 16 << 20
_PAD = 0xFF  # no UTF-8 byte: what is beyond a document's ends
_LOW = (1 << 24) - 1


def runs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (run, keys, sizes, data): whole documents, RUN bytes or one longer document together."""
    schema = T.StructType(
        [
            T.StructField("run", T.LongType()),
            T.StructField("keys", T.ArrayType(df.schema[key].dataType)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def gather(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number, keys, sizes, parts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def row():
            nonlocal number
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(parts))
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(keys)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([data], pa.binary()),
                ],
                schema.names,
            )
            number += 1
            return made

        for batch in batches:
            data, offsets = values(batch.column(1))
            doc, n = 0, batch.num_rows
            while doc < n:
                last = int(np.searchsorted(offsets, offsets[doc] + max(RUN - held, 0), "right")) - 1
                last = min(max(last, doc if held else doc + 1), n)
                if last > doc:
                    keys.append(batch.column(0).slice(doc, last - doc))
                    sizes += np.diff(offsets[doc : last + 1]).tolist()
                    parts.append(data[offsets[doc] : offsets[last]].tobytes())
                    held += int(offsets[last] - offsets[doc])
                doc = last
                if doc < n:
                    yield row()
                    keys, sizes, parts, held = [], [], [], 0
        if sizes:
            yield row()

    return df.select(key, text).mapInArrow(gather, schema)


def unpack(data: bytes, sizes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return whole, np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors of all strings of ``length`` bytes, in order."""
    from .hashing import _BASE, powers

    gram = length // 2
    window, n = length - gram + 1, len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = np.ones(n, bool)  # whether a string of the length starts here and ends in the same document
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        whole[max(begin, end - length + 1) : end] = False
    numbers = np.random.Generator(np.random.PCG64(41)).integers(1, 1 << 63, 256, np.uint64)
    up, down = powers(1 << (CHUNK + 2 * length).bit_length())
    places, hashes = [], []
    for start in range(0, n - length + 1, CHUNK):
        part = data[start : start + CHUNK + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(numbers[part] * up[: len(part)], out=sums[1:])
        grams = (sums[gram:] - sums[: len(part) - gram + 1]) * down[: len(part) - gram + 1]
        grams *= np.uint64(_BASE)
        grams ^= grams >> np.uint64(33)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        # sliding minimum with the place in the low bits, by doubling
        low = (grams & np.uint64(~_LOW & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)
        reach = 1
        while 2 * reach <= window:
            low = np.minimum(low[: len(low) - reach], low[reach:])
            reach *= 2
        if reach < window:
            low = np.minimum(low[: len(low) - (window - reach)], low[window - reach :])
        at = (low & np.uint64(_LOW)).astype(np.int64)[whole[start : start + len(low)]]
        if len(at):
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            places.append(at + start)
            hashes.append(grams[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, value = np.concatenate(places), np.concatenate(hashes)
    new = np.concatenate([[True], place[1:] != place[:-1]])  # slices share an anchor at most
    return place[new], value[new]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def suffixes(data, offsets, places, length: int) -> np.ndarray:
    """(anchors, length + left) bytes: what follows each anchor, then what precedes it, backwards."""
    from numpy.lib.stride_tricks import sliding_window_view

    left = length - length // 2
    doc = np.searchsorted(offsets, places, "right") - 1
    padded = np.concatenate([np.full(left, _PAD, np.uint8), data, np.full(length, _PAD, np.uint8)])
    out = np.empty((len(places), length + left), np.uint8)
    out[:, :length] = sliding_window_view(padded, length)[places + left]
    out[:, length:] = sliding_window_view(padded, left)[places][:, ::-1]
    out[:, :length][np.arange(length) >= (offsets[doc + 1] - places)[:, None]] = _PAD
    out[:, length:][np.arange(left) >= (places - offsets[doc])[:, None]] = _PAD
    return out


def front_code(strings: np.ndarray, places: np.ndarray) -> bytes:
    """A sorted run: distinct strings by the length shared with the one before and the rest, and their places."""
    import zstandard

    width = strings.shape[1]
    order = np.argsort(strings.view(f"S{width}").ravel(), kind="stable")
    strings, places = strings[order], places[order]
    differ = strings[1:] != strings[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    first = np.concatenate([[True], shared < width])
    at = np.flatnonzero(first)
    shared = np.concatenate([[0], shared])[at].astype(np.uint16)
    rest = strings[at][np.arange(width) >= shared[:, None]]
    counts = np.diff(np.append(at, len(places))).astype(np.uint32)
    head = np.array([len(at), len(places)], np.uint32)
    blob = b"".join(x.tobytes() for x in (head, counts, places.astype(np.uint32), shared, rest))
    return zstandard.ZstdCompressor(level=3).compress(blob)


class Stream:
    """A coded run, read string by string."""

    def __init__(self, run: int, blob: bytes, width: int):
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, m = np.frombuffer(raw, np.uint32, 2)
        n, m = int(n), int(m)
        counts = np.frombuffer(raw, np.uint32, n, 8)
        self.places = np.frombuffer(raw, np.uint32, m, 8 + 4 * n)
        self.bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.shared = np.frombuffer(raw, np.uint16, n, 8 + 4 * (n + m)).tolist()
        self.rest = raw[8 + 4 * (n + m) + 2 * n :]
        self.run, self.width, self.next, self.at, self.string = run, width, 0, 0, b""

    def step(self) -> int:
        """Moves on; the length shared with the string before, -1 at the end."""
        if self.next == len(self.shared):
            return -1
        shared = self.shared[self.next]
        size = self.width - shared
        self.string = self.string[:shared] + self.rest[self.at : self.at + size]
        self.at += size
        self.next += 1
        return shared

    def found(self) -> np.ndarray:
        return self.places[self.bounds[self.next - 1] : self.bounds[self.next]]


def merge(streams: list[Stream], width: int):
    """Yields (stream, length shared with the string that came out before) in order, from a tree of losers.

    A contender's ``known`` is what it shares with the last string out. Where two differ in it, the larger wins
    unread; where they agree, reading starts behind it.
    """
    k = 1
    while k < len(streams):
        k *= 2
    known = [s.step() for s in streams] + [-1] * (k - len(streams))
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = known[a], known[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = streams[a].string, streams[b].string
        while x < width and s[x : x + 16] == t[x : x + 16]:
            x += 16
        while x < width and s[x] == t[x]:
            x += 1
        if x >= width:
            known[b] = width
            return a, b
        if s[x] < t[x]:
            known[b] = x
            return a, b
        known[a] = x
        return b, a

    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        ahead = []
        for i in range(0, len(level), 2):
            won, lost = play(level[i], level[i + 1])
            loser[node + i // 2] = lost
            ahead.append(won)
        level = ahead
    best = level[0]
    while known[best] >= 0:
        yield streams[best], known[best]
        known[best] = streams[best].step()
        node = (best + k) // 2
        while node:
            other = loser[node]
            x, y = known[best], known[other]
            if x < y:
                loser[node], best = best, other
            elif x == y and x >= 0:
                best, loser[node] = play(best, other)
            node //= 2


def reach(keys: list[bytes], shared: list[int], counts: list[int], length: int) -> list[tuple[int, int]]:
    """(left, right) that each string of one gram covers around its anchor; ``shared`` is with the string before.

    Pairs are met by falling length shared to the right. Each set of strings that share as much is kept in the order
    of what precedes the anchors, so that a string's longest match to the left is one of its neighbours there; the
    smaller set is inserted into the larger.
    """
    pad = bytes([_PAD])
    n = len(keys)
    back = [k[length:] for k in keys]
    right = [len(k[:length].rstrip(pad)) for k in keys]
    left = [len(b.rstrip(pad)) for b in back]
    out = [(left[i], right[i]) if counts[i] > 1 and left[i] + right[i] >= length else (0, 0) for i in range(n)]

    def meet(i: int, j: int, t: int) -> None:
        r = min(t, right[i], right[j])
        if r + min(left[i], left[j]) < length:
            return
        x, most, a, b = 0, min(left[i], left[j]), back[i], back[j]
        while x < most and a[x : x + 16] == b[x : x + 16]:
            x += 16
        x = min(x, most)
        while x < most and a[x] == b[x]:
            x += 1
        if r + x >= length:
            for k in (i, j):
                out[k] = (max(out[k][0], x), max(out[k][1], r))

    if n <= 8:
        for i in range(n):
            t = length
            for j in range(i + 1, n):
                t = min(t, shared[j])
                meet(i, j, t)
        return out
    sets = [[(back[i], i)] for i in range(n)]
    owner = list(range(n))

    def find(x: int) -> int:
        while owner[x] != x:
            owner[x] = owner[owner[x]]
            x = owner[x]
        return x

    for j in sorted(range(1, n), key=lambda j: -min(shared[j], length)):
        t = min(shared[j], length)
        a, b = find(j - 1), find(j)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large = sets[a]
        for item in sets[b]:
            at = bisect_left(large, item)
            if at:
                meet(item[1], large[at - 1][1], t)
            if at < len(large):
                meet(item[1], large[at][1], t)
            large.insert(at, item)
        sets[b] = []
        owner[b] = a
    return out


def covered(df: DataFrame, length: int) -> DataFrame:
    """(run, spans): int64 pairs (start, end) in a run's bytes that repeats cover, from checkpointed runs.

    Grams are dealt into buckets by the bytes of text, so that a bucket, which one task holds, does not grow with the input.
    """
    held = df.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    n = max(partitions(df.sparkSession), -(-held // BUCKET))
    width = length + length - length // 2

    def name_grams(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                data, offsets = unpack(batch.column(2)[row].as_py(), batch.column(1)[row].as_py())
                _, hashes = anchors(data, offsets, length)
                hashes, counts = np.unique(hashes, return_counts=True)
                own = bucket_of(hashes, n)
                order = np.argsort(own, kind="stable")
                ends = np.searchsorted(own[order], np.arange(n + 1))
                made = [b for b in range(n) if ends[b] < ends[b + 1]]
                parts = [order[ends[b] : ends[b + 1]] for b in made]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(made, pa.int32()),
                            pa.array([batch.column(0)[row].as_py()] * len(made), pa.int64()),
                            pa.array([hashes[p].tobytes() for p in parts], pa.binary()),
                            pa.array([(counts[p] > 1).tobytes() for p in parts], pa.binary()),
                        ],
                        ["bucket", "run", "hashes", "twice"],
                    )

    def recurring(whole):
        import pyarrow as pa

        parts = [np.frombuffer(x, np.uint64) for x in whole["hashes"].to_pylist()]
        twice = np.frombuffer(b"".join(whole["twice"].to_pylist()), bool)
        every = np.concatenate(parts)
        names, back, counts = np.unique(every, return_inverse=True, return_counts=True)
        again = counts > 1
        again[back[twice]] = True
        flags, at, out = again[back], 0, []
        for p in parts:
            out.append(p[flags[at : at + len(p)]].tobytes())
            at += len(p)
        return pa.table({"run": whole["run"], "grams": pa.array(out, pa.binary())})

    named = df.select("run", "sizes", "data").mapInArrow(name_grams, "bucket int, run long, hashes binary, twice binary")
    known = (
        named.repartition(n, "bucket").groupBy("bucket").applyInArrow(recurring, "run long, grams binary").filter("length(grams) > 0")
        .groupBy("run").agg(F.collect_list("grams").alias("grams"))  # no more than a run has anchors
    )

    def sort_runs(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                data, offsets = unpack(batch.column(2)[row].as_py(), batch.column(1)[row].as_py())
                places, hashes = anchors(data, offsets, length)
                grams = np.frombuffer(b"".join(batch.column(3)[row].as_py()), np.uint64)
                held = np.isin(hashes, grams)
                places, own = places[held], bucket_of(hashes[held], n)
                order = np.argsort(own, kind="stable")
                places, own = places[order], own[order]
                for low in range(0, len(places), SORTED):
                    part, buckets = places[low : low + SORTED], own[low : low + SORTED]
                    strings = suffixes(data, offsets, part, length)
                    ends = np.searchsorted(buckets, np.arange(n + 1))
                    made = [b for b in range(n) if ends[b] < ends[b + 1]]
                    blobs = [front_code(strings[ends[b] : ends[b + 1]], part[ends[b] : ends[b + 1]]) for b in made]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(made, pa.int32()), pa.array([batch.column(0)[row].as_py()] * len(made), pa.int64()), pa.array(blobs, pa.binary())],
                        ["bucket", "run", "blob"],
                    )

    def merge_runs(whole):
        import pyarrow as pa

        streams = [Stream(r, b, width) for r, b in zip(whole["run"].to_pylist(), whole["blob"].to_pylist())]
        spans: dict[int, list[np.ndarray]] = {}
        keys, shared, counts, found = [], [], [], []

        def close():
            for (l, r), places in zip(reach(keys, shared, counts, length), found):
                if r:
                    for run, at in places:
                        at = at.astype(np.int64)
                        spans.setdefault(run, []).append(np.stack([at - l, at + r], axis=1))
            for x in (keys, shared, counts, found):
                x.clear()

        for stream, common in merge(streams, width):
            places = stream.found()
            if common >= width and keys:
                counts[-1] += len(places)
                found[-1].append((stream.run, places))
                continue
            if common < length // 2 and keys:
                close()
            keys.append(stream.string)
            shared.append(common)
            counts.append(len(places))
            found.append([(stream.run, places)])
        if keys:
            close()
        return pa.table(
            {"run": pa.array(list(spans), pa.int64()), "spans": pa.array([np.concatenate(x).tobytes() for x in spans.values()], pa.binary())}
        )

    candidates = df.select("run", "sizes", "data").join(known, "run")
    exchanged = candidates.select("run", "sizes", "data", "grams").mapInArrow(sort_runs, "bucket int, run long, blob binary")
    return exchanged.repartition(n, "bucket").groupBy("bucket").applyInArrow(merge_runs, "run long, spans binary")


def removed(size: int, spans: np.ndarray) -> np.ndarray:
    """Which bytes lie in a span."""
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, spans[:, 0], 1)
    np.subtract.at(depth, spans[:, 1], 1)
    return np.cumsum(depth[:size], dtype=np.int32, out=depth[:size]) > 0


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): every document's bytes without those that repeats cover."""
    held = cut(runs(df, key, text))
    spans = covered(held, length).groupBy("run").agg(F.collect_list("spans").alias("spans"))
    schema = T.StructType(
        [df.schema[key], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())]
    )

    def take_out(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                data, offsets = unpack(batch.column(3)[row].as_py(), batch.column(2)[row].as_py())
                marks = batch.column(4)[row].as_py()
                pairs = np.frombuffer(b"".join(marks or []), np.int64).reshape(-1, 2)
                gone = removed(len(data), pairs)
                keys = batch.column(1).slice(row, 1).flatten()
                for low in range(0, len(keys), 2000):
                    ends = offsets[low : low + 2001].tolist()
                    docs, taken, parts = [], [], []
                    for a, b in zip(ends[:-1], ends[1:]):
                        mark = gone[a:b]
                        taken.append(int(np.count_nonzero(mark)))
                        parts.append(int(mark[0]) + int(np.count_nonzero(mark[1:] & ~mark[:-1])) if taken[-1] else 0)
                        docs.append((data[a:b][~mark] if taken[-1] else data[a:b]).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(low, len(docs)), pa.array(np.diff(ends)), pa.array(taken, pa.int64()), pa.array(parts, pa.int64()), pa.array(docs, pa.binary())],
                        schema.names,
                    )

    return held.join(spans, "run", "left").select("run", "keys", "sizes", "data", "spans").mapInArrow(take_out, schema)


def op9_repeated_strings(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
