"""Packing of tokenised documents into fixed windows by best-fit decreasing.

Every document is tokenised whole and ended by one id. Overlong documents are cut into full windows and a rest; each
packer then takes its pieces longest first and puts each into the open window with the least room that still holds it,
which a segment tree over remaining capacities finds in logarithmic time. Packers are the partitions of one small
shuffle that carries lengths and digests, no ids unless asked for, and each works in pools of bounded size.

Defined cases: null and empty texts are the end id alone; null or repeated ids cost no row; very long texts are
tokenised in slices and cut into as many windows as they fill; ties in length go by a hash of digest, key and start, so
that a run repeats on the same splits; an empty table gives no piece. Of the input's columns only the key is carried
along; a key named like an output is not supported.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, partitions, table
from .hashing import values

WINDOW = 4096
END_ID = 2
POOL = 200_000
#: Bytes of text that are tokenised at once; a longer document is tokenised in slices that end between chunks.
SLICE = 1 << 21
#: Chunks whose ids a worker remembers; beyond, it forgets them all.
_CACHE = 250_000
_BREAK = "\x01"
#: Characters that are split from a letter before them, where the vocabulary does so too.
_STOPS = b",.!?;:#$%&*"
_LONGEST = 48


class Merges:
    """Byte-pair merges of many words at once: in each round every word of a length joins its first pair of least rank."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        import numpy as np

        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))  # bytes that do not print are named by the characters from 256 on
        names = [chr(b) if b in plain else chr(next(other)) for b in range(256)]
        self.inner = np.array([vocabulary[x] for x in names], np.int64)
        self.last = np.array([vocabulary[x + suffix] for x in names], np.int64)
        self.base = max(vocabulary.values()) + 1
        pairs = [x if isinstance(x, (list, tuple)) else x.split(" ") for x in merges]
        keys = np.array([vocabulary[a] * self.base + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.order, self.made = keys[order], order, made
        self.none = len(made)

    def ranks(self, left, right):
        import numpy as np

        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], self.none)

    def encode(self, words: list[bytes]):
        """(ids of all words after one another, number of ids of each); no word is empty."""
        import numpy as np

        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        sizes, done = np.zeros(len(words), np.int64), []
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n)
            raw = data[begins[rows][:, None] + np.arange(n)]
            ids = np.concatenate([self.inner[raw[:, :-1]], self.last[raw[:, -1:]]], axis=1)
            rank = self.ranks(ids[:, :-1], ids[:, 1:])
            while len(rows):
                if ids.shape[1] > 1:
                    at = rank.argmin(axis=1)
                    low = rank[np.arange(len(rows)), at]
                    over = low == self.none
                else:
                    over = np.ones(len(rows), bool)
                if over.any():
                    sizes[rows[over]] = ids.shape[1]
                    done.append((rows[over], ids[over]))
                    if over.all():
                        break
                    rows, ids, rank, at, low = (x[~over] for x in (rows, ids, rank, at, low))
                each, column = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
                ids = np.where(column < at[:, None], ids[:, :-1], ids[:, 1:])
                ids[each, at] = self.made[low]
                rank = np.where(column[:-1] < at[:, None], rank[:, :-1], rank[:, 1:])
                has = np.flatnonzero(at > 0)
                rank[has, at[has] - 1] = self.ranks(ids[has, at[has] - 1], ids[has, at[has]])
                has = np.flatnonzero(at < ids.shape[1] - 1)
                rank[has, at[has]] = self.ranks(ids[has, at[has]], ids[has, at[has] + 1])
        flat, starts = np.empty(int(sizes.sum()), np.uint32), np.cumsum(sizes) - sizes
        for rows, ids in done:
            flat[starts[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, sizes


def _merges(path: str) -> Merges | None:
    """The merges of a vocabulary whose words are runs of letters, in lower case, byte by byte with an end mark."""
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers") or []]
    fits = (
        model.get("type") == "BPE" and model.get("end_of_word_suffix") and not any(
            model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        )
        and kinds == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in before] == ["Split", "ByteLevel"]
        and "[\\p{L}]+" in str(before[0]["pattern"].get("Regex"))
        and not before[1].get("add_prefix_space") and not before[1].get("use_regex")
    )
    return Merges(model["vocab"], model["merges"], model["end_of_word_suffix"]) if fits else None


class Chunks:
    """Ids of what stands between blanks. The tokenizer never joins across a blank, so each form is encoded once.

    A chunk is looked up in lower case where the vocabulary's normaliser lowers it, and punctuation after a letter is a
    chunk of its own where the vocabulary parts it as well. New chunks of Latin letters alone go through the vocabulary's
    merges here, many at once; all others through the library, together, parted by a character that is one id.
    """

    def __init__(self, tokenizer, path: str | None = None, end_id: int = 2):
        import numpy as np

        self.tokenizer = tokenizer
        found = self._alone(f"a {_BREAK} a")
        self.parted = found[1] if len(found) == 3 and found[0] == found[2] else None
        self.lower = np.arange(256, dtype=np.uint8)
        if self._alone("AZ Aé'S") == self._alone("az aé's"):
            self.lower[65:91] = self.lower[97:123]
        self.stop = np.zeros(256, bool)
        for c in map(chr, _STOPS):
            tails = (c, c * 3, c + "'s", c + "a")
            self.stop[ord(c)] = all(self._alone(a + t) == self._alone(a) + self._alone(t) for t in tails for a in ("a", "é"))
        self.letter = np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.end_id = end_id
        self.merges = _merges(path) if path else None
        if self.merges is not None:
            words = [x.encode() for x in ("a", "the", "straße", "élève", "uncharacteristically", "zzzzqxj", "ñandú", "aaaaaaaaaa")]
            if not all(self._merged([w]) == self._alone(w.decode()) for w in words):
                self.merges = None
        self._forget()

    def _alone(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _merged(self, words: list[bytes]) -> list[int]:
        return self.merges.encode(words)[0].tolist()

    def _forget(self) -> None:
        import numpy as np

        self.slots: dict[bytes, int] = {}
        self.pool = np.array([self.end_id], "<u4")  # slot 0 is the end of a document
        self.begin, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _remember(self, names: list[bytes], flat, sizes) -> None:
        import numpy as np

        first = len(self.begin)
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, flat.astype("<u4")])
        self.slots.update(zip(names, range(first, first + len(names))))

    def _simple(self, chunk: bytes) -> bytes | None:
        """What the merges start from, for a chunk of Latin letters."""
        if len(chunk) > _LONGEST:
            return None
        if chunk.isascii():
            return chunk.lower() if chunk.isalpha() else None
        text = chunk.decode()
        low = text.lower()
        return low.encode() if max(text) < "ɐ" and text.isalpha() and low.isalpha() and max(low) < "ɐ" else None

    def learn(self, names: list[bytes]) -> None:
        import numpy as np

        simple = [(c, s) for c in names if (s := self._simple(c)) is not None] if self.merges is not None else []
        if simple:
            self._remember([c for c, _ in simple], *self.merges.encode([s for _, s in simple]))
        others = [c for c in names if c not in self.slots]
        joined = [c for c in others if self.parted is not None and b"<" not in c and _BREAK.encode() not in c]
        for low in range(0, len(joined), 4000):
            some = joined[low : low + 4000]
            text = f" {_BREAK} ".join(c.decode() for c in some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ids == self.parted)
            if len(at) == len(some) - 1:
                self._remember(some, np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1)
        for c in others:
            if c not in self.slots:
                ids = self._alone(c.decode())
                self._remember([c], np.array(ids, "<u4"), np.array([len(ids)], np.int64))

    def ids_of(self, data, bounds, whole: bool = True):
        """(ids, bounds in them) of the documents between ``bounds`` of the bytes; an end id after each if ``whole``."""
        import numpy as np
        import pyarrow as pa

        blank = (data == 32) | (data == 10)
        held = ~blank
        opens = held.copy()
        opens[1:] &= blank[:-1]
        inside = bounds[bounds < len(data)]
        opens[inside] = held[inside]
        marks = np.flatnonzero(data == 60)
        low = self.lower[data]
        if len(marks):  # the names of special ids are case-sensitive
            chunk_at = np.flatnonzero(opens)
            ends = np.append(chunk_at[1:], len(data))
            for k in np.unique(np.searchsorted(chunk_at, marks, "right") - 1).tolist():
                low[chunk_at[k] : ends[k]] = data[chunk_at[k] : ends[k]]
        letter = self.letter[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        opens[1:] |= letter[:-1] & self.stop[data[1:]]
        starts = np.flatnonzero(opens)
        chunks = np.zeros(0, np.int64)
        if len(starts):
            packed = np.cumsum(held, dtype=np.int32)
            offsets = np.append(packed[starts] - 1, packed[-1]).astype(np.int32)
            listed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[held])]).dictionary_encode()
            names = listed.dictionary.to_pylist()
            new = [c for c in names if c not in self.slots]
            if new and len(self.slots) + len(new) > _CACHE:
                self._forget()
                new = names
            if new:
                self.learn(new)
            slots = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))
            chunks = slots[listed.indices.to_numpy()]
        before = np.searchsorted(starts, bounds)
        if whole:
            chunks, before = np.insert(chunks, before[1:], 0), before + np.arange(len(before))
        sizes = self.size[chunks]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.begin[chunks] - sums[:-1], sizes) + np.arange(sums[-1])]
        return ids, sums[before]


_loaded: dict[tuple, Chunks] = {}


def _chunks(path: str | None, end_id: int = END_ID) -> Chunks:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if (path, end_id) not in _loaded:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _loaded[path, end_id] = Chunks(Tokenizer.from_file(str(path)), str(path), end_id)
    return _loaded[path, end_id]


def token_ids(column, chunks: Chunks):
    """Yields the ids of each text of an Arrow column, with the end id."""
    import numpy as np

    data, offsets = values(column)
    doc, n = 0, len(column)
    while doc < n:
        last = int(np.searchsorted(offsets, offsets[doc] + SLICE, "right")) - 1
        last = min(max(last, doc + 1), n)
        part = data[offsets[doc] : offsets[last]]
        if len(part) <= SLICE:
            ids, at = chunks.ids_of(part, offsets[doc : last + 1] - offsets[doc])
            yield from (ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
        else:
            found, at = [], 0
            while at < len(part):
                end = min(at + SLICE, len(part))
                while end < len(part):
                    gaps = np.flatnonzero((part[at:end] == 32) | (part[at:end] == 10))
                    if len(gaps):
                        end = at + int(gaps[-1]) + 1
                        break
                    end = min(end + SLICE, len(part))
                found.append(chunks.ids_of(part[at:end], np.array([0, end - at]), whole=False)[0])
                at = end
            yield np.concatenate([*found, np.array([chunks.end_id], "<u4")])
        doc = last


def tokenised_pieces(
    df: DataFrame, key: str, text: str, window: int, end_id: int, tokenizer: str | None, with_ids: bool
) -> DataFrame:
    """A row a piece: key, start, length, ids_crc32, doc_tokens, order (in its task), ids where asked for."""
    fields = [
        T.StructField(key, df.schema[key].dataType),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "order")),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ]

    def cut_up(batches):
        import pyarrow as pa

        chunks, order = _chunks(tokenizer, end_id), 0
        for batch in batches:
            rows, columns = [], [[] for _ in range(6)]
            for row, ids in enumerate(token_ids(batch.column(1), chunks)):
                for at in range(0, len(ids), window):
                    piece = ids[at : at + window].tobytes()
                    rows.append(row)
                    for column, x in zip(columns, (at, len(piece) // 4, zlib.crc32(piece), len(ids), order, piece if with_ids else None)):
                        column.append(x)
                    order += 1
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns[:5])]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return df.select(key, text).mapInArrow(lean(cut_up), T.StructType(fields))


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(n)`` is the least capacity of at least n that some window has."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.counts = [0] * (2 * self.leaves)
        self.windows: dict[int, list[int]] = {}

    def add(self, capacity: int, window: int) -> None:
        self.windows.setdefault(capacity, []).append(window)
        self._change(capacity, 1)

    def take(self, capacity: int) -> int:
        self._change(capacity, -1)
        return self.windows[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.counts[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        node = self.leaves + least
        if self.counts[node]:
            return least
        while node > 1:  # up until a right sibling holds a window, then down to its leftmost one
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node *= 2
                    if not self.counts[node]:
                        node += 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int], int]:
    """(window of each piece, offset there, number of windows)."""
    tree, placed, offsets, opened = CapacityTree(window), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        room = tree.tightest(n)
        if room is None:
            room, number, opened = window, opened, opened + 1
        else:
            number = tree.take(room)
        placed[i], offsets[i] = number, window - room
        if room > n:
            tree.add(room - n, number)
    return placed, offsets, opened


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
    packers: int | None = None,
) -> DataFrame:
    """A row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids where asked for.

    ``tokenizer`` is the path of a vocabulary file on every worker, ``packers`` the number of independent packers.
    """
    pieces = tokenised_pieces(df, key, text, window, end_id, tokenizer, with_ids)
    dealt = pieces.repartition(packers or partitions(df.sparkSession), "order", "ids_crc32", key)
    # blocks of a shuffle arrive in any order; a hash of the rows' own values fixes the order they are packed in
    dealt = dealt.sortWithinPartitions(F.xxhash64("ids_crc32", key, "start"), key, "start", "ids_crc32", "doc_tokens")
    schema = T.StructType(
        [f for f in pieces.schema if f.name not in ("order", "ids")]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
        + [f for f in pieces.schema if f.name == "ids"]
    )

    def fill(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first, held, rows = TaskContext.get().partitionId() << 40, [], 0

        def pool():
            nonlocal first
            whole = pa.Table.from_batches(held)
            placed, offsets, opened = best_fit_decreasing(whole.column("length").to_pylist(), window)
            whole = whole.append_column("sequence_id", pa.array([first + x for x in placed], pa.int64()))
            whole = whole.append_column("offset", pa.array(offsets, pa.int64()))
            first += opened
            return whole.select([f.name for f in schema]).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= POOL:
                yield from pool()
                held, rows = [], 0
        if rows:
            yield from pool()

    return dealt.mapInArrow(lean(fill), schema)


def op10_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
