"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded sample of labelled documents. It
reads a text as windows of bytes, labels every position from both directions, and a document's probabilities are the
mean of those of all its positions.

Defined cases: a null text and a text without a letter are ``und`` with score 0; a null id is never learned from and
not held out; without any labelled row every text is ``und``; ties go to the label that sorts first; very long texts are
read whole, in slices; rows that repeat are labelled one by one; an empty table gives an empty one; of the input's columns
only the key is carried along, and a key named like an output is not supported.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, small, table
from .hashing import values

WINDOW = 64
HIDDEN = 8
#: Sampled documents a label at most, of all labels about (one of each at least), and code points of each.
SAMPLE, WHOLE, SLICE = 400, 25_600, 800
STEPS, BATCH, RATE = 500, 192, 0.02
_LANES = 2048


@dataclass
class Model:
    """Rows of ``table`` are gates (update, reset, new) by direction; see ``_run`` for the equations."""

    labels: list[str]
    table: np.ndarray  # (2, 3 * hidden, 257); 256 stands for "after the end"
    inner: np.ndarray  # (2, 3 * hidden, hidden)
    out: np.ndarray  # (2, labels, hidden)
    bias: np.ndarray  # (labels,)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Sums over the positions of each window: (windows, labels). ``windows`` is (windows, WINDOW), 256 padded."""
        n, length = windows.shape
        total = np.zeros((n, len(self.labels)), np.float32)
        for at in range(0, n, _LANES):
            part = np.ascontiguousarray(windows[at : at + _LANES].T)
            lanes, hidden = part.shape[1], self.inner.shape[2]
            logits = np.empty((length, len(self.labels), lanes), np.float32)
            for d, order in ((0, range(length)), (1, range(length - 1, -1, -1))):
                state = np.zeros((hidden, lanes), np.float32)
                taken = np.empty((3 * hidden, lanes), np.float32)
                pushed = np.empty((3 * hidden, lanes), np.float32)
                # tanh of half its argument gives a gate: fold the half into the weights
                half = np.ones((3 * hidden, 1), np.float32)
                half[: 2 * hidden] = 0.5
                gates, inner = np.ascontiguousarray(self.table[d] * half), np.ascontiguousarray(self.inner[d] * half)
                for t in order:
                    np.take(gates, part[t], axis=1, out=taken, mode="clip")
                    np.matmul(inner, state, out=pushed)
                    both, new = taken[: 2 * hidden], taken[2 * hidden :]
                    both += pushed[: 2 * hidden]
                    np.tanh(both, out=both)
                    both *= 0.5
                    both += 0.5
                    pushed[2 * hidden :] *= both[hidden:]
                    new += pushed[2 * hidden :]
                    np.tanh(new, out=new)
                    state -= new
                    state *= both[:hidden]
                    state += new
                    if d == 0:
                        np.matmul(self.out[0], state, out=logits[t])
                        logits[t] += self.bias[:, None]
                    else:
                        scores = logits[t]
                        scores += self.out[1] @ state
                        scores -= scores.max(axis=0)
                        np.exp(scores, out=scores)
                        scores *= (part[t] < 256) / scores.sum(axis=0)
            total[at : at + _LANES] = logits.sum(axis=0).T
        return total


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, windows before each text and at the end); a last window is padded with 256."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    before = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    inside = (np.arange(before[-1]) - before[owner]) * WINDOW
    place = inside[:, None] + np.arange(WINDOW)
    absolute = np.minimum(place + offsets[owner][:, None], max(len(data) - 1, 0))
    windows = data[absolute].astype(np.int16) if before[-1] else np.zeros((0, WINDOW), np.int16)
    windows[place >= sizes[owner][:, None]] = 256
    return windows, before


def _run(table, inner, windows, order):
    """States and gates of one direction in training: lists by position of (state before, update, reset, new, pushed)."""
    hidden, lanes = inner.shape[1], windows.shape[1]
    state, steps, states = np.zeros((hidden, lanes), np.float32), {}, {}
    for t in order:
        taken, pushed = table[:, windows[t]], inner @ state
        update = 1 / (1 + np.exp(-(taken[:hidden] + pushed[:hidden])))
        reset = 1 / (1 + np.exp(-(taken[hidden : 2 * hidden] + pushed[hidden : 2 * hidden])))
        new = np.tanh(taken[2 * hidden :] + reset * pushed[2 * hidden :])
        steps[t] = (state, update, reset, new, pushed[2 * hidden :])
        state = (1 - update) * new + update * state
        states[t] = state
    return states, steps


def _gradients(model: Model, windows: np.ndarray, wanted: np.ndarray):
    """(loss, gradients of table, inner, out, bias) of the mean cross entropy over the positions before the end."""
    length, lanes = windows.shape
    hidden = model.inner.shape[2]
    orders = (list(range(length)), list(range(length - 1, -1, -1)))
    runs = [_run(model.table[d], model.inner[d], windows, orders[d]) for d in (0, 1)]
    mask = (windows < 256).astype(np.float32)
    mask /= mask.sum()
    g_table, g_inner = np.zeros_like(model.table), np.zeros_like(model.inner)
    g_out, g_bias, loss, errors = np.zeros_like(model.out), np.zeros_like(model.bias), 0.0, {}
    for t in range(length):
        scores = model.out[0] @ runs[0][0][t] + model.out[1] @ runs[1][0][t] + model.bias[:, None]
        scores = np.exp(scores - scores.max(axis=0))
        scores /= scores.sum(axis=0)
        loss -= float((np.log(scores[wanted, np.arange(lanes)] + 1e-9) * mask[t]).sum())
        scores[wanted, np.arange(lanes)] -= 1
        errors[t] = scores * mask[t]
        g_bias += errors[t].sum(axis=1)
    for d in (0, 1):
        states, steps = runs[d]
        back = np.zeros((hidden, lanes), np.float32)
        for t in reversed(orders[d]):
            before, update, reset, new, pushed = steps[t]
            g_out[d] += errors[t] @ states[t].T
            g = back + model.out[d].T @ errors[t]
            g_new = g * (1 - update) * (1 - new * new)
            g_update = g * (before - new) * update * (1 - update)
            g_reset = g_new * pushed * reset * (1 - reset)
            g_taken = np.concatenate([g_update, g_reset, g_new])
            g_pushed = np.concatenate([g_update, g_reset, g_new * reset])
            for row in range(3 * hidden):
                g_table[d, row] += np.bincount(windows[t], g_taken[row], 257)
            g_inner[d] += g_pushed @ before.T
            back = g * update + model.inner[d].T @ g_pushed
    return loss, (g_table, g_inner, g_out, g_bias)


def train(texts: list[str], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 5) -> Model | None:
    """Adam over random windows, labels drawn evenly; None without a text."""
    rng = np.random.Generator(np.random.PCG64(seed))
    names = sorted(set(labels))
    pools = []
    for name in names:
        raw = [t.encode() for t, label in zip(texts, labels) if label == name and t]
        data = np.frombuffer(b"".join(raw), np.uint8)
        windows, _ = cut_windows(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
        pools.append(windows)
    names, pools = [n for n, p in zip(names, pools) if len(p)], [p for p in pools if len(p)]
    if not names:
        return None
    spread = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    model = Model(names, spread(2, 3 * hidden, 257), spread(2, 3 * hidden, hidden), spread(2, len(names), hidden), np.zeros(len(names), np.float32))
    weights = [model.table, model.inner, model.out, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        wanted = rng.integers(0, len(names), BATCH)
        lanes = np.stack([pools[k][rng.integers(0, len(pools[k]))] for k in wanted]).T.astype(np.int64)
        _, gradients = _gradients(model, lanes, wanted)
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, m, v in zip(weights, gradients, first, second):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(df: DataFrame, key: str, text: str, lang: str) -> tuple[list[str], list[str]]:
    """Slices of about SAMPLE texts a label, fewer where labels are many, from rows with an id that is not held out; a
    hash of the id chooses. Every label is learned."""
    id_column, text_column, label = F.col(f"`{key}`"), F.col(f"`{text}`"), F.col(f"`{lang}`")
    rows = df.filter(label.isNotNull() & id_column.isNotNull() & ~held_out(key) & (F.length(text_column) > 0))
    rows = rows.select(id_column.alias("k"), text_column.alias("t"), label.alias("l"))
    counts, n = settle(rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")))
    if not n:
        return [], []
    each = max(1, min(SAMPLE, WHOLE // n))
    point = F.pmod(F.xxhash64(F.lit("sample"), "k"), F.lit(1 << 30)) / float(1 << 30)
    begin = F.pmod(F.xxhash64(F.lit("begin"), "k"), F.greatest(F.length("t") - SLICE, F.lit(1)).cast("long")).cast("int") + 1
    shares = small(counts.select("l", (F.lit(float(each)) / F.col("n")).alias("share")), n)
    drawn = rows.withColumn("p", point).join(shares, "l").filter("p < share")
    # about ``each`` of a label by chance, so a bound of twice as many is never met
    slices = drawn.select("p", "l", F.col("t").substr(begin, F.lit(SLICE)).alias("s")).orderBy("p", "l", "s").limit(2 * each * n + 1000)
    found = slices.collect()
    return [r["s"] for r in found], [r["l"] for r in found]


def predict(df: DataFrame, model: Model | None, key: str, text: str) -> DataFrame:
    """(key, lang_pred, score) of every row."""
    schema = T.StructType([df.schema[key], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers, whatever the input

    def label(batches):
        import pyarrow as pa

        net = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                data, offsets = values(batch.column(1))
                names, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
                sums = np.zeros((batch.num_rows, len(net.labels) if net else 1))
                ends = 0
                while net and ends < batch.num_rows:  # some megabytes of text at once
                    begin, limit = ends, offsets[ends] + (1 << 22)
                    ends = min(max(int(np.searchsorted(offsets, limit, "right")) - 1, begin + 1), batch.num_rows)
                    if offsets[ends] - offsets[begin] > 1 << 23:  # one very long text: by slices
                        for low in range(offsets[begin], offsets[ends], 1 << 22):
                            high = min(low + (1 << 22), offsets[ends])
                            windows, _ = cut_windows(data[low:high], np.array([0, high - low]))
                            sums[begin] += net.probabilities(windows).sum(axis=0)
                    else:
                        windows, before = cut_windows(data, offsets[begin : ends + 1])
                        by_window = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(net.probabilities(windows), axis=0, dtype=np.float64)])
                        sums[begin:ends] = by_window[before[1:]] - by_window[before[:-1]]
                for row, value in enumerate(batch.column(1)):
                    if net and any(map(str.isalpha, value.as_py() or "")):
                        best = int(sums[row].argmax())
                        names[row], scores[row] = net.labels[best], float(min(1.0, sums[row][best] / (offsets[row + 1] - offsets[row])))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], schema.names)

    return df.select(key, text).mapInArrow(label, schema)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fits on the labelled rows that are not held out, then labels every row: (key, held_out, lang_pred, score)."""
    model = train(*sample(df, key, text, lang))
    return predict(df, model, key, text).select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def op2_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
