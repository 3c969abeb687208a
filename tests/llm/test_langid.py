import random
import zlib

import numpy as np

from dialoom.llm import langid
from dialoom.llm.langid import Model, _gradients, cut_windows, identify, train


def test_gradients_against_differences():
    rng = np.random.Generator(np.random.PCG64(2))
    h, lanes = 3, 4
    make = lambda *s: rng.normal(0, 0.5, s)
    model = Model(["a", "b"], make(2, 3 * h, 257), make(2, 3 * h, h), make(2, 2, h), make(2))
    windows = rng.integers(0, 257, (5, lanes))
    windows[:2] %= 256
    wanted = np.array([0, 1, 1, 0])
    _, grads = _gradients(model, windows, wanted)
    for weights, grad in zip((model.table, model.inner, model.out, model.bias), grads):
        flat = weights.reshape(-1)
        for i in np.argsort(-np.abs(grad.reshape(-1)))[:4]:
            keep, e = flat[i], 1e-3
            flat[i] = keep + e
            up = _gradients(model, windows, wanted)[0]
            flat[i] = keep - e
            down = _gradients(model, windows, wanted)[0]
            flat[i] = keep
            assert abs((up - down) / (2 * e) - grad.reshape(-1)[i]) < 2e-3


def test_inference_is_the_trained_network():
    """The fast pass gives the probabilities that the training pass differentiates."""
    model = train(["abcabc" * 20, "xyz zy" * 20], ["p", "q"], steps=3)
    windows, _ = cut_windows(np.frombuffer(b"abc xyz", np.uint8), np.array([0, 7]))
    total = model.probabilities(windows)
    assert abs(total.sum() - 7) < 1e-4
    loss, _ = _gradients(model, windows.T.astype(np.int64), np.array([0]))
    assert 0 < total[0, 0] / 7 < 1 and loss > 0


def plain(model, window):
    """Sums of each label's probability over the positions of a window, one gate of one unit at a time."""
    import math

    hidden, labels = model.inner.shape[2], len(model.labels)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    states = {}
    for d, order in ((0, range(len(window))), (1, range(len(window) - 1, -1, -1))):
        h = [0.0] * hidden
        for t in order:
            b = int(window[t])
            push = [sum(float(model.inner[d][g][k]) * h[k] for k in range(hidden)) for g in range(3 * hidden)]
            given = [float(model.table[d][g][b]) for g in range(3 * hidden)]
            new = []
            for u in range(hidden):
                update, reset = sigmoid(given[u] + push[u]), sigmoid(given[hidden + u] + push[hidden + u])
                fresh = math.tanh(given[2 * hidden + u] + reset * push[2 * hidden + u])
                new.append((1 - update) * fresh + update * h[u])
            states[d, t] = h = new
    total = [0.0] * labels
    for t, b in enumerate(window):
        if b == 256:
            continue
        scores = [sum(float(model.out[d][k][u]) * states[d, t][u] for d in (0, 1) for u in range(hidden)) + float(model.bias[k]) for k in range(labels)]
        whole = sum(map(math.exp, scores))
        total = [x + math.exp(y) / whole for x, y in zip(total, scores)]
    return total


def test_every_probability_against_plain_loops():
    rng = np.random.Generator(np.random.PCG64(7))
    make = lambda *s: rng.normal(0, 0.6, s).astype(np.float32)
    untrained = Model(["a", "b", "c"], make(2, 24, 257), make(2, 24, 8), make(2, 3, 8), make(3))
    for model in (untrained, train(["abcabc" * 20, "xyz zy" * 20, "öäü" * 30], ["p", "q", "r"], steps=20)):
        data = "abc xyz öä ".encode() * 15 + b"q"
        windows, _ = cut_windows(np.frombuffer(data, np.uint8), np.array([0, 70, len(data)]))
        want = np.array([plain(model, w) for w in windows])
        assert np.allclose(model.probabilities(windows), want, atol=1e-3) and np.abs(want.sum(axis=1) - (windows < 256).sum(axis=1)).max() < 1e-6


def test_prediction_is_the_mean_over_positions(spark):
    model = train(["abcabc" * 20, "xyz zy" * 20], ["p", "q"], steps=20)
    text = "abc zyz " * 40
    windows, _ = cut_windows(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    want = np.array([plain(model, w) for w in windows]).sum(axis=0) / len(text)
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    for row in langid.predict(df, model, "doc_id", "text").collect():
        assert row.lang_pred == model.labels[int(want.argmax())] and abs(row.score - want.max()) < 1e-4


def test_rare_labels_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "WHOLE", 150)
    rows = [(i, f"text {i % 100} " * 3, f"l{i % 100}") for i in range(1000)]
    texts, labels = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    once = langid.sample(spark.createDataFrame([(i, "x y", f"l{i}") for i in range(300)], "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    learned = {f"l{i}" for i in range(300) if zlib.crc32(str(i).encode()) % 5}
    assert set(once[1]) == learned and len(texts) < 250 and len(set(labels)) > 50


def _rows(n):
    rng = random.Random(4)
    tongues = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["sch", "ung", "ver", "ü"], "cc": ["ción", "que", "os", "ñ"]}
    for i in range(n):
        lang = rng.choice(sorted(tongues))
        yield i, " ".join("".join(rng.choices(tongues[lang], k=3)) for _ in range(rng.randint(5, 40))), lang


def test_held_out_accuracy_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 60)
    monkeypatch.setattr(langid.train, "__defaults__", (60, 8, 5))
    rows = list(_rows(300)) + [(1001, None, "aa"), (1002, "", "bb"), (1003, "12 +", None), (None, "kalo mita", "aa"), (1004, "kalomi ta " * 40_000, None), (5, "ver ung", "bb")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id != 5}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1001, 1002, 1003))
    assert by[1004].lang_pred == "aa" and by[None].lang_pred == "aa" and not by[None].held_out
    test = [(i, lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 5 == 0 and i != 5]
    assert all(by[i].held_out for i, _ in test)
    assert sum(by[i].lang_pred == lang for i, lang in test) >= 0.95 * len(test)


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in identify(df).select("doc_id", "lang_pred", "score").collect()] == [(1, "und", 0.0)]
    assert identify(df.limit(0)).count() == 0
