import random

import numpy as np
import pytest

from dialoom.llm import repeats
from dialoom.llm.repeats import Stream, anchors, front_code, merge, remove_repeats


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def corpus(rng, length, n=120, letters="abé"):
    text = lambda k: "".join(rng.choices(letters, k=k))
    passages = [text(rng.randint(length // 2, 4 * length)) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                parts.append(p[a : a + rng.randint(length // 3, len(p))])
            else:
                parts.append(text(rng.randint(0, 2 * length)))
        docs.append("".join(parts))
    docs += [docs[3]] * 3 + [None, "", "z" * (5 * length), text(length) * 2, docs[5] + text(9)]
    return docs


@pytest.mark.parametrize("length,letters", [(20, "abcdé"), (20, "ab"), (200, "abcdefé\x00")])
def test_against_brute_force(spark, length, letters):
    docs = corpus(random.Random(length), length, letters=letters)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, run int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, length=length).collect()}
    want = brute(docs, length)
    assert [got[i] for i in range(len(docs))] == want


def test_many_runs_and_slices(spark, monkeypatch):
    monkeypatch.setattr(repeats, "RUN", 500)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    monkeypatch.setattr(repeats, "SORTED", 50)
    docs = corpus(random.Random(7), 40, 60) + ["".join(random.Random(1).choices("abcd", k=5000))] * 2
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, length=40).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, 40)


def test_every_string_has_its_anchor():
    data = np.random.default_rng(3).integers(97, 100, 3000).astype(np.uint8)
    places, _ = anchors(data, np.array([0, 1000, 1010, 3000]), 20)
    for p in [*range(0, 981), *range(1010, 2981)]:
        assert ((places >= p) & (places <= p + 10)).any()


def test_merge_orders_and_shares():
    rng = np.random.default_rng(5)
    strings = [rng.integers(97, 99, (40, 12)).astype(np.uint8) for _ in range(7)]
    streams = [Stream(i, front_code(s, np.arange(len(s))), 12) for i, s in enumerate(strings)]
    out, before = [], b""
    for stream, shared in merge(streams, 12):
        s = stream.string
        assert shared == next((i for i in range(12) if i >= len(before) or s[i] != before[i]), 12)
        out += [s] * len(stream.found())
        before = s
    assert out == sorted(r.tobytes() for s in strings for r in s)


def test_one_gram_with_many_contexts(spark):
    rng = random.Random(9)
    text = lambda k: "".join(rng.choices("abcdefgh", k=k))
    common = text(45)
    docs = [text(rng.randint(0, 50)) + common[rng.randint(0, 8) : rng.randint(38, 45)] + text(rng.randint(0, 50)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, length=30).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, 30)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_buckets_follow_the_bytes_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 20_000)
    rng = random.Random(11)
    text = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    passage = text(700)
    docs = [text(30_000) + passage + text(40_000), passage[100:600], passage * 2, None, *[passage] * 5]
    df = spark.createDataFrame([(1, t) for t in docs], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df).collect())
    assert got == sorted(brute(docs, 200))
