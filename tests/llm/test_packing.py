import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm.packing import CapacityTree, best_fit_decreasing, pack

public_tokenizers = pytest.importorskip("public_tokenizers")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_against_linear_search(lengths):
    placed, offsets, opened = best_fit_decreasing(lengths, 32)
    room, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(r, w) for w, r in enumerate(room) if r >= lengths[i]]
        if fits:
            least = min(fits)[0]
            assert 32 - offsets[i] == least
            room[placed[i]] -= lengths[i]
        else:
            assert placed[i] == len(room) and offsets[i] == 0
            room.append(32 - lengths[i])
        want[i] = placed[i]
    assert opened == len(room) and all(r >= 0 for r in room)


def test_tree_finds_least_capacity():
    tree, rng, held = CapacityTree(100), random.Random(1), []
    for i in range(300):
        c = rng.randint(1, 100)
        tree.add(c, i)
        held.append(c)
        if i % 3 == 0:
            least = rng.randint(1, 100)
            want = min((x for x in held if x >= least), default=None)
            assert tree.tightest(least) == want
            if want is not None:
                tree.take(want)
                held.remove(want)


def test_pieces_are_whole_documents(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "Hello  world\n\nÉté\tcafé á <|endoftext|>x's don't 123", "a b " * 6000, "zwölf Boxkämpfer jagen"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "twice", "x")] * 2 + [(3, "other " * 50, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = pack(df, with_ids=True, packers=2).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(
        np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t, _ in rows
    )
    for r in got.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 4096
    longest = got[got.doc_tokens == 12001].sort_values("start")
    assert list(longest.start) == [0, 4096, 8192]
    whole = [b"".join(longest.ids)] + list(got[got.doc_tokens != 12001].ids)
    assert sorted(whole) == want
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 4096


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("merges", [True, False])
def test_chunks_are_the_tokenizers_own(monkeypatch, merges):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from dialoom.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(2)
    chunks = packing.Chunks(tokenizer, path if merges else None)
    assert (chunks.merges is not None) == merges
    monkeypatch.setattr(packing, "_CACHE", 50)
    pool = list("aAbBzéÉßİΣσKŉ.,;:#$!?<|>=019 \n\n\t\x01\x85\xa0\u3000\u0301\u0338×÷日本😀") + ["'s", "'LL ", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", ", ", ". ", "The ", "ABC."]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(800)] + ["Straße " * 40 + "x" * 300]
    want = [[*tokenizer.encode(text, add_special_tokens=False).ids, 2] for text in texts]
    for size in (1 << 22, 40):  # the second cuts most texts into slices
        monkeypatch.setattr(packing, "SLICE", size)
        got = [x.tolist() for low in range(0, len(texts), 7) for x in packing.token_ids(pa.array(texts[low : low + 7]), chunks)]
        assert got == want


def test_words_are_merged_as_the_library_does():
    from tokenizers import Tokenizer

    from dialoom.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(3)
    chunks = packing.Chunks(tokenizer, path)
    words = ["".join(rng.choices("etaoinshrdluéüñß", k=rng.randint(1, 40))) for _ in range(5000)] + [c * n for c in "aeéz" for n in (2, 3, 7, 40)]
    flat, sizes = chunks.merges.encode([w.encode() for w in words])
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    assert [p.tolist() for p in parts] == [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def test_runs_repeat(spark):
    rng = random.Random(4)
    rows = [(i % 90 if i % 5 else None, "word " * rng.randint(0, 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    once, again = (sorted(map(tuple, pack(df, packers=3).collect()), key=str) for _ in range(2))
    assert once == again


def test_very_long_text(spark):
    from tokenizers import Tokenizer

    text = " ".join(f"w{i % 977} Ünder," for i in range(120_000))
    got = pack(spark.createDataFrame([(1, text)], "doc_id long, text string")).toPandas()
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    assert got.length.sum() == len(ids) + 1 and (got.length == 4096).sum() == (len(ids) + 1) // 4096
    first = got[got.start == 4096].iloc[0]
    assert first.ids_crc32 == zlib.crc32(np.array(ids[4096:8192], "<u4").tobytes())
