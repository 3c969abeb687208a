import random

import pytest

import corpus_pipeline
from dialoom.llm.quality import quality_rules

from test_mixing import count
from test_neardup import brute as components
from test_packing import np, public_tokenizers
from test_quality import brute as quality
from test_secrets import brute as spans


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng = random.Random(12)
    vocab = ["the", "of", "and", *[f"w{i}" for i in range(300)]]
    base = [" ".join(rng.choices(vocab, k=rng.randint(60, 150))) for _ in range(60)]
    rows = []
    for i in range(150):
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = f"edit{i}"
        text = " ".join(words) + (" password=abcdefgh12345" if i % 10 == 0 else "")
        rows.append((i, text if i % 13 else "too short", "en", f"s{i % 4}", len(text)))
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, base[0] + " é" * 5000, "fr", None, 1)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return rows, str(folder)


def test_stages_against_brute_force(spark, docs):
    from tokenizers import Tokenizer

    rows, folder = docs
    kept = {r.doc_id for r in quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).filter("kept").collect()}
    assert kept <= {r[0] for r in rows if not quality(r[1])[5]}
    rows = [r for r in rows if r[0] in kept]
    groups = components([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]

    def clean(text):
        out, at = "", 0
        for _, s, e in spans(text):
            if s >= at:
                out += text[at:s] + "[secret]"
            at = max(at, e)
        return out + text[at:]

    rows = [(r[0], clean(r[1]), r[3]) for r in rows]
    sizes = {s: sum(r[2] == s for r in rows) for s in {r[2] for r in rows}}
    weight = sum(n**0.7 for n in sizes.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc, text, source in rows:
        rate = len(rows) * sizes[source] ** 0.7 / weight / sizes[source]
        ids = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        want += [(doc, ids)] * count(rate, doc)
    got = corpus_pipeline.run(spark, folder).toPandas()
    assert sorted(zip(got.doc_id[got.start == 0], got.doc_tokens[got.start == 0])) == sorted(want)
    assert got.length.sum() == sum(n for _, n in want)
    assert (got.groupby("sequence_id").length.sum() <= 4096).all() and isinstance(got.length.to_numpy(), np.ndarray)


def test_stages_keep_the_columns(spark, docs):
    df = spark.read.parquet(f"{docs[1]}/documents.parquet").withColumnRenamed("lang", "kept")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, docs[1]).columns == df.columns, name
        assert stage(spark, df.limit(0), docs[1]).count() == 0
