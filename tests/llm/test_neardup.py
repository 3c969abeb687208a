import random

from dialoom.llm.neardup import near_duplicates


def brute(rows, percent=75):
    """(n_shingles, component) of (id, text) rows with different ids."""
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(20, 120))) for _ in range(n // 4)]
    rows = []
    for i in range(n):
        words = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i * 3 + 1, (" " if rng.random() < 0.5 else "\n").join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "a b"), (5004, "A  b"), (5005, "é É"), (5006, "é é")]
    rows += [(6000 + k, f"{rows[0][1]} tail{k}") for k in range(60)]
    rng.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", True) for i, t in rows], "doc_id long, text string, kept string, h1 boolean")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
    assert got == brute(rows)


def test_nulls_repeats_and_empty(spark):
    long = " ".join(f"t{i}" for i in range(300_000))
    rows = [(None, "one two three four five six"), (7, "one two three four five six"), (7, "one two three four five six"), (None, "alone"), (8, long), (9, long + " end"), (10, "x" * 3_000_000)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 1, 0, True), (0, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (8, 299_996, 8, True), (9, 299_997, 8, False), (10, 1, 10, True),
    ]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_star_larger_than_any_neighbourhood(spark, monkeypatch):
    """Copies that resemble their source but hardly one another are one component."""
    from dialoom.llm import neardup

    monkeypatch.setattr(neardup, "NEAR", 1)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(400)]
    rows = [(1, " ".join(base))]
    for k in range(250):
        words = list(base)
        for n in range(11):
            words[rng.randrange(400)] = f"e{k}x{n}"
        rows.append((10 + k, " ".join(words)))
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] != want[i] for i in want) == 0


def test_many_edges_take_rounds(spark, monkeypatch):
    from dialoom.llm import common

    monkeypatch.setattr(common, "EDGES", 10)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, 300), (300, 250), (7, 500)]
    random.Random(1).shuffle(edges)
    got = dict(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect())
    assert got == {**{i: 0 for i in range(91)}, 500: 0, 200: 200, 250: 200, 300: 200}


def test_very_long_texts_far_apart(spark):
    """Near copies of 300,000 shingles are candidates whatever unrelated long texts have ids between theirs."""
    import numpy as np

    from dialoom.llm import neardup

    rng, (a, b) = np.random.default_rng(8), neardup._functions()
    sizes, pairs, rows = 300_000, [], []
    for k in range(120):
        own = rng.integers(0, 1 << 63, sizes, np.uint64)
        rows.append((k, bytearray(neardup.signature(own, a, b).tobytes())))
        if k < 30:  # 0.9 of the union in common
            own[: sizes // 19] = rng.integers(0, 1 << 63, sizes // 19, np.uint64)
            rows.append((10_000 - k, bytearray(neardup.signature(own, a, b).tobytes())))
            pairs.append((k, 10_000 - k))
    found = {(r.a, r.b) for r in neardup.candidates(spark.createDataFrame(rows, "id long, sig binary")).collect()}
    assert [p for p in pairs if p not in found] == []
    assert len(found) == len(pairs)


def test_pairs_in_a_large_family(spark, monkeypatch):
    """Pairs over the threshold are found among many relatives that are just below it."""
    from dialoom.llm import neardup

    monkeypatch.setattr(neardup, "NEAR", 1)
    rng = random.Random(9)
    base, pairs, rows = [f"b{i}" for i in range(1000)], [], []

    def edited(words, k, times):
        words = list(words)
        for n in range(times):
            words[rng.randrange(len(words))] = f"e{k}x{n}"
        return words

    for k in range(1500):
        words = edited(base, k, 18)
        rows.append((k, " ".join(words)))
        if k < 60:
            rows.append((9000 - k, " ".join(edited(words, 9000 - k, 25))))
            pairs.append((k, 9000 - k))
    sets = {i: {tuple(t.split()[n : n + 5]) for n in range(996)} for i, t in rows if i < 60 or i > 8000}
    pairs = [(a, b) for a, b in pairs if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    missed = [p for p in pairs if got[p[0]] != got[p[1]]]
    assert len(pairs) > 40 and not missed


def test_candidates_of_a_family_are_a_few_a_member(spark):
    """All pairs of small regions; of crowded ones each member, and no more pairs than members. Batches and tasks cut them anywhere."""
    from collections import defaultdict

    import numpy as np

    from dialoom.llm import neardup

    rng, m = np.random.default_rng(6), 600
    sig = np.repeat(rng.integers(0, 1 << 16, (1, neardup.VALUES), np.uint16), m, axis=0)
    sig[:400][rng.random((400, neardup.VALUES)) < 0.2] = 7  # one large family, and small ones of up to five
    for at in range(400, m, 5):
        sig[at : at + 5] = rng.integers(0, 1 << 16, neardup.VALUES, np.uint16)
    hit = rng.random(sig.shape) < 0.1
    sig[hit] = rng.integers(0, 1 << 16, hit.sum(), np.uint16)
    regions = defaultdict(list)
    for tree, order in enumerate(neardup._orders()):
        for i in range(m):
            key = tuple(int(x) for x in sig[i, order])
            regions[tree, key[: neardup.LEAST]].append((key, i))
    pairs, crowded = set(), set()
    for (tree, key), rows in regions.items():
        ids = [i for _, i in sorted(rows)]
        few = len(ids) <= neardup.NEAR + 1
        pairs |= {(min(a, b), max(a, b)) for n, a in enumerate(ids) for b in (ids[n + 1 :] if few else ids[n + 1 : n + 2])}
        if not few:
            code = tree
            for x in key:
                code = code << 16 | x
            crowded |= {(i, code) for i in ids}
    classes = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sig)], "id long, sig binary")
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for batch, parts in ((10_000, 1), (5, 7), (97, 40)):
        for name, value in zip(names, (batch, parts)):
            spark.conf.set(name, value)
        try:
            got, members = (frame.collect() for frame in neardup.planted(classes))
        finally:
            for name, value in zip(names, before):
                spark.conf.set(name, value)
        got = {(r.a, r.b) for r in got}
        assert pairs <= got and len(got) <= len(pairs) + 20 * (parts - 1)
        assert {(r.id, r.region) for r in members} == crowded
    assert len(crowded) > 4000 and len(pairs) < 24 * m


def exact_components(rows, percent=75):
    """Components of an exact join by prefixes: of two sets that alike, each holds one of the other's rarest shingles."""
    from collections import Counter

    sets = {}
    for i, t in rows:
        w = (t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in w if x]
        sets[i] = frozenset(hash(tuple(w[k : k + 5])) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([hash(tuple(w))] if w else [])
    often, classes = Counter(), {}
    for i, s in sets.items():
        classes.setdefault(s, []).append(i)
    for s in classes:
        often.update(s)
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    def unite(a, b):
        a, b = sorted((find(a), find(b)))
        comp[b] = a

    lists = {}
    for s, ids in classes.items():
        if not s:
            continue
        for i in ids:
            unite(ids[0], i)
        rare = sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-percent * len(s) // 100) + 1]
        for other in {o for x in rare for o in lists.get(x, ())}:
            common = len(s & other)
            if 100 * common >= percent * (len(s) + len(other) - common):
                unite(ids[0], classes[other][0])
        for x in rare:
            lists.setdefault(x, []).append(s)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_equal_to_an_exact_join_on_ten_thousand_documents(spark):
    import os

    import pytest

    path = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the test tables")
    df = spark.read.parquet(path)
    want = exact_components([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
    assert len(got) >= 10_000 and got == want


def test_hub_pairs_in_parts(spark, monkeypatch):
    """Confirmation by parts of a hub's pairs: each pair as all sets say, whatever side the hub is on."""
    from dialoom.llm import neardup

    monkeypatch.setattr(neardup, "PART", 3)
    rng = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    rows = {50: base}
    for k in [*range(20), *range(60, 80)]:
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(60)] = f"e{k}"
        rows[k] = words
    pairs = [tuple(sorted((50, k))) for k in rows if k != 50] + [(1, 2), (2, 3), (60, 70)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in rows.items()}
    want = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "id long, text string")
    got = neardup.confirm(spark.createDataFrame(pairs, "a long, b long"), texts)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert 0 < len(want) < len(pairs)


def test_every_pair_of_a_crowded_region(spark, monkeypatch):
    """Pairs in a family whose rare values are shared by more members than a list would hold; blocks of any size."""
    import numpy as np

    from dialoom.llm import neardup

    monkeypatch.setattr(neardup, "NEAR", 1)
    monkeypatch.setattr(neardup, "MEMBERS", 150)
    rng = random.Random(21)
    some = lambda: int(rng.random() > 0.91)
    picks = {k: [some() for _ in range(250)] for k in range(500)}
    for k in range(60):  # about 0.8 of the union in common with k
        picks[9000 - k] = [some() if rng.random() < 0.4 else x for x in picks[k]]
    rows = [(i, " ".join(f"s{n}v{x}w{w}" for n, x in enumerate(p) for w in range(6))) for i, p in picks.items()]
    ids, names, comp = [i for i, _ in rows], {}, {i: i for i, _ in rows}
    sets = [{names.setdefault(tuple(w[k : k + 5]), len(names)) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    has = np.zeros((len(ids), len(names)), np.float32)
    for row, x in zip(has, sets):
        row[list(x)] = 1
    common, size = has @ has.T, has.sum(axis=1)

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, j in zip(*np.nonzero(100 * common >= 75 * (size[:, None] + size - common))):
        low, high = sorted((find(ids[i]), find(ids[j])))
        comp[high] = low
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: find(i) for i in ids}
    assert 20 < len(set(want.values())) < len(ids) - 20
    assert sum(got[i] != want[i] for i in ids) == 0


def test_held_together_counts_every_pair():
    import numpy as np

    from dialoom.llm.neardup import held_together

    rng = np.random.default_rng(4)
    base = rng.choice(1 << 40, 200, replace=False).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) < 0.85], rng.integers(1 << 41, (1 << 41) + 40, rng.integers(0, 20), np.uint64)])) for _ in range(90)]
    sets += [np.arange(k, k + 9, dtype=np.uint64) for k in range(30)]
    comp = rng.integers(0, 50, len(sets))
    for percent in (60, 75):
        for cut in (None, 40):
            pairs = set()
            for i in range(len(sets)):
                for j in range(i):
                    c = len(np.intersect1d(sets[i], sets[j]))
                    sides = cut is None or (j < cut) != (i < cut)
                    if sides and c and comp[i] != comp[j] and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                        pairs.add((min(comp[i], comp[j]), max(comp[i], comp[j])))
            got = held_together(sets, None, comp, comp, percent) if cut is None else held_together(sets[:cut], sets[cut:], comp[:cut], comp[cut:], percent)
            assert sorted(map(tuple, got.tolist())) == sorted((int(a), int(b)) for a, b in pairs) and pairs
