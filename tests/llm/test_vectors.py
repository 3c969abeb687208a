import math

import numpy as np

from dialoom.llm.vectors import Quantisers, distances, fit, near_vectors


def brute(rows, cosine=0.93):
    good = [(i, np.array(v, float), label) for i, v, label in rows if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, comp = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for n, (i, v, label) in enumerate(good):
        for j, w, other in good[n + 1 :]:
            if label == other and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return {i: (links[i], find(i)) for i in links}


def rows_of(n=600):
    rng = np.random.default_rng(8)
    seeds = rng.normal(0, 1, (25, 16))
    rows = []
    for i in range(n):
        v = seeds[rng.integers(25)] + rng.normal(0, rng.choice([0.0, 0.1, 0.25, 0.5]), 16)
        rows.append((i * 2 + 3, [float(np.float32(x)) for x in v], int(rng.integers(2)) if i % 50 else None))
    rows += [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [None, *[1.0] * 15], 1), (9005, [float("nan")] * 16, 1), (9006, [float("inf"), *[1.0] * 15], 1)]
    rows += [(9100 + k, [1.0, *[0.0] * 15], 0) for k in range(40)] + [(9200, [1.0, 2.0], 0), (9201, [2.0, 4.0], 0)]
    return rows


def test_against_brute_force(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == brute(rows)


def test_blocks_split_lists(spark, monkeypatch):
    from dialoom.llm import vectors

    monkeypatch.setattr(vectors, "BLOCK", 20)
    rows = rows_of(200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()} == brute(rows)


def test_lookup_is_the_distance_to_the_code():
    x = np.random.default_rng(1).normal(0, 1, (300, 16))
    q = fit(x)
    own, codes, error = q.encode(x)
    for i in (0, 7):
        members = np.flatnonzero(own == own[i])
        back = q.centres[own[i]] + np.concatenate([q.books[m][codes[members, m]] for m in range(len(q.books))], axis=1)
        assert np.allclose(q.lookup(x[:5], own[i], codes[members]), np.sqrt(distances(x[:5], back)), atol=1e-3)
        assert np.allclose(np.sqrt(((x[members] - back) ** 2).sum(axis=1)), error[members], atol=1e-9)
    assert isinstance(q, Quantisers)


def test_empty_and_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    got = near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.1], 1), (None, None, 1)], schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in got) == [(0, 0), (0, 1), (4, 1)]


def test_components_of_any_size(spark):
    rows = [(1, [1e200, 0.0], 1), (2, [1e200, 1e190], 1), (3, [1e-200, 1e-210], 1), (4, [0.0, 5e-324], 1), (5, [1e308, 1e308], 1), (6, [-1e308, -1e308], 1), (7, [0.0, -0.0], 1)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7)]


def many(n, seed=4):
    """Families around seeds that lie near each other, in 64 dimensions."""
    rng = np.random.default_rng(seed)
    seeds = rng.normal(0, 1, (max(n // 6, 1), 64)) + 0.5
    v = seeds[rng.integers(len(seeds), size=n)] + rng.normal(0, 1, (n, 64)) * rng.choice([0.1, 0.2, 0.25, 0.3], (n, 1))
    return v / np.linalg.norm(v, axis=1)[:, None]


def test_recall_and_probes_against_all_pairs():
    from dialoom.llm import vectors

    per = {}
    for n in (1000, 5000):
        x = many(n)
        i, j = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
        q = fit(x, round(n**0.5))
        own, _, _ = q.encode(x)
        probes = q.probes(x, own, float(np.sqrt(0.14)) * vectors.SPREAD / 8)
        found = probes[i, own[j]] | probes[j, own[i]]
        assert len(i) > 1000 and found.mean() >= 0.99
        per[n] = probes.sum(axis=1).mean()
    assert per[5000] < 2 * per[1000] < 60


def test_links_found_on_the_whole_path(spark):
    x = many(1500, 6)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert all(got[k] <= n for k, n in enumerate(want.tolist())) and sum(got.values()) >= 0.99 * want.sum() > 100
    exact = {r.vec_id: r.n_links for r in near_vectors(df, spread=None).collect()}
    assert [exact[k] for k in range(1500)] == want.tolist()
