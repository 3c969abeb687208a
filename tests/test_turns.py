import random

import pytest
from pyspark.sql import functions as F

from dialoom.operators import turns


def spec(rows, gap, glitch_max, glitch_gap, shortest, longest):
    """The rules one turn at a time: (merged, bridged, final)."""
    merged = []
    for s, e, who in sorted(r for r in rows if r[1] > r[0]):
        if merged and merged[-1][2] == who and max(0.0, s - merged[-1][1]) <= gap:
            merged[-1] = (merged[-1][0], max(merged[-1][1], e), who)
        else:
            merged.append((s, e, who))
    bridged, i = list(merged), 0
    while i + 2 < len(bridged):
        a, b, c = bridged[i : i + 3]
        if a[2] == c[2] != b[2] and max(0, b[1] - b[0]) <= glitch_max and max(0, b[0] - a[1]) <= glitch_gap and max(0, c[0] - b[1]) <= glitch_gap:
            bridged[i : i + 3] = [(a[0], c[1], a[2])]
            i = max(i - 1, 0)
        else:
            i += 1
    final = []
    for s, e, who in bridged:
        d = max(0.0, e - s)
        if d < shortest:
            continue
        n = 1 if d <= longest else max(2, -int(-d // longest))
        final += [(s + k * (d / n) if n > 1 else s, e if k == n - 1 else s + (k + 1) * (d / n), who) for k in range(n)]
    return merged, bridged, final


@pytest.fixture(scope="module")
def recordings():
    rng = random.Random(6)
    return {
        a: [(s := rng.randrange(0, 200) / 4, s + rng.choice([-1, 0, 1, 1, 2, 4, 12, 50]) / 4, rng.choice("ab c".split(" ") + ["d e"])) for _ in range(rng.randint(1, 25))]
        for a in range(120)
    }


def test_against_the_spec(spark, recordings):
    limits = dict(merge_gap=0.5, glitch_max=0.5, glitch_gap=0.5, shortest=0.5, longest=3.0)
    raw = spark.createDataFrame([(a, *r) for a, rows in recordings.items() for r in rows], "audio_id int, start double, end double, speaker_label string")

    def grouped(df):
        out = {}
        for r in df.collect():
            out.setdefault(r.audio_id, []).append((r.start, r.end, r.speaker_label))
        return {a: sorted(x) for a, x in out.items()}

    want = {a: spec([(s, e, w.replace(" ", "_")) for s, e, w in rows], *limits.values()) for a, rows in recordings.items()}
    merged = turns.merge_turns(turns.normalize_turns(raw), 0.5)
    assert grouped(merged) == {a: sorted(w[0]) for a, w in want.items() if w[0]}
    for by_group in (False, True):
        got = grouped(turns.bridge_turns(merged, 0.5, 0.5, ("run", "island"), grouped=by_group))
        assert got == {a: sorted(w[1]) for a, w in want.items() if w[1]}
    final = turns.cleanup_turns(raw, **limits)
    assert grouped(final) == {a: sorted(w[2]) for a, w in want.items() if w[2]}
    actions = {r.action: r.n for r in turns.audit_turns(raw, **limits).groupBy("action").agg(F.count("*").alias("n")).collect()}
    raws = sum(1 for rows in recordings.values() for s, e, _ in rows if e > s)
    n = [sum(len(w[k]) for w in want.values()) for k in range(3)]
    assert actions["merge_same_speaker_gap"] == raws - n[0]
    assert actions["bridge_micro_turn"] * 2 == n[0] - n[1] > 0
    assert actions["keep_turn"] + actions["split_long_turn"] == n[2]


def test_one_exchange_serves_merge(spark):
    raw = spark.createDataFrame([(1, 0.0, 1.0, "a")], "audio_id int, start double, end double, speaker_label string")
    plan = turns.merge_turns(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rttm_lines_round_as_their_sql(spark, tmp_path):
    """Ends on half hundredths, as sums of doubles: the line of each is that of the SQL; no line without a label."""
    from collections import Counter

    import pyarrow as pa
    import pyarrow.parquet as pq

    from dialoom.plans import registry

    duckdb = pytest.importorskip("duckdb")
    rng, n = random.Random(15), 4000
    path = f"{tmp_path}/events.parquet"
    pq.write_table(
        pa.table({
            "event_id": range(n),
            "ts": pa.array([1_704_067_200_000_000 + 5000 * rng.randrange(1, 500_000_000) for _ in range(n)], pa.timestamp("us")),
            "user_id": range(n),
            "event_type": [rng.choice(["click", "sign up", None]) for _ in range(n)],
            "value": [rng.randrange(1, 56_000) / 100 for _ in range(n)],
        }),
        path,
    )
    got = Counter(r.value for r in registry.queries()["rttm_lines"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    assert got == Counter(r[0] for r in con.execute(registry.oracle_sql()["rttm_lines"]).fetchall())
    assert got[None] > 0
