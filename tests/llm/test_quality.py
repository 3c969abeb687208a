import random
import re
from collections import Counter

from dialoom.llm import quality
from dialoom.llm.quality import Rule, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def texts():
    rng = random.Random(3)
    vocab = ["a", "b", "the", "é", "日本", "#x", "$", "|", "The", "z" * 30, " ", "\x1c"]
    out = [None, "", " \n\t ", "one", "a b", "a b a b a", "\n\nx\nx\n x\n", "　a", "a\x0bb\x0cc\rd"]
    for _ in range(80):
        gap = lambda: rng.choice([" ", " ", " ", "\n", "  ", "\t", "\r\n"])
        out.append("".join(rng.choice(vocab) + gap() for _ in range(rng.randint(1, 120))))
    out.append(" ".join(f"w{rng.randint(0, 4000)}" for _ in range(3_000)))
    return out


def test_against_brute_force(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame([(i, t, "mine", 5) for i, t in enumerate(rows)], "doc_id long, text string, kept string, n_words int")
    # the second sorts structs instead of packed numbers, the last two have windows of equal hash and other words
    for bits, mask in ((21, -1), (4, -1), (21, 3), (4, 3)):
        monkeypatch.setattr(quality, "_INDEX_BITS", bits)
        monkeypatch.setattr(quality, "_HASH_MASK", mask)
        some = rows if mask == -1 else rows[:60]
        got = {r.doc_id: tuple(r)[1:] for r in quality_rules(df.filter(df.doc_id < len(some))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
        assert [got[i] for i in range(len(some))] == [brute(t) for t in some]


def test_rules_and_columns(spark):
    good = " ".join(f"the w{i} of" for i in range(40))
    rows = [(1, good, "x"), (2, good.replace(" ", "!! "), "x"), (3, good + " #" * 60, "x"), (4, None, "x"), (4, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    got = quality_rules(df)
    assert set(df.columns) <= set(got.columns)
    assert [(r.kept, r.failed_rules) for r in got.collect()][0] == (True, [])
    assert sorted(r.kept for r in got.collect()) == [False, False, False, True, True]
    assert quality_rules(df, rules=(Rule("any", "n_words", most=1),)).filter("kept").count() == 0
    assert quality_rules(df.limit(0)).count() == 0


def test_plan_is_one_projection(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_filter_evaluates_the_counts_once(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")

    def splits(judged):
        return judged._jdf.queryExecution().optimizedPlan().toString().count("split(")

    assert splits(quality_rules(df).filter("kept").select("doc_id")) <= splits(quality_rules(df))


def test_any_name_of_an_input_column(spark):
    df = spark.createDataFrame([(1, "the of and " * 30, 2, 3, 4, 5)], "doc_id long, n_words string, _metrics int, _0 int, `a.b` int, kept int")
    got = quality_rules(df, text="n_words")
    assert {"doc_id", "_metrics", "_0", "a.b"} < set(got.columns)
    row = got.first()
    assert (row["n_words"], row["_metrics"], row["_0"], row["a.b"], row["kept"]) == (90, 2, 3, 4, False)
