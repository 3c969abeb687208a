"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Defined cases: null and empty texts have no words, so every count is 0 and they fail; texts of any length are counted
whole; repeated rows and ids are judged one by one, and a metric that equals its bound passes; an empty table gives an
empty one; an input column named like an output is replaced, every other column is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

#: Frequent function words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in that is was for it with as on be at by this had not are but from or have an they which you "
    "der die und das ist nicht ein eine den von zu mit auf im dem sich des "
    "le la les de des et est un une que dans pour qui sur pas du au en "
    "el los las y que del por con para una se lo como su"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= metric <= most``; a bound that is None does not hold. Metrics are expressions over the counts."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: Ratios per word or per line with a word; a text without words has ratio 0 and fails by its length.
RULES = (
    Rule("length", "n_words", least=50),
    Rule("mean_word", "word_chars / greatest(n_words, 1)", least=1.5, most=25),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.25),
    Rule("exclamations", "n_exclaims / greatest(n_words, 1)", most=0.5),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.005),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5),
    Rule("line_length", "n_words / greatest(n_lines, 1)", least=1.2),
)
_INDEX_BITS = 21
#: Bits of a window's hash that are used; windows of equal hash are compared word by word.
_HASH_MASK = -1


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Sorts the windows by hash with their index in the low bits, compares neighbours word by word, and adds up how
    far the marked windows reach. Texts too long for the packed index sort structs instead.
    """

    def at(s: Column, i: Column) -> Column:
        return F.get(s, i)

    def window_hash(i: Column) -> Column:
        i = i.cast("int")
        made = F.xxhash64(at(words, i), at(words, i + 1), at(words, i + 2))
        return made if _HASH_MASK == -1 else made.bitwiseAND(F.lit(_HASH_MASK))

    def same(i: Column, j: Column) -> Column:
        i, j = i.cast("int"), j.cast("int")
        found = at(words, i) == at(words, j)
        for k in (1, 2):
            found = found & (at(words, i + k) == at(words, j + k))
        return found

    def reach(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, k: F.least(F.lit(3), F.coalesce(x - at(starts, k - 1), F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def marked(ordered: Column, key, index) -> Column:
        def twin(x: Column, y: Column) -> Column:
            return (key(x) == key(y)) & same(index(x), index(y))

        def meets(x: Column, i: Column) -> Column:
            """Whether a neighbour has the hash of x and other words: then the whole run of the hash is looked through."""
            clash = (key(x) == key(at(ordered, i - 1))) | (key(x) == key(at(ordered, i + 1)))
            return clash & F.exists(ordered, lambda y: (index(x) != index(y)) & twin(x, y))

        near = lambda x, i: twin(x, at(ordered, i - 1)) | twin(x, at(ordered, i + 1))
        dup = F.filter(ordered, lambda x, i: F.coalesce(near(x, i), F.lit(False)) | F.coalesce(meets(x, i), F.lit(False)))
        return let(F.sort_array(F.transform(dup, lambda x: index(x).cast("int"))), reach)

    mask = (1 << _INDEX_BITS) - 1
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    packed = F.transform(
        starts, lambda i: F.shiftleft(window_hash(i), _INDEX_BITS).bitwiseOR(i.cast("long"))
    )
    wide = F.transform(starts, lambda i: F.struct(window_hash(i).alias("h"), i.alias("i")))
    return (
        F.when(F.size(words) < 3, F.lit(0).cast("long"))
        .when(
            F.size(words) < mask,
            let(
                F.sort_array(packed),
                lambda s: marked(
                    s, lambda x: F.shiftright(x, _INDEX_BITS), lambda x: x.bitwiseAND(F.lit(mask).cast("long"))
                ),
            ),
        )
        .otherwise(let(F.sort_array(wide), lambda s: marked(s, lambda x: x["h"], lambda x: x["i"])))
    )


#: What ``measured`` adds.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")
OUTPUTS = (*COUNTS, "failed_rules", "base_failed", "kept")


def measured(df: DataFrame, text: str, stop_words=STOP_WORDS) -> DataFrame:
    """The columns of ``df``, none of them named like a count, and the counts of each text.

    A generator of one row makes the counts. Filters on them stay above it; a projection's expressions would be copied
    into every filter that names them and evaluated once more for each.
    """
    forms = sorted({form for w in stop_words for form in (w, w.capitalize())})
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(filled, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(words: Column) -> Column:
        made = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.regexp_count(filled, F.lit("[#*$%&|<>]")),
            "n_exclaims": F.regexp_count(filled, F.lit("!")),
            "n_stop_words": F.size(F.filter(words, lambda w: w.isin(forms))),
            "lines": let(lines, lambda found: F.struct(F.size(found).alias("n"), F.size(F.array_distinct(found)).alias("d"))),
            "n_repeat_words": _repeat_words(words),
        }
        return F.struct(*[c.alias(n) if n == "lines" else c.cast("long").alias(n) for n, c in made.items()])

    def flat(found: Column) -> Column:
        own = {"n_lines": found["lines"]["n"], "n_dup_lines": found["lines"]["n"] - found["lines"]["d"]}
        return F.struct(*[(own[n] if n in own else found[n]).cast("long").alias(n) for n in COUNTS])

    return df.select("*", F.inline(F.transform(F.transform(F.array(words_of(F.col(f"`{text}`"))), counts), flat)))


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, stop_words=STOP_WORDS) -> DataFrame:
    """Adds the counts, ``base_failed``, ``kept`` and ``failed_rules`` (names of the rules that a text breaks)."""
    own = [f"_{i}" for i in range(len(df.columns))]  # no name of an input column can clash with one of an output
    counted = measured(df.toDF(*own), own[df.columns.index(text)], stop_words)
    broken = []
    for rule in rules:
        value = F.expr(rule.metric).cast("double")
        fails = F.lit(False)
        if rule.least is not None:
            fails = fails | (value < rule.least)
        if rule.most is not None:
            fails = fails | (value > rule.most)
        broken.append(F.when(fails, F.lit(rule.name)))
    failed = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counted.withColumn("failed_rules", failed).withColumn("base_failed", base)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.select(*[F.col(o).alias(c) for o, c in zip(own, df.columns) if c not in OUTPUTS], *OUTPUTS)


def op1_quality_rules(spark, sf_dir):
    from .common import table

    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def judged_sql(documents: str = "documents") -> str:
    """DuckDB SQL of the same rows, with every column of ``documents`` in front."""
    forms = ", ".join(f"'{form}'" for form in sorted({f for w in STOP_WORDS for f in (w, w.capitalize())}))
    checks = []
    for rule in RULES:
        if rule.least is not None:
            checks.append(f"({rule.metric.replace('/', '* 1.0 /')}) < {rule.least}")
        if rule.most is not None:
            checks.append(f"({rule.metric.replace('/', '* 1.0 /')}) > {rule.most}")
    return f"""
WITH d AS (SELECT *, row_number() OVER () AS rid FROM {documents}),
s AS (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM
  (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM
    (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM s))),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) v(k) WHERE n >= 2 GROUP BY rid),
m AS (SELECT s.*, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g'))::BIGINT AS n_exclaims,
  len(list_filter(ws, lambda x: x IN ({forms})))::BIGINT AS n_stop_words,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM s LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
judged AS (SELECT *, NOT base_failed AND NOT ({' OR '.join(checks)}) AS kept FROM b)"""


OP1_SQL = judged_sql() + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
