"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is reduced to a Boolean query over trigrams that every match must contain. The index
lists, for the trigrams that some query names, the texts that hold them; intersecting the postings of a query
gives the only texts in which its rule can match, and the expression is run on these alone. A rule without a
mandatory trigram scans every text.

Defined cases: a null text is empty and has no span; a null or repeated id costs no row (candidates are chosen by a hash of
id and text); spans with one start are listed in the order of the rules; texts of any length are scanned whole, in time
that grows with their length; an empty table gives an empty one; an input column named ``secret_spans`` is replaced,
others are kept.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, table

#: A query is a set of alternatives, each a set of trigrams that must all occur; None is "any text".
Query = frozenset[frozenset[str]] | None
MOST_STRINGS = 64
MOST_ALTERNATIVES = 128


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost and without overlap; matches shorter than ``least`` are dropped.

    ``group`` is the group that ``least`` measures, 0 for the whole match. Letters match in either case where
    ``fold`` holds. Java's matcher recurses in repeated groups, so a pattern that has one needs a ``scan``.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False
    #: What Java's matcher runs instead: it finds every match of the pattern, without recursion and in linear time;
    #: what it finds beyond is dropped by matching the pattern against it.
    scan: str | None = None


#: The first three are the base rules in the order that their spans are listed in.
RULES = (
    Rule("assign", r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("hub", r"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule(
        "web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40,
        scan=r"eyJ[A-Za-z0-9_-]++(?:\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?+",
    ),
    Rule(
        "key_block", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----",
        scan=r"-----BEGIN\x20(?:(?!PRIVATE\x20KEY-----)[A-Z]++\x20)*+PRIVATE\x20KEY-----",
    ),
)
BASE_KINDS = ("assign", "access", "hex")


def _trigrams(strings: frozenset[str]) -> Query:
    """The query of a part of a match that is exactly one of the strings."""
    if any(len(s) < 3 for s in strings):
        return None
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    product = frozenset(x | y for x in a for y in b)
    return product if len(product) <= MOST_ALTERNATIVES else min(a, b, key=len)


def _either(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return None
    union = a | b
    return union if len(union) <= MOST_ALTERNATIVES else None


def trigram_query(pattern: str, fold: bool = False) -> Query:
    """The Boolean query that every text with a match satisfies; trigrams are in lower case where ``fold`` holds.

    Walks the parsed expression with the exact strings that the part since the last break can be. A concatenation
    multiplies them, an alternation unites them, and whatever can be many strings ends them: their trigrams then
    join the conjunction.
    """

    def seq(items) -> tuple[frozenset[str] | None, Query]:
        """(every string the items can be, or None if too many; what the items need)"""
        strings: frozenset[str] | None = frozenset([""])
        need: Query = None
        whole = True
        for item in items:
            exact, inner = one(*item)
            joined = frozenset(x + y for x in strings for y in exact) if exact is not None else None
            if joined is not None and len(joined) <= MOST_STRINGS:
                strings = joined
            else:
                need, whole = _both(need, _trigrams(strings)), False
                if exact is None:
                    need, strings = _both(need, inner), frozenset([""])
                else:
                    strings = exact
        return (strings, None) if whole else (None, _both(need, _trigrams(strings)))

    def need_of(found) -> Query:
        exact, need = found
        return _trigrams(exact) if exact is not None else need

    def one(op, value) -> tuple[frozenset[str] | None, Query]:
        if op is sre.LITERAL:
            return frozenset([chr(value).lower() if fold else chr(value)]), None
        if op is sre.SUBPATTERN:
            return seq(value[3])
        if op is sre.BRANCH:
            found = [seq(x) for x in value[1]]
            if all(exact is not None for exact, _ in found):
                union = frozenset().union(*(exact for exact, _ in found))
                if len(union) <= MOST_STRINGS:
                    return union, None
            return None, reduce(_either, map(need_of, found))
        if op is sre.IN:
            chars = set()
            for kind, x in value:
                if kind is sre.LITERAL:
                    chars.add(chr(x).lower() if fold else chr(x))
                elif kind is sre.RANGE and x[1] - x[0] < 6:
                    chars |= {chr(c).lower() if fold else chr(c) for c in range(x[0], x[1] + 1)}
                else:
                    return None, None
            return (frozenset(chars), None) if len(chars) <= 6 else (None, None)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = value
            exact, need = seq(body)
            if exact is not None and most == 1 and least == 0:
                return exact | {""}, None
            return None, (need_of((exact, need)) if least else None)
        return None, None

    found = need_of(seq(sre_parser.parse(pattern)))
    return found and frozenset(x for x in found if not any(y < x for y in found))  # a stricter clause adds nothing


def _possessive(rule: Rule) -> str:
    """Matches what the scan has found if it is a match of the pattern: a part that the scan may leave out must be there."""
    return f"^(?:{rule.scan.replace('?+', '')})$" if rule.scan.endswith("?+") else f"^(?:{rule.scan})$"


def _regex(rule: Rule) -> str:
    return f"(?i){rule.pattern}" if rule.fold else rule.pattern


def running(values: Column, combine) -> Column:
    """What ``combine``, an associative function, makes of all elements up to each one; doubles its reach each round.

    A fold that appends to an array copies it at every step; this takes n log n steps in all.
    """
    last = F.greatest(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))) - 1).cast("int")

    def further(a: Column, k: Column) -> Column:
        return F.transform(a, lambda x, i: combine(x, F.get(a, i - F.call_function("shiftleft", F.lit(1), k))))

    return F.when(F.size(values) > 1, F.aggregate(F.sequence(F.lit(0), F.coalesce(last, F.lit(0))), values, further)).otherwise(values)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Structs (start, kind order, end) of a rule's matches, in code points.

    Splitting by the pattern gives what lies between the matches, so that running sums of both place each match.
    """
    regex = _regex(rule) if rule.scan is None else rule.scan
    measured = F.regexp_extract_all(text, F.lit(regex), rule.group) if rule.group else None
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def place(found: Column) -> Column:
        steps = F.transform(found["match"], lambda x, i: F.length(x) + F.length(F.get(found["gap"], i)))
        return let(running(steps, lambda x, y: x + F.coalesce(y, F.lit(0))), lambda ends: listed(found, ends))

    def listed(found: Column, ends: Column) -> Column:
        def span(x: Column, i: Column) -> Column:
            holds = F.length(x if rule.group == 0 else F.get(found["measure"], i)) >= rule.least
            if rule.scan is not None:
                holds = holds & x.rlike(_possessive(rule))
            start = F.get(ends, i) - F.length(x)
            return F.when(holds, F.struct(start.alias("start"), F.lit(order).alias("kind"), F.get(ends, i).alias("end")))

        return F.filter(F.transform(found["match"], span), lambda x: x.isNotNull())

    parts = [F.regexp_extract_all(text, F.lit(regex), 0).alias("match"), F.split(text, regex, -1).alias("gap")]
    parts += [measured.alias("measure")] if measured is not None else []
    return F.when(F.regexp_like(text, F.lit(regex)), let(F.struct(*parts), place)).otherwise(empty)


def _tight(rule: Rule) -> Rule:
    """A lone class repeated: its matches are maximal runs, so the shortest length may stand in the pattern."""
    m = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return Rule(rule.kind, f"{m[1]}{{{rule.least},}}", rule.least, 0, rule.fold) if m and rule.group == 0 and rule.least else rule


def postings(df: DataFrame, key: str, text: str, trigrams: list[str], fold: bool) -> DataFrame:
    """(key, trigram) of every listed trigram that a text holds."""
    source = F.lower(F.col(text)) if fold else F.col(text)
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_t"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return df.select(key, source.alias("_t")).select(key, F.explode(held).alias("trigram"))


def candidates(df: DataFrame, key: str, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): for each key, the indexed rules whose trigram query its postings satisfy."""
    spark = df.sparkSession
    clauses = []
    for order, rule in enumerate(rules):
        query = trigram_query(rule.pattern, rule.fold)
        for number, clause in enumerate(sorted(map(sorted, query or ()))):
            clauses += [(t, rule.fold, order, number, len(clause)) for t in clause]
    if not clauses:
        return df.select(F.col(key), F.array().cast("array<int>").alias("rules")).limit(0)
    wanted = spark.createDataFrame(clauses, "trigram string, fold boolean, rule int, clause int, needs int")
    index = None
    for fold in (False, True):
        names = sorted({c[0] for c in clauses if c[1] == fold})
        if names:
            part = postings(df, key, text, names, fold).withColumn("fold", F.lit(fold))
            index = part if index is None else index.unionByName(part)
    met = (
        index.join(F.broadcast(wanted), ["trigram", "fold"])  # the rules' own trigrams: bounded by the rule table
        .groupBy(key, "rule", "clause", "needs")
        .agg(F.count_distinct("trigram").alias("n"))
        .filter("n = needs")
    )
    return met.groupBy(key).agg(F.array_sort(F.collect_set("rule")).alias("rules"))


def secret_scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Adds ``secret_spans``: structs (kind, start, end) of all rules, by start and then rule order."""
    names = [f"_{i}" for i in range(len(df.columns))]  # no name of an input column can clash with one of these
    own = dict(zip(df.columns, names))
    id_column, text_column = own[key], own[text]
    keyed = df.toDF(*names).withColumn("scan_key", F.xxhash64(id_column, text_column))
    found = candidates(keyed, "scan_key", text_column, rules)
    joined = keyed.join(found, "scan_key", "left").withColumn("filled", F.coalesce(F.col(text_column), F.lit("")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("filled"), _tight(rule), order)
        if trigram_query(rule.pattern, rule.fold) is not None:
            spans = F.when(F.array_contains("rules", order), spans).otherwise(empty)
        parts.append(spans)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    listed = F.transform(
        F.array_sort(F.concat(*parts)),
        lambda x: F.struct(F.get(kinds, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    kept = [F.col(n).alias(c) for c, n in own.items() if c != "secret_spans"]
    return joined.select(*kept, listed.alias("secret_spans"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


#: Code points in a block of a text that is redacted.
_BLOCK = 4096


def _cut_out(blocks: Column, begin: Column, end: Column) -> Column:
    """The code points from ``begin`` to ``end`` of a text in blocks; reads its own blocks only."""
    first, last = F.floor(begin / _BLOCK).cast("int"), F.floor((end - 1) / _BLOCK).cast("int")
    head = F.get(blocks, first).substr((begin % _BLOCK) + 1, F.least(end - begin, F.lit(_BLOCK)))
    middle = F.when(last > first + 1, F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")).otherwise("")
    tail = F.get(blocks, last).substr(F.lit(1), ((end - 1) % _BLOCK) + 1)
    return F.when(end <= begin, "").when(first == last, head).otherwise(F.concat(head, middle, tail))


def redact(df: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The texts with every span of ``secret_spans`` replaced by the mask; overlapping spans become one.

    A null text stays null. The text is read in blocks, so that many spans of a very long text take no longer a span.
    """
    whole, spans = F.col(f"`{text}`"), F.col("secret_spans")

    def clean(found: Column) -> Column:
        ends, blocks = found["ends"], found["blocks"]
        before = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
        parts = F.transform(
            spans,
            lambda x, i: F.when(x["start"] >= before(i), F.concat(_cut_out(blocks, before(i), x["start"]), F.lit(mask))),
        )
        return F.concat(F.array_join(parts, ""), _cut_out(blocks, F.element_at(ends, -1), F.length(whole)))

    ends = running(F.transform(spans, lambda x: x["end"]), lambda x, y: F.greatest(x, y))
    blocks = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{_BLOCK}}}+"), 0)
    made = let(F.struct(ends.alias("ends"), blocks.alias("blocks")), clean)
    return df.withColumn(text, F.when(F.size(spans) > 0, made).otherwise(whole))


def op7_secret_scan(spark, sf_dir):
    scanned = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda x: x["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("secret_spans")).alias("spans")
    )


def spans_sql(documents: str = "documents") -> str:
    """DuckDB SQL: ``documents`` with ``secret_spans``, a list of structs (s, k, e, kind) in order."""
    lists = []
    for order, rule in enumerate(map(_tight, RULES)):
        lists.append(f"""list_filter(list_transform(range(1, len(m{order}) + 1), lambda i: {{
  's': list_sum(list_transform(g{order}[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m{order}[1:i - 1], lambda x: length(x))), 0)::BIGINT,
  'k': {order}, 'e': list_sum(list_transform(g{order}[1:i], lambda x: length(x)))::BIGINT + list_sum(list_transform(m{order}[1:i], lambda x: length(x)))::BIGINT,
  'kind': '{rule.kind}', 'n': length(v{order}[i])}}), lambda x: x.n >= {rule.least})""")
    found = ", ".join(
        f"regexp_extract_all(t, '{(x := _regex(rule).replace(chr(39), chr(39) * 2))}') AS m{i}, regexp_split_to_array(t, '{x}') AS g{i}, regexp_extract_all(t, '{x}', {rule.group}) AS v{i}"
        for i, rule in enumerate(map(_tight, RULES))
    )
    return f"""
WITH a AS (SELECT *, coalesce(text, '') AS t FROM {documents}),
b AS (SELECT *, {found} FROM a),
spans AS (SELECT * EXCLUDE ({', '.join(f'm{i}, g{i}, v{i}' for i in range(len(RULES)))}), list_sort(list_concat({', '.join(lists)})) AS secret_spans FROM b)"""


def _joined(where: str) -> str:
    return f"array_to_string(list_transform(list_filter(secret_spans, lambda x: {where}), lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"


OP7_SQL = f"""{spans_sql()}
SELECT doc_id, {', '.join(f"len(list_filter(secret_spans, lambda x: x.kind = '{k}'))::BIGINT AS n_{k}" for k in BASE_KINDS)},
  sha256(coalesce({_joined('x.k < 3')}, '')) AS base_sha256, coalesce({_joined('true')}, '') AS spans FROM spans"""
