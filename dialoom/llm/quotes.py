"""Quotation linking: conversations in reply order, without what their messages quote.

A line's quote level is the number of ``>`` in front of it. Lines of one level in a row are a passage; its text and each
of its lines are normalised and hashed, as are the own text and lines of every message. A passage belongs to the last
earlier message of its conversation that shares its hash, lines standing in for passages that quote in part. The parent is
the message that the hashes of the shallowest level name that names any, by their
number, where a hash that n earlier messages share counts an nth. Threads follow from the parents by pointer doubling.

Defined cases: null and empty texts quote nothing and are quoted by nothing; a null conversation or turn links with
nothing and is a thread of its own; a tie of votes goes to the later message; texts of any length are parsed whole; an
empty table gives an empty one; rows that repeat a conversation and turn are one message in links and stay rows; lines
of any length name a message, those that more earlier messages share weigh less; an input column named like an output is
replaced, others are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

#: The vote of a hash that one earlier message has; where n have it, it is an nth.
VOTE = 1_000_000
_MARK = re.compile(r"(?:[ \t]*>)+ ?")
#: Lines that announce a quote; fixed words of the four languages.
_ANNOUNCES = re.compile(r"(?i)\b(wrote|writes|said|schrieb|schreibt|a écrit|écrit|escribió|escribe)\b.*:\s*$")


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(own text, passages as (level, text)) of a message."""
    own, passages, level = [], [], 0
    for line in (text or "").split("\n"):
        mark = _MARK.match(line)
        if mark is None:
            level = 0
            own.append(line)
            continue
        depth, body = mark[0].count(">"), line[mark.end() :]
        if depth == level:
            passages[-1][1].append(body)
        else:
            if level == 0 and own and _ANNOUNCES.search(own[-1]):
                own.pop()
            passages.append((depth, [body]))
            level = depth
    return "\n".join(own).strip("\n"), [(d, "\n".join(b)) for d, b in passages]


def names(text: str) -> set[str]:
    """The normalised text and lines that can name a message: all but empty ones."""
    return {normal(text), *map(normal, text.split("\n"))} - {""}


def quoted_names(passages: list[tuple[int, str]]) -> dict[str, int]:
    """The names that passages hold, with the shallowest level that has each."""
    found: dict[str, int] = {}
    for level, text in passages:
        for name in names(text):
            found[name] = min(level, found.get(name, level))
    return found


OUTPUTS = ("n_quotes", "parent_turn", "depth", "thread")


def link_quotes(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The rows with own text in ``text``, and ``n_quotes``, ``parent_turn``, ``depth`` and ``thread`` (first turn)."""
    given = [c for c in df.columns if c not in OUTPUTS]
    own = {c: f"_{i}" for i, c in enumerate(given)}  # no name of an input column can clash with one of these
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    fields, at = rows.schema.fields, given.index(text)
    listed = T.ArrayType(T.LongType())
    schema = T.StructType([*fields, T.StructField("n_quotes", T.LongType())])
    hashes = T.StructType([*(T.StructField(n, listed) for n in ("own", "quoted", "levels"))])

    def clean(batches):
        import pyarrow as pa

        for batch in batches:
            texts, counts = [], []
            for value in batch.column(at):
                raw = value.as_py()
                kept, passages = parse(raw)
                texts.append(None if raw is None else kept)
                counts.append(len(passages))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], schema.names)

    def name(batches):
        import pyarrow as pa
        import xxhash

        code = lambda x: xxhash.xxh3_64_intdigest(x) - (1 << 63)
        for batch in batches:
            mine, quoted, levels = [], [], []
            for value in batch.column(2):
                kept, passages = parse(value.as_py())
                mine.append(sorted(map(code, names(kept))))
                asked = quoted_names(passages)
                quoted.append([code(x) for x in asked])
                levels.append(list(asked.values()))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (mine, quoted, levels)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], named_schema.names)

    # hashes are written once, without text, and read by all that follows; texts are parsed once more for the result
    c, t = F.col(own[conv]), F.col(own[turn])
    keyed = rows.select(c.alias("c"), t.alias("t"), own[text]).filter("c is not null and t is not null")
    named_schema = T.StructType([*keyed.schema.fields[:2], *hashes.fields])
    parsed = cut(keyed.mapInArrow(name, named_schema))
    each = F.explode(F.arrays_zip(F.col("quoted").alias("h"), F.col("levels").alias("level"))).alias("x")
    quoted = parsed.filter(F.size("quoted") > 0).select("c", "t", each)
    quoted = quoted.groupBy("c", "t", F.col("x.h").alias("h")).agg(F.min("x.level").alias("level"))
    asked = quoted.select("c", "h").distinct()
    mine = parsed.select("c", "t", F.explode("own").alias("h")).join(asked, ["c", "h"], "left_semi").distinct()
    # each quoted hash with the last earlier message that has it: ordered together, no pairs are made
    both = mine.select("c", "h", "t", F.col("t").alias("from")).unionByName(quoted.select("c", "h", "t", "level"), allowMissingColumns=True)
    from pyspark.sql import Window

    before = Window.partitionBy("c", "h").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    named = both.withColumns({"source": F.max("from").over(before), "n": F.count("from").over(before)}).filter("from is null and source is not null")
    votes = named.groupBy("c", "t", "level", "source").agg(F.sum(F.expr(f"{VOTE} div n")).alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("level"), "n", "source")).alias("best")
    parents = cut(votes.groupBy("c", "t").agg(best).select("c", "t", F.col("best.source").alias("up")))
    threads = follow(parents)
    out = rows.mapInArrow(clean, schema).join(threads, (c == F.col("c")) & (t == F.col("t")), "left")
    made = [
        "n_quotes", F.col("parent").alias("parent_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), F.coalesce("root", t).alias("thread"),
    ]
    return out.select(*[F.col(n).alias(x) for x, n in own.items()], *made)


def follow(parents: DataFrame) -> DataFrame:
    """(c, t, parent, depth, root) of every message with a parent, by doubling the reach of each round."""
    state = parents.select("c", "t", F.col("up").alias("parent"), F.col("up").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        next_up = state.select("c", F.col("t").alias("root"), F.col("root").alias("far"), F.col("depth").alias("more"))
        state = cut(
            state.join(next_up, ["c", "root"], "left").select(
                "c", "t", "parent", F.coalesce("far", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("far").isNotNull().alias("moved"),
            )
        )
        if not state.filter("moved").limit(1).count():
            return state.drop("moved")
        state = state.drop("moved")


def in_reply_order(linked: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations one after the other, each thread whole and every reply after what it answers."""
    return linked.orderBy(conv, "thread", turn)


def op8_quote_links(spark, sf_dir):
    linked = link_quotes(table(spark, sf_dir, "conversations"))
    return in_reply_order(linked).select("conv_id", "turn", "role", "thread", "parent_turn", "depth", "n_quotes", "text")
