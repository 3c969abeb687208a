from dialoom.llm.quotes import in_reply_order, link_quotes, parse


def test_levels():
    own, passages = parse("Hi\nAnn wrote:\n> one two\n> three\n>> deep er\n> > same deep\nend\n>x")
    assert own == "Hi\nend"
    assert passages == [(1, "one two\nthree"), (2, "deep er\nsame deep"), (1, "x")]
    assert parse(None) == ("", []) and parse("") == ("", [])


def test_links_threads_and_order(spark):
    rows = [
        (1, 0, "the first message here\nwith a second line in it"),
        (1, 1, "another start of talk"),
        (1, 2, "> With a  SECOND line in it\nI answer the first one"),
        (1, 3, "Bob schrieb:\n> another start of talk\nand I the other"),
        (1, 4, ">> the first message here\n> I answer the first one\n> and more of it\nlast of all words"),
        (1, 5, "> the first message here\n> with a second line in it\n> another start of talk\nmost lines win"),
        (2, 0, "> the first message here\nwrong conversation though"),
        (None, 1, "> the first message here\nno conversation at all"),
        (2, 1, None), (2, 2, ""), (1, 2, "> With a  SECOND line in it\nI answer the first one"),
    ]
    df = spark.createDataFrame([(*r, "user", 9) for r in rows], "conv_id long, turn long, text string, role string, thread int")
    got = in_reply_order(link_quotes(df)).collect()
    assert len(got) == len(rows)
    one = [(r.turn, r.parent_turn, r.depth, r.thread, r.text) for r in got if r.conv_id == 1]
    assert one == [
        (0, None, 0, 0, rows[0][2]), (2, 0, 1, 0, "I answer the first one"), (2, 0, 1, 0, "I answer the first one"), (4, 2, 2, 0, "last of all words"),
        (5, 0, 1, 0, "most lines win"), (1, None, 0, 1, rows[1][2]), (3, 1, 1, 1, "and I the other"),
    ]
    assert {(r.turn, r.parent_turn, r.text) for r in got if r.conv_id == 2} == {(0, None, "wrong conversation though"), (1, None, None), (2, None, "")}
    assert link_quotes(df.limit(0)).count() == 0


def test_long_chain(spark):
    rows = [(7, k, (f"> this is message number {k - 1} of many\n" if k else "") + f"this is message number {k} of many") for k in range(40)]
    got = link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert {r.turn: (r.depth, r.thread) for r in got} == {k: (k, 0) for k in range(40)}


def test_short_and_unspaced_quotes(spark):
    """A message is named by its words however few, and by lines without blanks; lines that many share weigh less."""
    rows = [
        (1, 0, "Yes please"), (1, 1, "今天天气很好\n我们去公园吧"), (1, 2, "OK"), (1, 3, "OK\nNo"),
        (1, 4, "> Yes please\nof course"), (1, 5, "> 我们去公园吧\n好"), (1, 6, "> OK\n> 今天天气很好\nand both"),
    ]
    got = link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert {r.turn: r.parent_turn for r in got} == {0: None, 1: None, 2: None, 3: None, 4: 0, 5: 1, 6: 1}


def test_shallowest_level_names_the_parent(spark):
    rows = [
        (1, 0, "line one of zero\nline two of zero\nline three of zero"),
        (1, 1, "> line one of zero\nthe answer of one"),
        (1, 2, "> the answer of one\n>> line one of zero\n>> line two of zero\n>> line three of zero\nnested reply"),
        (1, 3, "> a line that nobody wrote\n>> nested reply\nonly the deeper one is known"),
        (1, 4, ">> the answer of one\n> nested reply\n>> the answer of one\nboth"),
    ]
    got = link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert {r.turn: (r.parent_turn, r.depth) for r in got} == {0: (None, 0), 1: (0, 1), 2: (1, 2), 3: (2, 3), 4: (2, 3)}


def brute(rows):
    """(parent, depth, thread) of each message, by going through every earlier message of its conversation."""
    from dialoom.llm.quotes import normal, parse

    def all_names(text):
        return {x for x in [normal(text), *map(normal, text.split("\n"))] if x}

    out = {}
    for conv in {c for c, *_ in rows}:
        held, up = [], {}
        for _, turn, text in sorted(r for r in rows if r[0] == conv):
            own, passages = parse(text)
            levels = {}
            for level, passage in passages:
                for x in all_names(passage):
                    levels[x] = min(level, levels.get(x, level))
            votes = {}
            for x, level in levels.items():
                have = [k for k, named in held if x in named]
                if have:
                    of = votes.setdefault(level, {})
                    of[have[-1]] = of.get(have[-1], 0) + 1_000_000 // len(have)
            if votes:
                first = votes[min(votes)]
                up[turn] = max(first, key=lambda k: (first[k], k))
            held.append((turn, all_names(own)))
            chain, at = 0, turn
            while at in up:
                at, chain = up[at], chain + 1
            out[conv, turn] = (up.get(turn), chain, at)
    return out


def test_against_brute_force(spark):
    import random

    rng, rows = random.Random(6), []
    lines = ["Yes.", "no", "the plan is set", "  Meet  at NOON ", "好的", "see you", "> kept", "a line of some length here", "wer?"]
    for conv in range(25):
        texts = []
        for turn in range(rng.randint(1, 14)):
            own = [rng.choice(lines[:6] + lines[7:]) + (f" {turn}" if rng.random() < 0.4 else "") for _ in range(rng.randint(0, 4))]
            text = []
            if texts and rng.random() < 0.8:
                source = rng.choice(texts).split("\n")
                part = source if rng.random() < 0.5 else rng.sample(source, rng.randint(1, len(source)))
                text = (["X wrote:"] if rng.random() < 0.3 else []) + [rng.choice(["> ", ">", ">> "]) + x for x in part]
            rng.random() < 0.3 and text and text.insert(0, "")
            texts.append("\n".join(text + own))
            rows.append((conv, turn * 2, texts[-1]))
    rows.append((99, 0, "long " * 200_000))
    rows.append((99, 1, "> " + "long " * 200_000 + "\nindeed"))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, text string, c string, _0 int").repartition(3)
    got = {(r.conv_id, r.turn): (r.parent_turn, r.depth, r.thread) for r in link_quotes(df).collect()}
    want = brute(rows)
    assert got == want and sum(v[0] is not None for v in want.values()) > 60 and want[99, 1] == (0, 1, 0)
    assert {"c", "_0"} < set(link_quotes(df).columns)
