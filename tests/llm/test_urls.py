from dialoom.llm.urls import ROUNDS, RULES, Rule, filter_urls, host_of, judge_hosts, path_of

from pyspark.sql import functions as F


def test_parsing(spark):
    cases = {
        "HTTP://WWW.Example.NET/en/x?q#f": ("www.example.net", "/en/x"), "https://a.org": ("a.org", ""), "x://É.com?y/z": ("É.com", ""),
        "a://b://c/d": ("b:", "//c/d"), "no scheme/x": ("", ""), None: ("", ""), "": ("", ""), "http:///p": ("", "/p"), "s://h#/p": ("h", ""),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string").select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    assert {r.url: (r.h, r.p) for r in df.collect()} == cases


def test_rules(spark):
    cases = {
        "http://a.example.net/en/1": ("example.net/en/", "allow"), "http://example.net/e": ("net/", "block"), "http://example.net": (None, None),
        "http://myexample.net/en/": ("net/", "block"), "http://example.com/de/x": ("example.com/de/", "block"), "http://x.org/fr/": ("org/fr/", "allow"),
        "http://x.org/de/": (None, None),
    }
    df = spark.createDataFrame([(i, u, None, 1) for i, u in enumerate(cases)], "page_id long, url string, html string, rule int")
    got = {r.page_id: r for r in filter_urls(df, rules=RULES).collect()}
    for i, (name, verdict) in enumerate(cases.values()):
        assert got[i].rule == name and (verdict is None or got[i].verdict == verdict)


def brute(hosts, links, seeds, damping=0.85, rounds=ROUNDS):
    total = sum(seeds.values())
    start = {h: n / total for h, n in seeds.items()}
    out = {h: sum(w for (s, _), w in links.items() if s == h) for h in hosts}
    rank = dict(start)
    for _ in range(rounds):
        moved = {}
        for (s, d), w in links.items():
            if rank.get(s):
                moved[d] = moved.get(d, 0) + damping * rank[s] * w / out[s]
        kept = sum(moved.values())
        rank = {h: moved.get(h, 0) + start.get(h, 0) * (1 - kept) for h in hosts}
    return rank


def test_ranks_against_brute_force(spark):
    link = lambda *hs: "".join(f"<a href='https://{h}/x'>t</a>" for h in hs)
    pages = [("a.x", "allow", link("b.x", "c.x")), ("b.x", None, link("c.x") + "<img src=//d.x/i.png>"), ("c.x", None, link("c.x")), ("e.x", "block", None), ("d.x", None, link("e.x")), ("d.x", None, link("e.x", "b.x")), ("f.x", None, "")]
    got = {r.host: (r.trust, r.distrust) for r in judge_hosts(spark.createDataFrame(pages, "host string, ruled string, html string")).collect()}
    links = {("a.x", "b.x"): 1, ("a.x", "c.x"): 1, ("b.x", "c.x"): 1, ("b.x", "d.x"): 1, ("d.x", "e.x"): 2, ("d.x", "b.x"): 1}
    hosts = [f"{c}.x" for c in "abcdef"]
    trust, distrust = brute(hosts, links, {"a.x": 1}), brute(hosts, {(d, s): w for (s, d), w in links.items()}, {"e.x": 1})
    for h in hosts:
        t, d = got.get(h, (0, 0))
        assert abs(t - trust[h]) < 1e-9 and abs(d - distrust[h]) < 1e-9
    assert abs(sum(t for t, _ in got.values()) - 1) < 1e-9


def test_method_verdicts_and_empty(spark):
    html = "<a href='http://bad.com/y'>x</a>"
    rows = [(1, "http://bad.com/z/1", None), (2, "http://near.com/", html), (3, "http://far.org/", None), (None, None, None), (5, "http://near.com/", html)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in filter_urls(df, rules=(Rule("bad.com", "/z/", "block"),)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", None: "allow", 5: "block"}
    assert filter_urls(df.limit(0)).count() == 0


def test_verdicts_against_brute_force(spark):
    """Final verdicts with ties between hosts and their parents, without them, and how many the ties change."""
    import random

    rng = random.Random(3)
    hosts = ["example.net", "a.example.net", "b.a.example.net", "x.org", "y.x.org", "z.com", "w.z.com", "example.com", "m.example.com", "lone.de", "q.w.z.com"]
    rows = []
    for i in range(120):
        links = "".join(f"<a href='http://{rng.choice(hosts)}/p'>t</a>" for _ in range(rng.choice([0, 0, 1, 2])))
        rows.append((i, f"https://{rng.choice(hosts)}{rng.choice(['/en/', '/de/', '/fr/', '/'])}{i}", links + ("x" * 100_000 if i == 5 else "")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    changed = {}
    for ties in (True, False):
        pages = {r.page_id: r for r in filter_urls(df, ties=ties).collect()}
        links, seeds, family = {}, {"allow": {}, "block": {}}, set()
        for i, _, html in rows:
            host = pages[i].host
            for part in html.split("href='http://")[1:]:
                if (to := part.split("/")[0]) != host:
                    links[host, to] = links.get((host, to), 0) + 1
            if pages[i].rule:
                kind = next(r.verdict for r in RULES if r.name == pages[i].rule)
                seeds[kind][host] = seeds[kind].get(host, 0) + 1
        if ties:
            for host in {r.host for r in pages.values()}:
                while host.count(".") > 1:
                    up = host.split(".", 1)[1]
                    family |= {(host, up), (up, host)}
                    host = up
        for pair in family:
            links[pair] = links.get(pair, 0) + 1
        every = {h for pair in links for h in pair} | {r.host for r in pages.values()}
        trust, distrust = brute(every, links, seeds["allow"]), brute(every, {(d, s): w for (s, d), w in links.items()}, seeds["block"])
        for i, r in pages.items():
            if r.rule is None:
                assert abs(trust[r.host] - distrust[r.host]) < 1e-9 or r.verdict == ("block" if distrust[r.host] > trust[r.host] else "allow")
            else:
                assert r.verdict == next(x.verdict for x in RULES if x.name == r.rule)
        changed[ties] = {i: r.verdict for i, r in pages.items()}
    assert any(changed[True][i] != changed[False][i] for i in changed[True])
