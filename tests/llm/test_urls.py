from __future__ import annotations

import random

import pytest

from handbill.llm import urls


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]


def brute(rows, rules):
    out = []
    for i, url in rows:
        host, path = parts_of(url)
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        out.append((i, host, path, best[1], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    names = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "xa.com", "x-a.com", "a-b.a.com", "org"]
    paths = ["/", "/e", "/en/", "/en/a", "/en/a/b", "", "/é"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((rng.choice(names), rng.choice(paths)) for _ in range(20))}.values())
    rows = [(i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'www.', 'M.'])}{rng.choice(names)}{rng.choice(paths)}{rng.choice(['', 'x', '?q=/z', '#t'])}") for i in range(300)]
    rows += [(900, None), (901, "no url"), (902, "http://"), (903, "http://a.com"), (904, "http://com/en/\nnew"), (905, "x://y://a.com/"), (None, "http://a.com/en/"), (906, "http://..com//"), (3, rows[3][1])]
    df = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string").repartition(4)
    got = urls.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, rules)


def test_hot_host_is_spread_and_tables_may_be_empty(spark):
    rules = [("com", "/", "block")]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    df = spark.range(5000).selectExpr("id as page_id", "'http://one.com/same' as url")
    assert urls.judge(df, table).where("verdict = 'block'").count() == 5000
    assert urls.judge(df.limit(0), table).count() == 0
    assert urls.judge(df.limit(3), table.limit(0)).where("verdict = 'allow' and rule is null").count() == 3


def test_marks_in_hosts_and_deep_hosts(spark):
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("a\x02b.net", "/", "block")], "host string, path string, verdict string")
    rows = [(1, "http://com\x01example/en/x"), (2, "http://x.example.com/en/x"), (3, "http://" + "a." * 20000 + "example.com/en/y"), (4, "http://a\x02b.net/z"), (5, "http://net\x01a/z")]
    got = {r.page_id: r.rule for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got == {1: None, 2: "example.com/en/", 3: "example.com/en/", 4: "a\x02b.net/", 5: None}
    assert urls.judge(spark.createDataFrame(rows, "page_id long, url string").limit(0), rules).count() == 0
