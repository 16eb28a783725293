from __future__ import annotations

import random

import pytest
from oracle_check import compare, duck

from quoteloom.llm import queries, urls

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), queries.ORACLES[name]) is None


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op6_url_filters"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in (
            ("block", "net", "/"),
            ("allow", "example.net", "/en/"),
            ("block", "example.com", "/de/"),
            ("allow", "org", "/fr/"),
        )
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_odd_urls_equal_brute_force(spark):
    rng = random.Random(1)
    hosts = ["net", "a.net", "NET", "xnet", "example.net", "b.Example.NET", "example.com", "a.example.com:80", "org", "é.org", "nest.org", "", "u@net", "net."]
    tails = ["", "/", "/en/", "/en", "/EN/x", "/de/1?x=/fr/", "/fr/", "?/en/", "#/de/", "/x#net/", "/en/a/de/", "//en/", "/\n/"]
    rows = [f"{rng.choice(['http', 'https', ''])}://{h}{t}" for h in hosts for t in tails]
    rows += [None, "", "nohost/net/", "://net/", "a://b://net/", "http:/net/", rows[3], rows[3]]
    frame = spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(rows)] + [(None, "http://net/", "x", "y")],
        "page_id long, url string, host string, token string",
    )
    got = sorted((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame, urls.HOST_RULES).collect())
    want = sorted([(str(i), *brute(u)) for i, u in enumerate(rows)] + [("None", *brute("http://net/"))])
    assert got == want


def test_rules_are_indexed_by_their_rarest_token_and_need_it(spark):
    frame = spark.createDataFrame([(i, f"http://site.org/a{i % 3}/b{i % 7}") for i in range(30)], "page_id long, url string")
    rules = [urls.pattern_rule("block", "r", "/a1/b2", ["a1", "b2"]), urls.pattern_rule("block", "s", "/zzz", ["zzz"])]
    words = frame.selectExpr("explode(split(substr(url, 8), '[^a-z0-9]+')) AS token")
    index = {r.name: r.token for r in urls.rule_index(frame, words, rules).collect()}
    assert index == {"r": "b2", "s": "zzz"}
    blocked = urls.judge(frame, rules).where("verdict = 'block'").collect()
    assert [(r.page_id, r.rule) for r in blocked] == [(i, "r") for i in range(30) if i % 3 == 1 and i % 7 == 2]
    assert urls.judge(frame.limit(0), rules).count() == 0
    assert urls.judge(frame, []).where("rule IS NOT NULL").count() == 0
