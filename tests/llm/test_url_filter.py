from __future__ import annotations

import random
import string

from spineloom.llm import url_filter as U

RULES = U.Rules(block=("net/", "example.com/de/", "b.org/x"), allow=("example.net/en/", "org/fr/", "a.b.org/x/y"))


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c in string.ascii_uppercase else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = []
    for action, listed in (("block", rules.block), ("allow", rules.allow)):
        for rule in listed:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), h.count("."), rule, action))
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    words = set(host.replace("-", ".").split("."))
    return host, path, None, "block" if words & set(rules.words) else "allow"


def cases():
    rng = random.Random(8)
    hosts = ["net", "example.net", "www.example.net", "EXAMPLE.com", "x.example.com", "org", "a.b.org", "b.org", "my-casino.io", "fooexample.net", "", "a..net"]
    paths = ["", "/", "/en/", "/en/1", "/de/9", "/de", "/fr/a", "/x/y", "/x/z", "/x", "?q=/en/", "#/fr/", "/en/?a#b", "/é/"]
    urls = [f"{rng.choice(['http', 'https'])}://{h}{p}" for h in hosts for p in paths]
    return urls + [None, "", "no scheme", "://", "a://b://net/", "http://ads.x/", urls[0]]


def check(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in U.filter_urls(df, rules).collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], rules), urls[r.page_id]


def test_verdicts_match_brute_force(spark):
    check(spark, cases(), RULES)


def test_join_beyond_the_size_bound(spark, monkeypatch):
    monkeypatch.setattr(U, "MOST_BITS", 8)
    check(spark, cases(), RULES)


def test_without_rules(spark):
    check(spark, cases()[:20], U.Rules())


def test_cascade_is_exact_on_its_universe(spark):
    listed = spark.range(0, 400).selectExpr("concat('k', id) AS key")
    universe = spark.range(0, 20_000).selectExpr("concat('k', id * 3) AS key")
    levels = U.cascade(listed, universe)
    assert len(levels) > 1
    both = universe.union(listed).distinct().withColumn("found", U.member(levels, universe["key"]))
    assert {r.key for r in both.where("found").collect()} == {f"k{i}" for i in range(400)}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://net/", 7, "x")], "page_id long, url string, host int, rule string")
    assert U.filter_urls(df.limit(0), RULES).collect() == []
    row = U.filter_urls(df, RULES).first()
    assert (row.host, row.rule, row.verdict) == ("net", "net/", "block")
