import random

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import Rule

SCHEMA = "page_id long, url string"


def brute_force(url, rules, default="allow"):
    host, path = url_filter.host_and_path(url)
    best = None
    for r in rules if host else ():
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            rank = (r.host.count("."), len(r.path), r.verdict == "block")
            best = max(best or (rank, r), (rank, r), key=lambda x: x[0])
    return (host, path, best[1].text, best[1].verdict) if best else (host, path, None, default)


def test_host_and_path():
    assert url_filter.host_and_path("HTTP://User@Ex.COM:80/A/b?c#d") == ("user@ex.com:80", "/A/b")
    assert url_filter.host_and_path("x://ÀB?q/://z") == ("Àb", "")
    assert url_filter.host_and_path("a://b#/c") == ("b", "")
    assert url_filter.host_and_path("://") == ("", "")
    assert url_filter.host_and_path("example.org/es/") == ("", "") == url_filter.host_and_path(None)


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    labels, segments = ["a", "b", "org", "com", ""], ["", "x", "xy", "y", "1"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join("/" + rng.choice(segments) for _ in range(rng.randint(0, 3)))
    rules = [Rule(rng.choice(["allow", "block"]), host() or "a", path()) for _ in range(120)]
    rows = [(i, f"http://{host()}{path()}{rng.choice(['', '?a/b', '#x'])}") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS host", "3 AS rule")
    expected = {i: brute_force(u, rules) for i, u in rows}
    assert {r[0]: tuple(r)[1:] for r in url_filter.judge_urls(df, rules).collect()} == expected
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 40_000)
    assert len(list(url_filter._parts(rules))) > 2
    assert {r[0]: tuple(r)[1:] for r in url_filter.judge_urls(df, rules).collect()} == expected


def test_odd_rows(spark):
    urls = [None, "", "://", "nothing", "a://" + "x." * 5000 + "org/" + "y/" * 5000, "s://Example.ORG/en/17", "s://Example.ORG/en/17",
            "s://example.org", "s://www.example.org/es/", "s://example.org.de/es/", "s://a.com/de/x", "s://a.com/fr/?x"]
    rows = [(i if i else None, u) for i, u in enumerate(urls)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES, default="block").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *brute_force(u, URL_RULES, "block"))) for i, u in rows)


def test_empty_table_and_no_rules(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
    got = url_filter.judge_urls(spark.createDataFrame([(1, "s://a/b")], SCHEMA), []).first()
    assert tuple(got) == (1, "a", "/b", None, "allow")
