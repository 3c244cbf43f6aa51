import duckdb
import pytest

from pelorus.llm import op7_url_filter as op
from pelorus.llm.registry import URL_RULES, op7_url_rules

SF = "/root/testdata/sf0.001"
URLS = [
    None, "", "no scheme", "http://", "http:///net/fr/x", "http://A.EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "http://www.example.com",
    "http://x.net/fr/1", "http://x.net/FR/1", "http://net/es/", "http://ünet/es/", "a://b://c.net/es/", "http://example.com?q=/en/",
    "http://example.com:80/en/", "http://com.example.org/en/", "http://notexample.com/en/", "http://example.com/en/" + "p" * 50000,
]


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    i = 0
    while i < len(rest) and rest[i] not in "/?#":
        i += 1
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:i])
    path = rest[i:].split("?")[0].split("#")[0]
    fit = [r for r in rules if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("hasher", [op.digest, lambda s: 7])
def test_against_brute_force(spark, hasher):
    rules = [*URL_RULES, ("b.com", "/x", "block"), ("com", "/xxx", "allow"), ("com", "/xxx", "block"), ("", "/", "block"), ("org", "", "block")]
    urls = [*URLS, "http://b.com/xxxx", "http://b.com/x", "http://z.b.com/xx", "http://e.org"]
    pages = spark.createDataFrame([(i, u, "?") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    array = op.build(spark.createDataFrame(rules, "host string, path string, verdict string"), hasher=hasher)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op.judge(pages, array).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/fr/")], "page_id long, url string")
    array = op.build(spark.createDataFrame([], "host string, path string, verdict string"))
    assert [tuple(r) for r in op.judge(pages, array).collect()] == [(1, "a.net", "/fr/", None, "allow")]
    assert op.judge(pages.limit(0), array).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = op7_url_rules(spark, SF).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(op.SQL).fetchall()))
    assert {r.verdict for r in got} == {"allow", "block"}


def test_a_host_of_a_hundred_kilobytes(spark):
    import time

    rules = spark.createDataFrame([("b.c", "/", "block"), ("c", "/x", "allow"), ("", "/", "block")], "host string, path string, verdict string")
    array = op.build(rules)
    long = ".".join("a" * 50_000) + ".b.c"
    assert array.suffixes(long) == ["b.c", "c"] and array.suffixes("c") == ["c"] and array.suffixes(".c") == [".c", "c"] and array.suffixes("") == []
    pages = spark.createDataFrame([(1, f"http://{long}/x"), (2, "http://c/xy"), (3, "http://b.c/")], "page_id long, url string")
    start = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in op.judge(pages, array).collect()}
    assert got == {1: ("b.c/", "block"), 2: ("c/x", "allow"), 3: ("b.c/", "block")} and time.time() - start < 30
