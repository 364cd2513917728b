import random
import re

import duckdb
import pytest

from chronogrid.llm import queries, url_filter

FOLDER = "/root/testdata/sf0.001"


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for rule_host, rule_path, verdict in rules:
        if host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            key = (len(rule_host + rule_path), len(rule_host), rule_host + rule_path, verdict)
            best = max(best, key) if best else key
    return (host, path, best[2] if best else None, best[3] if best else default)


def test_rules_against_all_pairs(spark):
    """Nested, equal-length and deep rules over few hosts and paths, so that many fit."""
    rng = random.Random(4)
    labels = ["a", "b", "com", "org", "x-y"]
    parts = ["", "e", "en", "en/", "en/1", "de", "de/x"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(rng.randint(1, n)))
    found = {(host(3), "/" + rng.choice(parts)): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in found.items()]
    urls = [f"http{rng.choice(['', 's'])}://{host(4).upper() if i % 7 == 0 else host(4)}/{rng.choice(parts)}{rng.choice(['', '?q=/en/', '#de/'])}" for i in range(500)]
    urls += [None, "", "no scheme/en/", "http://", "http:///en/1", "HTTP://A.COM", "http://com?x", "http://com#/en", "://org/en/1", "a://b://c/en"]
    urls += urls[:40] * 3 + ["http://" + ".".join(["a"] * 300) + ".com/en/" + "y" * 3000]
    pages = spark.createDataFrame([(i, u, "h", "x", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host string, range int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert sorted(url_filter.judge(pages, none, "block").collect(), key=str) == sorted(
        [(1, "a.com", "/x", None, "block")] * 2 + [(None, "", "", None, "block")], key=str
    )
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, queries.URL_RULES)).count() == 0


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    want = con.execute(queries.ORACLES["op5_url_filter"]).fetchall()
    got = queries.QUERIES["op5_url_filter"](spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda r: r[0])


@pytest.mark.parametrize("sign", ["Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"])
def test_plan_has_only_functions_and_equality_joins(spark, sign, capsys):
    queries.QUERIES["op5_url_filter"](spark, FOLDER).explain("formatted")
    assert sign not in capsys.readouterr().out
