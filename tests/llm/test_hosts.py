from __future__ import annotations

from pyspark.sql import functions as F

from civicmart.llm import hosts
from civicmart.llm.queries import URL_RULES


def judged(spark, urls, outcomes=(), extra=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit("x") for c in extra})
    bad = spark.createDataFrame(list(outcomes), "page_id long, bad int")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hosts.judge_urls(pages, bad, URL_RULES).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://Sub.Example.ORG/es/a?b#c", "http://example.org/en/12", "http://other.org", "https://a.com/fr/x", "https://a.com/de/",
        "https://a.com/es/", None, "no scheme/de/", "ftp://xorg/es/", "https://example.org#frag/es/", "https://notexample.org/es/",
    ]
    got = judged(spark, urls, extra=("host", "path", "rule", "n", "bad"))
    assert got[0] == ("sub.example.org", "/es/a", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("other.org", "", None, got[2][3])
    assert got[3][2:] == ("com/fr/", "allow") and got[4][2:] == ("com/de/", "block")
    assert got[5][2] is None and got[6][:3] == ("", "", None) and got[7][:3] == ("", "", None) and got[8][2] is None
    assert got[9][:2] == ("example.org", "") and got[10][2] == "org/"
    assert all(v[3] in ("allow", "block") for v in got.values())


def test_hosts_follow_their_labelled_pages(spark):
    urls = [f"https://bad.net/{i}" for i in range(40)] + [f"https://good.net/{i}" for i in range(40)]
    outcomes = [(i, 1) for i in range(40)] + [(i, 0) for i in range(40, 80)]
    got = judged(spark, urls, outcomes)
    assert {got[i][3] for i in range(40)} == {"block"}
    assert {got[i][3] for i in range(40, 80)} == {"allow"}


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, ["https://a.net/"])[0][2] is None
