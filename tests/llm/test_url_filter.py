import pickle

import pytest

from tokenloom.llm import url_filter
from tokenloom.llm.url_filter import UrlFilter, judge_urls

CASES = [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/porn", "", "", None, "block"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://WWW.Example.com/en/1?x=porn", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://x.net/fr/", "x.net", "/fr/", "net/fr/", "block"), ("http://x.net/fr", "x.net", "/fr", None, "allow"),
    ("http://mynet/fr/", "mynet", "/fr/", None, "allow"), ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://com", "com", "", None, "allow"), ("http://shop.com?porn", "shop.com", "", None, "block"),
    ("http://free-bets.org/", "free-bets.org", "/", None, "block"), ("http://bets.org/free", "bets.org", "/free", None, "block"),
    ("http://bets.org/bets", "bets.org", "/bets", None, "allow"), ("http://alphabets.org/freedom", "alphabets.org", "/freedom", None, "allow"),
    ("http://essex.org/xxxl", "essex.org", "/xxxl", None, "allow"), ("http://a.org/#porn", "a.org", "/", None, "block"),
    ("://h/p", "h", "/p", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://é.org/Ü", "é.org", "/Ü", None, "allow"),
]


def test_cases(spark):
    d = spark.createDataFrame([(i % 3, c[0], "x") for i, c in enumerate(CASES)], "page_id long, url string, host string")
    got = sorted((r["url"] or "", r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(d).collect())
    assert got == sorted((c[0] or "", *c[1:]) for c in CASES)


def test_hits_and_empty(spark):
    f = UrlFilter(soft_hits=3, soft_weight=3)
    assert f.hits(b"http://cheap.org/free-bets/win") == (["free-bets"], ["bets", "cheap", "free", "win"])
    assert pickle.loads(pickle.dumps(f)).judge(b"http://cheap.org/free")[3] == "allow"
    assert UrlFilter(rules=(), strict=(), soft=()).judge(b"http://porn.org")[3] == "allow"
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_size_is_checked(monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_ENTRIES", 10)
    with pytest.raises(ValueError):
        UrlFilter()


def test_weights_from_a_versioned_table(spark):
    rows = [("v1", "porn", "strict", None), ("v2", "Alpha", "soft", 0.5), ("v2", "beta", "soft", 0.5), ("v2", "gamma", "soft", 1.5),
            ("v2", "delta", "soft", None), ("v2", "bad-word", "strict", 1.0), ("v2", None, "soft", 1.0), ("v2", "", "strict", 1.0), ("v2", "x", "odd", 1.0)]
    f = UrlFilter.of_table(spark.createDataFrame(rows, "version string, term string, kind string, weight double"), "v2", rules=())
    verdict = lambda path: f.judge(f"http://h.org/{path}".encode())[3]
    assert [verdict(x) for x in ("porn", "a/bad-word", "alpha/beta", "gamma", "gamma/gamma", "alpha/gamma", "alpha/beta/delta", "x")] == [
        "allow", "block", "allow", "allow", "allow", "block", "block", "allow"]
    assert UrlFilter(rules=(), soft=("a", ("a", 3.0), "b"), soft_weight=4.0).judge(b"http://h.org/a/b")[3] == "block"
    d = spark.createDataFrame([(1, "http://h.org/alpha/gamma")], "page_id long, url string")
    assert judge_urls(d, urls=pickle.loads(pickle.dumps(f))).first()["verdict"] == "block"


def test_table_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_ENTRIES", 3)
    table = spark.createDataFrame([("v", f"t{i}", "soft", 1.0) for i in range(4)], "version string, term string, kind string, weight double")
    with pytest.raises(ValueError):
        UrlFilter.of_table(table, "v", rules=())
