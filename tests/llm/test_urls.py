from __future__ import annotations

import re

import pytest

from firmscout.llm import urls

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SCHEMA = "page_id long, url string, bad int, host string"


def judged(spark, rows, **kwargs):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {r["page_id"]: r for r in urls.judge(df.repartition(3), RULES, **kwargs).collect()}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
        ("http://net", "net", "", None, "allow"),
        ("http://x.net/", "x.net", "/", "net/", "block"),
        ("http://xnet/", "xnet", "/", None, "allow"),
        ("https://example.com/de/1#top", "example.com", "/de/1", "example.com/de/", "block"),
        ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        ("https://org/fr/", "org", "/fr/", "org/fr/", "allow"),
        ("x://y://z.net/a", "y:", "//z.net/a", None, "allow"),
        ("mailto:me", "", "", None, "allow"),
        ("://h?q/en/", "h", "", None, "allow"),
        ("http://a.net\n/b\n?c", "a.net\n", "/b\n", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    r = judged(spark, [(1, url, None)])[1]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_templates_and_purity(spark):
    rows = [(i, f"http://h.com/news/{i}", 0) for i in range(100)]
    rows += [(100 + i, f"http://h.com/spam/{i}", 1) for i in range(100)]
    rows += [(200 + i, f"http://h.com/blog/{i}.html", None) for i in range(100)]
    rows += [(300 + i, f"http://h.com/about/{'team' if i % 2 else 'us'}", None) for i in range(20)]
    rows += [(400, "http://h.com/*/1", None), (None, None, None), (401, "http://h.com/a/b/c/d/e/f/g/h/i/j/k", None)]
    rows += [(300, "http://h.com/about/team", None)]
    got = judged(spark, rows)
    assert got[0]["template"] == "/news/*" and got[0]["verdict"] == "allow"
    assert got[100]["template"] == "/spam/*" and got[100]["verdict"] == "block"
    assert got[200]["template"] == "/blog/*" and got[200]["verdict"] == "allow"
    assert got[301]["template"] == "/about/team"
    assert got[400]["template"] == "/%2A/1"
    assert got[401]["template"] == "/a/b/c/d/e/f/g/h/i/j/k"


def test_short_depth_keeps_the_rest_as_one_segment(spark):
    rows = [(i, f"http://h.com/a/{i}/c/{i}", None) for i in range(50)]
    assert judged(spark, rows, depth=2)[7]["template"] == "/a/*"


def test_no_rows_and_no_python(spark):
    assert judged(spark, []) == {}
    df = urls.judge(spark.createDataFrame([(1, "http://a/b", 0, "x")], SCHEMA), RULES)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
