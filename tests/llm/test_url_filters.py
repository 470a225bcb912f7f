from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomwork.llm import url_filters
from loomwork.llm.components import components


def link(rel, href):
    return {"canonical": f'<LINK href="{href}" rel="canonical">', "og": f"<meta property='og:url' content='{href}'/>", "refresh": f'<meta http-equiv="refresh" content="0; URL={href}">'}[rel]


def judged(spark, pages, rules, links=None):
    pages = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, verdict string")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    links = links and spark.createDataFrame(links, "source string, target string")
    out = url_filters.judged(pages, rules, links)
    return {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict) for r in out.collect()}, out


RULES = [("bad.com", "/", "block"), ("bad.com", "/ok/", "allow"), ("good.org", "/", "allow"), ("a.b", "/x", "block"), ("a.b", "/x", "allow")]


def test_rules(spark):
    pages = [
        (1, "http://BAD.com/a?b", None), (2, "https://www.bad.com/ok/x", None), (3, "https://notbad.com/", None), (4, "https://sub.bad.com", None),
        (5, None, None), (6, "no address", None), (7, "ftp://a.b/xy://z", None), (8, "x://bad.com#/ok/", ""), (9, "://bad.com/é?", None), (9, "://bad.com/é?", None),
    ]
    got, out = judged(spark, pages, RULES)
    assert out.count() == 10
    assert got[1, pages[0][1]] == ("bad.com", "/a", "bad.com/", "block")
    assert got[2, pages[1][1]] == ("www.bad.com", "/ok/x", "bad.com/ok/", "allow")
    assert got[3, pages[2][1]] == ("notbad.com", "/", None, "allow")
    assert got[4, pages[3][1]] == ("sub.bad.com", "", None, "allow")
    assert got[5, None] == got[6, "no address"] == ("", "", None, "allow")
    assert got[7, pages[6][1]] == ("a.b", "/xy://z", "a.b/x", "allow")
    assert got[8, pages[7][1]] == ("bad.com", "", None, "allow")
    assert got[9, pages[8][1]] == ("bad.com", "/é", "bad.com/", "block")


def test_blocks_reach_aliases_and_allow_takes_precedence(spark):
    pages = [
        (1, "http://m1.net/p?utm_source=x", link("canonical", "https://m2.net/q")),
        (2, "https://m2.net/q/", link("og", "//m3.net/r#top")),
        (3, "http://m3.net:80/r", link("refresh", "http://bad.com/away")),
        (4, "http://good.org/mine", link("canonical", "http://bad.com/away")),
        (5, "http://www.m1.net/p/", None),
        (6, "http://other.net/p", link("canonical", "/self")),
        (7, "http://other.net/self", None),
        (8, "http://log.net/", None),
        (9, "http://m1.net/p?id=7", None),
    ]
    got, _ = judged(spark, pages, RULES, [("http://log.net", "http://bad.com/x"), (None, "http://bad.com/x")])
    verdicts = {page: row[3] for (page, _), row in got.items()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "allow"}


def test_empty_tables(spark):
    assert judged(spark, [(1, "http://a.b/", None)], RULES)[1].where("false").collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filters.judged(pages, rules).collect() == []
    one = spark.createDataFrame([(1, "http://a.b/", "")], "page_id long, url string, html string")
    assert [r.verdict for r in url_filters.judged(one, rules).collect()] == ["allow"]


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components_equal_union_find(spark, kind):
    random.seed(kind)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 300)] + [(400, 401), (None, 3), (5, 5)],
        "random": [(random.randint(0, 300), random.randint(0, 300)) for _ in range(180)],
        "none": [],
    }[kind]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if None not in (a, b) and a != b:
            root[find(a)] = find(b)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    groups = found.groupBy("component").agg(F.collect_set("node").alias("nodes")).collect()
    want: dict[int, set] = {}
    for x in list(root):
        want.setdefault(find(x), set()).add(x)
    assert sorted(sorted(g.nodes) for g in groups) == sorted(sorted(s) for s in want.values())
