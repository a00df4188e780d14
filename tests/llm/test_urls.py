from __future__ import annotations

import random
from urllib.parse import urljoin

import pytest

from lmtables.llm import components
from lmtables.llm.components import connected_components
from lmtables.llm.queries import URL_RULES
from pyspark.sql import functions as F

from lmtables.llm.url_aliases import decoded, judge_urls, page_links, resolved, rule_table
from lmtables.session import stage

PAGES = "page_id long, url string, html string, host int, rule int, verdict int"
LINKS = "src string, dst string"


def judged(spark, urls, links=(), rules=URL_RULES):
    pages = spark.createDataFrame([(i, u, None, 1, 2, 3) for i, u in enumerate(urls)], PAGES)
    out = judge_urls(pages, rule_table(spark, rules), spark.createDataFrame(list(links), LINKS), key="page_id")
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r.page_id: tuple(r)[1:] for r in out.collect()}


def test_rules_and_parts(spark):
    urls = [
        "http://A.Example.NET/en/x?y#z",
        "https://b.example.net/fr/",
        "ftp://example.com/de/1",
        "http://notexample.com/de/1",
        "http://x.org/fr/a",
        "http://example.net",
        "http://host?q=/de/",
        "no scheme",
        None,
        "",
        "x://y://z/p",
    ]
    assert judged(spark, urls) == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        1: ("b.example.net", "/fr/", "net/", "block"),
        2: ("example.com", "/de/1", "example.com/de/", "block"),
        3: ("notexample.com", "/de/1", None, "allow"),
        4: ("x.org", "/fr/a", "org/fr/", "allow"),
        5: ("example.net", "", None, "allow"),
        6: ("host", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("y:", "//z/p", None, "allow"),
    }


def test_aliases_take_decisions_with_allow_first(spark):
    urls = ["http://a.com/1", "https://A.com/1#f", "http://b.net/x", "http://c.com/", "http://d.org/fr/", "http://e.com/"]
    links = [
        ("http://a.com/1", "http://b.net/x"),
        ("http://c.com/", "http://d.org/fr/"),
        ("http://e.com/", "http://c.com/"),
        ("http://e.com/", "http://q.net/"),
        ("http://e.com/", "http://e.com/#top"),
        (None, "http://q.net/"),
        ("nothing", "http://q.net/"),
    ]
    got = {k: v[-1] for k, v in judged(spark, urls, links).items()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_a_rule_of_its_own_comes_first(spark):
    got = judged(spark, ["http://a.net/", "http://a.example.net/en/"], [("http://a.net/", "http://a.example.net/en/")])
    assert (got[0][-1], got[1][-1]) == ("block", "allow")


def test_without_rules_or_rows(spark):
    assert judged(spark, ["http://a.net/"], rules=())[0][-1] == "allow"
    assert judged(spark, []) == {}


def test_links_of_pages(spark):
    html = [
        '<link rel="canonical" href="//b.com/x">',
        "<LINK href='/y?a=1&amp;b=2' REL='nofollow Canonical'>",
        '<meta http-equiv=refresh content="0; URL=z/w">',
        '<!-- <link rel="canonical" href="http://no.com/"> -->',
        '<link rel="stylesheet" href="/canonical.css"><a href="/canonical">x</a>',
        None,
    ]
    pages = spark.createDataFrame([(i, "http://a.com/d/p", h, 0, 0, 0) for i, h in enumerate(html)], PAGES)
    got = {tuple(r) for r in page_links(pages).collect()}
    assert got == {
        ("http://a.com/d/p", "http://b.com/x"),
        ("http://a.com/d/p", "http://a.com/y?a=1&b=2"),
        ("http://a.com/d/p", "http://a.com/d/z/w"),
    }


def links_of(spark, html, url="https://a.com/d/e/p?x"):
    pages = spark.createDataFrame([(i, url, h, 0, 0, 0) for i, h in enumerate(html)], PAGES)
    return sorted(r.dst for r in page_links(pages).collect())


def canonical(href):
    return f'<link rel="canonical" href="{href}">'


def test_targets_are_resolved_like_a_browser_does(spark):
    base = "https://a.com/d/e/p?x"
    hrefs = ["../q", "./q", "..", ".", "../../../up", "/x/./y/../z", "/..", "a/b/../../c", "?q=1", "http://o.com", "q/..#f/../g", "q?r=/../s"]
    expected = {h: urljoin(base, h) for h in hrefs} | {"//H.com/a/../b": "https://H.com/b"}
    rows = spark.createDataFrame([(h, base) for h in expected], "href STRING, base STRING")
    got = {r.href: r.url for r in rows.select("href", resolved(F.col("href"), F.col("base")).alias("url")).collect()}
    assert got == expected
    assert links_of(spark, [canonical("../q"), canonical("/x/../y")]) == ["https://a.com/d/q", "https://a.com/y"]


def test_references_in_targets(spark):
    assert links_of(spark, [canonical("/y?a=1&#38;b=2&#x26;c=3&amp;d&amp e&quot;&unknown;&#8364;&#0;")]) == [
        "https://a.com/y?a=1&b=2&c=3&d& e\"&unknown;\u20ac\ufffd"
    ]
    rows = spark.createDataFrame([(1, "&lt;&#128512;&GT;"), (2, None), (3, ""), (4, "&" * 3000)], "id INT, t STRING")
    assert [r[0] for r in rows.select(decoded(F.col("t"))).collect()] == ["<\U0001f600>", None, "", "&" * 3000]


def test_base_of_a_page(spark):
    base = '<base target="_top"><base href="/other/&#x78;/"><base href="http://no.com/">'
    assert links_of(spark, [base + canonical("y"), canonical("../z") + base]) == ["https://a.com/other/x/y", "https://a.com/other/z"]


def test_what_is_not_declared(spark):
    hidden = [f"<{t} a='b'>{canonical('/no')}</{t} >" for t in ("script", "STYLE", "template", "textarea")]
    html = [*hidden, f"<script>{canonical('/no')}", f"<!-- {canonical('/no')}", canonical("mailto:x"), canonical("#f"), canonical(" ")]
    assert links_of(spark, html) == []
    assert links_of(spark, ["".join(hidden) + canonical("/yes"), '<link title="a > b" rel=canonical href=/too>']) == ["https://a.com/too", "https://a.com/yes"]


def test_repeated_pages_and_very_long_urls(spark):
    long = "http://a.net/" + "x/" * 50_000
    got = judged(spark, [long, long, None, None], [(long, "http://c.example.net/en/")])
    assert [got[i][-1] for i in range(4)] == ["block", "block", "allow", "allow"]
    assert links_of(spark, [canonical("../" * 3_000 + "q")] * 2) == ["https://a.com/q"] * 2


@pytest.mark.parametrize("shape", ["random", "chain", "hub"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
        "chain": [(i, i + 1) for i in range(70)],
        "hub": [(i, 500) for i in range(200)] + [(500, 500), (None, 3)],
    }[shape]
    group = {}
    for a, b in edges:
        if a is not None and a != b:
            whole = group.setdefault(a, {a}) | group.setdefault(b, {b})
            for x in whole:
                group[x] = whole
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert sorted(tuple(r) for r in got) == sorted((x, min(g)) for x, g in group.items())


def test_edges_that_are_stars_take_no_round(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(components, "stage", lambda df, label: staged.append(label) or stage(df, label))
    edges = [(i, i % 3) for i in range(3, 30)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert sorted(tuple(r) for r in got) == [(i, i % 3) for i in range(30)] and staged == ["edges"]
    # Two centres of one node, and a centre that has one itself, are no stars.
    for edges in ([(7, 2), (7, 5)], [(7, 5), (5, 2)]):
        got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
        assert sorted(tuple(r) for r in got) == [(2, 2), (5, 2), (7, 2)]
