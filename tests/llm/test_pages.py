from __future__ import annotations

import html as html_lib
import random
import re

import pytest

from lmtables.llm import wrapper
from lmtables.llm.page_tree import parse
from lmtables.llm.wrapper import align, extract_text

SCHEMA = "page_id long, url string, html string, text int, host int, layout int, blocks int"


def run(spark, pages):
    df = spark.createDataFrame([(i, u, h, 1, 2, 3, 4) for i, (u, h) in enumerate(pages)], SCHEMA)
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = sorted(out.collect(), key=lambda r: r.page_id)
    assert all(r.n_chars == len(r.text) for r in rows)
    return [r.text for r in rows]


def page(body, i=0):
    return (
        f"<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body>"
        f"<header><h1>Site</h1></header><nav><ul><li><a href='/a{i}'>link {i}</a></ul></nav><div class='cookie-notice'>We use {i}</div>"
        f"<div class=\"sidebar\"><p>side {i}</p></div>{body}<form><label>mail {i}</label><input></form>"
        f"<section id='comments'><p>reader {i} says</p></section><footer>&copy; {i}</footer></body></html>"
    )


def test_articles_are_whole_and_clean(spark):
    body = "<article><h1>Head {0}</h1><p>One <b>bold<br>line &amp; more<p>Two\n  {0}</p><div class=ad>buy {0}</div><ul><li>x<li>y {0}</ul><p>Same on all.</article>"
    pages = [(f"http://h.com/{i}", page(body.format(i), i)) for i in range(6)]
    want = ["\n\n".join([f"Head {i}", "One bold line & more", f"Two {i}", "x", f"y {i}", "Same on all."]) for i in range(6)]
    assert run(spark, pages) == want


def test_content_without_names_is_found_by_alignment(spark):
    """Plain containers only: what is equal on all pages is template, what varies is content."""
    body = "<div><div>Home News About</div><div><h2>Title {0}</h2><p>Body text number {0} goes on and on.</p><p>End {0}</p></div><div>All rights kept</div></div>"
    pages = [(f"http://plain.com/{i}", f"<html><body>{body.format(i)}</body></html>") for i in range(5)]
    assert run(spark, pages) == [f"Title {i}\n\nBody text number {i} goes on and on.\n\nEnd {i}" for i in range(5)]


def long_text(name, i, words):
    return " ".join(f"{name}{i}x{w}" for w in range(words))


@pytest.mark.parametrize(
    "body, names",
    [
        ("<div id=content><h1>{0}</h1><div class=text><p>{1}</p></div></div>", "ab"),
        ("<div class=intro><p>{0}</p></div><div class=rest><p>{1}</p></div>", "ab"),
        ("<div class=part><p>{0}</p></div><div class=part><p>{1}</p></div><div class=part><p>{2}</p></div>", "abc"),
        ("<section><h2>{0}</h2></section><section><h2>{1}</h2></section><section><h2>{2}</h2></section>", "abc"),
        ("<div><p>{0}</p><ul><li>{1}</ul><p>{2}</p></div>", "aba"),
        ("<div><p>{0}</p><table><tr><td>{1}</table><p>{2}</p></div>", "aba"),
        ("<article><p>{0}</p></article><div><p>{1}</p></div><article><p>{2}</p></article>", "abc"),
    ],
)
def test_content_is_whole_however_it_is_divided(spark, body, names):
    """No part is lost because another one holds more text."""
    pages, want = [], []
    for i in range(4):
        texts = [long_text(n + str(k), i, 6 + 8 * (n == "b")) for k, n in enumerate(names)]
        pages.append((f"http://parts.com/{i}", f"<body><div class=top>Home News</div>{body.format(*texts)}<div>All rights kept</div></body>"))
        want.append("\n\n".join(texts))
    assert run(spark, pages) == want


@pytest.mark.parametrize(
    "body",
    [
        "<form id=aspnetForm><label>Token {0}</label>{nav}<article>{text}</article><div class=comments>{side}</div></form>",
        "<form action=/><div class=page>{nav}<div class=body>{text}</div></div></form>",
        "<div class=content-sidebar-wrap>{nav}<div class=content>{text}</div><div class=sidebar>{side}</div></div>",
        "<div class=sidebar-right>{nav}<div>{text}</div></div><footer>Imprint {0}</footer>",
        "<form><div class=post-with-comments>{text}<section id=comments>{side}</section></div></form>",
        "<div class='layout sidebar'><div>{text}</div></div>",
        "<div class=side-widget>{side}</div><form><article>{text}</article></form>",
        "<div class=sidebar><main>{text}</main></div>",
        "<aside><article>{side}</article></aside><div class=content>{text}</div>",
        "<article>{text}</article><div class=related-posts>{side}{side}{side}</div>",
        "<article>{text}</article><ol class=commentlist><li><article class=comment-body>{side}{side}{side}</article></ol>",
        "<div>{text}</div><section id=comments>{side}{side}{side}{side}</section>",
    ],
)
def test_wrappers_of_the_content_are_not_dropped(spark, body):
    """What wraps the content stays whatever its name is; what stands beside or inside of the content is still dropped."""
    pages, want = [], []
    for i in range(4):
        lines = [long_text("title", i, 3), long_text("line", i, 40)]
        text = f"<h1>{lines[0]}</h1><p>{lines[1]}</p>"
        nav = f"<nav><a href=/{i}>link {i}</a></nav>"
        html = body.format(i, text=text, nav=nav, side=f"<p>{long_text('side', i, 15)}</p>").replace("<label>Token %d" % i, "<label>Token")
        pages.append((f"http://wrapped.com/{i}", f"<html><body>{html}</body></html>"))
        want.append("\n\n".join(lines))
    assert run(spark, pages) == want


def test_every_kind_of_page_of_a_host_has_a_template(spark):
    """Articles whose trees differ from each other, on a host with more listings: menus and notices are found in both."""
    menu = "<div class=top>Home News About</div>"
    listing = "<body>{menu}<table><tbody><tr><th>{0}</th><td>{1}</td></tr></tbody><tfoot><tr><td>{2}</td></tr></tfoot></table></body>"
    extra = ["<blockquote>quote {0}</blockquote>", "<h2>more {0}</h2>", "<pre>code {0}</pre>", "<ol><li>point {0}</ol>"]
    pages, want = [], []
    for i in range(9):
        texts = [long_text(n, i, 5) for n in "abc"]
        pages.append((f"http://mixed.com/list/{i}", listing.format(*texts, menu=menu)))
        want.append("\n\n".join(texts))
    for i, more in enumerate(extra):
        text, more = long_text("text", i, 20), more.format(i)
        body = f"<div class=page><div class=box><h1>title {i}</h1><div class=text><p>{text}</p>{more}</div></div><div class=hint>Subscribers read on</div></div>"
        pages.append((f"http://mixed.com/{i}", f"<body>{menu}{body}</body>"))
        want.append("\n\n".join([f"title {i}", text, re.sub("<[^>]*>", "", more)]))
    assert run(spark, pages) == want


def test_more_templates_than_models_of_one_round(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "MODELS", 2)
    pages, want = [], []
    for kind in range(5):
        for i in range(2):
            text = long_text(f"k{'abcde'[kind]}", i, 4)
            wrap = [f"<div class=k{'abcde'[kind]}{d}>" for d in "pqrst"]
            pages.append((f"http://many.com/{kind}/{i}", f"<body>{''.join(wrap)}<p>{text}</p><div>Menu</div></body>"))
            want.append(text)
    assert run(spark, pages) == want


def test_constant_texts_beside_varying_ones(spark):
    body = "<div><p>Our site uses cookies.</p><p>{0}</p><p>{1}</p><p>Tell your friends!</p></div>"
    texts = [(long_text("one", i, 5), long_text("two", i, 1 + i)) for i in range(4)]
    pages = [(f"http://same.com/{i}", f"<body>{body.format(*t)}</body>") for i, t in enumerate(texts)]
    assert run(spark, pages) == ["\n\n".join(t) for t in texts]
    pages = [(u, h.replace("<div>", "<article>").replace("</div>", "</article>")) for u, h in pages]
    assert run(spark, pages) == ["\n\n".join(["Our site uses cookies.", *t, "Tell your friends!"]) for t in texts]


def test_optional_parts(spark):
    """What only some pages have is content as well, unless it is the same on these or link lists."""
    more = ["", "<blockquote>quote</blockquote><div><pre>c</pre></div><div><h3>d</h3></div>", "<dl><dt>Ask us</dl>", "<dl><dt>Ask us</dl>"]
    pages = [(f"http://some.com/{i}", f"<body><div><h1>t {i}</h1><p>text {i}</p>{m}</div></body>") for i, m in enumerate(more)]
    assert run(spark, pages) == ["t 0\n\ntext 0", "t 1\n\ntext 1\n\nquote\n\nc\n\nd", "t 2\n\ntext 2", "t 3\n\ntext 3"]


def test_copies_of_one_page_keep_their_article(spark):
    pages = [("http://h.com/same", page("<article><p>The same text.</p></article>"))] * 40
    assert run(spark, pages) == ["The same text."] * 40


def test_odd_pages(spark):
    pages = [
        ("http://a.com/", None),
        (None, "<p>no url</p>"),
        ("http://b.com/", ""),
        ("http://c.com/", "just text &lt;b&gt; &#233;&nbsp;&unknown; 1 < 2"),
        ("http://d.com/", "<article><p>cut <b>off"),
        ("http://e.com/", "<main><table><tr><td>a<td>b<tr><td>c</table><pre>x\n  y</pre></main></div></p>"),
        ("http://f.com/", "<div>" * 3000 + "deep" + "</div>" * 3000),
        ("http://g.com/", "<article>" + "".join(f"<p>block {i}</p>" for i in range(20_000)) + "</article>"),
        ("http://h.com/", '<article><p title="a>b">q</p><p class=">broken>tail</p></article>'),
        ("http://i.com/", "<script>if (a<b) {}</script><article><h1>T</h1><textarea>t</textarea><p><span class='ad'>x</span>y</p></article>"),
    ]
    got = run(spark, pages)
    assert got[:6] == ["", "no url", "", "just text <b> é &unknown; 1 < 2", "cut off", "a\n\nb\n\nc\n\nx y"]
    assert got[6] == "deep" and got[7].count("\n\n") == 19_999
    assert got[8].startswith("q") and got[9] == "T\n\ny"
    assert run(spark, []) == []


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()
    got = run(spark, [(r.url, r.html) for r in rows])
    for r, text in zip(rows, got):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        clean = [" ".join(html_lib.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert text == "\n\n".join(b for b in clean if b)


def slow_match(a, b, i, j):
    if a[1][i] != b[1][j]:
        return 0
    below = [[n for n, p in enumerate(t[0]) if p == k] for t, k in ((a, i), (b, j))]
    best = [[0] * (len(below[1]) + 1) for _ in range(len(below[0]) + 1)]
    for x, m in enumerate(below[0]):
        for y, n in enumerate(below[1]):
            best[x + 1][y + 1] = max(best[x][y + 1], best[x + 1][y], best[x][y] + slow_match(a, b, m, n))
    return best[-1][-1] + 1


@pytest.mark.parametrize("seed", range(20))
def test_alignment_is_the_largest(seed):
    rng = random.Random(seed)
    trees = []
    for _ in range(2):
        size = rng.randrange(1, 14)
        trees.append(([-1, *(rng.randrange(i) for i in range(1, size))], ["r", *(rng.choice("abc") for _ in range(1, size))]))
    match, pairs = align(*trees)
    assert pairs == slow_match(*trees, 0, 0) == sum(m >= 0 for m in match)
    for node, partner in enumerate(match):
        if node and partner >= 0:
            assert trees[0][1][node] == trees[1][1][partner] and match[trees[0][0][node]] == trees[1][0][partner]


def test_siblings_fold():
    tree = parse("<div><p>a</p><p>b</p><p>c</p></div><div><p>d</p></div><div><p>e</p></div><div><p>f</p></div>")
    assert tree.keys == ["#page", "div", "p", "div", "p"]
    assert [b[1] for b in tree.blocks] == list("abcdef")
