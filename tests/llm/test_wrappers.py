"""Main text of pages: the tree, its alignment, wrappers and the whole operator."""

from __future__ import annotations

import html
import re
from functools import lru_cache

import pytest

from palaver.llm import dom
from palaver.llm.dom import Page, Shape, pairs, score
from palaver.llm.wrappers import induce, main_text, read_pages, references, slots

SCHEMA = "page_id long, url string, html string, host string, skeleton string, text string, menus string"
SF_DIR = "/root/testdata/sf0.001"


def extracted(spark, pages, parts=3):
    rows = [(i, *p, "a", "b", "c", "d") for i, p in enumerate(pages)]
    found = main_text(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def single(spark, *sources):
    """Texts of pages that no wrapper covers."""
    return extracted(spark, [(None, s) for s in sources])


def test_given_pages(spark):
    """The article element of the given pages, by plain text replacement."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = {}
    for page_id, url, source in pages.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", source or "", re.DOTALL)
        lines = re.sub(r"<[^>]*>?", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\n", inside[1] if inside else ""))).split("\n")
        want[page_id] = (url, "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x))
    assert {r["page_id"]: (r["url"], r["text"]) for r in main_text(pages).collect()} == want


def test_parts_that_are_no_text(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>"</p>"</script></head><body class="no-sidebar">
    <header>Site</header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div>
    <div class="page has-sidebar"><main><article class=post><header><h1>Head &amp; line</h1></header><p>One <b>two</b><br>three
    <p>Four&nbsp;five &#x41;&copy <!-- no > -->six<div class="ad-box">Buy</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>
    <form>Search<input value=">"></form><footer>By me</footer></article></main><aside>Side</aside></div>
    <section id="comments"><article class="comment"><p>First!</p></article></section><footer>Foot</footer></body></html>"""
    assert single(spark, page) == ["Head & line\nOne two three\nFour five A© six\na\nb\nc\nd"]


def test_odd_sources(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    many = "<p>a</p><h2>b</h2>" * 700
    assert single(spark, None, "", " \n ", "plain <3 text", "<p>cut <b", "<p>a</p></div></b>b<!-- open", deep, many, "<p>x" * 3, "<a title=it's>l</a> m", '<p title="a>b">q</p>') == [
        "", "", "", "plain <3 text", "cut", "a\nb", "x", "\n".join(["a", "b"] * 700), "x\nx\nx", "l m", "q",
    ]


def test_long_text(spark):
    words = "word " * 80_000
    assert single(spark, f"<article><p>{words}</article>") == [words.strip()]


def pages_of(host, n, extra=""):
    return [
        (f"https://{host}/{i}", f"<body><div class=top>Home of {host}</div>{extra if i % 3 == 0 else ''}<div class=x><ul><li><a href=1>Link {i}</a><li><a href=2>More {i}</a></ul></div>"
         f"<div class=y><h2>Title {i}</h2><p>Read on</p><p>Body {i} of <a>page</a> number {i}</p><p>Read on</p></div><div class=end>All rights kept</div></body>")
        for i in range(n)
    ]


def test_constant_slots_and_menus(spark):
    """What all pages of a host share goes, also where some pages have further nodes; slots of links go."""
    extra = "<div class=x><p>Extra for some</p></div>"
    got = extracted(spark, pages_of("a.org", 30, extra))
    assert got == [f"Title {i}\nBody {i} of page number {i}" for i in range(30)]


def test_few_pages_and_copies(spark):
    """Fewer than five distinct pages tell nothing: copies count once, and other hosts don't count."""
    copies = [pages_of("b.org", 1)[0]] * 20 + pages_of("c.org", 4) + [("not a url", "<p>Same</p>")] * 9
    got = extracted(spark, copies)
    whole = "Home of {}\nLink {}\nMore {}\nTitle {}\nRead on\nBody {} of page number {}\nRead on\nAll rights kept"
    assert got[:20] == [whole.format("b.org", *[0] * 5)] * 20
    assert got[20:24] == [whole.format("c.org", *[i] * 5) for i in range(4)]
    assert got[24:] == ["Same"] * 9


def test_near_copies_stay(spark):
    """A paragraph that half of the pages of a host share is no template."""
    pages = [(f"http://d.org/{i}", f"<article><h1>T{i}</h1><p>{'Shared text' if i % 2 else f'Own text {i}'}</p></article>") for i in range(20)]
    assert extracted(spark, pages) == [f"T{i}\n{'Shared text' if i % 2 else f'Own text {i}'}" for i in range(20)]


def test_wrapper_is_a_table(spark):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages_of("e.org", 10))], "page_id long, url string, html string")
    parsed = read_pages(frame)
    known = references(parsed)
    wrapper = induce(parsed, known).collect()
    assert [r["host"] for r in known.collect()] == ["e.org"] and len(wrapper) == 1
    assert len(wrapper[0]["constants"]) == 3 and len(wrapper[0]["menus"]) == 1


def test_empty(spark):
    found = main_text(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.isEmpty()


def shape(label, *kids):
    return Shape.of(label, kids)


@lru_cache
def largest(a, b):
    """Simple tree matching by trying all ordered matchings of the children."""
    if a.label != b.label:
        return 0

    def best(i, j):
        if i == len(a.kids) or j == len(b.kids):
            return 0
        return max(best(i + 1, j), best(i, j + 1), largest(a.kids[i], b.kids[j]) + best(i + 1, j + 1) if a.kids[i].label == b.kids[j].label else 0)

    return 1 + best(0, 0)


def test_simple_tree_matching():
    p, b = shape("p"), shape("p", shape("b"))
    one = shape("x", shape("nav", shape("a")), shape("div"), shape("y", p, shape("h"), b), shape("f"))
    two = shape("x", shape("div"), shape("nav", shape("a"), shape("c")), shape("div", p), shape("y", shape("h"), p, shape("h"), b), shape("f"))
    assert score(one, two) == largest(one, two) == 10
    assert pairs(one, two) == ((0, 1), (1, 2), (2, 3), (3, 4))
    names = slots(dom.wrote(two), dom.wrote(one))
    assert len(names) == two.size and names[0] == "0" and names[1] == "0/div:0"
    assert dom.read(dom.wrote(two)) is two


@pytest.mark.parametrize("source", ["<p>a<p>b<b>c</b><div>d</div>", "<ul><li>a<li>b<ul><li>c</ul></ul>", "<p>a</p><i>b</i><p>c</p><i>d</i>"])
def test_folding(source):
    page = Page(source)
    labels = []

    def walk(s):
        labels.append(s.label)
        for kid in s.kids:
            walk(kid)

    walk(page.shape)
    assert page.shape.size == len(labels)
    for node, text in zip(page.nodes, page.texts, strict=True):
        assert re.search(rf"<{labels[node]}>{text}", source)
