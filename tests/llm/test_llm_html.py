"""Main text of pages: wrappers of made-up hosts, the given pages by a plain cut, odd markup."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from bucketlens.llm import dom, html_extract

SCHEMA = "page_id BIGINT, url STRING, html STRING, host STRING, layout STRING, blocks STRING, keep STRING, text STRING"
DRAW = random.Random(5)


def words(n):
    return " ".join("".join(DRAW.choice("aeioklmnrst") for _ in range(DRAW.randint(2, 9))) for _ in range(n))


def extracted(spark, pages):
    """Text by page for (id, url, html)."""
    df = spark.createDataFrame([(*p, "h", "l", "b", "k", "t") for p in pages], SCHEMA)
    return {r.page_id: r.text for r in html_extract.extract_text(df).collect()}


def blocks_of(markup):
    return [text for _, text, _ in dom.parse(markup, html_extract.set_apart).blocks]


def test_given_pages(spark):
    """In the given pages the article is marked and holds headings and paragraphs only."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_extract.html_query(pages).collect()}
    assert len(got) == pages.count()
    for page in pages.collect():
        inner = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        parts = re.split("</?p>|</?h1>", re.sub("</?b>", "", inner.replace("<br>", " ")))
        expected = "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (expected, len(expected), page.url)


def test_template_of_a_host_without_names(spark):
    """Nothing but what pages share tells the template: no landmark, no telling class."""
    pages, expected = [], {}
    for k in range(40):
        title, paragraphs = words(6), [words(30) for _ in range(k % 5 + 1)]
        body = "".join(f"<p>{p}" for p in paragraphs)
        pages.append(
            (k, f"http://Plain.example:80/{k}", f"<title>{title}</title><div><div class=x1>Plain Site since 1999</div><div><h2>{title}</h2><div>{body}</div>"
             f"<div>All rights kept by Plain Site</div></div></div><table><tr><td>Imprint and terms</table>")
        )
        expected[k] = "\n\n".join([title, *paragraphs])
    assert extracted(spark, pages) == expected


def test_optional_parts_are_aligned_to_the_seed(spark):
    """A block that some pages lack is told by the pages that have it."""
    pages, expected = [], {}
    for k in range(30):
        text, note = words(40), "<div><b>Read our other offers</b></div>" if k % 3 else ""
        pages.append((k, f"https://a.example/{k}", f"<div>{note}<section><p>{text}</p></section><ul><li>{words(1)}</li></ul></div>"))
        expected[k] = text
    got = extracted(spark, pages)
    assert all(text in got[k] and "offers" not in got[k] for k, text in expected.items())


def test_names_links_and_comments(spark):
    page = (
        "<body><header><h1>Site</h1></header><div class='cookieNotice'>We use cookies</div><nav>Menu</nav>"
        "<main><article><header><h1>The title</h1></header><p>First <em>part</em> &amp; <a href=x>link</a>.</p><aside>Aside</aside>"
        "<div id=ad-7>Buy</div><form><label>Mail</label><input></form><ul><li>one<li>two</ul><p>Last&nbsp;&nbsp; part"
        "<section class='comments'><article><p>A reader</p></article></section><script>x('<p>no</p>')</script><style>p{}</style>"
        "<span class='share-buttons'>Share</span></article></main><div class=sidebar>Side</div><footer>Foot</footer>"
    )
    assert extracted(spark, [(1, "http://one.example", page)]) == {1: "The title\n\nFirst part & link.\n\none\n\ntwo\n\nLast part"}
    listed = "<div><div><p>" + words(50) + "</p></div><div>" + "".join(f"<p><a href=/{k}>{words(9)}</a></p>" for k in range(9)) + "</div></div>"
    got = extracted(spark, [(1, "http://one.example", listed)])
    assert got == {1: re.search("<p>([^<]*)</p>", listed)[1]}


def test_copies_are_no_template(spark):
    """Repeated pages, and a host whose pages share their article, keep it."""
    page = "<div>Menu here</div><article><h1>Same</h1><p>Same text everywhere.</article>"
    pages = [(k, "http://copies.example/x", page) for k in range(50)]
    pages += [(100 + k, "http://shared.example/x", page.replace("Menu", f"Menu {k}")) for k in range(50)]
    assert set(extracted(spark, pages).values()) == {"Same\n\nSame text everywhere."}
    bare = "<div><p>One and the same.</p></div>"
    assert set(extracted(spark, [(k, "http://copies.example/", bare) for k in range(9)]).values()) == {"One and the same."}


def test_missing_and_odd_pages(spark):
    deep = "<div>" * 3_000 + "<p>deep down" + "</div>" * 10
    long_text = words(60_000)
    pages = [
        (1, None, "<p>No url"), (2, "http://x.example", None), (3, "http://x.example", ""), (4, "", "just text"), (None, None, None),
        (5, "not a url", "<p>never <closed"), (6, "http://y.example", "<script>only()</script>"), (7, "http://deep.example", deep),
        (8, "http://long.example", f"<article><p>{long_text}"), (9, "http://z.example", "</p></div>a < b <> c <1> &lt;p&gt; &nosuch; &#233;"),
        (9, "http://z.example", "</p></div>a < b <> c <1> &lt;p&gt; &nosuch; &#233;"), (10, "http://q.example", "<a href='x>one</a><p title=\"<b>\">two"),
    ]
    got = extracted(spark, pages)
    assert got[1] == "No url" and got[2] == got[3] == got[6] == got[None] == "" and got[4] == "just text"
    assert got[7] == "deep down" and got[8] == long_text
    assert got[9] == "a < b <> c <1> <p> &nosuch; é"
    assert got[10].endswith("two")
    assert html_extract.html_query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_decisions_are_joined_without_a_broadcast(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    expected = sorted(map(tuple, html_extract.extract_text(pages).collect()))
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, html_extract.extract_text(pages).collect())) == expected


def test_measures_do_not_depend_on_the_partitions(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("host", F.lit("h"))
    one, many = (html_extract.slot_measures(pages.repartition(n)).collect() for n in (1, 13))
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


@pytest.mark.parametrize(
    "markup, blocks",
    [
        ("a<br>b<p>c<p>d</p>e", ["a b", "c", "d", "e"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<p><b>a<p>b</b>c", ["a", "bc"]),
        ("x<!-- <p>no --><!DOCTYPE q><?php no ?>y", ["xy"]),
        ("<textarea><p>no</textarea >a<TITLE>no</Title>b", ["ab"]),
        ("<p>a\t\n b　c</p><hr>d<script>never closed", ["a b c", "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
    ],
)
def test_blocks(markup, blocks):
    assert blocks_of(markup) == blocks


def test_repeats_are_folded():
    shape, places = dom.fold(dom.parse("<div><h2>a</h2><p>b<p>c<h2>d</h2><p>e</div><div><i>f</i></div>", html_extract.set_apart))
    assert shape == "root(div(h2 p) div)"
    assert places == [0, 1, 2, 3, 3, 2, 3, 4]


def plain_matching(a, b):
    """Size of the largest matching of two trees (label, children), from the definition."""
    if a[0] != b[0]:
        return 0
    sizes = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for k, y in enumerate(b[1]):
            sizes[i + 1][k + 1] = max(sizes[i][k + 1], sizes[i + 1][k], sizes[i][k] + plain_matching(x, y))
    return 1 + sizes[-1][-1]


def test_alignment_is_a_largest_matching():
    def tree(depth):
        return DRAW.choice("ab"), [tree(depth - 1) for _ in range(DRAW.randint(0, 3))] if depth else []

    def text(t):
        return t[0] + (f"({' '.join(map(text, t[1]))})" if t[1] else "")

    for _ in range(200):
        a, b = ("r", [tree(3) for _ in range(3)]), ("r", [tree(3) for _ in range(3)])
        seed, other = dom.Layout(text(a)), dom.Layout(text(b))
        partners = dom.align(seed, other)
        matched = [(p, k) for k, p in enumerate(partners) if p >= 0]
        assert len(matched) == plain_matching(a, b)
        assert len({p for p, _ in matched}) == len(matched)
        for p, k in matched:
            assert seed.labels[p] == other.labels[k]
            assert k == 0 or partners[other.parents[k]] == seed.parents[p]
        assert [p for p, _ in matched] == sorted(p for p, _ in matched)
