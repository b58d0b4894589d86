"""The main text of web pages, by wrappers learnt from the pages of each host.

Pages become trees, trees become layouts (see ``dom``). Of every host the most frequent
layout is the seed, to which all its other layouts are aligned by simple tree matching.
Aligned nodes are slots of the host's wrapper. What stands in a slot is compared over
all pages of the host: a slot with one and the same text on different pages is template,
the others vary and are content, unless they are set apart by their name (menus,
adverts, comments), by links making up most of them, or by standing outside the
element that is marked as the article. A node that no slot of the seed matches is judged
by the pages of its own layout.

The pages are read twice: for the measures of the slots, which are combined in every
task before the shuffle (their number follows the layouts, not the pages), and for the
text. The decisions, one row per host and layout, meet the pages by a broadcast where
they are small (measured), otherwise by a join that spreads a layout's pages.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketlens.llm import dom
from bucketlens.llm.common import spread_join
from bucketlens.session import staged

# Elements and words of class, id and role that set a part of a page apart.
APART = set("head header nav footer aside form menu dialog button select fieldset object embed audio video canvas map datalist".split())
APART_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead header toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations comment comments reply replies respond"
    " responses disqus discussion pagination pager widget widgets search searchbox skip hidden contentinfo complementary".split()
)
LANDMARKS = [{"article"}, {"main"}]
LANDMARK_WORDS = {"main": {"main", "articlebody", "article-body"}}
# Inside an article these hold its text, whatever other pages show.
FLOW = dom.HEADINGS | set("p li dt dd blockquote pre td th caption figcaption summary address".split())
# A slot with more of its characters in links than this is a list of links.
LINKED = 0.5

# Decisions that take more bytes than this are not broadcast.
BROADCAST_BYTES = 16 << 20
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

MEASURES = "pages BIGINT, text_min STRING, text_max STRING, page_min STRING, page_max STRING, chars BIGINT, linked BIGINT"
COMBINED = [F.sum, F.min, F.max, F.min, F.max, F.sum, F.sum]
MEASURE_NAMES = [m.split()[0] for m in MEASURES.split(", ")]


def _words(label: str) -> tuple[str, list[str]]:
    tag, *words = label.split(".")
    return tag, words


def set_apart(label: str) -> bool:
    """Does the name alone say that this is no part of the article?"""
    tag, words = _words(label)
    return tag in APART or any(part in APART_WORDS for w in words for part in (w, *w.split("-")))


def _is_landmark(label: str, kind: set[str]) -> bool:
    tag, words = _words(label)
    return tag in kind or any(w in LANDMARK_WORDS.get(k, ()) for k in kind for w in words)


def content_nodes(tree: dom.Layout, measures: dict[int, dict]) -> list[bool]:
    """Which nodes of a layout hold the main text.

    ``measures`` has the node's pages, text_min, text_max, page_min, page_max, chars and
    linked over all pages of the host that show it.
    """
    n = len(tree.labels)
    apart = [False] * n
    for node in range(n):
        up = tree.parents[node]
        # The header of an article holds its title.
        title = up >= 0 and tree.labels[node] == "header" and any(_is_landmark(tree.labels[up], k) for k in LANDMARKS)
        apart[node] = up >= 0 and apart[up] or set_apart(tree.labels[node]) and not title

    def inside(kind: set[str]) -> list[bool]:
        held = [False] * n
        for node in range(n):
            up = tree.parents[node]
            held[node] = not apart[node] and (up >= 0 and held[up] or _is_landmark(tree.labels[node], kind))
        return held

    def constant(m: dict) -> bool:
        return m["page_min"] != m["page_max"] and m["text_min"] == m["text_max"]

    article = next((held for kind in LANDMARKS if any((held := inside(kind))[k] for k in measures)), None)
    if article is not None:
        # What an article says stays, also where all pages of a small host say it.
        return [
            article[k] and k in measures and (_words(tree.labels[k])[0] in FLOW or not constant(measures[k])) for k in range(n)
        ]
    return [
        k in measures and not apart[k] and not constant(measures[k]) and measures[k]["linked"] <= LINKED * measures[k]["chars"]
        for k in range(n)
    ]


def _parsed(html: str | None) -> tuple[str, list[tuple[int, str, int]]]:
    """A page's layout, and its blocks with their nodes there."""
    page = dom.parse(html or "", set_apart)
    shape, places = dom.fold(page)
    return shape, [(places[node], text, linked) for node, text, linked in page.blocks]


def slot_measures(pages: DataFrame) -> DataFrame:
    """host, layout, node and the measures of what stands there; node -1 counts the layout's pages."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str, int], list] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                shape, blocks = _parsed(html.as_py())
                slots: dict[int, list] = {}
                for node, text, linked in blocks:
                    slot = slots.setdefault(node, [[], 0])
                    slot[0].append(text)
                    slot[1] += linked
                page = xxhash.xxh3_128_hexdigest(repr(blocks))
                rows = [(-1, page, 0, 0)]
                for node, (texts, linked) in slots.items():
                    joined = "\n".join(texts)
                    rows.append((node, xxhash.xxh3_128_hexdigest(joined), len(joined) - len(texts) + 1, linked))
                for node, digest, chars, linked in rows:
                    m = found.get((host, shape, node))
                    if m is None:
                        found[host, shape, node] = [1, digest, digest, page, page, chars, linked]
                    else:
                        m[:] = m[0] + 1, min(m[1], digest), max(m[2], digest), min(m[3], page), max(m[4], page), m[5] + chars, m[6] + linked
            columns = [*zip(*found), *zip(*found.values())] if found else [[]] * 10
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
            names = ["host", "layout", "node", *MEASURE_NAMES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = pages.select("host", "html").mapInArrow(measure, f"host STRING, layout STRING, node INT, {MEASURES}")
    return rows.groupBy("host", "layout", "node").agg(*(f(m).alias(m) for f, m in zip(COMBINED, MEASURE_NAMES)))


def host_wrappers(measures: DataFrame) -> DataFrame:
    """host, layout, keep (one flag per node of the layout), from what ``slot_measures`` gives."""
    layouts = measures.where("node = -1").select("host", "layout", "pages")
    seed = layouts.groupBy("host").agg(F.max_by("layout", F.struct("pages", "layout")).alias("seed"))

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, shapes, seeds = (c.to_pylist() for c in batch.columns)
            aligned = [dom.align(dom.layout(s), dom.layout(x)) for x, s in zip(shapes, seeds)]
            sizes = [len(a) for a in aligned]
            of = np.repeat(np.arange(len(aligned)), sizes)
            nodes = [k for a in aligned for k in range(len(a))]
            columns = [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(nodes, pa.int32()), pa.array([p for a in aligned for p in a], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "layout", "node", "slot"])

    pairs = spread_join(layouts.select("host", "layout"), seed, ["host"], ["layout"])
    nodes = pairs.select("host", "layout", "seed").mapInArrow(partners, "host STRING, layout STRING, node INT, slot INT")
    # Every layout has its own measures; those of a slot come from all layouts that have it.
    own = nodes.join(measures.where("node >= 0"), ["host", "layout", "node"])
    own = staged(own, "html-slots")
    of_slot = own.where("slot >= 0").groupBy("host", "slot").agg(*(f(m).alias(f"slot_{m}") for f, m in zip(COMBINED, MEASURE_NAMES)))
    judged = spread_join(own, of_slot, ["host", "slot"], ["layout", "node"])
    chosen = [F.coalesce(f"slot_{m}", m).alias(m) for m in MEASURE_NAMES]
    by_layout = judged.groupBy("host", "layout").agg(F.collect_list(F.struct("node", *chosen)).alias("slots"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for shape, slots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                flags.append(content_nodes(dom.layout(shape), {s["node"]: s for s in slots}))
            columns = [batch.column(0), batch.column(1), pa.array(flags, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "layout", "keep"])

    return by_layout.mapInArrow(decide, "host STRING, layout STRING, keep ARRAY<BOOLEAN>")


def page_blocks(pages: DataFrame) -> DataFrame:
    """page_id, url, host, layout, blocks (node, text) in page order."""

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [_parsed(html.as_py()) for html in batch.column(3)]
            ends = np.cumsum([0, *(len(b) for _, b in parsed)])
            nodes = pa.array([node for _, blocks in parsed for node, _, _ in blocks], pa.int32())
            texts = pa.array([text for _, blocks in parsed for _, text, _ in blocks], pa.string())
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([nodes, texts], names=["node", "text"]))
            shapes = pa.array([shape for shape, _ in parsed], pa.string())
            columns = [*batch.columns[:3], shapes, listed]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "layout", "blocks"])

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url STRING, host STRING, layout STRING, blocks ARRAY<STRUCT<node: INT, text: STRING>>"
    return pages.select("page_id", "url", "host", "html").mapInArrow(blocks_of, schema)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the article of every page, blocks parted by an empty line.

    Character references are decoded, white space inside a block becomes one blank. A
    NULL or empty page, and one without an article, has empty text. Pages without a host
    (NULL url, or none in it) are one group. Repeated pages come out alike and are no
    evidence of a template: that takes pages that differ. Where a host has one page only,
    names and links decide. Columns other than page_id, url and html are not looked at.
    """
    known = pages.select("page_id", "url", F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"), "html")
    wrappers = staged(host_wrappers(staged(slot_measures(known), "html-measures")), "html-wrappers")
    size = wrappers.agg(F.sum(F.length("host") + F.length("layout") + F.size("keep"))).first()[0] or 0
    blocks = page_blocks(known)
    keys = ["host", "layout"]
    if size <= BROADCAST_BYTES:
        decided = blocks.join(F.broadcast(wrappers), keys, "left")
    else:
        decided = spread_join(blocks, wrappers, keys, ["page_id", "url"])
    kept = F.filter("blocks", lambda b: F.get("keep", b["node"]))
    return decided.select("page_id", "url", F.concat_ws("\n\n", F.transform(kept, lambda b: b["text"])).alias("text"))


def html_query(pages: DataFrame) -> DataFrame:
    """page_id, url, text, and its length in characters."""
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))
