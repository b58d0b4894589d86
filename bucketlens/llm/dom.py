"""Pages as trees of block elements, their layouts, and the alignment of two layouts.

A layout is a page's tree with repeats folded: of neighbouring children with the same
layout, or pairs and triples of them that come again, one stays. A page with three
paragraphs and one with thirty have the same layout, and every block of text belongs to
one of its nodes. Layouts are written as text, ``article(h1 p)``, children in order.
"""

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

# HTML element names by their part in the parsing rules.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea noscript template iframe noembed noframes xmp svg math title".split())
TRANSPARENT = {"html", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that end an open paragraph, and elements ended by a sibling of their kind.
ENDS_PARAGRAPH = HEADINGS | set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr main menu"
    " nav ol p pre search section summary table ul".split()
)
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": set(), "tfoot": {"tbody", "thead", "tr", "td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"},
}
# An element of this kind keeps what is inside from being ended by what comes later.
SCOPES = {"ul", "ol", "dl", "table", "select", "menu", "dir"}

# Attribute values without "<" are told by their quotes; any other tag ends at the first ">".
MARKUP = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/><]*)((?:[^>"'<]++|"[^"<]*"|'[^'<]*')*+|[^>]*)>|[!?][^>]*(?:>|\Z))""", re.S
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# Ends the label of a node whose own text is mostly links: menus fold apart from prose.
MOSTLY_LINKS = ".@"
# Elements nested deeper than this are no nodes of their own; their text is kept as ever.
DEEPEST = 250


@lru_cache(maxsize=4096)
def label_of(tag: str, attributes: str) -> str:
    """Element name, then its class, id and role words in order, without digits and signs."""
    found = []
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "hidden" if name.lower() == "hidden" else "".join(values)
        found += [w.strip("-") for w in re.sub(r"[^a-z\s_-]", "", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()).replace("_", "-").split()]
    return ".".join([tag, *dict.fromkeys(w for w in found if w)])


@dataclass
class Page:
    """parents, labels: of the nodes in page order, node 0 the root. blocks: (node, text, characters in links)."""

    parents: list[int]
    labels: list[str]
    blocks: list[tuple[int, str, int]]


@lru_cache(maxsize=64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I)


def parse(html: str, is_marked) -> Page:
    """The tree of a page. Inline elements are no nodes unless ``is_marked(label)``.

    Whatever the markup is like, all text outside raw elements (scripts and the like)
    lands in a block: end tags without a start are passed over, missing ones are implied.
    """
    parents, labels, blocks = [-1], ["root"], []
    tags, stack = ["root"], [0]
    pieces: list[str] = []
    link_pieces: list[str] = []
    links = 0

    def flush() -> None:
        if pieces:
            text = "".join(pieces)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                linked = " ".join(unescape("".join(link_pieces)).split()) if link_pieces else ""
                blocks.append((stack[-1], text, len(linked)))
            pieces.clear()
            link_pieces.clear()

    def close_to(depth: int) -> None:
        flush()
        del stack[depth:], tags[depth:]

    at, search = 0, MARKUP.search
    while (m := search(html, at)) is not None:
        if m.start() > at:
            piece = html[at : m.start()]
            pieces.append(piece)
            if links:
                link_pieces.append(piece)
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if not tag.isalnum():
            tag = re.sub(r"[^a-z0-9-]", "", tag)
        if m[1]:
            if tag == "a":
                links = 0
            if tag == "br":
                pieces.append(" ")
            elif tag in TRANSPARENT:
                continue
            elif tag in tags:
                # A paragraph's end tag doesn't reach out of the element around it.
                k = len(tags) - 1 - tags[::-1].index(tag)
                if tag == "p" or tag not in INLINE or not any(t not in INLINE for t in tags[k + 1 :]):
                    close_to(k)
            continue
        if tag == "a":
            links = 1
        if tag == "br" or tag == "img":
            pieces.append(" ")
            continue
        if tag in RAW:
            end = _raw_end(tag).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in TRANSPARENT:
            flush()
            continue
        attributes = m[3]
        label = label_of(tag, attributes) if attributes and ATTRIBUTE.search(attributes) else tag
        if tag in INLINE and not (label != tag and is_marked(label)):
            continue
        flush()
        if tag in ENDS_PARAGRAPH and "p" in tags:
            close_to(len(tags) - 1 - tags[::-1].index("p"))
        if tag in ENDED_BY:
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] in SCOPES:
                    break
                if tags[k] in ENDED_BY[tag]:
                    close_to(k)
                    break
        if len(stack) > DEEPEST:
            continue
        parents.append(stack[-1])
        labels.append(label)
        stack.append(len(labels) - 1)
        tags.append(tag)
    if at < len(html):
        pieces.append(html[at:])
    flush()
    chars = [0] * len(labels)
    for node, text, linked in blocks:
        chars[node] += len(text) - 2 * linked
    for node in {node for node, _, _ in blocks}:
        if chars[node] < 0:
            labels[node] += MOSTLY_LINKS
    return Page(parents, labels, blocks)


class Layout:
    """A layout's nodes in order: label, parent, children, depth."""

    def __init__(self, text: str):
        self.labels, self.parents, self.children, self.depths = [], [], [], []
        open_nodes: list[int] = []
        for token in re.findall(r"[^() ]+|\(|\)", text):
            if token == "(":
                open_nodes.append(len(self.labels) - 1)
            elif token == ")":
                open_nodes.pop()
            else:
                parent = open_nodes[-1] if open_nodes else -1
                if parent >= 0:
                    self.children[parent].append(len(self.labels))
                self.labels.append(token)
                self.parents.append(parent)
                self.children.append([])
                self.depths.append(len(open_nodes))


@lru_cache(maxsize=512)
def layout(text: str) -> Layout:
    return Layout(text)


def fold(page: Page) -> tuple[str, list[int]]:
    """The page's layout, and for every node of the page its node there."""
    n = len(page.labels)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(1, n):
        children[page.parents[node]].append(node)
    shapes: list[str] = [""] * n
    folded: list[list[list[int]]] = [[] for _ in range(n)]
    for node in range(n - 1, -1, -1):
        groups: list[list[int]] = []
        names: list[str] = []
        for child in children[node]:
            groups.append([child])
            names.append(shapes[child])
            for k in (1, 2, 3):
                if len(names) >= 2 * k and names[-k:] == names[-2 * k : -k]:
                    for again in range(-k, 0):
                        groups[again - k] += groups[again]
                    del groups[-k:], names[-k:]
                    break
        folded[node] = groups
        shapes[node] = f"{page.labels[node]}({' '.join(names)})" if names else page.labels[node]
    tree = layout(shapes[0])
    places = [0] * n
    for node in range(n):
        for group, place in zip(folded[node], tree.children[places[node]]):
            for child in group:
                places[child] = place
    return shapes[0], places


def align(seed: Layout, other: Layout) -> list[int]:
    """Simple tree matching: for each node of ``other`` its partner in ``seed``, or -1.

    Partners have the same label, their parents are partners, and partners of siblings
    come in the same order; as many nodes as possible have one. Ties go to later siblings.
    """
    at_depth: dict[tuple[int, str], list[int]] = {}
    for b, label in enumerate(other.labels):
        at_depth.setdefault((other.depths[b], label), []).append(b)
    size: dict[tuple[int, int], int] = {}

    def table(a: int, b: int) -> list[list[int]]:
        rows = [[0] * (len(other.children[b]) + 1)]
        for x in seed.children[a]:
            above, row = rows[-1], [0]
            for k, y in enumerate(other.children[b]):
                row.append(max(row[k], above[k + 1], above[k] + size.get((x, y), 0)))
            rows.append(row)
        return rows

    for a in range(len(seed.labels) - 1, -1, -1):
        for b in at_depth.get((seed.depths[a], seed.labels[a]), ()):
            size[a, b] = 1 + (table(a, b)[-1][-1] if seed.children[a] and other.children[b] else 0)
    partners = [-1] * len(other.labels)
    todo = [(0, 0)] if (0, 0) in size else []
    while todo:
        a, b = todo.pop()
        partners[b] = a
        rows = table(a, b)
        i, k = len(seed.children[a]), len(other.children[b])
        while i and k:
            x, y = seed.children[a][i - 1], other.children[b][k - 1]
            if (x, y) in size and rows[i][k] == rows[i - 1][k - 1] + size[x, y]:
                todo.append((x, y))
                i, k = i - 1, k - 1
            elif rows[i][k] == rows[i - 1][k]:
                i -= 1
            else:
                k -= 1
    return partners
