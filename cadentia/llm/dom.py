"""Pages as trees of blocks, their features, and the text of chosen blocks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np

# Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
SILENT = set("script style head title noscript template svg iframe object math canvas".split())
BLOCK = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul option select textarea button legend caption".split()
)
#: What may stand in a head, whose end tag may be left out; anything else ends it.
_IN_HEAD = set("head title meta link base style script noscript template".split())
#: A start tag ends the open elements named here, unless one of the limits lies between.
_ENDS = {tag: ({"p"}, {"table", "td", "th", "button"}) for tag in BLOCK - {"option", "legend", "caption", "body", "html"}}
_ENDS |= {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TAGS = (
    "html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li nav header footer aside form table td tr "
    "blockquote pre figure figcaption button fieldset dl a span th dt dd details summary caption"
).split()
_TAG = {tag: i for i, tag in enumerate(TAGS)}
_TOKEN = re.compile(r"[a-z]+")
#: Comments, which go; scripts and styles, in which one is no comment, stay. What isn't closed reaches to the end.
_COMMENT = re.compile(r"(<(script|style)\b.*?(?:</\2\s*>|\Z))|<!--.*?(?:--!?>|\Z)", re.DOTALL | re.IGNORECASE)
_TAG_BEGINS = re.compile(r"<[a-zA-Z/!?]")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Page:
    """Nodes in page order, those of markup blocks and of any element with a class, id or role."""

    tag: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)  # one behind the last node inside
    words: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links
    marks: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)  # text and its node; breaks are line feeds

    def text(self, kept: list[bool]) -> str:
        return " ".join("".join(t if kept[n] else "\n" for n, t in self.runs).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, its node (that of the parent if it has none), own, silent
        self.silent = 0
        self.links = 0
        self._node("html", ())

    def _node(self, tag: str, tokens: tuple[str, ...]) -> int:
        page = self.page
        n = len(page.tag)
        parent = self.open[-1][1] if self.open else -1
        page.tag.append(_TAG.get(tag, len(TAGS)))
        page.tokens.append(tokens)
        page.parent.append(parent)
        page.depth.append(page.depth[parent] + 1 if parent >= 0 else 0)
        page.end.append(-1)
        for counts in (page.words, page.chars, page.linked, page.marks, page.controls):
            counts.append(0)
        if not self.open:
            self.open.append((tag, n, True, False))
        return n

    def _end_head(self, tag: str) -> None:
        """Closes an open head before what can't stand in it; a body closes it whatever is still open inside."""
        if not self.silent or tag in _IN_HEAD or tag == "html":
            return
        if self.open[-1][0] == "head":
            self._close(len(self.open) - 1)
        elif tag == "body":
            at = next((i for i, o in enumerate(self.open) if o[0] == "head"), 0)
            if at:
                self._close(at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_head(tag)
        if tag == "br" or tag == "hr":
            self.page.runs.append((self.open[-1][1], "\n"))
        if tag in VOID:
            if tag == "input":
                self.page.controls[self.open[-1][1]] += 1
            return
        if tag == "html" or (tag == "body" and any(o[0] == "body" for o in self.open)):
            return
        if tag in _ENDS:
            self._end_implied(*_ENDS[tag])
        named = [v for k, v in attrs if k in ("class", "id", "role") and v]
        parent = self.open[-1][1]
        block = tag in BLOCK
        hidden = any(k == "hidden" or (k == "style" and v and _INVISIBLE.search(v)) for k, v in attrs)
        silent = tag in SILENT or (hidden and tag not in ("html", "body"))
        if block or (named and tag not in SILENT):
            node = self._node(tag, tuple(_TOKEN.findall(" ".join(named).lower())))
            if block:
                self.page.runs.append((node, "\n"))
                if tag in ("button", "select", "textarea"):
                    self.page.controls[node] += 1
            self.open.append((tag, node, True, silent))
        else:
            self.open.append((tag, parent, False, silent))
        self.silent += silent
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def _end_implied(self, ends: set[str], limits: set[str]) -> None:
        found = 0
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in limits or (tag in BLOCK and tag not in ends):
                break
            if tag in ends:
                found = i
        if found:
            self._close(found)

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            tag, node, own, silent = self.open.pop()
            self.silent -= silent
            self.links -= tag == "a"
            if own:
                self.page.end[node] = len(self.page.tag)
                if tag in BLOCK:
                    self.page.runs.append((node, "\n"))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head("")
        if self.silent:
            return
        page, node = self.page, self.open[-1][1]
        page.runs.append((node, data))
        stripped = data.split()
        if stripped:
            n = sum(map(len, stripped))
            page.words[node] += len(stripped)
            page.chars[node] += n
            page.marks[node] += data.count(".") + data.count(",")
            if self.links:
                page.linked[node] += n

    def finish(self) -> Page:
        self.close()
        self._close(1)
        self.page.end[0] = len(self.page.tag)
        return self.page


def parse(html: str | None) -> Page:
    """The nodes and texts of a page, in time linear in its length."""
    html = _COMMENT.sub(lambda m: m[1] or "", html or "")
    closed = html.rfind(">") + 1  # a tag behind it never ends
    if cut := _TAG_BEGINS.search(html, closed):
        html = html[: cut.start()]
    builder = _Builder()
    builder.feed(html)
    return builder.finish()


#: Columns of ``features`` before those of tags and tokens.
MEASURES = (
    "depth", "place", "own words", "own link share", "own mark rate", "words", "share of page", "link share",
    "mark rate", "nodes per word", "controls", "children", "siblings", "sibling place", "same tag", "sibling words",
    "paragraph share", "ancestor links",
)


class Features:
    """A row per node of all pages: measures, tag, parent's tag, tags and attribute tokens of ancestors, own tokens.

    The measures are held, 18 numbers a node; the rest of a row is made for a slice of nodes at a time.
    """

    def __init__(self, pages: list[Page], vocabulary: dict[str, int]):
        sizes = np.array([len(p.tag) for p in pages], np.int64)
        first = np.cumsum(sizes) - sizes
        shift = np.repeat(first, sizes)
        self.total = total = int(sizes.sum())
        self.vocabulary = vocabulary

        def column(name: str) -> np.ndarray:
            return np.concatenate([np.empty(0), *(np.array(getattr(p, name), np.float64) for p in pages)])

        node = np.arange(total)
        end = column("end").astype(np.int64) + shift
        parent = column("parent").astype(np.int64)
        parent = np.where(parent >= 0, parent + shift, node)
        tag = column("tag").astype(np.int64)
        own = {name: column(name) for name in ("words", "chars", "linked", "marks", "controls")}

        def inside(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum(values)])
            return sums[end] - sums[node]

        def rate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return a / np.maximum(b, 1.0)

        all_words = inside(own["words"])
        page_words = np.repeat(all_words[first], sizes)
        root = parent == node
        siblings = np.bincount(parent[~root], minlength=total)
        order = np.lexsort((node, parent))
        before = np.empty(total)
        before[order] = np.arange(total) - np.searchsorted(parent[order], parent[order])
        pair = parent * (len(TAGS) + 1) + tag
        _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        sibling_words = np.bincount(parent[~root], weights=all_words[~root], minlength=total)
        paragraph = np.isin(tag, [_TAG["p"], _TAG["pre"], _TAG["blockquote"]])
        words_so_far = np.concatenate([[0.0], np.cumsum(own["words"])])[node]
        words_so_far -= np.repeat(words_so_far[first], sizes)
        links = inside(own["linked"])
        link_share = rate(links, inside(own["chars"]))
        self.measures = np.column_stack(
            [
                column("depth"), rate(words_so_far, page_words), own["words"], rate(own["linked"], own["chars"]),
                rate(own["marks"], own["words"]), all_words, rate(all_words, page_words), link_share,
                rate(inside(own["marks"]), all_words), rate(end - node, all_words), inside(own["controls"]),
                siblings, siblings[parent], before, rate(count[which], siblings[parent]),
                rate(sibling_words[parent], siblings[parent]), rate(inside(paragraph * own["words"]), all_words), link_share[parent],
            ]
        ).astype(np.float32)
        self.tag, self.above = tag, tag[parent]
        # (node, column) of own tokens; (first, behind, column) of what nodes inherit from an ancestor
        known = [(n, vocabulary[t]) for n, tokens in enumerate(t for p in pages for t in p.tokens) for t in set(tokens) if t in vocabulary]
        self.own = np.array(known, np.int64).reshape(-1, 2)
        self.outer = np.column_stack([self.own[:, 0] + 1, end[self.own[:, 0]], self.own[:, 1]])
        marked = np.flatnonzero(np.isin(tag, [_TAG[t] for t in ("nav", "header", "footer", "aside", "form", "article", "main")]))
        self.outer_tags = np.column_stack([marked + 1, end[marked], tag[marked]])

    def rows(self, low: int, high: int) -> np.ndarray:
        """The feature rows of some consecutive nodes."""
        n, width, words = high - low, len(TAGS) + 1, len(self.vocabulary)
        at = np.arange(n)
        one, above = np.zeros((n, width), bool), np.zeros((n, width), bool)
        one[at, self.tag[low:high]] = True
        above[at, self.above[low:high]] = True
        own = np.zeros((n, words), bool)
        mine = self.own[(self.own[:, 0] >= low) & (self.own[:, 0] < high)]
        own[mine[:, 0] - low, mine[:, 1]] = True

        def inherited(spans: np.ndarray, columns: int) -> np.ndarray:
            out = np.zeros((n, columns), bool)
            for first, behind, column in spans[(spans[:, 0] < high) & (spans[:, 1] > low)].tolist():
                out[max(first - low, 0) : behind - low, column] = True
            return out

        return np.hstack([self.measures[low:high], one, above, inherited(self.outer_tags, width), own, inherited(self.outer, words)]).astype(np.float32)
