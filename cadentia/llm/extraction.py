"""Main text of web pages: boosted trees over DOM features, decoded from the root down.

The trees are trained here. Nobody has labelled the pages, so passages of a bounded sample of
them are laid out anew in pages of many kinds whose parts are known: articles in different
containers, with menus, headers, footers, sidebars, notices, adverts, forms, share bars and
reader comments around and inside them, with end tags missing or the end cut off. Decoding
chooses the best set of open nodes: a node is only kept if its parent is, so no descendant of
a dropped block comes back and no kept block hangs in the air.
"""

from __future__ import annotations

import html as markup
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm import boosting
from cadentia.llm.dom import Features, Page, parse

#: Pages whose passages are laid out anew, the longest of them, and the pages made of them.
SAMPLE, SAMPLE_CHARS, LAYOUTS = 200, 100_000, 450
#: Attribute tokens that become features.
TOKENS = 80
TREES, DEPTH = 36, 4
SEED = 5
#: Characters of pages parsed together, and nodes whose features are held at once.
CHARS_AT_ONCE, NODES_AT_ONCE = 1 << 18, 4096

_CONTENT = [
    "<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
    '<div class="content">{}</div>', '<div id="content"><div class="post">{}</div></div>', '<div class="article-body">{}</div>',
    '<section class="story">{}</section>', '<div class="entry-content">{}</div>', '<table><tr><td class="text">{}</td></tr></table>',
    '<div id="main"><div class="wrapper">{}</div></div>', "<div>{}</div>", "{}",
]
_SIDE = [
    "<nav>{links}</nav>", "<nav>{links}</nav>", '<div class="menu">{links}</div>', '<div id="navigation">{links}</div>', '<ul class="nav">{items}</ul>',
    "<header>{short}</header>", '<div class="header">{short}{links}</div>', '<div id="masthead">{short}</div>', '<header class="site-header"><h1>{plain}</h1>{links}</header>',
    "<aside>{long}</aside>", "<aside><h3>{plain}</h3>{links}</aside>", '<div class="sidebar">{links}{short}</div>', '<div id="sidebar"><div class="widget">{short}</div></div>',
    '<div class="related"><h3>{plain}</h3>{links}</div>', '<div class="breadcrumbs">{links}</div>', '<section class="recommended">{links}</section>',
]
_ANYWHERE = [
    '<div class="ad">{short}</div>', '<div class="ad">{plain}</div>', '<div class="ads">{short}</div>', '<div class="advert">{plain}</div>', '<div class="advertisement"><a href="/x">{plain}</a></div>',
    '<div class="banner">{short}</div>', '<div class="sponsored">{short}</div>', '<div class="promo">{short}</div>', '<aside class="promo">{short}</aside>',
    '<div class="cookie-notice">{short}<button>{word}</button></div>', '<div class="notice">{short}</div>', '<div role="alert">{plain}</div>', '<div class="consent">{short}</div>', '<p class="notice">{plain}</p>', '<div class="disclaimer">{short}</div>',
    '<form action="/s"><label>{word}</label><input name="q"><button>{word}</button></form>', '<form class="newsletter"><p>{plain}</p><input type="email"><button>{word}</button></form>', '<form><select><option>{word}</option><option>{word}</option></select><textarea>{plain}</textarea></form>',
    '<div class="share">{links}</div>', '<ul class="social">{items}</ul>', '<div class="newsletter">{short}</div>', '<div class="popup">{short}</div>',
]
_COMMENTS = [
    '<section class="comments"><h2>{plain}</h2>{replies}</section>', '<div id="comments">{replies}</div>', '<ol class="comment-list">{replies}</ol>',
    '<section id="comments"><h3>{plain}</h3>{replies}<form><textarea></textarea><button>{word}</button></form></section>', '<div class="discussion">{replies}</div>', '<div class="responses">{replies}</div>',
]
_REPLY = ['<div class="comment"><p>{long}</p></div>', '<article class="comment"><b>{word}</b><p>{long}</p></article>', '<li class="comment"><p>{long}</p></li>', '<div class="reply"><span class="author">{word}</span><p>{plain}</p></div>']
_FOOT = ["<footer>{plain}</footer>", "<footer>&copy; {plain} &middot; {plain}</footer>", "<footer>{links}{short}</footer>", '<div class="footer">{short}{links}</div>', '<div id="footer"><p>{plain}</p></div>', '<div class="copyright">{plain}</div>']
#: Inside articles: ``@`` is a passage, ``~`` a few words, and what stands between ``%`` repeats.
_RICH = [
    "<table>%<tr><td>~</td><td>~</td></tr>%</table>", "<table><thead><tr><th>~</th><th>~</th></tr></thead><tbody>%<tr><td>~</td><td>~</td></tr>%</tbody></table>",
    "<table><caption>~</caption>%<tr><th>~</th><td>~</td><td>~</td></tr>%</table>", '<table class="data">%<tr><td>~</td><td>@</td></tr>%</table>',
    '<figure><img src="/i.png"><figcaption>~</figcaption></figure>', "<figure><figcaption>@</figcaption></figure>", '<figure class="image"><img src="/i.png"><figcaption><p>~</p></figcaption></figure>', "<figure><pre>@</pre><figcaption>~</figcaption></figure>",
    "<dl>%<dt>~</dt><dd>@</dd>%</dl>", "<dl>%<dt>~<dd>~%</dl>", '<dl class="terms">%<dt><b>~</b></dt><dd><p>@</p></dd>%</dl>',
    "<details><summary>~</summary><p>@</p></details>", "<details open><summary>~</summary>@</details>", "<details><summary>~</summary><ul>%<li>~</li>%</ul></details>",
    "<ol>%<li>~</li>%</ol>", "<ol>%<li><p>@</p></li>%</ol>", "<section><h3>~</h3><p>@</p></section>", '<div class="quote"><p>@</p></div>', "<blockquote><p>@</p><cite>~</cite></blockquote>", "<pre><code>@</code></pre>", "<h3>~</h3>", "<p>~</p>",
]
#: Stands for kept text while a layout is labelled: each of its words ends with this character.
_MARK = "\ue000"


class _Layouts:
    """Pages of known parts, made of passages."""

    def __init__(self, passages: list[str], seed: int):
        self.random = random.Random(seed)
        self.passages = passages
        self.words = [w for p in passages for w in p.split()] or ["word"]

    def _phrase(self, least: int, most: int) -> str:
        n = self.random.randint(least, most)
        at = self.random.randrange(len(self.words))
        return markup.escape(" ".join(self.words[at : at + n])) or "word"

    def _links(self) -> list[str]:
        return [f'<a href="/{i}">{self._phrase(1, 3)}</a>' for i in range(self.random.randint(2, 9))]

    def _fill(self, template: str) -> str:
        while "{" in template:
            before, _, rest = template.partition("{")
            kind, _, after = rest.partition("}")
            if kind == "links":
                links = self._links()
                value = "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>" if self.random.random() < 0.7 else " | ".join(links)
            elif kind == "items":
                value = "".join(f"<li>{a}</li>" for a in self._links())
            elif kind == "replies":
                value = "".join(self._fill(self.random.choice(_REPLY)) for _ in range(self.random.randint(1, 6)))
            elif kind == "short":
                value = f"<p>{self._phrase(2, 14)}</p>" if self.random.random() < 0.5 else self._phrase(2, 14)
            elif kind == "long":
                value = self._phrase(8, 60)
            else:
                value = self._phrase(1, 2) if kind == "word" else self._phrase(2, 14)
            # what was filled in has no braces of its own
            template = before + value.replace("{", "(").replace("}", ")") + after
        return template

    def _passage(self) -> str:
        text = self.random.choice(self.passages) if self.passages else self._phrase(5, 40)
        if self.random.random() < 0.15:
            text = " ".join(text.split()[: self.random.randint(1, 4)])
        return " ".join(markup.escape(w) + _MARK for w in text.split())

    def _rich(self, template: str) -> str:
        """A template of what articles hold besides paragraphs: ``@`` is a kept passage, ``~`` a few kept words, ``%`` repeats its row."""
        before, row, after = template.split("%") if "%" in template else (template, "", "")
        filled = before + row * self.random.randint(1, 6) + after
        short = lambda: " ".join(self._passage().split()[: self.random.randint(1, 8)])
        return "".join(self._passage() if c == "@" else short() if c == "~" else c for c in filled)

    def _article(self) -> str:
        parts = [f"<h{self.random.choice([1, 1, 1, 2])}>{self._passage()[:120]}{_MARK}</h1>"] if self.random.random() < 0.85 else []
        for _ in range(self.random.choice([0, 1, 1, 2, 3, 4, 6, 9, 14])):
            text, kind = self._passage(), self.random.random()
            if self.random.random() < 0.16:
                parts.append(self._rich(self.random.choice(_RICH)))
            elif kind < 0.62:
                parts.append(f"<p>{text}</p>")
            elif kind < 0.72:
                parts.append(f"<p><b>{text}<br>")  # end tags forgotten
            elif kind < 0.76:
                parts.append(f"<p>{text}")
            elif kind < 0.80:
                parts.append(f"<h2>{text[:60]}{_MARK}</h2>")
            elif kind < 0.84:
                parts.append("<ul>" + "".join(f"<li>{self._passage()}</li>" for _ in range(self.random.randint(1, 5))) + "</ul>")
            elif kind < 0.87:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.90:
                parts.append(f"<div>{text}</div>")
            elif kind < 0.92:
                parts.append(f"<pre>{text}</pre>")
            elif kind < 0.95:
                parts.append(f'<p>{text} <a href="/y">{self._passage()[:40]}{_MARK}</a></p>')
            else:
                parts.append(f"{text}<br>")
            if self.random.random() < 0.08:
                parts.append(self._fill(self.random.choice(_ANYWHERE + _SIDE[9:])))
        if self.random.random() < 0.1:
            parts.append(self._fill(self.random.choice(_COMMENTS)))
        return "".join(parts)

    def page(self) -> str:
        r = self.random
        if r.random() < 0.3:  # the plainest and most frequent kind
            parts = [r.choice(_SIDE[:2]), "<!-- x -->", r.choice(_ANYWHERE[:2]), None, r.choice(_FOOT[:2])]
        else:
            parts = r.choices(_SIDE, k=r.randint(0, 3)) + r.choices(_ANYWHERE, k=r.randint(0, 2)) + [None]
            parts += r.choices(_ANYWHERE + _SIDE, k=r.randint(0, 2)) + r.choices(_COMMENTS, k=r.random() < 0.35)
            parts += r.choices(_FOOT, k=r.random() < 0.8)
            parts = [None] if r.random() < 0.08 else parts  # nothing but the article
        container = r.choice(_CONTENT[:2]) if len(parts) == 5 and parts[1] == "<!-- x -->" else r.choice(_CONTENT)
        body = "".join(container.replace("{}", self._article()) if p is None else self._fill(p) for p in parts)
        out = f"<!DOCTYPE html><html><head><title>{self._phrase(1, 8)}</title><script>var t;</script></head><body>{body}"
        return out + ("</body></html>" if r.random() < 0.85 else "")


def _labels(page: Page) -> np.ndarray:
    """Whether most words inside a node are kept ones; a node without words follows its parent."""
    n = len(page.tag)
    kept, words = np.zeros(n + 1), np.zeros(n + 1)
    for node, text in page.runs:
        found = text.split()
        kept[node + 1] += sum(w.endswith(_MARK) for w in found)
        words[node + 1] += len(found)
    kept, words = np.cumsum(kept), np.cumsum(words)
    end = np.array(page.end)
    inside, of = kept[end] - kept[:n], words[end] - words[:n]
    label = inside > 0.5 * of
    for i in range(1, n):
        if not of[i]:
            label[i] = label[page.parent[i]]
    return label


@dataclass
class Extractor:
    vocabulary: dict[str, int]
    forest: boosting.Forest

    def texts(self, pages: list[str | None]) -> list[str]:
        out: list[str] = []
        held: list[Page] = []
        size = 0
        for html in pages:
            held.append(parse(html))
            size += len(html or "")
            if size >= CHARS_AT_ONCE:
                out += self._texts(held)
                held, size = [], 0
        return out + self._texts(held)

    def _texts(self, pages: list[Page]) -> list[str]:
        found = Features(pages, self.vocabulary)
        slices = range(0, found.total, NODES_AT_ONCE)
        logit = [self.forest.logit(found.rows(at, min(at + NODES_AT_ONCE, found.total))) for at in slices]
        value = np.clip(np.concatenate([np.empty(0), *logit]), -6, 6).tolist()
        out, first = [], 0
        for page in pages:
            out.append(page.text(decode(page, value[first : first + len(page.tag)])))
            first += len(page.tag)
        return out


def decode(page: Page, logit: list[float]) -> list[bool]:
    """The nodes to keep: the largest sum of evidence, by words, over sets closed towards the root."""
    n = len(page.tag)
    gain = [value * (1 + words) for value, words in zip(logit, page.words, strict=True)]
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[page.parent[i]] += gain[i]
    kept = [False] * n
    kept[0] = gain[0] > 0
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and gain[i] > 0
    return kept


def train(sample: list[str], seed: int = SEED) -> Extractor:
    """Fits the trees on layouts of the passages of some pages (invented words, if they have none)."""
    passages = []
    for page in map(parse, sample):
        passages += [" ".join(t.split()) for _, t in page.runs if len(t.split()) >= 5]
    layouts = _Layouts(passages[:20_000], seed)
    made = [layouts.page() for _ in range(LAYOUTS)]
    marked = [parse(m) for m in made]
    label = np.concatenate([_labels(p) for p in marked])
    plain = [parse(m.replace(_MARK, "")) for m in made]
    seen = Counter(t for p in plain for tokens in p.tokens for t in set(tokens))
    vocabulary = {t: i for i, (t, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TOKENS])}
    found = Features(plain, vocabulary)
    return Extractor(vocabulary, boosting.fit(found.rows(0, found.total), label.astype(float), TREES, DEPTH))


def fit(pages: DataFrame, sample: int = SAMPLE) -> Extractor:
    """Trains on passages of the at most ``sample`` pages of the smallest hashes.

    Only ids are sorted; of rows that repeat an id the least text is taken, null ids none.
    """
    usable = pages.filter(F.char_length("html").between(1, SAMPLE_CHARS)).filter("page_id IS NOT NULL")
    order = F.xxhash64("page_id", F.lit(SEED))
    chosen = usable.select("page_id").distinct().orderBy(order, "page_id").limit(sample)
    rows = usable.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect()
    return train([r.html for r in sorted(rows)])


def extracted(pages: DataFrame, extractor: Extractor) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html, ...)``.

    Null and empty pages, and pages without an article, have an empty text. Repeated rows and
    null ids are kept as they are; other columns are not looked at.
    """
    shared = pages.sparkSession.sparkContext.broadcast(extractor)

    def extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part[["page_id", "url"]].assign(text=shared.value.texts(part["html"].tolist()))

    found = pages.select("page_id", "url", "html").mapInPandas(extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extracted(pages, fit(pages))
