import hashlib
import html
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pytest

import corpus_pipeline
from cadentia.llm import boosting, dom, extraction, near_dup, rules, toxicity, warc
from cadentia.session import scratch_dir
from conftest import SF
from llm.prose import prose

PAGES = "page_id long, url string, html string, text string, payload string, refers_to long"


@pytest.fixture(scope="module")
def extractor(spark):
    return extraction.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_articles_of_the_given_pages_are_found_exactly(spark, extractor):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in extraction.extracted(pages, extractor).join(pages.select("page_id", "html"), "page_id").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        article = re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", article)
        assert r.text == " ".join(html.unescape(article).split())
        assert r.n_chars == len(r.text)


def test_layouts_that_were_not_learned_from(extractor):
    layouts = extraction._Layouts([prose(i, 30) for i in range(50)], seed=99)
    good = 0
    for _ in range(120):
        marked = layouts.page()
        words = [w for _, t in dom.parse(marked).runs for w in t.split()]
        want = Counter(w.replace(extraction._MARK, "") for w in words if w.endswith(extraction._MARK))
        got = Counter(extractor.texts([marked.replace(extraction._MARK, "")])[0].split())
        both = 2 * sum((want & got).values())
        good += both >= 0.95 * (sum(want.values()) + sum(got.values()))
    assert good >= 0.9 * 120


CHROME = "<nav><a href=/>Home</a> <a href=/a>About us</a></nav>{}<footer>Copyright of the owners</footer>"
INNER = {
    "table": ("<table><thead><tr><th>{0}</th><th>{1}</th></tr></thead><tbody><tr><td>{2}</td><td>{3}</td></tr></tbody></table>", 4),
    "bare table": ("<table><tr><td>{0}</td><td>{1}</td></tr><tr><td>{2}</td><td>{3}</td></tr></table>", 4),
    "figure": ("<figure><img src=x.png alt=picture><figcaption>{0}</figcaption></figure>", 1),
    "terms": ("<dl><dt>{0}</dt><dd>{1}</dd><dt>{2}</dt><dd>{3}</dd></dl>", 4),
    "details": ("<details><summary>{0}</summary><p>{1}</p></details>", 2),
    "list": ("<ol><li>{0}</li><li>{1}</li></ol>", 2),
}


@pytest.mark.parametrize("kind", INNER)
def test_nothing_of_an_article_is_dropped(extractor, kind):
    """Layouts of the test's own: the given pages have none of these, and no template of the training is used."""
    template, n = INNER[kind]
    lost = 0
    for seed in range(12):
        r = random.Random(seed)
        inner = [prose(100 * seed + i, r.randint(1, 9)) for i in range(n)]
        before, after = prose(seed, r.randint(20, 60)), prose(seed + 50, r.randint(20, 60))
        article = f"<article><h1>{prose(seed + 9, 5)}</h1><p>{before}</p>{template.format(*inner)}<p>{after}</p></article>"
        want = " ".join([prose(seed + 9, 5), before, *inner, after])
        lost += extractor.texts([CHROME.format(article)])[0] != want
    assert lost <= 1


def test_invisible_text_is_no_text(extractor):
    body = f"<article><p>{prose(1, 40)}</p><p hidden>secret words</p><div style='color:red; display: none'><p>more of them</p></div><p>{prose(2, 40)}</p></article>"
    assert extractor.texts([CHROME.format(body)])[0] == f"{prose(1, 40)} {prose(2, 40)}"


def test_decoding_is_the_best_closed_choice():
    rng = np.random.default_rng(4)
    for _ in range(60):
        depth, parts = 0, []
        for _ in range(int(rng.integers(1, 7))):
            parts.append("<div>" + "w " * int(rng.integers(0, 4)))
            depth += 1
            if rng.random() < 0.5:
                parts.append("</div>")
        page = dom.parse("".join(parts))
        n = len(page.tag)
        logit = rng.normal(size=n).tolist()
        gain = [v * (1 + w) for v, w in zip(logit, page.words, strict=True)]
        best = 0.0
        for bits in range(1 << n):
            kept = [bool(bits >> i & 1) for i in range(n)]
            if all(kept[page.parent[i]] for i in range(1, n) if kept[i]):
                best = max(best, sum(g for g, k in zip(gain, kept, strict=True) if k))
        found = extraction.decode(page, logit)
        assert sum(g for g, k in zip(gain, found, strict=True) if k) == pytest.approx(best)


@pytest.mark.parametrize("filler", ["<!--", "<!-- x -->", "<p>w", "<div>", "<!a", "<a ", "<script>", "<!-- > ", "</p>", "&amp;", "<p hidden>w"])
def test_long_pages_take_linear_time_and_bounded_memory(extractor, filler):
    page = "<p>start</p>" + filler * (300_000 // len(filler))
    began = time.process_time()
    tracemalloc.start()
    extractor.texts([page])
    assert tracemalloc.get_traced_memory()[1] < 250_000_000
    tracemalloc.stop()
    assert time.process_time() - began < 60


def test_slices_of_nodes_have_the_same_features(extractor, monkeypatch):
    layouts = extraction._Layouts([prose(i, 30) for i in range(20)], seed=3)
    pages = [layouts.page().replace(extraction._MARK, "") for _ in range(20)]
    whole = extractor.texts(pages)
    monkeypatch.setattr(extraction, "NODES_AT_ONCE", 7)
    monkeypatch.setattr(extraction, "CHARS_AT_ONCE", 1)
    assert extractor.texts(pages) == whole


@pytest.mark.parametrize("after", ["<body><p>", "<body class=x><article><p>", "<p>", "<article>", "<div>", "<br>", "<span>", "", "<noscript><p>no</p></noscript><p>"])
def test_a_head_without_its_end_tag(after):
    page = dom.parse(f"<!DOCTYPE html><html><head><meta charset=utf-8><title>T</title><script>var t;</script>{after}one two</html>")
    assert page.text([True] * len(page.tag)) == "one two"


def test_layouts_without_an_end_tag_of_the_head(extractor):
    layouts = extraction._Layouts([prose(i, 30) for i in range(50)], seed=7)
    for _ in range(60):
        marked = layouts.page().replace(extraction._MARK, "")
        short = marked.replace("</head>", "")
        assert short != marked and dom.parse(short) == dom.parse(marked)
        assert extractor.texts([short]) == extractor.texts([marked])


def test_references_white_space_and_forgotten_end_tags(extractor):
    body = f"<article><h1>A &amp; B</h1><p>{prose(1, 40)}&nbsp;caf&eacute;<br>\n\t next <b>in</b>line<p>{prose(2, 30)} &am"
    got = extractor.texts([f"<body><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>{body}"])[0]
    assert got == f"A & B {prose(1, 40)} café next inline {prose(2, 30)} &am"


def test_no_descendant_of_a_dropped_block_is_kept(extractor):
    page = dom.parse("<div><div><p>a b c</p></div></div><p>d</p>")
    rng = np.random.default_rng(1)
    for _ in range(200):
        kept = extraction.decode(page, rng.normal(size=len(page.tag)).tolist())
        assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])


def test_messy_pages(spark, extractor):
    long = "<article>" + "".join(f"<p>{prose(i, 50)}</p>" for i in range(400)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", long), (3, "u", long), (None, "u", "<p"), (4, "u", "<" * 2000), (5, "u", "</div></p>\x00&#0;&#xD800;<!-- x")]
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)
    got = extraction.extracted(pages, extractor)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[1] == texts[2] == "" and texts[3] == " ".join(prose(i, 50) for i in range(400))
    assert extraction.extracted(pages.limit(0), extraction.fit(pages.limit(0))).collect() == []


def test_boosting_learns_an_interaction():
    x = np.random.default_rng(2).normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x[:1500], y[:1500], trees=40, depth=3)
    assert ((forest.logit(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.95


def _records(spark, rows, least=1000):
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages, path, least)
    return warc.read_archives(spark, path)


def test_revisits_and_exact_round_trip(spark):
    big, other = "é\r\n\r\nWARC/1.1\r\n" * 100, "x" * 1000
    rows = [(i, f"http://h/{i}", big) for i in (3, 9, 7, 9)] + [(1, "u", other), (2, "u\r\nX: y", other), (4, "u", "x" * 999), (5, "u", "x" * 999)]
    rows += [(6, None, None), (8, "u", ""), (None, "u", big)]
    found = warc.resolve(_records(spark, rows)).collect()
    got = sorted(((r.page_id, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in found), key=repr)
    want = [(3, "revisit", 9, big), (7, "revisit", 9, big), (9, "response", None, big), (9, "response", None, big)]
    want += [(1, "revisit", 2, other), (2, "response", None, other), (4, "response", None, "x" * 999), (5, "response", None, "x" * 999)]
    want += [(6, "response", None, ""), (8, "response", None, ""), (None, "response", None, big)]
    assert got == sorted(want, key=repr)
    for r in found:
        assert r.payload_digest == hashlib.sha1(bytes(r.payload)).hexdigest() and r.payload_bytes == len(bytes(r.payload))


def test_archives_are_members_of_named_and_dated_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rows = [(i, f"http://h/{i}", "a" * 1000) for i in range(4)] + [(None, "u", "b"), (None, "u", "b"), (4, "v", "c" * 500)]
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES).coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"), date=datetime(2031, 5, 6, 7, 8, 9, tzinfo=timezone.utc))
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) >= 2
    records = []
    for file in files:
        raw = file.read_bytes()
        while raw:  # each member by itself, as a reader that seeks would take it
            member = zlib.decompressobj(31)
            record = member.decompress(raw)
            raw = member.unused_data
            if record:
                assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
                head = record.split(b"\r\n\r\n")[0].decode().split("\r\n")[1:]
                records.append(dict(line.split(": ", 1) for line in head))
    assert len(records) == len(rows) and len({r["WARC-Record-ID"] for r in records}) == len(rows)
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r["WARC-Record-ID"]) for r in records)
    assert {r["WARC-Date"] for r in records} == {"2031-05-06T07:08:09Z"}
    by_page = {r.get("X-Page-ID"): r for r in records}
    for page in "012":
        assert by_page[page]["WARC-Type"] == "revisit" and by_page[page]["WARC-Refers-To"] == by_page["3"]["WARC-Record-ID"]
        assert by_page[page]["WARC-Refers-To-Target-URI"] == "http://h/3" and by_page[page]["WARC-Refers-To-Date"] == "2031-05-06T07:08:09Z"


def test_no_pages_and_cut_off_archives(spark):
    assert _records(spark, []).collect() == []
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc._parse(__import__("gzip").compress(b"HTTP/1.1 200 OK\r\n")))


@pytest.fixture(scope="module")
def toxic_rows():
    r = random.Random(8)
    bad = ["scoundrel", "nitwit", "blockhead"]
    rows = []
    for i in range(700):
        words = prose(i, r.randint(20, 200)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(words) // 30)):
                words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_unseen_misspellings(spark, toxic_rows):
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in toxic_rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in toxic_rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    label = {i: y for i, _, y in toxic_rows}
    rows = toxicity.scored(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    clean = prose(5000, 60)
    plain, spelt = model.scores([clean, f"{clean} you scoundrell and nitwitt"])
    assert spelt > 10 * plain
    long = f"{prose(5001, 20_000)} scoundrel nitwit blockhead scoundrels"
    assert model.scores([long])[0] >= toxicity.THRESHOLD  # whole texts, undiluted


def test_toxicity_of_messy_rows(messy, clashing, toxic_rows, empty):
    model = toxicity.train([t for _, t, _ in toxic_rows[:200]], np.array([y for *_, y in toxic_rows[:200]]))
    got = toxicity.scored(clashing, model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == messy.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.collect())
    assert {r.score < 1e-9 for r in got.collect() if r.doc_id in (5, 6, 7)} == {True}
    assert toxicity.scored(empty, model).collect() == []
    only = toxicity.train(["a b c"], np.array([0]))
    assert only.scores(["a b c", None])[0] < 0.01


def test_pipeline_stages_match_what_they_state(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "pseudonyms", "mix", "encode"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf)
        path = scratch_dir(spark, name)
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        if name == "quality_rules":
            stats = rules.statistics(before.select("doc_id", "text"))
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            want = rules.judged(stats, rules.learn(stats, labels)).filter("kept").select("doc_id")
            assert sorted(map(tuple, kept.select("doc_id").collect())) == sorted(map(tuple, want.collect()))
        elif name == "near_dedup":
            want = near_dup.near_duplicates(before, least=80).filter("kept").select("doc_id")
            assert sorted(map(tuple, kept.select("doc_id").collect())) == sorted(map(tuple, want.collect()))
        elif name == "pseudonyms":
            assert kept.count() == before.count()
            assert kept.join(before.select("doc_id", before.text.alias("old")), "doc_id").filter("old rlike '@mail' and old = text").count() == 0
    done = corpus_pipeline.run(spark, sf)
    assert done.columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
    assert done.count() == kept.count() and set(r[0] for r in done.select("doc_id").collect()) <= set(r[0] for r in docs.select("doc_id").collect())
