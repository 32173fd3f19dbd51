import random

import numpy as np
import pytest

import corpus_pipeline
from cadentia.llm import near_dup
from cadentia.llm import shingles as S


def _shingles(text):
    words = [w for w in (text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Components of the exact links, the text of a row being what is linked."""
    sets = [(d, _shingles(t)) for d, t in rows]
    ids = [d if d is not None else float("inf") for d, _ in sets]
    group = list(range(len(sets)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if (a and b and 100 * len(a & b) >= 85 * len(a | b)) or ids[i] == ids[j] != float("inf"):
                group[find(i)] = find(j)
    least = {}
    for i in range(len(sets)):
        least[find(i)] = min(least.get(find(i), float("inf")), ids[i])
    found = [least[find(i)] for i in range(len(sets))]
    return sorted(
        ((d, len(s), None if c == float("inf") else c) for (d, s), c in zip(sets, found, strict=True)), key=repr
    )


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_messy_rows_match_brute_force(messy, messy_rows):
    found = near_dup.near_duplicates(messy)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert _got(found) == brute([(r[0], r[1]) for r in messy_rows])
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_chains_and_a_large_group_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)  # so that the group meets in many blocks
    r = random.Random(3)
    words = [str(i) for i in range(400)]
    rows = []
    for i in range(150):  # around the threshold: chains of links, some only through a third text
        text = list(words)
        for _ in range(r.randint(0, 14)):
            text[r.randrange(400)] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, f"{rows[i][1]} tail") for i in range(20)] + [(2000 + i, rows[0][1]) for i in range(30)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize(("least", "rows", "bands", "agreeing"), [(85, 4, 16, 39), (80, 3, 21, 34)])
def test_bands_follow_from_the_least_similarity(least, rows, bands, agreeing):
    assert near_dup.banding(least) == near_dup.Banding(least, rows, bands, agreeing)
    assert (1 - (least / 100) ** rows) ** bands <= 1e-5


def test_the_pipeline_takes_copies_from_080(spark):
    words = [[f"w{i}x{j}" for j in range(400)] for i in range(40)]
    rows = []
    for i, text in enumerate(words):  # eight scattered edits: 356 of 436 shingles shared, 0.817
        other = [f"new{j}" if j % 48 == 20 and j < 390 else w for j, w in enumerate(text)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_dup.deduplicated(docs).count() == 80  # the query's 0.85 is not reached
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))


def test_empty_table(empty):
    assert near_dup.near_duplicates(empty).collect() == []
    assert near_dup.deduplicated(empty).collect() == []


def test_one_document_of_each_group_stays_with_its_columns(clashing, messy_rows):
    kept = near_dup.deduplicated(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14]  # 2 and 3 are 1 again, 9 is 8, 10 came twice


def test_rows_without_an_id_are_documents_of_their_own(spark):
    def edited(text, *places):
        return " ".join("changed" if i in places else w for i, w in enumerate(text.split()))

    a, b, c, d, e = (" ".join(f"{name}{i}" for i in range(200)) for name in "abcde")
    rows = [
        (5, a), (None, edited(a, 100)), (9, b), (None, edited(b, 100)),  # near copies of 5 and of 9
        (None, c), (None, edited(c, 100)), (None, c.upper()), (None, c),  # near and exact copies of one another
        (None, d), (None, None), (None, ""),
        (7, e), (7, edited(c, 20, 60, 100, 140, 180)), (8, edited(e, 100)),  # one doc_id, two texts
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(near_dup.near_duplicates(docs)) == brute(rows)
    kept = [tuple(r) for r in near_dup.deduplicated(docs).collect()]
    assert sorted(d for d, _ in kept if d is not None) == [5, 7, 7, 9]
    unnamed = [t for d, t in kept if d is None]
    assert sorted(str(t)[:1] for t in unnamed) == ["", "N", "c", "d"] or sorted(str(t)[:1] for t in unnamed) == ["", "C", "N", "d"]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    found = near_dup.components(spark.createDataFrame(links, "a long, b long"))
    assert {(r.id, r.component) for r in found.collect() if r.id != r.component} == {
        (i, 0) for i in range(1, 61)
    } | {(i, 100) for i in range(101, 160)}


def test_signatures_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85):
        agreeing = []
        for _ in range(40):
            both, rest = rng.integers(1, 2**63, 600, dtype=np.uint64), rng.integers(1, 2**63, 2000, dtype=np.uint64)
            n = round(600 * (1 - share) / (2 * share))
            a, b = np.concatenate([both, rest[:n]]), np.concatenate([both, rest[n : 2 * n]])
            x, y = S.circulant_minhash([a, b], 64)
            agreeing.append((x == y).mean())
        assert np.mean(agreeing) == pytest.approx(share, abs=0.03)


def test_second_permutation_is_one():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65521)
    y, spare = x.copy(), np.empty_like(x)
    S._second_permutation(y, spare)
    assert len(np.unique(y)) == len(np.unique(x))


def test_words_longer_than_a_chunk(monkeypatch):
    text = ("a" * 5000 + " ") * 3 + "b c d"
    whole = S.shingle_sets([text.encode()])[0]
    monkeypatch.setattr(S, "_CHUNK", 1024)
    assert (S.shingle_sets([text.encode()])[0] == whole).all()
