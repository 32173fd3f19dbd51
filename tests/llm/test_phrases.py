import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadentia.llm import phrases as P
from cadentia.llm.queries import ORACLES

SCHEMA = "doc_id long, text string, lang string"


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _counts(docs):
    """(language, words of a phrase) -> occurrences, one piece after another."""
    out, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    out[lang][tuple(words[i : i + n])] += 1
    return out, total


def _expected(docs, most=P.REPORTED):
    counts, total = _counts(docs)
    rows = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


def _some(seed, n):
    r = random.Random(seed)
    words = [*"abcdefgh", "The", "É", "漢字", "\x1c", "x" * 40, "rare"]
    weights = [30, 20, 10, 8, 6, 5, 4, 3, 5, 2, 2, 2, 1, 0.2]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "? ! ", "\x0b"]
    rows = []
    for i in range(n):
        text = "".join(w + g for w, g in zip(r.choices(words, weights, k=r.randint(0, 60)), r.choices(gaps, k=60), strict=False))
        rows.append((i if i % 9 else None, text, r.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(1, None, "en"), (2, "", "fr"), (3, " .\n", "fr"), (4, "only a few words", "it")]
    return rows + rows[:10]


@pytest.mark.parametrize(("heavy", "budget"), [(1 << 16, 1 << 20), (20, 50), (0, 1)])
def test_any_partition_of_the_tree_gives_the_counts_of_brute_force(spark, monkeypatch, heavy, budget):
    monkeypatch.setattr(P, "HEAVY", heavy)
    monkeypatch.setattr(P, "BUDGET", budget)
    docs = _some(1, 120)
    table = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit(1) for c in ("n", "word", "w1", "a", "l", "r", "rank", "phrase")})
    got = P.collocations(table.repartition(3))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == _expected(docs)


def test_only_the_best_are_reported_in_order(spark):
    docs = _some(2, 200)
    got = P.collocations(spark.createDataFrame(docs, SCHEMA), most=7)
    assert sorted(map(tuple, got.collect())) == _expected(docs, 7)


def test_small_batches_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(P, "BATCH_BYTES", 100)
    monkeypatch.setattr(P, "COUNTED", 5)
    docs = _some(3, 80)
    assert sorted(map(tuple, P.collocations(spark.createDataFrame(docs, SCHEMA)).collect())) == _expected(docs)


def test_many_different_words_in_a_batch():
    r = np.random.default_rng(1)
    a, b, c = (r.integers(0, 50, 3000) for _ in range(3))
    c[::5] = -1
    few = P._different(a, b, c, 51)
    most, P.MOST_WORDS = P.MOST_WORDS, 10
    try:
        many = P._different(a, b, c, 51)
    finally:
        P.MOST_WORDS = most
    assert all((x == y).all() for x, y in zip((*few[0], few[1]), (*many[0], many[1]), strict=True))
    assert few[1].sum() == 3000 and set(zip(*few[0], strict=True)) == set(zip(a, b, c, strict=True))


def test_packed_suffixes_come_back():
    words = pa.array([b"a b", b"a b c", "é x".encode(), b"z"], pa.binary())
    got, n = P._unpacked(*P._packed(words.slice(1, 3), np.array([3, 1, 70000])))
    assert got.equals(words.slice(1, 3)) and n.tolist() == [3, 1, 70000]


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(3_000_000_000_000, 3_000_000_000_001, 3_000_000_000_007), (10, 10, 10), (10, 11, 1_000_000_007)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", P._score("a", "l", "r")).collect()
    assert [x[3] for x in got] == [10**6 * a * a // (left * right) for a, left, right in rows]


def test_no_texts_and_no_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.collocations(empty).collect() == []
    assert P.collocations(spark.createDataFrame([(1, None, None), (2, " ", "en")], SCHEMA)).collect() == []


def test_query_matches_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = P.op13_collocations(spark, sf)
    cursor = con.execute(ORACLES["op13_collocations"])
    order = [d[0] for d in cursor.description]
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(cursor.fetchall()) != []
