import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadentia.llm import bpe as B
from cadentia.llm.transducer import Transducer, compiled

PATH = public_tokenizers.path(B.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return B.Bpe(PATH)


def _random_texts(seed, n):
    parts = ["<|endoftext|>", "<|endof", " ", "  ", "\n", "\t", "'s", "'t", "'ll", "é", "\U0001030c", "՘", "࢏", "Ᲊ", "1", "22"]
    parts += ["x", "the", "The", "!", "\x85", " ", "​", "\x1c", "　", "漢", "\U0001f642", "a" * 70, "￾"]
    r = random.Random(seed)
    return ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(n)]


def _encoded(encoder, texts):
    ids, size = encoder.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(size)[:-1])] if texts else []


@pytest.mark.parametrize("step", [1, 7, 400])
def test_ids_and_texts_are_those_of_the_library(own, library, step):
    texts = _random_texts(1, 400) + ["x" * 5000, "ab" * 3000, " " * 3000 + "a", "", " ", "a  b", " a", "a "]
    lexicon = sorted(w.encode() for w in {w for t in texts[:100] for k in itertools.chain(*own.keys(t)) for w in own.words(k)} - set(own.special))
    encoder = B.Encoder(own, Transducer(compiled((w, tuple(own.merged(w))) for w in lexicon)))
    found = [ids for at in range(0, len(texts), step) for ids in _encoded(encoder, texts[at : at + step])]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert found == want
    flat, size = np.array([i for ids in want for i in ids]), np.array([len(ids) for ids in want])
    assert own.decoded(flat, size) == texts == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_any_ids_decode_as_in_the_library(own, library):
    r = random.Random(2)
    some = [[r.randrange(50257) for _ in range(r.randint(0, 12))] for _ in range(500)]
    flat, size = np.array([i for ids in some for i in ids]), np.array([len(ids) for ids in some])
    assert own.decoded(flat, size) == [library.decode(ids, skip_special_tokens=False) for ids in some]


def test_long_texts_are_split_where_no_word_reaches_across(own, library, monkeypatch):
    monkeypatch.setattr(B, "STRETCH", 20)
    encoder = B.Encoder(own, Transducer(compiled([])))
    texts = [" ".join(_random_texts(3, 50)), "one two  three\n four five six seven eight nine ten eleven", "x" * 100]
    assert _encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_both_ways_of_merging_agree(own):
    r = random.Random(4)
    for _ in range(300):
        ids = [own.byte_ids[b] for b in "".join(r.choices("theaino ré", k=r.randint(1, 60))).encode()]
        assert own._merged_short(list(ids)) == own._merged_long(list(ids))


def test_an_odd_vocabulary_is_refused():
    with pytest.raises(ValueError, match="not plain byte-level"):
        B.Bpe(public_tokenizers.path("word_bpe_49k.json"))


def _states(words):
    """States of the minimal automaton: sets of endings with the outputs that are still open, brute force."""
    starts = {w[:n] for w in words for n in range(len(w) + 1)}

    def open_output(start):
        all_ = [ids for w, ids in words.items() if w.startswith(start)]
        n = 0
        while all(len(i) > n for i in all_) and len({i[n] for i in all_}) == 1:
            n += 1
        return n

    return {frozenset((w[len(s) :], ids[open_output(s) if s else 0 :]) for w, ids in words.items() if w.startswith(s)) for s in starts}


def test_transducer_is_minimal_and_says_the_ids():
    r = random.Random(5)
    for _ in range(30):
        words = {bytes(r.choices(b"ab", k=r.randint(1, 7))): tuple(r.choices((1, 2), k=r.randint(0, 4))) for _ in range(r.randint(1, 40))}
        data = compiled(sorted(words.items()))
        found = Transducer(data)
        assert len(found.final_length) == len(_states(words))
        asked = [bytes(x) for n in range(8) for x in itertools.product(b"ab", repeat=n)] + [b"c", b"ac"]
        ids, size, known = found.outputs(asked, 7)
        assert [w for w, k in zip(asked, known, strict=True) if k] == [w for w in asked if w in words]
        parts = np.split(ids, np.cumsum(size)[:-1])
        assert all(tuple(p.tolist()) == words.get(w, ()) for w, p in zip(asked, parts, strict=True))
        assert not found.outputs(asked, 0)[2].any()


def test_transducer_wants_sorted_words():
    with pytest.raises(ValueError, match="sorted"):
        compiled([(b"b", (1,)), (b"a", (2,))])
    assert not Transducer(compiled([])).outputs([b"a", b""], 9)[2].any()


def test_messy_rows(messy, messy_rows, library, spark):
    found = sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in B.encoded(messy).collect()), key=repr)
    want = [(d, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for d, t, *_ in messy_rows]
    assert found == sorted(want, key=repr)
    texts = spark.createDataFrame([([15496, None, 995, 99999],), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in texts.select(B.decode("ids")).collect()] == ["Hello world", "", ""]


def test_lexicon_changes_nothing(messy, clashing, empty):
    plain = sorted(B.encoded(messy, most=0).collect(), key=repr)
    assert sorted(B.encoded(clashing, most=50).collect(), key=repr) == plain
    assert B.encoded(empty).collect() == []


def test_counts_cover_all_texts_and_the_bound_holds(messy, messy_rows, own):
    counts = {bytes(r.word): r.n for r in B.word_counts(messy).collect()}
    want = {}
    for _, text, *_ in messy_rows:
        for key in itertools.chain(*own.keys(text or "")):
            for w in own.words(key):
                if w not in own.special and len(w.encode()) <= B.LONGEST:
                    want[w.encode()] = want.get(w.encode(), 0) + 1
    assert counts == want
    found = B.frequent_words(B.word_counts(messy), 20)
    assert 0 < len(found) <= 20 and found == sorted(found)
    assert min(counts[w] for w in found) >= max(n for w, n in counts.items() if w not in found)


def test_query(spark, messy, messy_rows, library, tmp_path):
    messy.withColumn("extra", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t, *_ in messy_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, B.op11_byte_bpe(spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)
