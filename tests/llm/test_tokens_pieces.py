import math

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from cadentia.llm import pieces as P
from cadentia.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_of_messy_rows(messy, messy_rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(
        (
            (d, len((t or "").encode()), n, n > 2048)
            for d, t, *_ in messy_rows
            for n in [len(tokenizer.encode(t or "", add_special_tokens=False).ids)]
        ),
        key=repr,
    )
    assert sorted(map(tuple, token_counts.token_counts(messy).collect()), key=repr) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_are_cut_where_nothing_reaches_across(messy_rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        one = Tokenizer.from_file(path)
        count = lambda t: len(one.encode(t, add_special_tokens=False).ids)
    else:
        one = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(one.encode(t))
    texts = [r[1] or "" for r in messy_rows] + [" lead", "trail ", "a  b   c", "a\n b", "a \n b", "  "]
    texts = [t[:20_000] for t in texts]
    assert token_counts.Counter(path).lengths([t.encode() for t in texts]) == [count(t) for t in texts]


def test_counts_do_not_depend_on_what_is_remembered(monkeypatch, messy_rows):
    texts = [(r[1] or "").encode() for r in messy_rows]
    whole = token_counts.Counter(public_tokenizers.path("word_bpe_49k.json")).lengths(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 50)
    assert token_counts.Counter(public_tokenizers.path("word_bpe_49k.json")).lengths(texts) == whole


def test_empty_table(empty):
    assert token_counts.token_counts(empty).collect() == [] and P.encoded(empty).collect() == []


def _viterbi(pieces, text):
    """The same search, a character at a time over a dictionary."""
    if not text:
        return []
    keys = {pieces.written[i]: (int(i), s) for i, s in zip(pieces.ids, pieces.score, strict=True)}
    raw = b" " + text.encode().replace("▁".encode(), b" ") if text else b""
    starts = [i for i, c in enumerate(raw) if c & 0xC0 != 0x80]
    best, back = {0: 0.0}, {}
    for at, after in zip(starts, starts[1:] + [len(raw)], strict=True):
        arcs = [(at + n, *keys[raw[at : at + n]]) for n in range(1, 60) if raw[at : at + n] in keys and at + n <= len(raw)]
        if not any(end == after for end, _, _ in arcs):
            arcs.append((after, -1, pieces.unknown_score))
        for end, i, score in arcs:
            if best[at] + score > best.get(end, -math.inf):
                best[end], back[end] = best[at] + score, (at, i)
    out, end = [], len(raw)
    while end:
        at, i = back[end]
        out.append([i] if i >= 0 else [int(pieces.bytes[c]) for c in raw[at:end]])
        end = at
    return [i for ids in reversed(out) for i in ids]


@pytest.mark.parametrize("scores", ["rank", "file"])
def test_encoding_matches_a_plain_viterbi(messy_rows, scores):
    pieces = P.Pieces(MODEL, scores)
    encoder = P.Encoder(pieces)
    texts = [(r[1] or "")[:1500] for r in messy_rows] + [" lead", "trail ", "a  b", "\n\n", "日本語", "a\nb c"]
    ids, size = encoder.encode([t.encode() for t in texts])
    cuts = np.concatenate([[0], np.cumsum(size)])
    for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        assert ids[a:b].tolist() == _viterbi(pieces, t), t[:40]


def test_agrees_with_the_library_on_a_unigram_file(tmp_path, messy_rows):
    """The library's scores are single precision: ties may fall otherwise, totals may not."""
    ours = P.Pieces(MODEL, "rank")
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    for i, score in zip(ours.ids.tolist(), ours.score, strict=True):
        model.pieces[i].score = float(np.float32(score))
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    stated = P.Pieces(str(path))
    assert np.allclose(stated.score, ours.score, atol=1e-5)
    score = dict(zip(stated.ids.tolist(), stated.score, strict=True))
    texts = [(r[1] or "")[:3000] for r in messy_rows]
    ids, size = P.Encoder(stated).encode([t.encode() for t in texts])
    cuts, same = np.concatenate([[0], np.cumsum(size)]), 0
    for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        mine, theirs = ids[a:b].tolist(), library.encode(t)
        same += mine == theirs
        total = lambda x: sum(score.get(i, 0.0) for i in x)
        assert total(mine) == pytest.approx(total(theirs), abs=0.05)
    assert same >= len(texts) - 2


def test_round_trip_of_messy_rows(spark, messy, messy_rows):
    found = {(r.doc_id, r.n_tokens): r for r in P.encoded(messy).collect()}
    assert all(r.n_tokens == len(r.ids) for r in found.values())
    # a text's own marker comes back as a space
    assert all(r.round_trip for r in found.values() if r.doc_id != 12)
    back = messy.select("text", P.decode(P.encode("text")).alias("decoded")).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)


def test_decoding_bytes_nulls_and_unknown():
    pieces = P._pieces(P.VOCABULARY, "auto")
    raw = [int(pieces.bytes[b]) for b in "é".encode()]
    cases = [raw, raw[:1], [], [int(pieces.unknown)], [1, 2]]
    ids = np.array([i for c in cases for i in c], np.int64)
    found = P._decode(pieces, ids, np.array([len(c) for c in cases]))
    assert [f.decode(errors="replace") for f in found] == ["é", "�", "", "⁇ ", ""]


def test_double_array_finds_every_key():
    keys = [b"a", b"ab", b"abc", b"b", b"bc", bytes([0]), bytes([255, 1]), b"abd"]
    trie = P.DoubleArray(keys)
    data = np.frombuffer(b"abcab" + bytes([255, 1, 0]), np.uint8)
    place, end, value = trie.matches(data, np.arange(len(data)), np.full(len(data), len(data)))
    want = {(i, i + len(k), v) for v, k in enumerate(keys) for i in range(len(data)) if data[i : i + len(k)].tobytes() == k}
    assert set(zip(place.tolist(), end.tolist(), value.tolist(), strict=True)) == want


def test_remembering_changes_nothing(monkeypatch, messy_rows):
    texts = [(r[1] or "").encode() for r in messy_rows]
    pieces = P.Pieces(MODEL)
    whole = P.Encoder(pieces).encode(texts)[0].tolist()
    monkeypatch.setattr(P, "REMEMBERED", 2)
    encoder = P.Encoder(pieces)
    assert [i for t in texts for i in encoder.encode([t])[0].tolist()] == whole
    assert list(P._by_bytes(pa.array([None, "a"]))) == [[None, b"a"]]
