"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Texts are cut where no piece can reach across; each different part of a batch is encoded once.
All parts go through the trie and the lattice in step: one numpy operation follows every start
position by one more byte, one extends the best paths of all parts by one more position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm.workers import given_back

VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
#: What the library subtracts from the least score for a character without a piece.
UNKNOWN_PENALTY = 10.0
#: Bytes of text cut and encoded together.
BATCH_BYTES = 1 << 20
#: Different parts that a worker remembers; beyond that it starts anew. Bounds memory, not results.
REMEMBERED = 150_000
#: Rows decoded together.
DECODED_ROWS = 256
_NO_SCORE = -np.inf
_MARKER = MARKER.encode()


class DoubleArray:
    """Trie over byte strings: the child of state ``s`` by byte ``b`` is ``base[s] + b`` if ``check`` there is ``s``."""

    def __init__(self, keys: list[bytes]):
        """``keys`` are different and not empty; the value of a key is its place in the list."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for value, key in enumerate(keys):
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][byte]
            ends[node] = value
        room = 2 * len(children) + 1024
        base, check, value = [0] * room, [-1] * room, [-1] * room
        check[0], value[0] = 0, ends[0]
        # no place from 256 to ``free`` is free, nodes of several children try from ``hint`` on; every
        # byte's child fits from 256 on
        free = hint = 256
        wide, narrow = [(0, 0)], []
        while wide or narrow:
            node, state = wide.pop() if wide else narrow.pop()
            codes = sorted(children[node])
            while check[free] >= 0:
                free += 1
            place, tried = (free if len(codes) == 1 else max(hint, free)), 0
            while any(check[place - codes[0] + code] >= 0 for code in codes):
                place, tried = place + 1, tried + 1
                if place + 512 >= len(check):
                    base, check, value = base + [0] * room, check + [-1] * room, value + [-1] * room
            if tried > 64:  # crowded below: leave the gaps to nodes of one child
                hint = place
            start = place - codes[0]
            base[state] = start
            for code in codes:
                child = children[node][code]
                check[start + code], value[start + code] = state, ends[child]
                if children[child]:
                    (wide if len(children[child]) > 1 else narrow).append((child, start + code))
        room = max(i for i, c in enumerate(check) if c >= 0) + 512
        self.base, self.check, self.value = (np.array(x[:room], np.int32) for x in (base, check, value))

    def matches(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All keys in ``data`` that begin at ``starts`` and end by ``stops``: ``(start's place, end, value)``."""
        place, state, at = np.arange(len(starts)), np.zeros(len(starts), np.int64), starts
        found = []
        while len(place):
            inside = at < stops[place]
            place, state, at = place[inside], state[inside], at[inside]
            child = self.base[state] + data[at]
            there = self.check[child] == state
            place, state, at = place[there], child[there], at[there] + 1
            hit = np.flatnonzero(self.value[state] >= 0)
            found.append((place[hit], at[hit], self.value[state[hit]]))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Pieces:
    """The pieces and scores of a ``sentencepiece`` model file.

    ``scores``: "file" takes the file's numbers as log scores; "rank" takes minus the logarithm
    of a piece's rank (Zipf's law), for files whose scores are merge ranks; "auto" chooses by
    the kind that the file states.
    """

    def __init__(self, path: str, scores: str = "auto"):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        stated = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            stated.ParseFromString(file.read())
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        self.prefix = stated.normalizer_spec.add_dummy_prefix
        self.unknown = model.unk_id()
        self.bytes = np.full(256, -1, np.int32)
        normal = []
        self.written = [n.replace(MARKER, " ").encode() for n in names]
        for i in ids:
            if model.is_byte(i):
                self.bytes[int(names[i][3:5], 16)] = i
                self.written[i] = bytes([int(names[i][3:5], 16)])
            elif model.is_unknown(i):
                self.written[i] = stated.trainer_spec.unk_surface.encode()
            elif model.is_control(i):
                self.written[i] = b""
            elif not model.is_unused(i):
                normal.append(i)
        self.ids = np.array(normal, np.int32)
        self.score = np.array([model.get_score(i) for i in normal], np.float64)
        merge_ranks = stated.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        if scores == "rank" or (scores == "auto" and merge_ranks):
            rank = np.empty(len(normal))
            rank[np.argsort(-self.score, kind="stable")] = np.arange(len(normal))
            self.score = -np.log(rank + 2.0)
        # pieces that only spell out single characters may carry a score far below all others
        self.unknown_score = self.score.min() - UNKNOWN_PENALTY if len(normal) else -UNKNOWN_PENALTY
        self.trie = DoubleArray([self.written[i] for i in normal])
        # a marker behind another character begins a new part, if no piece holds one there; so
        # does a line end that is in no piece
        local = not any(MARKER in names[i].lstrip(MARKER) for i in normal)
        line = not any("\n" in names[i] for i in normal)
        if local:
            self.cut = re.compile(rb"\n| *[^ \n]+| +" if line else rb" *[^ ]+| +")
        else:
            self.cut = re.compile(rb"(?s).+")

    def parts(self, text: bytes) -> list[bytes]:
        """The text in parts that are encoded alone; spaces stand for markers."""
        marked = text.replace(_MARKER, b" ")
        return self.cut.findall(b" " + marked if self.prefix and text else marked)

    def encode_parts(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every part, one after another, and how many each has."""
        data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(r) for r in raw], np.int64)
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(raw)), size)
        starts = np.flatnonzero((data & 0xC0) != 0x80)  # characters
        next_ = np.append(starts[1:], len(data))
        place, end, value = self.trie.matches(data, starts, (first + size)[owner[starts]])
        begin, score = starts[place], self.score[value]
        # a character without a piece of its own is unknown
        bare = np.ones(len(starts), bool)
        bare[place[end == next_[place]]] = False
        begin = np.concatenate([begin, starts[bare]])
        end = np.concatenate([end, next_[bare]])
        score = np.concatenate([score, np.full(bare.sum(), self.unknown_score)])
        piece = np.concatenate([self.ids[value], np.full(bare.sum(), -1, np.int32)])
        best, back = self._best_paths(len(data), begin, end, score, first, owner)
        return self._walk_back(data, begin, end, piece, back, first, size)

    def _best_paths(self, total, begin, end, score, first, owner) -> tuple[np.ndarray, np.ndarray]:
        """Best score and last arc of a path to every byte; place ``k`` of all parts is done in one step.

        Equal scores keep the path that came first, whose last piece begins first.
        """
        step = begin - first[owner[begin]]
        if len(step) and step.max() < 1 << 16:
            step = step.astype(np.uint16)  # sorted by radix
        order = np.argsort(step, kind="stable")
        cuts = np.searchsorted(step[order], np.arange(int(step.max()) + 2)) if len(step) else []
        # the end of a part is not the start of the next one
        best, back = np.full(total + 1, _NO_SCORE), np.full(total + 1, -1, np.int64)
        at_start = np.zeros(total + 1, bool)
        at_start[first] = True
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            arcs = order[a:b]
            if not len(arcs):
                continue
            come = np.where(at_start[begin[arcs]], 0.0, best[begin[arcs] - 1]) + score[arcs]
            last = end[arcs] - 1  # a path is kept under its last byte
            better = come > best[last]
            best[last[better]] = come[better]
            back[last[better]] = arcs[better]
        return best, back

    def _walk_back(self, data, begin, end, piece, back, first, size) -> tuple[np.ndarray, np.ndarray]:
        part = np.flatnonzero(size > 0)
        at = (first + size)[part] - 1
        found_part, found_arc = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(part):
            arc = back[at]
            found_part.append(part)
            found_arc.append(arc)
            more = begin[arc] > first[part]
            part, at = part[more], begin[arc[more]] - 1
        part, arc = np.concatenate(found_part), np.concatenate(found_arc)
        order = np.lexsort((begin[arc], part))
        part, arc = part[order], arc[order]
        ids, unknown = piece[arc], piece[arc] < 0
        if not unknown.any():
            return ids, np.bincount(part, minlength=len(size))
        if (self.bytes < 0).any():  # no byte pieces: a run of unknown characters is one unknown
            ids = np.where(unknown, self.unknown, ids)
            same = np.concatenate([[False], unknown[1:] & unknown[:-1] & (part[1:] == part[:-1])])
            return ids[~same], np.bincount(part[~same], minlength=len(size))
        width = np.where(unknown, end[arc] - begin[arc], 1)
        inner = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        byte = self.bytes[data[np.repeat(begin[arc], width) + inner]]
        ids = np.where(np.repeat(unknown, width), byte, np.repeat(ids, width))
        return ids.astype(np.int32), np.bincount(np.repeat(part, width), minlength=len(size))


class Encoder:
    """Encodes batches of texts and remembers parts it has met."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.first, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        if len(self.place) > REMEMBERED:
            self._forget()
        cut = [self.pieces.parts(t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(cut)).difference(self.place))
        if new:
            ids, size = self.pieces.encode_parts(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
            self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
        known = self.place.__getitem__
        n = np.array([len(parts) for parts in cut], np.int64)
        where = np.fromiter(map(known, chain.from_iterable(cut)), np.int64, int(n.sum()))
        width = self.size[where]
        per_text = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(n)])]
        return _gather(self.ids, self.first[where], width), np.diff(per_text)


def _gather(values: np.ndarray, first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """``values[first:first + width]`` of every row, one after another."""
    at = np.repeat((first - (np.cumsum(width) - width)).astype(np.int32), width)
    at += np.arange(len(at), dtype=np.int32)
    return values[at]


def _decode(pieces: Pieces, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
    table = np.frombuffer(b"".join(pieces.written), np.uint8)
    width = np.array([len(w) for w in pieces.written], np.int64)
    first = np.cumsum(width) - width
    width = width[ids]
    data = _gather(table, first[ids], width).tobytes()
    cuts = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(size)])].tolist()
    lead = 1 if pieces.prefix else 0
    return [
        data[a + lead if data[a : a + lead] == b" " else a : b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


@lru_cache(maxsize=2)
def _pieces(vocabulary: str, scores: str) -> Pieces:
    return Pieces(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary), scores)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, scores: str) -> Encoder:
    return Encoder(_pieces(vocabulary, scores))


def _by_bytes(batch: pa.Array) -> Iterator[list[bytes | None]]:
    out, total = [], 0
    for item in batch.cast(pa.binary()):
        text = item.as_py()
        out.append(text)
        total += len(text or "")
        if total >= BATCH_BYTES:
            yield out
            out, total = [], 0
    if out:
        yield out


def encode(text: Column | str, vocabulary: str = VOCABULARY, scores: str = "auto") -> Column:
    """Array of piece ids of a text column; null and empty texts have none.

    ``vocabulary`` names a file of ``public_tokenizers`` or is a path that every executor has.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(vocabulary, scores)
        for batch in given_back(batches):
            yield _lists([encoder.encode(texts) for texts in _by_bytes(batch)])

    return ids(F.col(text) if isinstance(text, str) else text)


def _lists(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    size = np.concatenate([[0], *[s for _, s in found]])
    flat = np.concatenate([np.empty(0, np.int32), *[i for i, _ in found]])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(size), pa.int32()), pa.array(flat, pa.int32()))


def _checked(text: Column | str, vocabulary: str, scores: str) -> Column:
    """Struct of the ids of a text and whether they decode to it: both in one visit to the worker."""

    @F.arrow_udf("struct<ids: array<int>, round_trip: boolean>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(vocabulary, scores)
        for batch in batches:
            found, same = [], []
            for texts in _by_bytes(batch):
                found.append(encoder.encode(texts))
                same += [a == (b or b"") for a, b in zip(_decode(encoder.pieces, *found[-1]), texts, strict=True)]
            yield pa.StructArray.from_arrays([_lists(found), pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return both(F.col(text) if isinstance(text, str) else text)


def decode(ids: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """The text of a column of piece ids: markers become spaces, byte pieces their bytes.

    Null and empty arrays are the empty text. Bytes that are no UTF-8 become U+FFFD. A text
    that held the marker character itself comes back with spaces there, as from the library.
    """

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(vocabulary, "auto")
        for batch in batches:
            out: list[str] = []
            for at in range(0, len(batch), DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                size = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                found = _decode(pieces, part.flatten().to_numpy(zero_copy_only=False), size)
                out += [raw.decode(errors="replace") for raw in found]
            yield pa.array(out, pa.string())

    return text(F.col(ids) if isinstance(ids, str) else ids)


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, scores: str = "auto") -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of every row of ``docs(doc_id, text, ...)``.

    ``round_trip`` says that decoding gives the text again (a null one as empty). Repeated rows
    and null ids are kept as they are; other columns are not looked at.
    """
    found = docs.select("doc_id", _checked("text", vocabulary, scores).alias("found"))
    return found.select("doc_id", F.size("found.ids").cast("long").alias("n_tokens"), "found.ids", "found.round_trip")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
