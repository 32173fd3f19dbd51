"""Byte-level BPE with a lexicon of frequent words, and its inverse.

1. Spark counts the words (what merges can't reach across) of all texts. The most frequent ones,
   at most ``LEXICON`` of up to ``LONGEST`` bytes, are merged once and compiled into a minimal
   acyclic transducer with their ids as output (``transducer``).
2. The compiled file lies in the shared scratch folder; Spark gives every executor a copy
   (``addFile``), and its Python workers map that one file into memory.
3. A worker looks the different words of a batch up in step, merges those that the lexicon
   lacks by the ranks, and lines the ids up in text order. So the lexicon changes the time and
   never the result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm.transducer import Transducer, compiled, ragged
from cadentia.session import materialise, scratch_dir

VOCABULARY = "byte_bpe_50k.json"
#: Words of the lexicon at most, and the longest one's bytes: 8 MB of words whatever the corpus.
LEXICON, LONGEST = 1 << 17, 64
#: Steps per doubling of a word's count, by which the least frequent word of the lexicon is found.
LEVELS = 8
#: Bytes of text encoded together, and different words counted before they leave a worker.
BATCH_BYTES, COUNTED = 1 << 22, 1 << 19
#: Keys that a worker remembers; beyond that it starts anew. Bounds memory, not results.
REMEMBERED = 400_000
#: Characters of a text that are split together.
STRETCH = 1 << 20
#: Symbols of a word up to which its pairs are simply looked through again after each merge.
SHORT = 40
#: A merge is one number, its rank above the new id; a pair of ids is one number too.
ID_BITS = 24
ID_MASK, NO_MERGE = (1 << ID_BITS) - 1, 1 << 62

#: The published split of byte-level BPE into words.
_WORDS = regex.compile(public_tokenizers.PATTERN)
#: The same for texts of ASCII characters, without Unicode tables.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[a-zA-Z]+| ?[0-9]+| ?[^\sa-zA-Z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: A space that begins a word: no word reaches across the place before it.
_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
#: White space next to a space.
_ODD_SPACE = re.compile(r" (?=\s)|\s(?= )")
Key = str | tuple[str]
#: The first character that Unicode leaves open.
_LEAST_UNKNOWN = "\u0378"


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def _unsettled(text: str) -> bool:
    """Whether the text has a character that this Python's Unicode tables don't know.

    Tables of other versions may call it a letter.
    """
    return max(text) >= _LEAST_UNKNOWN and any(unicodedata.category(c) == "Cn" for c in set(text))


class Bpe:
    """Vocabulary and merges of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, split = stated["model"], stated["pre_tokenizer"] or {}
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        added = stated["added_tokens"]
        odd += [k for t in added for k in ("single_word", "lstrip", "rstrip") if t[k]]
        if odd or stated["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path}: not plain byte-level BPE {odd}")
        vocabulary, names = model["vocab"], _byte_names()
        self.path = path
        self.byte_ids = [vocabulary[n] for n in names]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {vocabulary[a] << ID_BITS | vocabulary[b]: rank << ID_BITS | vocabulary[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        byte_of = {n: b for b, n in enumerate(names)}
        written = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        written |= {i: token.encode() for token, i in self.special.items()}
        size = [len(written.get(i, b"")) for i in range(max(written) + 1)]
        self.width = np.array(size, np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.written = np.frombuffer(b"".join(written.get(i, b"") for i in range(len(size))), np.uint8)
        self._library = None

    def keys(self, text: str) -> Iterator[list[Key]]:
        """The text as keys of ``words``, in order, in lists of bounded length.

        Where single spaces stand between other characters, no word reaches across the place
        before them, so what lies between two spaces is split once however often it occurs.
        """
        for n, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if n % 2:
                yield [(part,)]
                continue
            at = 0
            while len(part) - at > STRETCH and (cut := _BOUNDARY.search(part, at + STRETCH)):
                yield self._keys(part[at : cut.start()])
                at = cut.start()
            yield self._keys(part[at:])

    def _keys(self, text: str) -> list[Key]:
        parts: list[Key] = text.split(" ")
        if "" in parts[1:] or _ODD_SPACE.search(text):
            return [(word,) for word in self._split(text)]
        parts[0] = " " + parts[0]
        return parts

    def words(self, key: Key) -> list[str]:
        """The words of a key: of a word in a tuple itself, behind a space a text's first part, any other one after a space."""
        if isinstance(key, tuple):
            return [key[0]]
        return self._split(key[1:] if key.startswith(" ") else " " + key)

    def _split(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII_WORDS.findall(text)
        if not _unsettled(text):
            return _WORDS.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word: of all neighbours the pair of least rank merges first, the leftmost of equals."""
        ids = [self.byte_ids[b] for b in word]
        return self._merged_short(ids) if len(ids) <= SHORT else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        found = [get(a << ID_BITS | b, NO_MERGE) for a, b in zip(ids, ids[1:], strict=False)]
        while found and (best := min(found)) < NO_MERGE:
            at = found.index(best)
            ids[at] = new = best & ID_MASK
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = get(ids[at - 1] << ID_BITS | new, NO_MERGE)
            if at < len(found):
                found[at] = get(new << ID_BITS | ids[at + 1], NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, n log n for a word of n bytes."""
        n = len(ids)
        after, before, get = list(range(1, n + 1)), list(range(-1, n - 1)), self.merges.get
        heap = [(best, at, ids[at], ids[at + 1]) for at in range(n - 1) if (best := get(ids[at] << ID_BITS | ids[at + 1]))]
        heapq.heapify(heap)
        while heap:
            best, at, left, right = heapq.heappop(heap)
            then = after[at]
            if ids[at] != left or then >= n or ids[then] != right:
                continue  # one of the two has merged meanwhile
            ids[at], ids[then] = new, _ = best & ID_MASK, -1
            after[at] = later = after[then]
            if later < n:
                before[later] = at
                if best := get(new << ID_BITS | ids[later]):
                    heapq.heappush(heap, (best, at, new, ids[later]))
            if (earlier := before[at]) >= 0 and (best := get(ids[earlier] << ID_BITS | new)):
                heapq.heappush(heap, (best, earlier, ids[earlier], new))
        return [i for i in ids if i >= 0]

    def decoded(self, ids: np.ndarray, size: np.ndarray) -> list[str]:
        """Texts of id sequences that stand one after another; ids without a token are passed over."""
        ids = np.where((ids >= 0) & (ids < len(self.width)), ids, len(self.width))
        width = np.append(self.width, 0)[ids]
        data = ragged(self.written, np.append(self.first, 0)[ids], width).tobytes()
        cuts = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(size)])].tolist()
        return [data[a:b].decode(errors="replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Encoder:
    """Encodes batches of texts: words of the lexicon by the transducer, all others by merging.

    The ids of keys met are remembered, up to a number of keys, so only new ones are looked up.
    """

    def __init__(self, bpe: Bpe, lexicon: Transducer):
        self.bpe, self.lexicon = bpe, lexicon
        self._forget()

    def _forget(self) -> None:
        self.place: dict[Key, int] = {}
        self.ids, self.width = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        if len(self.place) > REMEMBERED:
            self._forget()
        place, known = self.place, len(self.place)
        number, counts = [], []
        for text in texts:
            size = 0
            for keys in self.bpe.keys(text):
                number.append(np.array([place.setdefault(k, len(place)) for k in keys], np.int32))
                size += len(keys)
            counts.append(size)
        self._learn(list(islice(place, known, None)))
        return _lined_up(self.ids, self.width, np.concatenate([np.empty(0, np.int32), *number]), np.array(counts, np.int64))

    def _learn(self, keys: list[Key]) -> None:
        place: dict[str, int] = {}
        of_key, n_words = [], []
        for key in keys:
            words = self.bpe.words(key)
            of_key += [place.setdefault(w, len(place)) for w in words]
            n_words.append(len(words))
        ids, width = _lined_up(*self._looked_up(list(place)), np.array(of_key, np.int64), np.array(n_words, np.int64))
        self.ids, self.width = np.concatenate([self.ids, ids]), np.concatenate([self.width, width])

    def _looked_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [w.encode() for w in words]
        ids, size, known = self.lexicon.outputs(raw, LONGEST)
        if known.all():
            return ids, size
        rest, own, special = np.flatnonzero(~known).tolist(), [], self.bpe.special
        for at in rest:
            own.append([special[words[at]]] if words[at] in special else self.bpe.merged(raw[at]))
        # the others' ids stand behind those of the lexicon
        first = np.cumsum(size) - size
        both = np.concatenate([ids, np.fromiter(chain.from_iterable(own), np.int32)])
        size[rest] = [len(x) for x in own]
        first[rest] = len(ids) + np.cumsum(size[rest]) - size[rest]
        return ragged(both, first, size), size


def _lined_up(ids: np.ndarray, width: np.ndarray, order: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the parts in ``order``, and how many each group of ``counts`` parts has."""
    first = np.cumsum(width) - width
    width = width[order]
    per_group = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(counts)])]
    return ragged(ids, first[order], width).astype(np.int32), np.diff(per_group)


def _path(vocabulary: str) -> str:
    return vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)


@lru_cache(maxsize=2)
def _bpe(vocabulary: str) -> Bpe:
    return Bpe(_path(vocabulary))


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, lexicon: str) -> Encoder:
    return Encoder(_bpe(vocabulary), Transducer.mapped(SparkFiles.get(lexicon)))


def word_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(word binary, n)``: how often each word of up to ``LONGEST`` bytes occurs in all texts of ``docs(text)``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = _bpe(vocabulary), Counter()

        def out() -> pa.RecordBatch:
            words = Counter()
            for key, n in seen.items():
                for word in bpe.words(key):
                    words[word] += n
            seen.clear()
            short = {w: n for word, n in words.items() if len(w := word.encode()) <= LONGEST and word not in bpe.special}
            return pa.RecordBatch.from_arrays([pa.array(list(short), pa.binary()), pa.array(list(short.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                for keys in bpe.keys(text.as_py() or ""):
                    seen.update(keys)
                if len(seen) > COUNTED:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON) -> list[bytes]:
    """The most frequent of ``(word, n)`` that occur twice or more, down to a count at which they are ``most`` at most.

    The count is found from the number of words per level, ``LEVELS`` levels for each doubling.
    """
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    counts = materialise(counts.filter("n > 1").withColumn("level", level), "words")
    least, total = None, 0
    for at, n in sorted(counts.groupBy("level").count().collect(), reverse=True):
        total += n
        if total > most:
            break
        least = at
    if least is None:
        return []
    return sorted(bytes(r.word) for r in counts.filter(F.col("level") >= least).select("word").collect())


def lexicon(spark: SparkSession, words: list[bytes], vocabulary: str = VOCABULARY) -> str:
    """Compiles sorted ``words`` and hands the file to all executors, later ones too; its name there."""
    bpe = _bpe(vocabulary)
    data = compiled((w, tuple(bpe.merged(w))) for w in words)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark, 'lexicon')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(data)
    stream.close()
    spark.sparkContext.addFile(path)
    return name


def _by_bytes(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of about ``BATCH_BYTES``, null as empty, and where the first one stands."""
    out, total, first = [], 0, 0
    for at, item in enumerate(texts):
        text = item.as_py() or ""
        out.append(text)
        total += len(text)
        if total >= BATCH_BYTES:
            yield first, out
            out, total, first = [], 0, at + 1
    if out:
        yield first, out


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = LEXICON) -> DataFrame:
    """``doc_id, ids, decoded`` of every row of ``docs(doc_id, text, ...)``.

    ``ids`` are those of the ``tokenizers`` library without begin, end or padding; a special
    token's string inside a text is that token. ``decoded`` is the text of the ids, special
    tokens included. Null and empty texts have no ids; repeated rows and null ids are kept as
    they are; other columns are not looked at.
    """
    slim = docs.select("doc_id", "text")
    name = lexicon(docs.sparkSession, frequent_words(word_counts(slim, vocabulary), most), vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, name)
        for batch in batches:
            keys, texts = batch.columns
            for first, part in _by_bytes(texts):
                ids, size = encoder.encode(part)
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                decoded = pa.array(encoder.bpe.decoded(ids, size), pa.string())
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(part)), lists, decoded], ["doc_id", "ids", "decoded"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def decode(ids: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """The text of a column of id arrays; null and empty arrays are the empty text.

    Bytes that are no UTF-8 become U+FFFD; null ids and ids without a token are passed over.
    """

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _bpe(vocabulary)
        for batch in batches:
            out: list[str] = []
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                size = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                out += bpe.decoded(part.flatten().fill_null(-1).to_numpy(zero_copy_only=False), size)
            yield pa.array(out, pa.string())

    return text(F.col(ids) if isinstance(ids, str) else ids)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
