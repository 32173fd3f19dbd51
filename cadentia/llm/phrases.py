"""Phrase collocations from depth-truncated suffix subtrees, vertically partitioned.

1. One pass counts the words of each language. The counts are the frequencies of one-word
   prefixes, by which the suffix tree is partitioned vertically: a prefix of up to ``HEAVY``
   occurrences is a subtree's root; one of more is prolonged by the next word, and once more if that
   word is as frequent (a pair is no more frequent than either of its words).
2. Prefixes are put together into groups whose suffixes fit the memory budget ``BUDGET``.
3. A second pass cuts every suffix after ``DEPTH`` words. A task sends each group the part of its
   subtrees that its own texts give, as sorted different suffixes with counts, compressed.
4. Every group merges its parts and builds its subtrees for itself: sorted suffixes are the leaves in
   order, and the total of the leaves below a node is how often the node's phrase occurs.

Words of fewer than ``LEAST`` occurrences are in no candidate, so a bit map of the others lets the
second pass end suffixes there. Bit maps are of a fixed size and may let too much pass, never too little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadentia.session import materialise

#: Words of a phrase at most, occurrences of a candidate at least, and phrases reported for a language.
DEPTH, LEAST, REPORTED = 3, 10, 2000
#: Per cent of a phrase's occurrences inside one longer candidate from which it is dropped.
COVERED = 50
SCALE = 1_000_000
#: Occurrences whose suffixes a group holds, and beyond which a prefix is prolonged.
BUDGET, HEAVY = 1 << 20, 1 << 16
#: Bytes of texts whose suffixes are sorted together.
BATCH_BYTES = 4 << 20
#: Different words of a batch up to which three numbers fit 63 bits.
MOST_WORDS = 1 << 21
#: Different words that a worker adds up before it hands them on.
COUNTED = 1 << 19
#: Bits of a bit map: 8 MB.
MAP_BITS = 1 << 26
#: Parts in which the candidates of a language are ranked before the best of them meet.
SALTS = 256
NO_LANG = "und"

#: Byte classes: between words of a piece, and between pieces. A-Z are lower-cased.
_GAP, _CUT = np.zeros(256, bool), np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_EDGE = _GAP | _CUT
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Words:
    """The words of a batch of texts: ``number`` of each in order, their ``spelling``, sorted, and where pieces begin."""

    def __init__(self, texts: list[bytes]):
        raw = (b"\n".join(texts) + b"\n").translate(_LOWER)
        data = np.frombuffer(raw, np.uint8)
        solid = ~_EDGE[data]
        edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        first, last = edge[::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(last - first)])
        kept = data[solid]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        coded = words.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.spelling = coded.dictionary.take(pa.array(order))
        self.number = rank[coded.indices.to_numpy()]
        cuts = np.concatenate([[0], np.cumsum(_CUT[data])])
        piece = cuts[first]
        self.begins = np.diff(piece, prepend=-1) != 0

    def counts(self) -> np.ndarray:
        return np.bincount(self.number, minlength=len(self.spelling))


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    """64 bits of (language, word), as ``_hash`` takes them of columns."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _hash() -> Column:
    return F.xxhash64("lang", "word")


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(MAP_BITS - 1)).astype(np.int64)


def _bit_map(words: DataFrame) -> bytes:
    """The bits of the words' hashes, ``MAP_BITS`` whatever their number."""
    place = _hash().bitwiseAND(F.lit(MAP_BITS - 1))
    parts = words.groupBy(F.bitmap_bucket_number(place + 1).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
    out = bytearray(MAP_BITS // 8)
    for part, bits in parts.collect():
        at = (part - 1) * len(bits)
        out[at : at + len(bits)] = bits
    return bytes(out)


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = _place(hashes)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").filter("text is not null")


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``BATCH_BYTES`` at a time, and what is left of each in the end."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
            lang, text = lang.as_py(), text.as_py()
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= BATCH_BYTES:
                yield lang, held.pop(lang)
                size.pop(lang)
            elif sum(size.values()) >= 2 * BATCH_BYTES:  # many languages: the largest goes first
                most = max(size, key=size.get)
                yield most, held.pop(most)
                size.pop(most)
    yield from held.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of all words of ``docs(lang, text)``; a null word has the language's total."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(parts).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")])
            yield from whole.rename_columns(["lang", "word", "n"]).combine_chunks().to_batches()

        for lang, texts in _by_language(batches):
            found = Words(texts)
            words = pa.concat_arrays([found.spelling.cast(pa.binary()), pa.nulls(1, pa.binary())]).cast(pa.string())
            n = pa.array(np.append(found.counts(), len(found.number)), pa.int64())
            parts.append(pa.table({"lang": pa.array([lang] * len(n), pa.string()), "word": words, "n": n}))
            rows += len(n)
            if rows > COUNTED:
                yield from out()
                parts, rows = [], 0
        if parts:
            yield from out()

    each = _texts(docs).mapInArrow(counted, "lang string, word string, n long")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _grouped(lang: str, found: Words, frequent: np.ndarray, heavy: np.ndarray, groups: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """The batch's part of the subtrees of every group: ``(group, suffixes, counts)``, suffixes different and sorted."""
    if not len(found.number):
        return
    hashes = _hashes(lang, found.spelling)
    good, many = _set(frequent, hashes), _set(heavy, hashes)
    number = found.number
    # place 0 stands for the suffix's end: of the piece, or before a word that is in no candidate
    code = np.where(good[number], number + 1, 0)
    follows = np.append(~found.begins[1:], False)
    second = np.where(follows, np.append(code[1:], 0), 0)
    third = np.where((second > 0) & np.append(follows[1:], False), np.append(code[2:], [0, 0])[: len(code)], 0)
    of = (code > 0) & (second > 0)
    (a, b, c), counts = _different(code[of] - 1, second[of] - 1, third[of] - 1, len(found.spelling) + 1)
    # the prefix that roots the subtree, hashed into its group
    mixed = hashes[a].copy()
    longer = many[a]
    mixed[longer] = _mix(mixed[longer], hashes[b[longer]])
    longest = longer & many[b]
    mixed[longest] = _mix(mixed[longest], np.where(c[longest] >= 0, hashes[c[longest]], np.uint64(0)))
    group = (_mix(mixed, np.uint64(1)) >> np.uint64(1)).astype(np.int64) % groups
    order = np.argsort(group, kind="stable")
    spelled = found.spelling.cast(pa.binary())
    pair = pc.binary_join_element_wise(spelled.take(pa.array(a[order])), spelled.take(pa.array(b[order])), b" ")
    last = spelled.take(pa.array(np.where(c[order] >= 0, c[order], 0)))
    phrases = pc.if_else(pa.array(c[order] >= 0), pc.binary_join_element_wise(pair, last, b" "), pair)
    cuts = [*np.flatnonzero(np.diff(group[order], prepend=-1)), len(order)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(group[order[x]]), phrases.slice(x, y - x), counts[order[x:y]]


def _different(a: np.ndarray, b: np.ndarray, c: np.ndarray, words: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The different triples of word numbers (``c`` may be -1), sorted, and how often each stands there."""
    if words < MOST_WORDS:
        code, counts = np.unique((a * words + b) * words + c + 1, return_counts=True)
        return (code // (words * words), code // words % words, code % words - 1), counts
    pair, of = np.unique(a * words + b, return_inverse=True)
    code, counts = np.unique(of * words + c + 1, return_counts=True)
    return (pair[code // words] // words, pair[code // words] % words, code % words - 1), counts


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (b + np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)) + (a >> np.uint64(2)))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(31))


_SENT = "group_id long, lang string, rows long, size long, suffixes binary, numbers binary"


def _packed(suffixes: pa.Array, counts: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """Rows, bytes, and the compressed suffixes, their counts and lengths."""
    _, offsets, data = suffixes.buffers()
    cuts = np.frombuffer(offsets, np.int32)[suffixes.offset : suffixes.offset + len(suffixes) + 1].astype(np.int64)
    numbers = np.stack([counts, np.diff(cuts)]).astype(np.uint32)
    size = int(cuts[-1] - cuts[0])
    whole = data.slice(int(cuts[0]), size)
    return len(suffixes), size, pa.compress(whole, "zstd", asbytes=True), pa.compress(numbers.tobytes(), "zstd", asbytes=True)


def _unpacked(rows: int, size: int, suffixes: bytes, numbers: bytes) -> tuple[pa.Array, np.ndarray]:
    counts, lengths = np.frombuffer(pa.decompress(numbers, 8 * rows, "zstd"), np.uint32).reshape(2, rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.decompress(suffixes, size, "zstd")]), counts


_NODES = "lang string, w1 string, w2 string, w3 string, n long"


def _subtrees(parts: pa.Table, heavy: np.ndarray) -> pa.Table:
    """The nodes of a group's subtrees of two and three words with how often their phrases occur.

    A node above its group's prefix has leaves in other groups too; it is given whatever its
    total, any other one from ``LEAST`` on.
    """
    out = []
    for lang in pc.unique(parts["lang"]).to_pylist():
        mine = parts.filter(pc.equal(parts["lang"], lang)).select(["rows", "size", "suffixes", "numbers"])
        suffixes, counts = zip(*(_unpacked(*row.values()) for row in mine.to_pylist()), strict=True)
        leaves = pa.table({"phrase": pa.concat_arrays(suffixes), "n": np.concatenate(counts)})
        leaves = leaves.group_by("phrase", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        words = pc.split_pattern(leaves["phrase"].chunk(0), b" ")
        w1, w2 = pc.list_element(words, 0), pc.list_element(words, 1)
        w3 = pc.list_element(pc.list_slice(words, 2, 3, return_fixed_size_list=True), 0)
        nodes = pa.table({"w1": w1, "w2": w2, "w3": w3, "n": leaves["n_sum"].chunk(0)})
        full = nodes.filter(pc.and_(pc.is_valid(nodes["w3"]), pc.greater_equal(nodes["n"], LEAST)))
        pairs = nodes.group_by(["w1", "w2"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["w1", "w2", "n"]).combine_chunks()
        above = [_set(heavy, _hashes(lang, pairs[c].chunk(0))) if len(pairs) else np.zeros(0, bool) for c in ("w1", "w2")]
        pairs = pairs.filter(pc.or_(pa.array(above[0] & above[1]), pc.greater_equal(pairs["n"], LEAST)))
        pairs = pairs.append_column("w3", pa.nulls(len(pairs), pa.binary())).select(["w1", "w2", "w3", "n"])
        both = pa.concat_tables([full, pairs])
        out.append(both.add_column(0, "lang", pa.array([lang] * len(both), pa.string())))
    whole = pa.concat_tables(out)
    return whole.cast(pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("n", pa.int64())]))


def phrase_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(lang, word, n)`` of words and ``(lang, w1, w2, w3, n)`` of phrases of two and three words, all of ``LEAST`` and more.

    A null word has the language's total of words; ``w3`` is null in a phrase of two words.
    """
    spark = docs.sparkSession
    words = materialise(word_counts(docs).filter(F.col("word").isNull() | (F.col("n") >= LEAST)), "words")
    total = words.filter("word is null").agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // BUDGET))
    known = words.filter("word is not null")
    maps = spark.sparkContext.broadcast((_bit_map(known), _bit_map(known.filter(F.col("n") > HEAVY))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, heavy = (np.frombuffer(m, np.uint8) for m in maps.value)
        for lang, texts in _by_language(batches):
            rows = []
            for group, suffixes, counts in _grouped(lang, Words(texts), frequent, heavy, groups):
                rows.append((group, lang, *_packed(suffixes, counts)))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["group_id", "lang", "rows", "size", "suffixes", "numbers"])

    def built(parts: pa.Table) -> pa.Table:
        return _subtrees(parts, np.frombuffer(maps.value[1], np.uint8))

    nodes = _texts(docs).mapInArrow(cut, _SENT).groupBy("group_id").applyInArrow(built, _NODES)
    # only nodes above a group's prefix come from several groups
    summed = nodes.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    return words, materialise(summed, "phrases")


def _score(a: str, left: str, right: str) -> Column:
    """Exact ``floor(SCALE a a / (l r))``, in 128 bits."""
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"cast({SCALE} as decimal(7, 0)) * ({wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, most: int = REPORTED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of ``docs(lang, text)``.

    A null language is ``und``; null and empty texts have no words, and a language without
    candidates has no rows. Repeated rows count as often as they stand there; other columns are
    not looked at. Ties go to the more frequent phrase, then to the smaller one in byte order.
    """
    words, phrases = phrase_counts(docs)
    known = words.filter("word is not null")
    total = words.filter("word is null").select("lang", F.col("n").alias("total"))
    pairs = phrases.filter("w3 is null").select("lang", "w1", "w2", F.col("n").alias("a"))
    triples = phrases.filter("w3 is not null").withColumnRenamed("n", "a")
    one = lambda word, n: known.select("lang", F.col("word").alias(word), F.col("n").alias(n))
    two = lambda x, y, n: pairs.toDF("lang", x, y, n)

    # a pair inside a triple that has enough of its occurrences goes
    part = F.explode(F.array(F.struct("w1", "w2", "a"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")))
    within = triples.select("lang", part.alias("p")).groupBy("lang", "p.w1", "p.w2").agg(F.max("p.a").alias("longer"))
    left = pairs.join(within, ["lang", "w1", "w2"], "left").filter(f"100 * coalesce(longer, 0) < {COVERED} * a")
    found2 = left.join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score")
    )
    found3 = (
        triples.join(one("w1", "l1"), ["lang", "w1"])
        .join(two("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(two("w1", "w2", "l2"), ["lang", "w1", "w2"])
        .join(one("w3", "r2"), ["lang", "w3"])
        .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
        .withColumn("first", F.col("s1") <= F.col("s2"))
        .select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
            F.when(F.col("first"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
            F.when(F.col("first"), F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
        )
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found2.union(found3).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
