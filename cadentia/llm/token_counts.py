"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

A text is cut at safe boundaries, where no token of the vocabulary can reach across, so the
counts of its parts add up to the count of the whole. Parts are counted once per batch and
worker, whatever the number of their occurrences, in batches of about equal bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Bytes of text that are cut and counted together.
BATCH_BYTES = 1 << 20
#: Parts that a worker remembers; beyond that it starts anew. Bounds memory, not results.
REMEMBERED = 200_000

#: Before a single space between two other characters: byte-level patterns and white space
#: markers take such a space with what follows it.
_BEFORE_SPACE = re.compile(rb"(?<=[^\x20\x09-\x0D])(?=\x20[^\x20\x09-\x0D])")


class Counter:
    """Token counts with one vocabulary file: of ``tokenizers`` (.json) or ``sentencepiece`` (.model)."""

    def __init__(self, path: str):
        self.seen: dict[bytes, int] = {}
        if path.endswith(".json"):
            self.count, self.cut = _json_counter(path)
        else:
            self.count, self.cut = _model_counter(path)

    def lengths(self, texts: list[bytes | None]) -> list[int]:
        out: list[int] = []
        batch: list[list[bytes]] = []
        size = 0
        for text in texts:
            batch.append(self.cut(text) if text else [])
            size += len(text or b"")
            if size >= BATCH_BYTES:
                out += self._lengths(batch)
                batch, size = [], 0
        return out + self._lengths(batch)

    def _lengths(self, batch: list[list[bytes]]) -> list[int]:
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        new = list({part for parts in batch for part in parts}.difference(self.seen))
        self.seen.update(zip(new, self.count([part.decode() for part in new]), strict=True))
        known = self.seen.__getitem__
        return [sum(map(known, parts)) for parts in batch]


def _json_counter(path: str) -> tuple[Callable[[list[str]], list[int]], Callable[[bytes], list[bytes]]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def count(parts: list[str]) -> list[int]:
        out = []
        for at in range(0, len(parts), 4096):
            found = tokenizer.encode_batch_fast(parts[at : at + 4096], add_special_tokens=False)
            out += [len(e.ids) for e in found]
        return out

    # If white space is dropped before the merges, each word stands alone: "a b" counts as "a" and "b".
    apart = [e.ids for e in tokenizer.encode_batch(["a", " \t\n\x0b\x0c\r", "b"], add_special_tokens=False)]
    whole = tokenizer.encode("a \t\n\x0b\x0c\rb", add_special_tokens=False).ids
    drops = not apart[1] and whole == apart[0] + apart[2]
    return count, bytes.split if drops else _BEFORE_SPACE.split


def _model_counter(path: str) -> tuple[Callable[[list[str]], list[int]], Callable[[bytes], list[bytes]]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.get_piece_size()))
    local = not any("▁" in piece.lstrip("▁") for piece in pieces)

    def cut(text: bytes) -> list[bytes]:
        # the model writes a marker before each text, which is what the space turns into
        first, *rest = _BEFORE_SPACE.split(text)
        return [first, *(part[1:] for part in rest)]

    def count(parts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(parts, num_threads=1)]

    return count, cut if local else lambda text: [text]


@lru_cache(maxsize=4)
def _counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text column, without begin, end or padding; null and empty texts have none.

    ``vocabulary`` names a file of ``public_tokenizers`` or is a path that every executor has.
    """

    @F.arrow_udf("long")
    def lengths(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        for part in parts:
            yield pa.array(counter.lengths(part.cast(pa.binary()).to_pylist()), pa.int64())

    return lengths(F.col(text) if isinstance(text, str) else text)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text, ...)``.

    Repeated rows and null ids are kept as they are; other columns are not looked at.
    """
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count("text", vocabulary).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
