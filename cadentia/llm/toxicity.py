"""Toxicity of whole texts: embeddings of subword bags, averaged into a linear softmax.

A text is read in windows of words. A window is the average of the embeddings of all
character n-grams of its different words, word borders included, so a misspelling shares most vectors with the word
it hides; a softmax over that average scores the window, and the text has the score of its most
toxic window, whatever its length. Embeddings and softmax are trained together in numpy, on the
windows that decide a text. As the softmax is linear, one number per n-gram is enough to score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm.shingles import _SPACE, _hash_words, mix64

#: n-grams in bytes of lower-cased UTF-8; a word's borders count as one byte each.
SHORTEST, LONGEST = 3, 6
BUCKET_BITS, DIMENSIONS = 17, 8
WINDOW = 16
#: A window averages over so many n-grams at least, with zeros for those that it lacks: a few
#: words, or one repeated, say less than a full window.
LEAST_GRAMS = 256
#: Labelled rows of either class that the model is fitted on, and the longest of them in bytes.
SAMPLE, SAMPLE_BYTES = 1500, 20_000
PASSES, RATE, DECAY = 90, 0.06, 2e-6
#: Windows of a text that training looks at, the most toxic ones, chosen again every few passes.
DECIDING, CHOICE = 2, 5
THRESHOLD = 0.7
SEED = 7
_BATCH = 1 << 18
_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the places of all n-grams inside one word, borders included, and their buckets.

    ``data`` begins and ends with white space.
    """
    space = _SPACE[data]
    code = _CODE[np.where(space, 32, data)]
    hashed = code.copy()
    inside = np.ones(len(data), bool)
    power = np.uint64(1)
    for n in range(2, LONGEST + 1):
        power = np.uint64((int(power) * int(_STEP)) & 0xFFFFFFFFFFFFFFFF)
        m = len(data) - n + 1
        if m <= 0:
            return
        if n > 2:  # what was the last byte is inner now
            inside = inside[:m] & ~space[n - 2 : n - 2 + m]
        hashed = hashed[:m] + code[n - 1 :] * power
        if n >= SHORTEST:
            at = np.flatnonzero(inside[:m])
            yield at, (mix64(hashed[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _buffers(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in batches: bytes, the first byte of every window, and the text of every window."""
    batch, size, first = [], 0, 0
    for i, text in enumerate(texts):
        batch.append((text or "").lower().encode("utf-8", "surrogatepass"))
        size += len(batch[-1]) + 1
        if size >= _BATCH or i == len(texts) - 1:
            data = np.frombuffer(b" " + b" ".join(batch) + b" ", np.uint8)
            hashes, words = _hash_words(data)
            starts = np.cumsum([0] + [len(t) + 1 for t in batch])[: len(batch)] + 1
            owner = np.searchsorted(starts, words, side="right") - 1
            nth = np.arange(len(words)) - np.searchsorted(owner, np.arange(len(batch)))[owner]
            opens = nth % WINDOW == 0
            yield _once(data, hashes, words, np.cumsum(opens)), words[opens], owner[opens] + first
            first, batch, size = i + 1, [], 0


def _once(data: np.ndarray, hashes: np.ndarray, words: np.ndarray, window: np.ndarray) -> np.ndarray:
    """``data`` with blanks for words that stand in their window already."""
    order = np.lexsort((hashes, window))
    same = (hashes[order][1:] == hashes[order][:-1]) & (window[order][1:] == window[order][:-1])
    again = np.sort(order[1:][same])
    if not len(again):
        return data
    data = data.copy()
    ends = np.append(words[1:], len(data))[again]  # white space up to the next word is blank anyway
    width = ends - words[again]
    data[np.repeat(words[again] - (np.cumsum(width) - width), width) + np.arange(width.sum())] = 32
    return data


@dataclass
class Model:
    """``weight`` of an n-gram is its embedding's product with the softmax's difference of classes."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        for data, begins, owner in _buffers(texts):
            if len(begins):
                np.maximum.at(best, owner, self._logits(data, begins))
        return 1.0 / (1.0 + np.exp(-np.clip(best, -500, 500)))  # without words: 0, next to

    def _logits(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(data) + 1), np.zeros(len(data) + 1, np.int64)
        for at, bucket in _grams(data):
            total[at + 1] += self.weight[bucket]
            count[at + 1] += 1
        total, count = np.cumsum(total), np.cumsum(count)
        # a window's n-grams may begin at the space before its first word
        cuts = np.append(begins - 1, len(data))
        return np.diff(total[cuts]) / np.maximum(np.diff(count[cuts]), LEAST_GRAMS) + self.bias


def _windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams ordered by window, where each window begins, and its text."""
    grams, sizes, owners = [], [], []
    for data, begins, owner in _buffers(texts):
        if not len(begins):
            continue
        at, bucket = (np.concatenate(x) for x in zip(*_grams(data), strict=True))
        window = np.searchsorted(begins - 1, at, side="right") - 1
        kept = window >= 0
        at, bucket, window = at[kept], bucket[kept], window[kept]
        order = np.argsort(window, kind="stable")
        grams.append(bucket[order].astype(np.int32))
        sizes.append(np.bincount(window, minlength=len(begins)))
        owners.append(owner)
    if not grams:
        return np.empty(0, np.int32), np.zeros(1, np.int64), np.empty(0, np.int64)
    size = np.concatenate(sizes)
    return np.concatenate(grams), np.concatenate([[0], np.cumsum(size)]), np.concatenate(owners)


def train(texts: list[str], toxic: np.ndarray, seed: int = SEED) -> Model:
    """Fits embeddings and softmax together, by Adam on the windows that decide each text.

    Without rows of both classes the model is a constant.
    """
    toxic = np.asarray(toxic, bool)
    buckets = 1 << BUCKET_BITS
    if toxic.all() or not toxic.any():
        return Model(np.zeros(buckets), -20.0 if not toxic.any() else 20.0)
    grams, cuts, owner = _windows(texts)
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.1, (buckets, DIMENSIONS))
    softmax, bias = random.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    params = [embedding, softmax, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    balance = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    width = np.maximum(np.diff(cuts), LEAST_GRAMS)
    for step in range(1, PASSES + 1):
        if step == 1:  # nothing is learned yet: any windows
            chosen = _deciding(random.random(len(owner)), owner, 4 * DECIDING)
        elif step % CHOICE == 0:
            per_gram = embedding @ (softmax[:, 1] - softmax[:, 0])
            logit = np.empty(len(owner))
            for a in range(0, len(owner), 4096):  # a slice of windows at a time bounds memory
                b = min(a + 4096, len(owner))
                total = np.concatenate([[0.0], np.cumsum(per_gram[grams[cuts[a] : cuts[b]]])])
                logit[a:b] = np.diff(total[cuts[a : b + 1] - cuts[a]]) / width[a:b]
            chosen = _deciding(logit, owner, DECIDING)
        if step == 1 or step % CHOICE == 0:
            ids, first = _rows_of(grams, cuts, chosen)
        n = np.diff(first)
        mean = np.empty((len(n), DIMENSIONS))
        for d in range(DIMENSIONS):
            mean[:, d] = np.diff(np.concatenate([[0.0], np.cumsum(embedding[:, d][ids])])[first])
        mean /= np.maximum(n, LEAST_GRAMS)[:, None]
        scores = mean @ softmax + bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        share = np.bincount(owner[chosen], minlength=len(texts))
        loss = p
        loss[np.arange(len(chosen)), toxic[owner[chosen]].astype(int)] -= 1.0
        loss *= (balance[owner[chosen]] / share[owner[chosen]])[:, None] * len(texts)
        pull = loss @ softmax.T / np.maximum(n, LEAST_GRAMS)[:, None]
        grads = [
            np.stack([np.bincount(ids, np.repeat(pull[:, d], n), buckets) for d in range(DIMENSIONS)], axis=1),
            mean.T @ loss,
            loss.sum(axis=0),
        ]
        for param, grad, (m, v) in zip(params, grads, moments, strict=True):
            grad = grad / len(texts) + DECAY * param
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad * grad
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(embedding @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def _deciding(logit: np.ndarray, owner: np.ndarray, most: int) -> np.ndarray:
    """The windows of the largest logits of every text."""
    order = np.lexsort((-logit, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    return np.sort(order[rank < most])


def _rows_of(grams: np.ndarray, cuts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(cuts)[chosen]
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(cuts[:-1][chosen] - first[:-1], n) + np.arange(first[-1])
    return grams[at], first


def held_out() -> Column:
    """Rows that the model never learns from; a row without a doc_id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Trains on at most ``sample`` rows of either label, those of the smallest hashes.

    Rows that are held out, without a label, without a text or with one of over
    ``SAMPLE_BYTES`` are not learned from; of rows that repeat a doc_id the least text is.
    """
    known = labels.filter(F.col(label).isin(0, 1)).filter("doc_id IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).alias("toxic"))
    usable = docs.filter((F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES)).select("doc_id")
    order = F.xxhash64("doc_id", F.lit(SEED))
    known = known.join(usable, "doc_id", "left_semi")
    chosen = known.filter("toxic = 1").orderBy(order, "doc_id").limit(sample).union(
        known.filter("toxic = 0").orderBy(order, "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.filter((F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES))
    found = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).toPandas().sort_values("doc_id")
    return train(found["text"].tolist(), found["toxic"].to_numpy() == 1)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text, ...)``.

    Only the text is scored, whole; a text without words scores 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight, bias = shared.value
        for batch in batches:
            yield pa.array(Model(weight, bias).scores(batch.to_pylist()), pa.float64())

    out = docs.select("doc_id", held_out().alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, fit(docs, labels))
