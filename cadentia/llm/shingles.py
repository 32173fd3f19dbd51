"""Word shingles and circulant MinHash of a batch of texts, in numpy.

All hashes are taken over the UTF-8 bytes of a whole batch at once: a word is the
difference of two prefix sums of a polynomial hash, a shingle mixes five of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_CHUNK = 1 << 18

#: Byte classes of the contract: white space is 0x20 and 0x09-0x0D, A-Z are lower-cased.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.arange(256, dtype=np.uint64)
_LETTER[65:91] += np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64((_LETTER + np.uint64(1)) * _MULT)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_MULT, _CHUNK + 1), _powers(_INV, _CHUNK + 1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words ``[^\\x20\\x09-\\x0D]+`` of a buffer, A-Z lower-cased, in order."""
    hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    at = 0
    while at < len(data):
        stop = min(at + _CHUNK, len(data))
        if stop < len(data):  # cut behind white space; a word longer than a chunk is hashed in one piece
            gaps = np.flatnonzero(_SPACE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(_SPACE[data[stop:]])
                stop = stop + int(later[0]) if len(later) else len(data)
        h, first = _hash_words(data[at:stop])
        hashes.append(h)
        starts.append(first + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(starts)


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    first, last = edge[::2], edge[1::2]
    if len(data) <= _CHUNK:
        up, down = _UP[: len(data)], _DOWN
    else:
        up, down = _powers(_MULT, len(data) + 1)[:-1], _powers(_INV, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up, out=total[1:])
    return mix64((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)), first


def batches(texts: list[str | None], size: int = _CHUNK) -> Iterator[list[bytes]]:
    """The texts in UTF-8, in order, in lists of about ``size`` bytes; null is empty."""
    out, total = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if out and total + len(raw) > size:
            yield out
            out, total = [], 0
        out.append(raw)
        total += len(raw) + 1
    if out:
        yield out


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles.

    A text of fewer words has its whole sequence as its one shingle, a text without words none.
    """
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    words, starts = word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
    cuts = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    rolled = np.full(max(0, len(words) - WIDTH + 1), WIDTH, np.uint64)
    for j in range(WIDTH):
        rolled *= _MULT
        rolled += words[j : j + len(rolled)]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            s = np.sort(rolled[a : b - WIDTH + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            whole = b - a
            for w in words[a:b].tolist():
                whole = (whole * int(_MULT) + w) & 0xFFFFFFFFFFFFFFFF
            out.append(mix64(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


#: One more bijection puts the shingles in their first order, before any shift.
_FIRST = np.uint64(0xD6E8FEB86659FD93)
_SLICE = 1 << 14


def circulant_minhash(sets: list[np.ndarray], k: int) -> np.ndarray:
    """``k`` MinHash coordinates for each non-empty set, from two permutations.

    The first permutation spreads the shingles over the ring of 32-bit integers; coordinate
    ``j`` is the least value that the second one takes when the ring is turned by ``j`` places.
    """
    out = np.full((len(sets), k), 0xFFFFFFFF, np.uint32)
    if not sets:
        return out
    ring = (mix64(np.concatenate(sets) * _FIRST) >> np.uint64(32)).astype(np.uint32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x, t = np.empty(_SLICE, np.uint32), np.empty(_SLICE, np.uint32)
    for at in range(0, len(ring), _SLICE):  # a slice stays in the cache for all turns
        part = ring[at : at + _SLICE]
        whose = owner[at : at + _SLICE]
        starts = np.flatnonzero(np.diff(whose, prepend=-1))
        rows, y, z = whose[starts], x[: len(part)], t[: len(part)]
        for j in range(k):
            np.subtract(part, np.uint32(j), out=y)
            _second_permutation(y, z)
            out[rows, j] = np.minimum(out[rows, j], np.minimum.reduceat(y, starts))
    return out


def _second_permutation(x: np.ndarray, spare: np.ndarray) -> None:
    """A bijection of 32-bit integers, in place: the permutation whose argument is turned."""
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)
    np.multiply(x, np.uint32(0x85EBCA6B), out=x)
    np.right_shift(x, np.uint32(13), out=spare)
    np.bitwise_xor(x, spare, out=x)
    np.multiply(x, np.uint32(0xC2B2AE35), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def set_fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone: sums of two mixes of its hashes."""
    a = mix64(shingles).sum(dtype=np.uint64)
    b = mix64(shingles * _MULT + np.uint64(0x1234567)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
