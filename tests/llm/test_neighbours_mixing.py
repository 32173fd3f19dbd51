import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadentia.llm import mixing, neighbours

VECTORS = "vec_id long, embedding array<float>, label int, block int, dim int, score double"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3.0) for i, v in rows], VECTORS)


def _search(spark, rows, every=1, nearest=5):
    vectors = _table(spark, rows)
    index = neighbours.build_index(vectors, block=64)
    asked = neighbours.usable(vectors.filter(f"vec_id % {every} = 0"))
    found = defaultdict(list)
    for r in sorted(neighbours.search(index, asked, nearest).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def test_recall_and_scores_with_unequal_lengths(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(300, 16)) * rng.uniform(0.2, 3, size=(300, 1))).astype(np.float32)
    found = _search(spark, [(i, v.tolist()) for i, v in enumerate(x)], every=10)
    exact = x.astype(float)
    hit = 0
    for q in range(0, 300, 10):
        scores = (exact * exact[q]).sum(axis=1)
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:5]
        hit += len(set(best) & {i for i, _ in found[q]})
        assert all(s == scores[i] for i, s in found[q])
        assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)
    assert len(found) == 30 and hit >= 0.9 * 150


def test_ties_repeats_and_vectors_that_take_no_part(spark):
    one = [1.0, 0.0]
    rows = [(i, one) for i in range(40)] + [(i, one) for i in range(40)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0]), (103, [1.0, None]), (104, [float("nan"), 1.0])]
    rows += [(105, [float("inf"), 1.0]), (None, one), (None, one), (106, [2.0, 1.0, 1.0])]
    found = _search(spark, rows)
    assert set(found) == set(range(40))  # 106 is alone in its dimension
    assert found[0] == [(i, 1.0) for i in (1, 2, 3, 4, 5)] and found[3] == [(i, 1.0) for i in (0, 1, 2, 4, 5)]


def test_an_id_with_two_vectors_is_two_candidates_and_two_queries(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.8])]
    vectors = _table(spark, rows)
    index = neighbours.build_index(vectors, block=64)
    asked = neighbours.usable(vectors.filter("vec_id = 0"))
    found = sorted((round(r.score, 6), r.rank, r.vec_id) for r in neighbours.search(index, asked, 5).collect())
    f = lambda x: round(float(np.float32(x)), 6)
    want = [(0.0, 3, 0), (f(0.1), 2, 2), (f(0.9), 1, 1), (0.0, 3, 0), (f(0.1), 2, 1), (f(0.8), 1, 2)]
    assert found == sorted(want)


def _block(vectors):
    """One block of an index, made as the tasks make it."""
    longest = np.sqrt((vectors * vectors).sum(axis=1)).max()
    rest = np.sqrt(np.maximum(longest**2 - (vectors * vectors).sum(axis=1), 0))
    p = (np.hstack([vectors, rest[:, None]]) @ neighbours._projections(vectors.shape[1])).astype(np.float32)
    order = np.argsort(p, axis=0, kind="stable")
    return neighbours.Block({
        "ids": np.arange(len(vectors)).tobytes(), "vectors": vectors.tobytes(), "longest": longest,
        "sorted": np.ascontiguousarray(np.take_along_axis(p, order, axis=0).T).tobytes(),
        "places": np.ascontiguousarray(order.T.astype(np.uint32)).tobytes(),
    })


def test_windows_are_counted_once_however_often_they_widen():
    rng = np.random.default_rng(8)
    block = _block(rng.normal(size=(500, 16)))
    projected = rng.normal(size=(1, neighbours.PROJECTIONS)).astype(np.float32) * 4
    start = np.array([np.searchsorted(line, v) for line, v in zip(block.sorted, projected[0], strict=True)])
    grown, begin, end = np.zeros(500, np.uint8), start, start
    for radius in (0.5, 0.9, 2.0, 7.0):
        low, high = (x[0] for x in block._windows(projected, np.array([radius])))
        block._count(grown, low, begin, end, high)
        begin, end = low, high
        inside = np.abs(block.sorted - projected.T) <= neighbours.HALF_WIDTH * radius
        want = np.zeros(500, int)
        np.add.at(want, block.places[inside], 1)
        assert abs(grown.astype(int) - want).max() <= 1  # a value on the edge may fall to either side
    assert block.counted == grown.sum()


def test_near_vectors_are_found_without_looking_at_most_of_the_arrays():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(80, 24))
    vectors = (centres[rng.integers(0, 80, 4000)] + 0.15 * rng.normal(size=(4000, 24))).astype(np.float32).astype(float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    block = _block(vectors)
    asked = np.arange(0, 4000, 100)
    found = block.search(vectors[asked], asked, 20)
    hit = 0
    for q, (ids, scores) in zip(asked, found, strict=True):
        exact = vectors @ vectors[q]
        exact[q] = -np.inf
        hit += len(set(ids) & set(np.argsort(-exact)[:20]))
        assert (scores == (vectors[ids] * vectors[q]).sum(axis=1)).all()
    assert hit >= 0.95 * 20 * len(asked)
    assert block.counted < 0.3 * neighbours.PROJECTIONS * len(vectors) * len(asked)


def test_fewer_vectors_than_asked_for_and_none(spark):
    assert _search(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])]) == {0: [(1, 4.0)], 1: [(0, 4.0)]}
    assert _search(spark, [(0, None)]) == {} and _search(spark, []) == {}


def _targets(sizes, weights=(3, 1, 2)):
    """Water-filling, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, target = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in target]
        share = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if share * weight[s] >= 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]


@pytest.fixture(scope="module")
def sources(spark):
    r = random.Random(4)
    rows = []
    for i in range(1200):
        source = "hot" if r.random() < 0.4 else r.choice(["a", "b", "Z", "é", None, "tiny"])
        words = 1 + int(r.paretovariate(1.0)) % 300
        rows.append((i, source, " ".join("w" * words) if i % 90 else None))
    rows += rows[:40] + [(None, "a", "x y z")] * 50 + [(5000, "empty", "")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_targets_and_taken_words(spark, sources, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 32)  # three levels of the tree
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = mixing.copies(sources).collect()
    assert len(rows) == sources.count()
    sizes, taken, target, most = Counter(), Counter(), {}, Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r["size"])
        assert 0 <= r.copies <= 2
    want = _targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - target[s]) <= most[s]
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_reruns_agree_in_any_order(sources):
    once = sorted(map(tuple, mixing.copies(sources).collect()), key=repr)
    again = sorted(map(tuple, mixing.copies(sources.repartition(7, "text")).collect()), key=repr)
    assert once == again


def test_rounding_keeps_expectations():
    r = np.random.default_rng(5)
    size = r.integers(1, 50, 9).astype(float)
    p0 = r.uniform(0.1, 0.9, 9)
    total = np.zeros(9)
    for _ in range(6000):
        p = p0.copy()
        left = mixing._pair_up(p, size, r.random(9))
        assert (p * size).sum() == pytest.approx((p0 * size).sum())
        if left >= 0:
            p[left] = float(r.random() < p[left])
        assert set(p) <= {0.0, 1.0}
        total += p
    assert np.abs(total / 6000 - p0).max() < 0.03


def test_mixed_takes_what_copies_say(clashing, empty):
    drawn = mixing.mixed(clashing)
    assert drawn.columns == clashing.columns
    want = Counter()
    for r in mixing.copies(clashing).collect():
        want[r.doc_id, r.source] += r.copies
    got = Counter((r.doc_id, r.source) for r in drawn.collect())
    assert got == +want
    assert mixing.mixed(empty).collect() == [] and mixing.copies(empty).collect() == []
