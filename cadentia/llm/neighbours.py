"""Nearest neighbours by inner product with collision-counting hashing.

The largest inner product becomes the smallest distance: a vector gets one more coordinate that
fills its length up to the longest one, a query is scaled to it. Vectors lie in blocks; a block keeps
its vectors sorted by each random projection. A query opens a window around its own projection in each
array; vectors that collide in enough windows are verified by their exact inner product. The windows
are those of a radius, and widen (virtual rehashing on the same arrays) until enough verified vectors
lie within it, so no number of candidates is set. What a window has covered is counted once: a wider one
goes on from where it ended, to the left and to the right. Blocks of queries meet blocks of vectors; only the
best of a block leave it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadentia.session import materialise

NEAREST = 20
PROJECTIONS = 96
#: Half the width of a window, in radii.
HALF_WIDTH = 1.3
#: Collisions asked for: so many deviations below what a vector at the radius has on average.
SLACK = 1.0
#: A radius that held too few is widened by this factor, and more each time.
WIDEN = 1.12
#: Vectors of an index block, queries that meet one copy of it in a task, how many of them are searched
#: together, and vectors that hint at the first radius.
BLOCK, QUERIES, TOGETHER, HINT = 16384, 65536, 1024, 512
SEED = 11

_INDEX = "dim int, block long, ids binary, vectors binary, sorted binary, places binary, longest double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding (doubles), dim``: rows equal in id and vector are one; an id with several vectors has a row for each.

    Vectors without an id, null, empty, of length zero, or with a null or non-finite component
    are left out.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & F.coalesce(
            ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("embedding", lambda x: x != 0),
            F.lit(False),
        )
    )
    return clean.distinct().withColumn("dim", F.size("embedding"))


def _projections(dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim)).normal(size=(dim + 1, PROJECTIONS))


def build_index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per block: its ids and vectors, and for each projection the sorted values and whose they are."""
    rows = materialise(usable(vectors), "vectors")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    n, longest = rows.agg(F.count("*"), F.max(length)).first()
    longest = longest or 1.0
    blocks = F.lit(-(-n // block) or 1)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        x = np.vstack(part["embedding"].to_numpy()).astype(np.float64)
        rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0.0))
        p = (np.hstack([x, rest[:, None]]) @ _projections(x.shape[1])).astype(np.float32)
        order = np.argsort(p, axis=0, kind="stable")
        in_order = np.take_along_axis(p, order, axis=0)
        return pd.DataFrame(
            {
                "dim": [x.shape[1]],
                "block": part["block"].iloc[:1].to_numpy(),
                "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                "vectors": [x.tobytes()],
                "sorted": [np.ascontiguousarray(in_order.T).tobytes()],
                "places": [np.ascontiguousarray(order.T.astype(np.uint32)).tobytes()],
                "longest": [longest],
            }
        )

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks))
    return dealt.groupBy("dim", "block").applyInPandas(build, _INDEX)


class Block:
    """One block of the index, in memory."""

    def __init__(self, row: pd.Series):
        self.ids = np.frombuffer(row["ids"], np.int64)
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
        self.sorted = np.frombuffer(row["sorted"], np.float32).reshape(PROJECTIONS, n)
        # as wide as bincount asks for, so that no window is converted again
        self.places = np.frombuffer(row["places"], np.uint32).reshape(PROJECTIONS, n).astype(np.intp)
        self.counted = 0  # entries of windows, over all queries
        self.longest = row["longest"]
        self.projections = _projections(self.vectors.shape[1])[:-1]  # a query's last coordinate is 0
        p = math.erf(HALF_WIDTH / math.sqrt(2))
        self.collisions = math.floor(PROJECTIONS * p - SLACK * math.sqrt(PROJECTIONS * p * (1 - p)))
        self.hint = self.vectors[:: max(1, n // HINT)]

    def _windows(self, projected: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where every query's window begins and ends in every sorted array."""
        half = HALF_WIDTH * radius
        low, high = np.empty(projected.shape, np.int64), np.empty(projected.shape, np.int64)
        for j, line in enumerate(self.sorted):
            low[:, j] = np.searchsorted(line, projected[:, j] - half)
            high[:, j] = np.searchsorted(line, projected[:, j] + half, side="right")
        return low, high

    def search(self, queries: np.ndarray, own: np.ndarray, nearest: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and inner products of the ``nearest`` vectors of every query, best first."""
        length = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        scaled = queries * (self.longest / length)
        projected = (scaled @ self.projections).astype(np.float32)
        full = self.longest**2
        # the second best of a few vectors (the best may be the query itself) hints at a radius that holds enough
        second = -min(2, len(self.hint))
        hints = (scaled[i : i + 256] @ self.hint.T for i in range(0, len(scaled), 256))
        best = np.concatenate([np.partition(h, second, axis=1)[:, second] for h in hints])
        radius = np.sqrt(np.maximum(2 * (full - best), 1e-4 * full))
        out: list = [None] * len(queries)
        left, widen = np.arange(len(queries)), 1.0
        collisions = np.zeros((len(queries), len(self.ids)), np.uint8)
        # an empty window at the query's own place
        begins = ends = np.stack([np.searchsorted(line, projected[:, j]) for j, line in enumerate(self.sorted)], axis=1)
        while len(left):
            low, high = self._windows(projected[left], radius[left])
            again = []
            for place, q in enumerate(left):
                self._count(collisions[q], low[place], begins[q], ends[q], high[place])
                ids, scores, done = self._verified(collisions[q], queries[q], own[q], radius[q], nearest)
                if done:
                    order = np.lexsort((ids, -scores))[:nearest]
                    out[q] = ids[order], scores[order]
                else:
                    again.append(q)
            begins, ends = begins.copy(), ends.copy()
            begins[left], ends[left] = low, high
            left = np.array(again, np.int64)
            widen *= WIDEN
            radius[left] *= widen
        return out

    def _count(self, collisions: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray, high: np.ndarray) -> None:
        """Adds what the windows cover beyond what they covered before, to the left and to the right.

        Where less lies outside the windows than is new in them, what is outside is counted instead.
        """
        n, covered = len(collisions), int((begin - low + high - end).sum())
        self.counted += covered
        if int((low + n - high).sum()) < covered:
            bounds = zip(self.places, low.tolist(), high.tolist(), strict=True)
            outside = np.concatenate([part for line, a, b in bounds for part in (line[:a], line[b:])])
            np.subtract(PROJECTIONS, np.bincount(outside, minlength=n), out=collisions, casting="unsafe")
            return
        bounds = zip(self.places, low.tolist(), begin.tolist(), end.tolist(), high.tolist(), strict=True)
        new = np.concatenate([part for line, a, b, c, d in bounds for part in (line[a:b], line[c:d])])
        collisions += np.bincount(new, minlength=n).astype(np.uint8)

    def _verified(self, collisions, query, own, radius, nearest):
        """Ids and exact inner products of the ``nearest`` vectors that collide often, and whether enough lie within the radius.

        Products of a matrix and a vector may differ from the exact ones in the last digits; all that could be
        among the nearest by that much are summed again one by one.
        """
        near = np.flatnonzero(collisions >= self.collisions)
        whole = radius >= 2 * self.longest  # no vector is farther away
        if whole:
            near = np.arange(len(self.ids))
        mine = near[self.ids[near] == own]
        near = near[~np.isin(near, mine[(self.vectors[mine] == query).all(axis=1)])] if len(mine) else near
        length = np.sqrt((query * query).sum())
        if len(near) > nearest:
            about = self.vectors[near] @ query
            if np.isfinite(about).all():  # products of vast numbers are not
                least = np.partition(about, len(near) - nearest)[len(near) - nearest]
                near = near[about >= least - 1e-9 * self.longest * length]
        scores = (self.vectors[near] * query).sum(axis=1)
        within = scores * (self.longest / length) >= self.longest**2 - radius**2 / 2
        return self.ids[near], scores, whole or int(within.sum()) >= nearest


def search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST, own: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``nearest`` vectors found for every query.

    ``queries`` has the columns of ``usable``. Best first, equal scores by vec_id; fewer rows if
    there are fewer vectors of a query's dimension. Unless ``own``, a query is no neighbour of
    itself; another row of its id, with another vector, may be. Rows of one id are queries of their own.
    """
    blocks = index.select(F.col("dim").alias("of"), F.col("block").alias("met"))
    n = queries.count()
    chunks = -(-n // QUERIES) or 1
    asked = (
        queries.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)))
        .join(blocks, F.col("dim") == F.col("of"))  # a query for every block of its dimension
        .select("dim", F.col("met").alias("block"), "chunk", F.col("vec_id").alias("query_id"), "embedding", F.xxhash64("embedding").alias("row"))
    )
    held = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []})
        block = Block(left.iloc[0])
        ids = right["query_id"].to_numpy(np.int64)
        found: list = []
        for at in range(0, len(right), TOGETHER):
            part = right.iloc[at : at + TOGETHER]
            asked_for = np.vstack(part["embedding"].to_numpy()).astype(np.float64)
            found += block.search(asked_for, ids[at : at + TOGETHER] if not own else np.full(len(part), np.iinfo(np.int64).min), nearest)
        size = [len(f[0]) for f in found]
        return pd.DataFrame(
            {
                "query_id": np.repeat(ids, size),
                "row": np.repeat(right["row"].to_numpy(np.int64), size),
                "vec_id": np.concatenate([f[0] for f in found]),
                "score": np.concatenate([f[1] for f in found]),
            }
        )

    key = ("dim", "block", "chunk")
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(meet, "query_id long, row long, vec_id long, score double")
    best = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_collision_counting(spark: SparkSession, sf_dir: str, every: int = 20) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = materialise(build_index(vectors), "index")
    queries = materialise(usable(vectors.filter(F.col("vec_id") % every == 0)), "queries")
    return search(index, queries)
