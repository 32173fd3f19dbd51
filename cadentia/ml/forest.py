"""Random forests, every tree grown on all rows, stored as a table of nodes, scored as flat arrays.

A task grows whole trees of any depth on histogram bins. A table that a task can hold is given to several
tasks, each of which grows other trees, a level at a time for all nodes. Of a larger one the bins are
written to the shared folder: a task takes its tree's rows from there to files of its own, parts them node
by node, and holds the rows of a node once they are few. Bootstrap weights are Poisson draws from a hash of
row and tree, so a task that runs again grows the same trees. The nodes of all trees are the model.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.operators.cadence import predict_confidence
from cadentia.session import materialise, scratch_dir
from cadentia.settings import ForestParams
from cadentia.sources.npy import open_system, qualified

NODES = "tree int, node int, feature int, threshold double, left int, right int, p double, weight double, gain double"
#: Bytes of the features of the rows that a task holds; of larger tables and nodes the rows lie in files.
HELD_BYTES = 64 << 20
#: Off unless set: every tree sees all rows. If set, rows are dealt to shards of that many bytes of features, and a tree sees one of them.
SHARD_BYTES: int | None = None
#: Bytes of a file that are read at once, intervals in which the values of all features are counted at once, and draws made at once.
CHUNK_BYTES, INTERVALS, DRAWS = 2 << 20, 1 << 17, 1 << 18
#: Histogram bins of a feature, and cells of the histograms that are held at once.
BINS, CELLS = 128, 1 << 19
#: Bytes of nodes that a worker holds at once, and of the features of rows that meet them; a larger forest is read a pack of trees at a time.
MODEL_BYTES, NODE_BYTES, ROW_BYTES = 16 << 20, 36, 32 << 20
#: Rows times trees that a worker walks at once.
WALKED = 1 << 20
_GAIN = 1e-12


@dataclass(frozen=True)
class Forest:
    """A fitted forest: ``nodes`` as in ``NODES``; a leaf has feature -1, and node 0 is a tree's root."""

    nodes: DataFrame
    n_features: int
    n_trees: int


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (_mixed(x) >> np.uint64(11)).astype(float) / 2.0**53


#: Distribution function of a Poisson draw of mean 1.
_POISSON = np.exp(-1.0) * np.cumsum(1 / np.cumprod([1.0, *range(1, 16)]))


def _poisson(u: np.ndarray) -> np.ndarray:
    return np.searchsorted(_POISSON, u, side="right").astype(float)


def _between(values: np.ndarray) -> np.ndarray:
    return values[:-1] + np.diff(values) / 2


def _placed(x: np.ndarray, cuts: list[np.ndarray], bins: int) -> np.ndarray:
    """Bin numbers: a value goes to the first bin whose threshold is no less."""
    out = np.empty(x.shape, np.uint8 if bins <= 256 else np.uint16)
    for f, cut in enumerate(cuts):
        out[:, f] = np.searchsorted(cut, x[:, f], side="left")
    return out


def _binned(x: np.ndarray, bins: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin numbers and, per feature, the thresholds between bins."""
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > bins:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins), method="nearest"))
        cuts.append(_between(values))
    return _placed(x, cuts, bins), cuts


def _ordered(bits: np.ndarray) -> np.ndarray:
    """The bits of floats as integers in the order of the floats, and back."""
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def _keys(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """A batch's features as ordered integers, sorted, a row for each feature."""
    x = _finite(batch, d)
    return np.sort(_ordered((np.ascontiguousarray(x.T) + 0.0).view(np.int64)), axis=1)


def _extent(rows: DataFrame, d: int, bins: int) -> pa.Table:
    """Per feature the number of its values, the least and the greatest, and if it has few, all that are different."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, few = 0, [], [], [np.empty(0, np.int64)] * d
        for batch in batches:
            if not len(batch):
                continue
            keys = _keys(batch, d)
            n += len(batch)
            low.append(keys[:, 0])
            high.append(keys[:, -1])
            for f in range(d):
                if few[f] is not None:
                    more = np.union1d(few[f], keys[f])
                    few[f] = more if len(more) <= bins else None
        if n:
            columns = [np.arange(d, dtype=np.int32), np.full(d, n), np.min(low, axis=0), np.max(high, axis=0)]
            yield pa.record_batch([*map(pa.array, columns), pa.array(few, pa.list_(pa.int64()))], names=["slot", "n", "low", "high", "few"])

    found = rows.mapInArrow(seen, "slot int, n long, low long, high long, few array<long>").groupBy("slot")
    few = F.when(F.max(F.col("few").isNull().cast("int")) == 0, F.array_distinct(F.flatten(F.collect_list("few"))))
    return found.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), few.alias("few")).toArrow().sort_by("slot")


def _counted(rows: DataFrame, d: int, of: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each interval ``starts`` to ``ends`` of feature ``of`` the number of values inside, the least and the greatest."""
    first = np.searchsorted(of, np.arange(d + 1))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = np.zeros(len(of), np.int64), np.full(len(of), np.iinfo(np.int64).max), np.full(len(of), np.iinfo(np.int64).min)
        for batch in batches:
            if not len(batch):
                continue
            keys = _keys(batch, d)
            for f in range(d):
                own = slice(first[f], first[f + 1])
                begin = np.searchsorted(keys[f], starts[own], side="left")
                end = np.searchsorted(keys[f], ends[own], side="right")
                some = np.flatnonzero(end > begin)
                at = first[f] + some
                n[at] += (end - begin)[some]
                low[at] = np.minimum(low[at], keys[f][begin[some]])
                high[at] = np.maximum(high[at], keys[f][end[some] - 1])
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(low[at]), pa.array(high[at])], names=["slot", "n", "low", "high"])

    found = rows.mapInArrow(seen, "slot int, n long, low long, high long").groupBy("slot")
    table = found.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    n, low, high = (np.zeros(len(of), np.int64) for _ in range(3))
    for whole, name in ((n, "n"), (low, "low"), (high, "high")):
        whole[table["slot"].to_numpy()] = table[name].to_numpy()
    return n, low, high


def _table_cuts(rows: DataFrame, d: int, bins: int) -> list[np.ndarray]:
    """The thresholds that ``_binned`` takes from all rows, without a task that holds a feature's values.

    The ranks of the quantiles are looked for in intervals of the values; each pass over the rows counts
    what lies in parts of those that hold one, until an interval's ends or its only value answer.
    """
    extent = _extent(rows, d, bins)
    few = [None if v is None or len(v) > bins else np.sort(v) for v in extent["few"].to_pylist()]
    total, low, high = (extent[c].to_numpy() for c in ("n", "low", "high"))
    wanted = [np.empty(0, np.int64) if v is not None else np.unique(np.around((n - 1) * np.linspace(0, 1, bins)).astype(np.int64))
              for n, v in zip(total, few, strict=True)]
    feature, rank = np.repeat(np.arange(d), [len(w) for w in wanted]), np.concatenate(wanted)
    value, at = np.zeros(len(rank), np.int64), feature.copy()
    of, base, n = np.arange(d), np.zeros(d, np.int64), total
    missing = np.arange(len(rank))
    while True:
        here, asked = at[missing], rank[missing]
        bottom = (asked == base[here]) | (low[here] == high[here])
        top = asked == base[here] + n[here] - 1
        value[missing] = np.where(bottom, low[here], high[here])
        missing = missing[~(bottom | top)]
        if not len(missing):
            break
        kept, nth = np.unique(at[missing], return_inverse=True)
        parts = max(2, INTERVALS // len(kept))
        begin, span = low[kept].astype(np.uint64), high[kept].astype(np.uint64) - low[kept].astype(np.uint64)
        step = span // np.uint64(parts) + np.uint64(1)
        offset = step[:, None] * np.arange(parts, dtype=np.uint64)
        real = offset <= span[:, None]
        starts = (begin[:, None] + offset).view(np.int64)
        ends = (begin[:, None] + np.minimum(offset + (step - np.uint64(1))[:, None], span[:, None])).view(np.int64)
        parent = np.broadcast_to(np.arange(len(kept))[:, None], real.shape)[real]
        parts_n, parts_low, parts_high = _counted(rows, d, of[kept][parent], starts[real], ends[real])
        below = np.cumsum(parts_n) - parts_n
        first = np.searchsorted(parent, np.arange(len(kept)))
        sought = below[first[nth]] + rank[missing] - base[kept][nth]
        at[missing] = np.searchsorted(below + parts_n, sought, side="right")
        of, base, n, low, high = of[kept][parent], base[kept][parent] + below - below[first[parent]], parts_n, parts_low, parts_high
    floats = lambda keys: _ordered(np.asarray(keys, np.int64)).view(np.float64)
    return [_between(floats(v) if v is not None else np.unique(floats(value[feature == f]))) for f, v in enumerate(few)]


def _chosen(weight: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the gain, the place among its features, and the bin of its best split, from histograms by node, feature and bin."""
    weight, ones = weight.cumsum(axis=2), ones.cumsum(axis=2)
    all_w, all_1 = weight[:, :, -1:], ones[:, :, -1:]
    right_w, right_1 = all_w - weight, all_1 - ones
    with np.errstate(divide="ignore", invalid="ignore"):
        left_over = 2 * ones * (weight - ones) / weight
        right_over = 2 * right_1 * (right_w - right_1) / right_w
        drop = 2 * all_1 * (all_w - all_1) / all_w - left_over - right_over
    drop[(weight <= 0) | (right_w <= 0)] = 0.0
    n_bins = drop.shape[2]
    flat = drop.reshape(len(drop), -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), best], best // n_bins, best % n_bins


def _best_splits(bins, y, w, local, features, n_bins):
    """For each node the gain, feature and bin of its best split, from histograms of its own features."""
    m, k = features.shape
    gain, feature, cut = np.zeros(m), np.full(m, -1), np.zeros(m, int)
    step = max(1, CELLS // (k * n_bins))
    for low in range(0, m, step):
        high = min(m, low + step)
        rows = np.flatnonzero((local >= low) & (local < high))
        own = local[rows] - low
        b = bins[rows[:, None], features[local[rows]]]
        key = ((own[:, None] * k + np.arange(k)) * n_bins + b).ravel()
        shape = (high - low, k, n_bins)
        weight = np.bincount(key, np.repeat(w[rows], k), (high - low) * k * n_bins).reshape(shape)
        ones = np.bincount(key, np.repeat(w[rows] * y[rows], k), (high - low) * k * n_bins).reshape(shape)
        gain[low:high], place, cut[low:high] = _chosen(weight, ones)
        feature[low:high] = features[np.arange(low, high), place]
    return gain, feature, cut


def grow(
    bins: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, w: np.ndarray, tree: int, par: ForestParams, *, top: int = 0, depth: int = 0
) -> dict[str, np.ndarray]:
    """One tree on binned rows of weight ``w``, a level at a time, or what is below its node ``top`` at ``depth``; its nodes by column."""
    kept = np.flatnonzero(w > 0)
    bins, y, w = bins[kept], y[kept], w[kept]
    d, n_bins = bins.shape[1], max(len(c) for c in cuts) + 1
    tried = d if par.feature_subset == "all" else max(1, int(np.sqrt(d)))
    draws = np.random.default_rng([par.seed, tree, top] if top else [par.seed, tree])
    out: dict[str, list] = {c: [] for c in ("feature", "threshold", "left", "right", "p", "weight", "gain")}
    local, frontier, n_nodes = np.zeros(len(y), np.int64), 1, 1
    while frontier:
        weight = np.bincount(local, w, frontier)
        ones = np.bincount(local, w * y, frontier)
        drawn = np.argpartition(draws.random((frontier, d)), tried - 1, axis=1)[:, :tried]
        features = np.sort(drawn, axis=1)  # ties go to the first feature
        gain, feature, cut = _best_splits(bins, y, w, local, features, n_bins)
        mixed = (ones > 0) & (ones < weight)
        stuck = np.flatnonzero(mixed & (gain <= _GAIN))
        if len(stuck) and tried < d:  # none of its features splits the node: look at all of them
            place = np.full(frontier, -1)
            place[stuck] = np.arange(len(stuck))
            rows = np.flatnonzero(place[local] >= 0)
            every = np.tile(np.arange(d), (len(stuck), 1))
            gain[stuck], feature[stuck], cut[stuck] = _best_splits(bins[rows], y[rows], w[rows], place[local[rows]], every, n_bins)
        split = mixed & (gain > _GAIN) & (par.max_depth is None or depth < par.max_depth)
        nth = np.cumsum(split) - 1
        out["feature"].append(np.where(split, feature, -1))
        out["threshold"].append(np.array([cuts[f][c] if s else 0.0 for f, c, s in zip(feature, cut, split, strict=True)]))
        out["left"].append(np.where(split, n_nodes + 2 * nth, -1))
        out["right"].append(np.where(split, n_nodes + 2 * nth + 1, -1))
        out["p"].append(np.divide(ones, weight, out=np.zeros(frontier), where=weight > 0))
        out["weight"].append(weight)
        out["gain"].append(np.where(split, gain, 0.0))
        going = split[local]
        bins, y, w, local = bins[going], y[going], w[going], local[going]
        goes_right = bins[np.arange(len(local)), feature[local]] > cut[local]
        local = 2 * nth[local] + goes_right
        frontier = 2 * int(split.sum())
        n_nodes, depth = n_nodes + frontier, depth + 1
    return {c: np.concatenate(v) for c, v in out.items()}


def _rows_at_once(row_bytes: int) -> int:
    return max(1, CHUNK_BYTES // row_bytes)


def _read(path: Path, kind: np.dtype) -> Iterator[np.ndarray]:
    with path.open("rb") as f:
        while data := f.read(_rows_at_once(kind.itemsize) * kind.itemsize):
            yield np.frombuffer(data, kind)


def _parted(path: Path, right: Path, kind: np.dtype, feature: int, cut: int) -> int:
    """Moves the rows that go right to a file of their own; the others stay. The number of those that stay."""
    stay, done = 0, 0
    with path.open("r+b") as f, right.open("wb") as other:
        while data := f.read(_rows_at_once(kind.itemsize) * kind.itemsize):
            rows = np.frombuffer(data, kind)
            done += len(rows)
            goes_right = rows["bins"][:, feature] > cut
            other.write(rows[goes_right].tobytes())
            f.seek(stay * kind.itemsize)
            f.write(rows[~goes_right].tobytes())
            stay += len(rows) - int(goes_right.sum())
            f.seek(done * kind.itemsize)
        f.truncate(stay * kind.itemsize)
    return stay


def _split_of(path: Path, kind: np.dtype, features: np.ndarray, n_bins: int) -> tuple[float, int, int]:
    """Gain, feature and bin of the best split of a node whose rows lie in a file."""
    k = len(features)
    weight, ones = np.zeros(k * n_bins), np.zeros(k * n_bins)
    for rows in _read(path, kind):
        key = (np.arange(k) * n_bins + rows["bins"][:, features]).ravel()
        weight += np.bincount(key, np.repeat(rows["w"], k), k * n_bins)
        ones += np.bincount(key, np.repeat(rows["w"] * rows["y"], k), k * n_bins)
    gain, place, cut = _chosen(weight.reshape(1, k, n_bins), ones.reshape(1, k, n_bins))
    return float(gain[0]), int(features[place[0]]), int(cut[0])


Chunk = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _filed(path: Path, chunks: Callable[[], Iterator[Chunk]], kind: np.dtype) -> int:
    """Writes the rows that have a weight, or if none has, all by their numbers; how many these are."""
    for drawn in (True, False):
        count = 0
        with path.open("wb") as f:
            for bins, y, w, n in chunks():
                w = w if drawn else n
                kept = np.flatnonzero(w > 0)
                rows = np.empty(len(kept), kind)
                rows["bins"], rows["y"], rows["w"] = bins[kept], y[kept], w[kept]
                f.write(rows.tobytes())
                count += len(rows)
        if count:
            break
    return count


def grow_from_files(
    chunks: Callable[[], Iterator[Chunk]], cuts: list[np.ndarray], bin_type: np.dtype, tree: int, par: ForestParams, held: int
) -> Iterator[dict[str, np.ndarray]]:
    """One tree on chunks of bins, labels, weights and numbers of rows; its nodes, with their numbers, some at a time.

    The rows lie in files of this task, one for each node that waits, together as many as the tree has. A node
    of more than ``held`` rows is split from its file, what is below the others is grown by ``grow``. A child's number is above its parent's.
    """
    d, n_bins = len(cuts), max(len(c) for c in cuts) + 1
    tried = d if par.feature_subset == "all" else max(1, int(np.sqrt(d)))
    names = ("node", "feature", "threshold", "left", "right", "p", "weight", "gain")
    with tempfile.TemporaryDirectory(prefix="tree-") as folder:
        path, kind = Path(folder, "0"), np.dtype([("bins", bin_type, (d,)), ("y", float), ("w", float)])
        n = _filed(path, chunks, kind)
        waiting, n_nodes, upper = [(path, n, 0, 0)], 1, []
        while waiting:
            path, n, node, depth = waiting.pop()
            if n <= held:
                rows = np.fromfile(path, kind)
                path.unlink()
                below = grow(rows["bins"], cuts, rows["y"], rows["w"], tree, par, top=node, depth=depth)
                del rows
                size = len(below["p"])
                number = np.append(node, np.arange(n_nodes, n_nodes + size - 1))
                n_nodes += size - 1
                for side in ("left", "right"):
                    below[side] = np.where(below[side] < 0, -1, number[below[side]])
                yield {"node": number, **below}
                continue
            weight = ones = 0.0
            for rows in _read(path, kind):
                weight, ones = weight + rows["w"].sum(), ones + (rows["w"] * rows["y"]).sum()
            gain, feature, cut = 0.0, -1, 0
            if 0 < ones < weight and (par.max_depth is None or depth < par.max_depth):
                drawn = np.argpartition(np.random.default_rng([par.seed, tree, node]).random(d), tried - 1)[:tried]
                gain, feature, cut = _split_of(path, kind, np.sort(drawn), n_bins)
                if gain <= _GAIN and tried < d:
                    gain, feature, cut = _split_of(path, kind, np.arange(d), n_bins)
            if gain > _GAIN:
                right = Path(folder, str(n_nodes + 1))
                stay = _parted(path, right, kind, feature, cut)
                upper.append((node, feature, cuts[feature][cut], n_nodes, n_nodes + 1, ones / weight, weight, gain))
                waiting += [(right, n - stay, n_nodes + 1, depth + 1), (path, stay, n_nodes, depth + 1)]
                n_nodes += 2
            else:
                path.unlink()
                upper.append((node, -1, 0.0, -1, -1, ones / weight, weight, 0.0))
        if upper:
            yield dict(zip(names, map(np.array, zip(*upper, strict=True)), strict=True))


def _numbers(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _finite(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """A batch's features."""
    if batch["features"].null_count:
        raise ValueError("features must not be null")
    x = _numbers(batch["features"], d)
    if not np.isfinite(x).all():
        raise ValueError("features must be finite")
    return x


def _shard(batches: Iterator[pa.RecordBatch], d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and row hashes of a shard; a batch is let go when its numbers have been taken."""
    x, y, row = [], [], []
    for batch in batches:
        x.append(_finite(batch, d).copy())
        y.append(batch["label"].to_numpy(zero_copy_only=False))
        row.append(batch["row"].to_numpy(zero_copy_only=False).astype(np.uint64))
    return np.concatenate(x), np.concatenate(y), np.concatenate(row)


_KINDS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("threshold", pa.float64()), ("left", pa.int32()),
                    ("right", pa.int32()), ("p", pa.float64()), ("weight", pa.float64()), ("gain", pa.float64())])
_NEXT = np.uint64(0x9E3779B97F4A7C15)


def _nodes(tree: int, nodes: dict[str, np.ndarray]) -> pa.RecordBatch:
    columns = {"tree": np.full(len(nodes["p"]), tree), **nodes}
    return pa.record_batch([pa.array(columns[f.name]).cast(f.type) for f in _KINDS], schema=_KINDS)


def _salt(tree: int, par: ForestParams) -> np.ndarray:
    return _mixed(np.array([par.seed * 1_000_003 + tree], np.uint64))


def fit_forest(labelled: DataFrame, par: ForestParams = ForestParams()) -> Forest:
    """A forest on ``labelled(features, label)``; labels are 0 and 1.

    Without ``max_depth`` trees grow until their leaves are pure or can't be split. Every tree learns from
    all rows, and the thresholds between bins are quantiles of all rows, at every size of the table; a task holds
    the bins of ``HELD_BYTES`` of features at most. Rows that are equal have draws of their own. No rows, or
    null or non-finite features, are an error.
    """
    rows = labelled.select(F.col("features").cast("array<double>").alias("features"), F.col("label").cast("double").alias("label"))
    first = rows.first()
    if first is None:
        raise ValueError("a forest needs rows")
    d, size = len(first.features), rows.count() * len(first.features) * 8
    grown = _held_trees(rows, d, size, par) if SHARD_BYTES or size <= HELD_BYTES else _filed_trees(rows, d, par)
    return Forest(materialise(grown, "forest"), d, par.n_trees)


def _held_trees(rows: DataFrame, d: int, size: int, par: ForestParams) -> DataFrame:
    """Trees of tasks that hold the whole table, or a shard of it if shards were asked for."""
    trees = par.n_trees
    shards = min(trees, -(-size // SHARD_BYTES)) if SHARD_BYTES else 1
    copies = min(-(-rows.sparkSession.sparkContext.defaultParallelism // shards), -(-trees // shards))
    dealt = rows.withColumn("row", F.xxhash64("features", "label")).withColumn("shard", F.pmod("row", F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    def grown(key: tuple[pa.Scalar, ...], shard: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, copy = (k.as_py() for k in key)
        x, y, row = _shard(shard, d)
        bins, cuts = _binned(x, BINS)
        del x  # from here on the bins stand for the features
        order = np.argsort(row, kind="stable")
        bins, y, row = bins[order], y[order], row[order]
        starts = np.flatnonzero(np.diff(row, prepend=~row[:1]))
        nth = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        row = _mixed(row + nth.astype(np.uint64) * _NEXT)
        for tree in range(number + shards * copy, trees, shards * copies):
            w = _poisson(_uniform(row ^ _salt(tree, par))) if par.bootstrap else np.ones(len(y))
            nodes = grow(bins, cuts, y, w if w.any() else np.ones(len(y)), tree, par)
            yield _nodes(tree, {"node": np.arange(len(nodes["p"])), **nodes})

    return dealt.groupBy("shard", "copy").applyInArrow(grown, NODES)


def _weights(row: np.ndarray, n: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The draws of ``n`` equal rows each, in sum: those that ``n`` rows of this hash have one by one."""
    last, out = np.cumsum(n), np.zeros(len(n))
    for low in range(0, int(last[-1]) if len(n) else 0, DRAWS):
        copy = np.arange(low, min(low + DRAWS, int(last[-1])))
        of = np.searchsorted(last, copy, side="right")
        nth = (copy - (last - n)[of]).astype(np.uint64)
        out += np.bincount(of, _poisson(_uniform(_mixed(row[of] + nth * _NEXT) ^ salt)), len(n))
    return out


def _filed_trees(rows: DataFrame, d: int, par: ForestParams) -> DataFrame:
    """Trees of tasks that read the bins of all rows from the shared folder; equal rows are one row there, with their number."""
    spark, cuts, kind = rows.sparkSession, _table_cuts(rows, d, BINS), np.dtype(np.uint8 if BINS <= 256 else np.uint16)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _placed(_finite(batch, d), cuts, BINS)
            ends = pa.py_buffer(np.arange(len(batch) + 1, dtype=np.int32) * np.int32(d * kind.itemsize))
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, ends, pa.py_buffer(bins)])
            yield pa.record_batch([batch["row"], batch["label"], packed], names=["row", "label", "bins"])

    hashed = rows.withColumn("row", F.xxhash64("features", "label")).mapInArrow(binned, "row long, label double, bins binary")
    path = scratch_dir(spark, "bins")
    hashed.groupBy("row", "label", "bins").agg(F.count(F.lit(1)).alias("n")).write.option("parquet.block.size", str(MODEL_BYTES)).parquet(path)
    folder, held = qualified(spark, path), max(1, HELD_BYTES // (8 * d))

    def chunks(salt: np.ndarray) -> Iterator[Chunk]:
        system, inner = open_system(folder)
        for f in sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".parquet")):
            with system.open_input_file(f) as source:
                for batch in pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(_rows_at_once(d * kind.itemsize)):
                    row, y, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("row", "label", "n"))
                    _, ends, packed = batch["bins"].buffers()
                    start = int(np.frombuffer(ends, np.int32)[batch["bins"].offset])
                    bins = np.frombuffer(packed, kind, len(batch) * d, start).reshape(-1, d)
                    yield bins, y, _weights(row.astype(np.uint64), n, salt) if par.bootstrap else n, n

    def grown(numbers: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in (t for batch in numbers for t in batch["id"].to_pylist()):
            salt = _salt(tree, par)
            for nodes in grow_from_files(partial(chunks, salt), cuts, kind, tree, par, held):
                yield _nodes(tree, nodes)

    return spark.range(0, par.n_trees, 1, par.n_trees).mapInArrow(grown, NODES)


def importances(spark: SparkSession, model: Forest) -> DataFrame:
    """Share of each feature in the impurity that the splits take away, the mean over all trees."""
    whole = model.nodes.groupBy("tree").agg(F.sum("gain").alias("whole")).where("whole > 0")
    each = model.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).join(whole, "tree")
    trees = whole.count()
    share = each.groupBy(F.col("feature").cast("bigint").alias("feature")).agg((F.sum(F.col("gain") / F.col("whole")) / max(trees, 1)).alias("importance"))
    every = spark.range(model.n_features).withColumnRenamed("id", "feature")
    return every.join(share, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def importance_stats(ranked: DataFrame) -> DataFrame:
    return ranked.agg(F.avg("importance").alias("mean_importance"), F.stddev_pop("importance").alias("std_importance"))


class Walker:
    """Trees as flat arrays: all rows walk all trees in step."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
        tree, node = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        self.roots = np.flatnonzero(node == 0)
        base = self.roots[np.searchsorted(tree[self.roots], tree)]
        self.feature, self.threshold, self.p = (nodes[c].to_numpy() for c in ("feature", "threshold", "p"))
        self.left, self.right = (nodes[c].to_numpy() + base for c in ("left", "right"))

    def total(self, x: np.ndarray) -> np.ndarray:
        """For each row the sum of its leaves' probabilities over all trees."""
        out = np.zeros(len(x))
        step = max(1, WALKED // max(1, len(self.roots)))
        for low in range(0, len(x), step):
            rows = x[low : low + step]
            at = np.tile(self.roots, len(rows))
            row = np.repeat(np.arange(len(rows)), len(self.roots))
            open_ = np.flatnonzero(self.feature[at] >= 0)
            while len(open_):
                here = at[open_]
                left = rows[row[open_], self.feature[here]] <= self.threshold[here]
                at[open_] = np.where(left, self.left[here], self.right[here])
                open_ = open_[self.feature[at[open_]] >= 0]
            out[low : low + step] = self.p[at].reshape(len(rows), -1).sum(axis=1)
        return out


class Piece:
    """Some consecutive nodes of a tree that is larger than a pack."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by("node")
        self.feature, self.threshold, self.left, self.right, self.p = (nodes[c].to_numpy() for c in ("feature", "threshold", "left", "right", "p"))
        self.low = int(nodes["node"][0].as_py())
        self.high = self.low + len(nodes)

    def walk(self, x: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        """Rows that are ``at`` a node of the piece walk on until they leave it; at a leaf they add its probability and end at -1."""
        open_ = np.flatnonzero((at >= self.low) & (at < self.high))
        while len(open_):
            here = at[open_] - self.low
            leaf = self.feature[here] < 0
            out[open_[leaf]] += self.p[here[leaf]]
            at[open_[leaf]] = -1
            open_, here = open_[~leaf], here[~leaf]
            left = x[open_, self.feature[here]] <= self.threshold[here]
            at[open_] = np.where(left, self.left[here], self.right[here])
            open_ = open_[(at[open_] >= self.low) & (at[open_] < self.high)]


_WALKED = ("tree", "node", "feature", "threshold", "left", "right", "p")


def _packed(model: Forest) -> tuple[str, int, list[range]]:
    """The folder below which the trees lie in packs of about ``MODEL_BYTES``, ``pack=0`` and so on, the number of packs of
    whole trees, and the packs of each tree that is larger than one."""
    spark, most = model.nodes.sparkSession, max(1, MODEL_BYTES // NODE_BYTES)
    sizes = model.nodes.groupBy("tree").agg((F.max("node") + 1).cast("long").alias("n"))
    large = F.array_sort(F.collect_list(F.when(F.col("n") > most, F.struct("tree", "n"))))
    found = sizes.agg(F.sum(F.when(F.col("n") <= most, F.col("n"))).alias("small"), large.alias("large")).first()
    packs = max(1, -(-(found["small"] or 0) // most))
    pieces, end = [], packs
    for _, n in found["large"]:
        pieces.append(range(end, end - (-n // most)))
        end = pieces[-1].stop
    nodes, pack = model.nodes.select(*_WALKED), F.pmod("tree", F.lit(packs))
    if pieces:
        firsts = [(tree, of.start) for (tree, _), of in zip(found["large"], pieces, strict=True)]
        nodes = nodes.join(F.broadcast(spark.createDataFrame(firsts, "tree int, first int")), "tree", "left")
        pack = F.coalesce(F.expr(f"cast(first + node div {most} as int)"), pack)
    path = scratch_dir(spark, "packs")
    nodes = nodes.select(*_WALKED, pack.alias("pack"))
    nodes.repartition("pack").sortWithinPartitions("pack", "tree", "node").write.partitionBy("pack").parquet(path)
    return qualified(spark, path), packs, pieces


def _pack(folder: str, number: int, kind: type[Walker] | type[Piece] = Walker) -> Walker | Piece | None:
    """The trees of a pack; none if no tree fell to it."""
    system, inner = open_system(f"{folder}/pack={number}")
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return None
    files = sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".parquet"))
    return kind(pa.concat_tables([pq.ParquetFile(system.open_input_file(f)).read(list(_WALKED)) for f in files]))


def _total(folder: str, packs: int, pieces: list[range], d: int):
    size = max(1, ROW_BYTES // (8 * d))

    @F.arrow_udf("double")
    def total(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        only = _pack(folder, 0) if packs == 1 and not pieces else None

        def scored(held: list[pa.Array]) -> Iterator[pa.Array]:
            """Every pack is read once for all the rows that are held; those of a large tree again if its nodes lead back."""
            rows = [_numbers(batch.drop_null(), d) for batch in held]
            sums = [np.zeros(len(x)) for x in rows]
            for number in range(packs):
                walker = only or _pack(folder, number)
                for x, found in zip(rows, sums, strict=True):
                    found += walker.total(x) if walker else 0.0
            for numbers in pieces:
                at = [np.zeros(len(x), np.int64) for x in rows]
                while any((a >= 0).any() for a in at):
                    for number in numbers:
                        piece = _pack(folder, number, Piece)
                        for x, a, found in zip(rows, at, sums, strict=True):
                            piece.walk(x, a, found)
            for batch, found in zip(held, sums, strict=True):
                known = batch.is_valid().to_numpy(zero_copy_only=False)
                out = np.zeros(len(batch))
                out[known] = found
                yield pa.array(out, mask=~known)

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= size or only:
                yield from scored(held)
                held, n = [], 0
        if held:
            yield from scored(held)

    return total


def forest_scores(model: Forest, df: DataFrame) -> DataFrame:
    """Adds ``p``, the probability of class 1: the mean of the leaves that a row comes to.

    The nodes stay in the shared folder, as packs of whole trees of about ``MODEL_BYTES``, or of pieces of a tree that
    is larger; a task holds one of them at a time, for rows of about ``ROW_BYTES``. None comes to the driver.
    Null features give null.
    """
    total = _total(*_packed(model), model.n_features)
    return df.withColumn("p", total(F.col("features").cast("array<double>")) / model.n_trees)


def forest_predict(model: Forest, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return predict_confidence(forest_scores(model, df), threshold)


def model_path(folder: str, tag: str) -> str:
    return f"{folder.rstrip('/')}/random_forest_{tag}"


def save_model(model: Forest, folder: str, tag: str) -> str:
    """The table of nodes, with the model's shape beside it."""
    path = model_path(folder, tag)
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    shape = model.nodes.sparkSession.createDataFrame([(model.n_features, model.n_trees)], "n_features int, n_trees int")
    shape.coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")
    return path


def load_model(spark: SparkSession, folder: str, tag: str) -> Forest:
    path = model_path(folder, tag)
    shape = spark.read.parquet(f"{path}/shape").first()
    return Forest(spark.read.schema(NODES).parquet(f"{path}/nodes"), shape.n_features, shape.n_trees)


def load_latest(registry: DataFrame, folder: str) -> Forest:
    """The model of the newest tag in a registry of encoder and decoder files."""
    from cadentia.operators.tracking import artifact_pairs, latest_tag, parse_artifacts

    found = latest_tag(artifact_pairs(parse_artifacts(registry), keys=()), keys=()).first()
    if found is None or found["tag"] is None:
        raise FileNotFoundError("no complete model under a recognised tag")
    return load_model(registry.sparkSession, folder, found["tag"])

