"""Queries on tables whose sizes divide by nothing, against their SQL or what they returned on other sizes."""

import os
import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadentia.llm import near_dup, neighbours
from cadentia.ml import forest
from cadentia.operators import generation
from cadentia.plans.oracles import ORACLES
from cadentia.plans.queries import QUERIES
from cadentia.session import materialise
from cadentia.settings import ForestParams
from cadentia.sources import npy
from cadentia.streaming import flush
from llm.test_near_dup import _got, brute
from llm.test_neighbours_mixing import _block
from test_oracles import _sorted


def embeddings(folder, n: int) -> str:
    cells = np.random.default_rng(5).normal(size=(n, 64)).astype(np.float32)
    columns = {"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(list(cells)), "label": pa.array(np.arange(n) % 10)}
    pq.write_table(pa.table(columns), f"{folder}/embeddings.parquet")
    return str(folder)


def same_as_sql(spark, folder: str, key: str, table: str) -> int:
    df, con = QUERIES[key](spark, folder), duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(ORACLES[key])
    columns = [d[0] for d in cursor.description]
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    assert got == _sorted(columns, cursor.fetchall())
    return len(got)


@pytest.mark.parametrize("key", ["class_mix", "class_plan", "generate_plugged", "generate_batch"])
def test_a_last_chunk_of_any_size_is_planned(spark, tmp_path, key):
    assert same_as_sql(spark, embeddings(tmp_path, 1086), key, "embeddings") >= 16


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 1001])
def test_rows_left_over_go_to_the_last_class(spark, n):
    samples = spark.range(n).withColumnRenamed("id", "sample_idx")
    plan = generation.class_plan(samples, F.lit(n), 1000, remainder="last").where("chunk = 0 or sample_idx = 1000")
    kinds = {(r["split_set"], r["sample_idx"]): r["class"] for r in plan.collect()}
    assert len(kinds) == 3 * n
    size = n - n // 1000 * 1000 or 1000
    for i in range(n // 1000 * 1000, n):
        assert kinds["concatenated", i] == generation.CLASSES[min(3, i % 1000 // (size // 4)) if size >= 4 else 3]
        half = min(1, i % 1000 // (size // 2)) if size >= 2 else 1
        assert (kinds["false", i], kinds["true", i]) == (generation.CLASSES[half], generation.CLASSES[half + 2])


def _vectors(spark, n=3000, d=8):
    """Labels as good as random, so that trees grow deep."""
    cells = F.transform(F.sequence(F.lit(1), F.lit(d)), lambda k: F.pmod(F.xxhash64("id", k), F.lit(1000)).cast("double"))
    return spark.range(n).select("id", cells.alias("features"), F.pmod(F.xxhash64("id", F.lit(0)), F.lit(2)).cast("double").alias("label"))


def test_a_forest_is_scored_without_its_nodes_in_the_driver(spark, monkeypatch):
    rows = materialise(_vectors(spark), "vectors")
    model = forest.fit_forest(rows, ForestParams(n_trees=12))
    whole = {r["id"]: r["p"] for r in forest.forest_scores(model, rows).collect()}
    monkeypatch.setattr(forest, "MODEL_BYTES", 2000 * forest.NODE_BYTES)
    monkeypatch.setattr(forest, "ROW_BYTES", 700 * 8 * 8)  # rows meet the packs in several lots
    monkeypatch.setattr(DataFrame, "toArrow", None)
    monkeypatch.setattr(spark.sparkContext, "broadcast", None)
    got = {r["id"]: r["p"] for r in forest.forest_scores(model, rows.coalesce(1)).collect()}
    assert got.keys() == whole.keys() and len(got) == 3000
    assert all(got[i] == pytest.approx(p, abs=1e-12) for i, p in whole.items())


def _paths(model):
    """A tree's nodes by the way that leads to them, as their numbers may differ."""
    nodes = {(r["tree"], r["node"]): r for r in model.nodes.collect()}
    out, waiting = {}, [((tree, node), "") for tree, node in nodes if node == 0]
    while waiting:
        (tree, node), way = waiting.pop()
        r = nodes.pop((tree, node))
        out[tree, way] = (r["feature"], r["threshold"], r["p"], r["weight"], r["gain"])
        if r["feature"] >= 0:
            assert r["left"] > node and r["right"] > node
            waiting += [((tree, r["left"]), way + "l"), ((tree, r["right"]), way + "r")]
    assert not nodes  # all are reached
    return out


@pytest.fixture(scope="module")
def large(spark):
    """More rows than a task holds, and a forest on them whose trees are alike."""
    rows = materialise(_vectors(spark, 140_000, 64), "vectors")
    return rows, forest.fit_forest(rows, ForestParams(n_trees=2, max_depth=2, bootstrap=False, feature_subset="all"))


def test_every_tree_of_a_table_larger_than_a_task_holds_learns_from_all_rows(large):
    rows, model = large
    nodes = model.nodes
    assert [(r["tree"], r["weight"]) for r in nodes.where("node = 0").orderBy("tree").collect()] == [(0, 140_000.0), (1, 140_000.0)]
    x = np.array([r["features"] for r in rows.select("features").collect()])
    thresholds = forest._binned(x, forest.BINS)[1]
    assert all(r["threshold"] in thresholds[r["feature"]] for r in nodes.where("feature >= 0").collect())


@pytest.mark.parametrize("par", [ForestParams(n_trees=5, feature_subset="all"), ForestParams(n_trees=3, bootstrap=False, feature_subset="all", max_depth=6)])
def test_trees_grown_from_files_are_those_grown_in_memory(spark, monkeypatch, par):
    some = _vectors(spark).withColumn("features", F.transform("features", lambda v, i: F.when(i == 2, v % 2).when(i == 3, 0.0).otherwise(v - 500)))
    rows = materialise(some.unionByName(some.where("id % 3 = 0")).unionByName(some.where("id % 9 = 0")), "vectors")  # equal rows
    whole = _paths(forest.fit_forest(rows, par))
    monkeypatch.setattr(forest, "HELD_BYTES", 150 * 8 * 8)
    monkeypatch.setattr(forest, "CHUNK_BYTES", 190 * 24)
    monkeypatch.setattr(forest, "INTERVALS", 700)
    monkeypatch.setattr(forest, "DRAWS", 100)
    assert _paths(forest.fit_forest(rows.repartition(5), par)) == whole


def test_trees_grown_from_files_of_some_features_are_whole_and_the_same_again(spark, monkeypatch):
    rows, par = materialise(_vectors(spark), "vectors"), ForestParams(n_trees=4)
    whole = _paths(forest.fit_forest(rows, par))
    monkeypatch.setattr(forest, "HELD_BYTES", 150 * 8 * 8)
    grown = _paths(forest.fit_forest(rows, par))
    assert grown == _paths(forest.fit_forest(rows.repartition(7), par))
    assert all(grown[tree, ""][2:4] == whole[tree, ""][2:4] for tree in range(4))  # the same draws of all rows
    for (tree, way), (feature, _, p, weight, _) in grown.items():
        if feature >= 0:
            assert weight == grown[tree, way + "l"][3] + grown[tree, way + "r"][3]
        else:
            assert p in (0, 1)  # grown until they are pure


def test_thresholds_of_a_table_are_those_of_its_rows_in_one_place(spark, monkeypatch):
    rng = np.random.default_rng(5)
    columns = [rng.normal(size=2000), rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000), np.where(rng.random(2000) < 0.6, 0.0, rng.random(2000)),
               rng.integers(0, 128, 2000) - 64.0, rng.integers(0, 129, 2000) * -1.0, np.zeros(2000), 1 + rng.random(2000) * 1e-12, -np.exp(rng.normal(size=2000))]
    x = np.stack(columns, axis=1)
    rows = spark.createDataFrame([([float(v) for v in r],) for r in x], "features array<double>").repartition(6)
    want = forest._binned(x, forest.BINS)[1]
    for intervals in (1, 1 << 17):
        monkeypatch.setattr(forest, "INTERVALS", intervals)
        got = forest._table_cuts(rows, 8, forest.BINS)
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_a_tree_larger_than_a_pack_is_walked_in_pieces(spark, monkeypatch):
    rows = materialise(_vectors(spark), "vectors")
    model = forest.fit_forest(rows, ForestParams(n_trees=5))
    small = forest.fit_forest(rows, ForestParams(n_trees=2, max_depth=3)).nodes.withColumn("tree", F.col("tree") + 5)
    model = forest.Forest(materialise(model.nodes.unionByName(small), "forest"), 8, 7)
    whole = {r["id"]: r["p"] for r in forest.forest_scores(model, rows).collect()}
    monkeypatch.setattr(forest, "MODEL_BYTES", 300 * forest.NODE_BYTES)
    monkeypatch.setattr(forest, "ROW_BYTES", 700 * 8 * 8)
    folder, packs, pieces = forest._packed(model)
    assert packs == 1 and len(pieces) == 5 and all(len(p) > 1 for p in pieces)
    got = {r["id"]: r["p"] for r in forest.forest_scores(model, rows.coalesce(1)).collect()}
    assert got.keys() == whole.keys() and len(got) == 3000
    assert all(got[i] == pytest.approx(p, abs=1e-12) for i, p in whole.items())


def test_scores_of_a_large_table_are_the_shares_of_all_its_rows(large):
    rows, model = large
    leaves = forest.forest_scores(model, rows).groupBy(F.round("p", 12)).agg(F.first("p").alias("p"), F.avg("label").alias("share")).collect()
    assert len(leaves) == 4 and all(r["p"] == pytest.approx(r["share"], abs=1e-12) for r in leaves)


def test_a_forest_on_all_rows_of_a_large_table_survives_storage(spark, large, tmp_path):
    rows, model = large
    forest.save_model(model, str(tmp_path), "final_v1")
    again = forest.load_model(spark, str(tmp_path), "final_v1")
    assert _paths(again) == _paths(model) and (again.n_features, again.n_trees) == (64, 2)
    both = forest.forest_scores(again, forest.forest_scores(model, rows).withColumnRenamed("p", "before"))
    leaves = both.groupBy(F.round("p", 12)).agg(F.first("p").alias("p"), F.avg("label").alias("share"), F.max(F.abs(F.expr("p - before"))).alias("off")).collect()
    assert len(leaves) == 4 and all(r["p"] == pytest.approx(r["share"], abs=1e-12) and r["off"] == 0 for r in leaves)


def test_histograms_are_cut_without_a_change_of_the_trees(monkeypatch):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(4000, 8)), (rng.random(4000) < 0.5).astype(float)
    bins, cuts = forest._binned(x, forest.BINS)
    grown = lambda: forest.grow(bins, cuts, y, np.ones(4000), 3, ForestParams())
    monkeypatch.setattr(forest, "CELLS", 1 << 22)
    whole = grown()
    for cells in (1 << 19, 1 << 12):
        monkeypatch.setattr(forest, "CELLS", cells)
        cut = grown()
        assert all((whole[c] == cut[c]).all() for c in whole)


def test_growing_a_shard_takes_little_more_than_its_features():
    """A shard's task holds its features once, then their bins and the nodes of one tree."""
    d, rows = 64, 20_000
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(rows, d)), (rng.random(rows) < 0.5).astype(float)
    bins, cuts = forest._binned(x, forest.BINS)
    tracemalloc.start()
    forest.grow(bins, cuts, y, np.ones(rows), 1, ForestParams())
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 100 << 20


def test_flushes_of_files_that_tasks_wrote_side_by_side(spark, tmp_path, monkeypatch):
    """No task sorts all events, and files count in the order of their names, whatever ended first."""
    n = 5003
    ids = np.random.default_rng(1).permutation(n)
    events = {"event_id": pa.array(ids, pa.int64()), "value": pa.array(ids / 7)}
    pq.write_table(pa.table(events), f"{tmp_path}/events.parquet", row_group_size=500)
    seen = []
    start = flush.ingest_in_flushes
    monkeypatch.setattr(flush, "ingest_in_flushes", lambda spark, folder, *a, **k: seen.append(folder) or start(spark, folder, *a, **k))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert same_as_sql(spark, str(tmp_path), "stream_ingest_flush", "events") == 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spark.read.parquet(seen[0]).inputFiles()) == 4


def test_the_order_of_files_is_that_of_arrival_or_of_names(spark, tmp_path):
    for nth, name in enumerate(("c", "a", "b")):
        pq.write_table(pa.table({"x": pa.array(range(10 * nth, 10 * nth + 10))}), f"{tmp_path}/{name}.parquet", row_group_size=4)
        os.utime(f"{tmp_path}/{name}.parquet", (nth + 1, nth + 1))
    schema = spark.read.parquet(str(tmp_path)).schema.json()
    common = {"path": npy.qualified(spark, str(tmp_path)), "checkpoint": npy.qualified(spark, f"{tmp_path}/no"), "rows": "30", "seconds": "0", "schema": schema}
    for order, first in (({}, (0, 10, 20)), ({"order": "name"}, (10, 20, 0))):
        reader = flush.FlushReader(common | order)
        assert reader.latestOffset() == {"row": 30}
        parts = reader.partitions({"row": 3}, {"row": 27})
        got = [x for p in parts for b in reader.read(p) for x in b.column(0).to_pylist()]
        assert got == [f + i for f in first for i in range(10)][3:27]
    with pytest.raises(ValueError, match="order"):
        flush.ingest_in_flushes(spark, str(tmp_path), "out", "checkpoint", order="size")


def test_wide_windows_are_counted_by_what_lies_outside(monkeypatch):
    """The same neighbours and collisions, with fewer entries walked than the windows cover."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 48))
    block, asked = _block(vectors), np.arange(0, 3000, 100)
    walked, plain = [], np.bincount
    monkeypatch.setattr(neighbours.np, "bincount", lambda x, **k: walked.append(len(x)) or plain(x, **k))
    found = block.search(vectors[asked], asked, 20)
    assert sum(walked) < 0.75 * block.counted
    hits = 0
    for q, (ids, scores) in zip(asked, found, strict=True):
        exact = (vectors * vectors[q]).sum(axis=1)
        assert (scores == exact[ids]).all() and q not in ids
        exact[q] = -np.inf
        hits += len(set(ids) & set(np.argsort(-exact)[:20]))
    assert hits >= 0.9 * 20 * len(asked)
    collisions, low, high = np.zeros(3000, np.uint8), np.full(96, 200), np.full(96, 2900)
    block._count(collisions, low, np.full(96, 1000), np.full(96, 1000), high)
    assert (collisions == plain(block.places[:, 200:2900].ravel(), minlength=3000)).all()


@pytest.mark.filterwarnings("ignore")
def test_vast_vectors_are_verified_too():
    vectors = np.random.default_rng(3).normal(size=(60, 4)) * 1e150
    block = _block(vectors)
    near = block._verified(np.full(60, 96, np.uint8), vectors[0] * 1e10, -1, block.longest * 2, 5)
    assert len(near[0]) >= 5


def test_a_group_of_near_copies_makes_few_links_and_no_row_for_each_pair(spark, monkeypatch):
    """Texts around the threshold, in several blocks: the components are those of all exact links."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    r = random.Random(5)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(160):
        text = list(words)
        for _ in range(r.randint(3, 9)):
            text[r.randrange(300)] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    confirmed = []
    plain = near_dup._confirmed
    monkeypatch.setattr(near_dup, "_confirmed", lambda pairs, *a: confirmed.append(pairs.count()) or plain(pairs, *a))
    links = []
    residual = near_dup._residual_links
    monkeypatch.setattr(near_dup, "_residual_links", lambda *a: links.append(residual(*a)) or links[-1])
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _got(found) == brute(rows)
    assert len(confirmed) == 1 and links  # pairs of the stars only
