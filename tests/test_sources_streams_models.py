import math
import resource
from datetime import datetime

import duckdb
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cadentia.ml import embed, forest
from cadentia.operators import telemetry, tracking
from cadentia.plans import fixtures as fx
from cadentia.plans.queries import QUERIES, linear_model
from cadentia.settings import ForestParams, Plateau
from cadentia.sources import npy, tables
from cadentia.streaming import flush
from cadentia.streaming import plateau as stream_state
from cadentia.streaming import telemetry as streams
from conftest import SF, plan, rows

# --- sources ---------------------------------------------------------------------


@pytest.fixture()
def npy_files(tmp_path):
    data = {}
    for i, dtype in enumerate((np.float32, np.float64)):
        data[f"f{i}.npy"] = np.arange(11 * 2 * 3, dtype=dtype).reshape(11, 2, 3) + i
        np.save(tmp_path / f"f{i}.npy", data[f"f{i}.npy"])
    (tmp_path / "broken.npy").write_bytes(b"not an array")
    paths = [str(tmp_path / n) for n in ("f0.npy", "absent.npy", "broken.npy", "f1.npy")]
    return data, paths


def test_npy_scan_skips_bad_files_and_keeps_positions(spark, npy_files):
    data, paths = npy_files
    df = npy.read_npy(spark, paths, rows_per_split=4)
    assert df.rdd.getNumPartitions() == 6
    for r in df.collect():
        np.testing.assert_array_equal(r["cells"], data[r["source_file"].rsplit("/", 1)[-1]][r["row_idx"]].ravel())
        assert r["shape"] == "[2, 3]"
    assert df.count() == 22


def test_npy_subset_comes_before_the_cap(spark, npy_files):
    _, paths = npy_files
    df = npy.read_npy(spark, paths, subsets={"f0.npy": (3, 9)}, rows_per_file=4, rows_per_split=3)
    df = df.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))
    assert rows(df, "source_file", "row_idx") == [("f0.npy", i) for i in (3, 4, 5, 6)] + [("f1.npy", i) for i in range(4)]


def test_npy_scan_fails_only_if_nothing_is_left(spark, npy_files):
    _, paths = npy_files
    with pytest.raises(PySparkException):
        npy.read_npy(spark, paths[1:3]).collect()


def test_parquet_scan_skips_missing_and_unreadable_files(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad.parquet"
    spark.range(5).write.parquet(good)
    bad.write_bytes(b"nothing")
    assert tables.read_existing(spark, [str(tmp_path / "absent"), good, str(bad)]).count() == 5
    with pytest.raises(FileNotFoundError):
        tables.read_existing(spark, [str(tmp_path / "absent"), str(bad)])


def test_routing_types_rejects_and_nulls(spark, tmp_path):
    queue = fx.queue(spark, SF)
    broken = queue.limit(3).withColumn("value", F.lit(None).cast("double"))
    path = str(tmp_path / "store")
    tables.write_routed(queue.unionByName(broken), path)
    stored = spark.read.parquet(path)
    assert stored.count() == queue.count() + 3
    unknown = queue.where(~F.col("table").isin(*tables.TABLES)).count()
    assert unknown > 0 and stored.where("table = '_rejects'").count() == unknown + 3
    for name in tables.TABLES:
        got = tables.read_table(spark, path, name)
        assert got.columns == tables.columns_of(name)
        want = queue.where(F.col("table") == name)
        known_broken = broken.where(F.col("table") == name).count()
        assert got.count() == want.count() and known_broken >= 0
        assert got.select(F.max("timestamp")).first() == want.select(F.max("timestamp")).first()


def test_stored_size(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(100).write.parquet(str(path))
    on_disk = sum(f.stat().st_size for f in path.rglob("*") if f.is_file() and not f.name.startswith((".", "_")))
    assert telemetry.stored_size(spark, str(path)).first()["size_bytes"] == on_disk


# --- streams: several files, so several micro-batches -----------------------------


@pytest.fixture()
def split_events(spark, tmp_path):
    """The events in four files of consecutive time."""
    folder = tmp_path / "in"
    events = fx.table(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bounds = [0, 250, 500, 750, 1000]
    for lo, hi in zip(bounds, bounds[1:]):
        part = events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1)
        part.write.mode("append").parquet(str(folder))
    return str(folder), events


def one_file_at_a_time(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def arriving(spark, events, tmp_path, order, parts=6):
    """The events in ``parts`` files of consecutive time, put into a folder one after another in ``order``."""
    folder = tmp_path / "arriving"
    folder.mkdir(exist_ok=True)
    cut = np.linspace(0, 1000, parts + 1).astype(int)

    def put(numbers):
        for n in numbers:
            lo, hi = int(cut[n]), int(cut[n + 1])
            part = events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1)
            part.write.mode("append").parquet(str(folder))

    return str(folder), put, order


ORDERS = [(0, 1, 2, 3, 4, 5), (5, 4, 3, 2, 1, 0), (2, 5, 0, 4, 1, 3)]


def series_shape(df):
    return df.selectExpr("ts", "event_type as resource_type", "'n' as resource_name", "value")


def series_of(df, keys=streams.SERIES_KEYS):
    return {tuple(r[k] for k in keys): (round(r["mean_value"], 9), r["max_value"], r["samples"]) for r in df.collect()}


@pytest.mark.parametrize(("order", "delay"), [(ORDERS[0], 0), (ORDERS[1], 0), (ORDERS[2], 0), (ORDERS[2], 86400), (ORDERS[1], 10**9)])
def test_stream_series_equals_batch_in_any_order_and_after_restarts(spark, split_events, tmp_path, order, delay):
    _, events = split_events
    folder, put, order = arriving(spark, events, tmp_path, order)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in (order[:2], order[2:3], order[3:]):  # each run goes on from the checkpoint of the one before
        put(part)
        source = series_shape(one_file_at_a_time(spark, folder, events.schema))
        streams.drain(streams.write_series(source, out, checkpoint, seconds=3600, delay=delay, once=True))
    batch = series_shape(events).groupBy(
        F.unix_timestamp(F.date_trunc("hour", "ts")).alias("window_start"), "resource_type", "resource_name"
    ).agg(F.avg("value").alias("mean_value"), F.max("value").alias("max_value"), F.count("*").alias("samples"))
    assert series_of(streams.metric_series(spark, out, checkpoint, seconds=3600)) == series_of(batch)


def test_stream_series_stores_a_window_once(spark, split_events, tmp_path):
    """What is stored grows with the windows: none is written again by a later batch, and no batch leaves empty files."""
    _, events = split_events
    folder, put, _ = arriving(spark, events, tmp_path, None)
    put(range(6))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    source = series_shape(one_file_at_a_time(spark, folder, events.schema))
    streams.drain(streams.write_series(source, out, checkpoint, seconds=3600, delay=0, once=True))
    closed = spark.read.parquet(f"{out}/closed")
    assert closed.count() == closed.select(*streams.SERIES_KEYS).distinct().count() > 0
    written = {r[0] for r in closed.select("batch_id").distinct().collect()}
    assert {int(p.name.split("=")[1]) for p in (tmp_path / "out" / "closed").iterdir() if "=" in p.name} == written
    assert streams.metric_series(spark, str(tmp_path / "nothing yet"), str(tmp_path / "none")).collect() == []


@pytest.mark.parametrize(("order", "delay"), [(ORDERS[0], 0), (ORDERS[1], 0), (ORDERS[2], 0), (ORDERS[2], 86400), (ORDERS[1], 10**9)])
def test_stream_dedup_equals_batch_in_any_order_and_after_restarts(spark, split_events, tmp_path, order, delay):
    _, events = split_events
    folder, put, order = arriving(spark, events, tmp_path, order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in (order[:2], order[1:4], order[3:]):  # some files come twice
        put(part)
        stream = one_file_at_a_time(spark, folder, events.schema)
        streams.drain(streams.dedup(stream, out, checkpoint, ("ts", "event_id"), delay=delay, once=True))
    assert rows(streams.deduplicated(spark, out, schema), "event_id") == rows(events, "event_id")


def test_stream_dedup_across_batches(spark, split_events, tmp_path):
    folder, events = split_events
    cast = lambda: one_file_at_a_time(spark, folder, events.schema)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    out = str(tmp_path / "out")
    for checkpoint in ("cp", "lost"):
        streams.drain(streams.dedup(cast().unionByName(cast()), out, str(tmp_path / checkpoint), ("ts", "event_id"), once=True))
        assert rows(streams.deduplicated(spark, out, schema), "event_id") == rows(events, "event_id")


def test_stream_dedup_keeps_rows_without_a_time(spark, split_events, tmp_path):
    _, events = split_events
    folder = str(tmp_path / "in2")
    for _ in range(2):
        events.limit(3).withColumn("ts", F.lit(None).cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
    out = str(tmp_path / "out")
    streams.drain(streams.dedup(one_file_at_a_time(spark, folder, events.schema), out, str(tmp_path / "cp"), ("ts", "event_id"), once=True))
    assert spark.read.parquet(out).count() == 3


def test_late_rows_are_looked_up_in_their_own_days_only(spark, tmp_path):
    days = spark.range(20).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as day", "0L as batch_id")
    path = str(tmp_path / "table")
    days.write.partitionBy("day", "batch_id").parquet(path)
    late = days.where("id in (3, 7)").drop("batch_id")
    found = streams.stored_days(spark, path, late, 1)
    text = plan(found)
    assert "PartitionFilters" in text and "2024-01-04" in text and "2024-01-08" in text
    assert rows(found, "id") == [(3,), (7,)]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    found.collect()
    assert scan.metrics().apply("numFiles").value() in (0, 2) and streams.stored_days(spark, path, late, 0).count() == 0


def test_flushes_end_after_so_many_rows_and_go_on_after_a_restart(spark, split_events, tmp_path):
    _, events = split_events
    folder, put, _ = arriving(spark, events, tmp_path, None, parts=4)  # 250 rows a file
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    drain = lambda: flush.drain_flushes(flush.ingest_in_flushes(spark, folder, out, checkpoint, rows=120, seconds=0))
    sizes = lambda: [r["count"] for r in spark.read.parquet(out).groupBy("batch_id").count().orderBy("batch_id").collect()]
    put([0])
    drain()
    assert sizes() == [120, 120, 10]
    put([1, 2])
    drain()  # a new query from the checkpoint: nothing twice, nothing lost, and a flush may span files
    assert sizes() == [120, 120, 10, 120, 120, 120, 120, 20]
    drain()
    put([3])
    drain()
    assert rows(spark.read.parquet(out).select("event_id"), "event_id") == [(i,) for i in range(1000)]
    # a crash before the last commit: the batch runs again with the rows it had
    last = max((p for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    before = sizes()
    drain()
    assert sizes() == before
    assert spark.read.parquet(out).count() == 1000


def test_few_rows_wait_for_more(spark, split_events, tmp_path):
    _, events = split_events
    folder, put, _ = arriving(spark, events, tmp_path, None, parts=10)
    put([0])
    reader = flush.FlushReader({"path": npy.qualified(spark, folder), "checkpoint": npy.qualified(spark, str(tmp_path / "no")), "rows": "150", "seconds": "3600", "schema": events.schema.json()})
    assert reader.initialOffset() == {"row": 0} and reader.latestOffset() == {"row": 0}  # 100 rows wait
    put([1])
    assert reader.latestOffset() == {"row": 150} and reader.latestOffset() == {"row": 150}
    reader.seconds = 0
    assert reader.latestOffset() == {"row": 200}
    parts = reader.partitions({"row": 90}, {"row": 150})
    assert [(p.lo, p.hi) for p in parts] == [(90, 100), (0, 50)]
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 60


def test_stream_route_is_idempotent_per_batch(spark, split_events, tmp_path):
    folder, events = split_events
    queue = one_file_at_a_time(spark, folder, events.schema).selectExpr(*fx.QUEUE_COLUMNS)
    out = str(tmp_path / "out")
    streams.drain(streams.route(queue, out, str(tmp_path / "cp1"), once=True))
    first = rows(spark.read.parquet(out), "table", "timestamp", "value")
    assert len(first) == 1000
    # a lost checkpoint replays the same batches over the same partitions
    streams.drain(streams.route(queue, out, str(tmp_path / "cp2"), once=True))
    assert len(rows(spark.read.parquet(out), "table", "timestamp", "value")) == 1000


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("gaps", [False, True])
def test_stream_plateau_equals_the_batch_run_in_any_order_and_after_restarts(spark, split_events, tmp_path, order, gaps):
    _, events = split_events
    folder, put, order = arriving(spark, events, tmp_path, order)
    par = Plateau(min_lr=4e-4)
    # files hold parts of every round; with gaps, most epochs wait for others that never come
    epoch = "event_id" if gaps else "event_id div 7"
    losses = lambda df: df.selectExpr("'run' as tag", "event_id % 7 as round", f"{epoch} as epoch", "value as val_loss")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    key = lambda df: {(r["round"], r["epoch"]): (r["misses"], round(r["lr"], 12)) for r in df.collect()}
    arrived = []
    for part in (order[:2], order[2:3], order[3:]):
        put(part)
        arrived += part
        stream = losses(one_file_at_a_time(spark, folder, events.schema))
        streams.drain(stream_state.write_plateau(stream, out, checkpoint, par, once=True))
    assert key(stream_state.stream_plateau(spark, out, par)) == key(tracking.plateau(losses(events), par))


def test_stream_plateau_settles_each_epoch_once(spark, split_events, tmp_path):
    _, events = split_events
    folder, put, _ = arriving(spark, events, tmp_path, None)
    put((0, 1, 2, 3, 4, 5))
    losses = one_file_at_a_time(spark, folder, events.schema).selectExpr("'run' as tag", "0L as round", "event_id as epoch", "value as val_loss")
    out = str(tmp_path / "out")
    streams.drain(stream_state.write_plateau(losses, out, str(tmp_path / "cp"), once=True))
    trace = spark.read.parquet(out)
    assert trace.where("settled").count() == 1000 == trace.where("settled").select("epoch").distinct().count()


def test_stream_plateau_rejects_an_epoch_that_comes_again(spark, split_events, tmp_path):
    folder, events = split_events
    twice = one_file_at_a_time(spark, folder, events.schema).selectExpr("'run' as tag", "0L as round", "event_id % 300 as epoch", "value as val_loss")
    with pytest.raises(Exception, match="two losses"):
        streams.drain(stream_state.write_plateau(twice, str(tmp_path / "out"), str(tmp_path / "cp"), once=True))


def test_plateau_follows_a_long_round_across_batches(spark):
    """A round that fills many Arrow batches and shares its task with short ones is one fold."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        df = spark.range(900).selectExpr("'t' as tag", "if(id < 700, 1L, id) as round", "if(id < 700, 699 - id, 0L) as epoch", "cast(pmod(id * 37, 101) as double) as val_loss")
        got = {(r["round"], r["epoch"]): (r["misses"], r["lr"]) for r in tracking.plateau(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    fold = tracking.PlateauFold(Plateau())
    assert [got[1, e] for e in range(700)] == [fold.step(float((699 - e) * 37 % 101)) for e in range(700)]
    assert all(got[r, 0] == (0, 0.001) for r in range(700, 900))


# --- models -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(400):
        label = i % 2
        data.append((i, [float(x) for x in rng.normal(label * 1.5, 1.0, 6)], float(label)))
    return spark.createDataFrame(data, "id bigint, features array<double>, label double")


def auc(scored):
    pos, neg = scored[scored.label == 1]["p"].to_numpy(), scored[scored.label == 0]["p"].to_numpy()
    return ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()


def test_forest_separates_and_survives_storage(spark, separable, tmp_path):
    model = forest.fit_forest(separable, ForestParams(n_trees=20, max_depth=5))
    scored = forest.forest_predict(model, separable).toPandas()
    assert auc(scored) > 0.9
    assert (scored["confidence"] >= 0.5).all()
    stats = forest.importance_stats(forest.importances(spark, model)).first()
    assert stats["mean_importance"] == pytest.approx(1 / 6)
    for tag in ("final_v1", "final_v2"):
        forest.save_model(model, str(tmp_path), tag)
    names = ["vae_encoder_final_v1.keras", "vae_decoder_final_v1.keras", "vae_encoder_final_v2.keras"]
    registry = spark.createDataFrame([(n,) for n in names], "path string")
    loaded = forest.load_latest(registry, str(tmp_path))
    again = forest.forest_scores(loaded, separable).toPandas()
    assert again.set_index("id")["p"].to_dict() == scored.set_index("id")["p"].to_dict()
    with pytest.raises(FileNotFoundError):
        forest.load_latest(registry.limit(0), str(tmp_path))


def test_scores_are_those_of_a_recursive_walk_in_sql(spark, separable, tmp_path):
    """The stored table of nodes, walked by another engine."""
    model = forest.fit_forest(separable, ForestParams(n_trees=30))
    path = forest.save_model(model, str(tmp_path), "final_v1")
    separable.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW nodes AS SELECT * FROM '{path}/nodes/*.parquet'")
    con.execute(f"CREATE VIEW vectors AS SELECT * FROM '{tmp_path}/rows/*.parquet'")
    want = con.execute("""
        WITH RECURSIVE walk AS (
          SELECT id, features, tree, 0 AS node FROM vectors, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT id, features, walk.tree, CASE WHEN features[feature + 1] <= threshold THEN "left" ELSE "right" END
          FROM walk JOIN nodes USING (tree, node) WHERE feature >= 0)
        SELECT id, avg(p) FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY id""").fetchall()
    got = {r["id"]: r["p"] for r in forest.forest_scores(model, separable).collect()}
    assert len(want) == 400 and all(got[i] == pytest.approx(p, abs=1e-12) for i, p in want)


def test_a_large_forest_is_scored_in_passes(spark, separable, monkeypatch):
    model = forest.fit_forest(separable, ForestParams(n_trees=10, max_depth=3))
    whole = rows(forest.forest_scores(model, separable), "id", "p")
    monkeypatch.setattr(forest, "MODEL_BYTES", 3 * 15 * forest.NODE_BYTES)
    monkeypatch.setattr(forest, "WALKED", 7)
    in_passes = rows(forest.forest_scores(model, separable), "id", "p")
    assert [i for i, _ in whole] == [i for i, _ in in_passes]
    assert all(a == pytest.approx(b, abs=1e-12) for (_, a), (_, b) in zip(whole, in_passes, strict=True))


def test_forest_is_as_good_as_the_library_on_rows_not_seen(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 8))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] > 0) ^ (rng.random(1500) < 0.05)).astype(float)
    df = spark.createDataFrame([(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))], "id bigint, features array<double>, label double")
    train, held = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    ours = auc(forest.forest_scores(forest.fit_forest(train, ForestParams(n_trees=60)), held).toPandas())
    vectors = lambda d: d.withColumn("v", array_to_vector("features"))
    theirs = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=60, maxDepth=12, seed=1).fit(vectors(train))
    p = vector_to_array("probability")[1].alias("p")
    assert ours > auc(theirs.transform(vectors(held)).select("label", p).toPandas()) - 0.01


def test_trees_are_pure_weighted_and_the_same_again(spark, separable, monkeypatch):
    par = ForestParams(n_trees=12)
    key = lambda m: sorted(map(tuple, m.nodes.collect()))
    first = forest.fit_forest(separable, par)
    assert key(first) == key(forest.fit_forest(separable.repartition(7), par))
    leaves = first.nodes.where("feature < 0")
    assert leaves.where("p not in (0, 1)").count() == 0  # grown until they are pure
    inner = first.nodes.alias("n").join(first.nodes.alias("c"), F.expr("n.tree = c.tree and c.node in (n.left, n.right)"))
    sums = inner.groupBy("n.tree", "n.node").agg(F.sum("c.weight").alias("below"), F.first("n.weight").alias("own"))
    assert sums.where("abs(below - own) > 1e-9").count() == 0
    monkeypatch.setattr(forest, "SHARD_BYTES", 400 * 6 * 8 // 4)  # four shards: trees differ in the rows they saw
    sharded = forest.fit_forest(separable, par)
    roots = sharded.nodes.where("node = 0")
    assert roots.count() == 12 and roots.agg(F.max("weight")).first()[0] < 400 / 2
    assert auc(forest.forest_scores(sharded, separable).toPandas()) > 0.9


def test_forest_faults(spark, separable):
    with pytest.raises(ValueError, match="rows"):
        forest.fit_forest(separable.limit(0))
    bad = separable.withColumn("features", F.transform("features", lambda x: F.lit(math.nan)))
    with pytest.raises(PySparkException):
        forest.fit_forest(bad, ForestParams(n_trees=2)).nodes.count()
    model = forest.fit_forest(separable, ForestParams(n_trees=2))
    none = separable.withColumn("features", F.when(F.col("id") > 5, F.col("features")))
    assert forest.forest_scores(model, none).where("p is null").count() == 6


def test_embedding_is_deterministic(spark):
    obs = fx.observations(spark, SF).where("cadence_id in (0, 1, 2, 4, 6, 8)")
    model = embed.fit_embedding(obs, k=4)
    one, two = (rows(embed.embed(model, obs.repartition(n)), "cadence_id", "obs", "z") for n in (1, 4))
    assert one == two and all(len(r[2]) == 4 for r in one)


@pytest.mark.parametrize(("cells", "n", "k"), [(64, 500, 8), (5, 40, 5), (300, 60, 4)])
def test_embedding_spans_the_exact_subspace(spark, cells, n, k):
    rng = np.random.default_rng(cells)
    x = rng.normal(size=(n, cells)) * np.linspace(2, 1, cells) + 3
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "cells array<double>").repartition(5)
    model = embed.fit_embedding(df, k)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    exact = vectors[:, ::-1][:, :k]
    assert np.abs(model.components.T @ model.components - np.eye(k)).max() < 1e-9
    assert np.linalg.norm(exact @ exact.T - model.components @ model.components.T) < 1e-3
    assert np.allclose(model.variances, values[::-1][:k], rtol=1e-6) and np.allclose(model.mean, x.mean(axis=0))


def test_embedding_of_wide_rows_holds_no_square_matrix(spark):
    """8192 cells: the square matrix alone would be 512 MB here."""
    wide = spark.range(64).select(F.transform(F.sequence(F.lit(1), F.lit(8192)), lambda i: F.sin(i * (F.col("id") % 5 + 1)) + F.rand(3) * 0.01).alias("cells"))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    model = embed.fit_embedding(wide, 4)
    assert model.components.shape == (8192, 4) and model.variances[3] > 100 * model.variances[0] / 8192
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000  # kB


def test_embedding_of_null_cells_and_of_no_rows(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 1), (None, 2), ([2.0, 1.0, 0.0], 3), ([0.0, 0.0, 1.0], 4)], "cells array<float>, z_id int")
    model = embed.fit_embedding(df, 2)
    found = {r.z_id: r.z for r in embed.embed(model, df).collect()}
    assert found[2] is None and np.allclose(found[1], np.array([1.0, 2.0, 3.0]) @ model.components)
    with pytest.raises(ValueError, match="rows"):
        embed.fit_embedding(df.where("z_id = 2"), 1)


def test_batch_size_does_not_change_scores(spark):
    df = fx.table(spark, SF, "embeddings").select("vec_id", F.col("embedding").alias("cells"))
    one, two = (rows(embed.batch_score(df, linear_model, 64, batch_size=b), "vec_id", "p") for b in (7, 4048))
    assert all(a[0] == b[0] and math.isclose(a[1], b[1]) for a, b in zip(one, two)) and len(one) == 500


# --- reports and stores -----------------------------------------------------------


def test_a_second_report_never_outlives_its_first(spark, tmp_path):
    path = str(tmp_path / "report.csv")
    columns = [f.split()[0] for f in tables.REPORT_SCHEMA.split(", ")] if isinstance(tables.REPORT_SCHEMA, str) else tables.REPORT_SCHEMA.names
    found = QUERIES["detections"](spark, SF).select(columns)
    sure = found.withColumn("confidence", F.lit(0.99))
    tables.write_detections(sure, path)
    assert tables.read_high_confidence(spark, path).count() == found.count() > 0
    tables.write_detections(found.withColumn("confidence", F.lit(0.5)), path)
    assert tables.read_high_confidence(spark, path).count() == 0
    assert not (tmp_path / "report_high_confidence.csv").exists()


def test_a_range_of_a_clustered_store_reads_its_days_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows_ = spark.range(30 * 24).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as ts", "cast(id as double) as value")
    tables.write_clustered(rows_, path)
    lo, hi = datetime(2024, 1, 9, 22), datetime(2024, 1, 10, 3)
    got = tables.read_clustered(spark, path, lo, hi)
    assert rows(got, "id") == [(i,) for i in range(8 * 24 + 22, 9 * 24 + 4)]
    text = plan(got)
    assert "PartitionFilters" in text and "2024-01-09" in text and "PushedFilters: [" in text
    got.collect()
    files = [v.value() for scan in [got._jdf.queryExecution().executedPlan()] for v in [_metric(scan, "numFiles")] if v is not None]
    assert files and files[0] <= 2
    assert tables.read_clustered(spark, path).count() == 720 and tables.read_clustered(spark, path, lo).count() == 720 - 8 * 24 - 22


def _metric(node, name):
    """The first metric of that name in a plan that has run."""
    for part in [node, *[node.children().apply(i) for i in range(node.children().size())]]:
        if part.metrics().contains(name):
            return part.metrics().apply(name)
        if part is not node and (found := _metric(part, name)) is not None:
            return found
    return _metric(node.executedPlan(), name) if "AdaptiveSparkPlan" in node.nodeName() else None
