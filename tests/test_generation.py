import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadentia.functions.hashing import PRIME, uniform
from cadentia.geometry import Geometry
from cadentia.operators import clean, generation, indexing, plug, spectral
from cadentia.plans import fixtures as fx
from cadentia.session import materialise
from cadentia.settings import Curriculum, Injection
from conftest import SF, rows

FULL = fx.FULL_GEOMETRY
PAR = Injection(chunk_size=100)
KEYS = ("split_set", "sample_idx", "obs")


@pytest.fixture(scope="module")
def backgrounds(spark):
    return materialise(fx.backgrounds(spark, SF), "test-backgrounds")


def samples(spark, n=120):
    return spark.range(n).withColumnRenamed("id", "sample_idx")


def batch(spark, backgrounds, n=120, seed=3, engine=None, **kw):
    return generation.generate_batch(samples(spark, n), backgrounds, FULL, seed=seed, par=PAR, engine=engine, **kw)


def cells_of(df):
    return {tuple(r[k] for k in KEYS): np.array(r["cells"]) for r in df.select(*KEYS, "cells").collect()}


def python_uniform(i, draw, seed):
    x1 = (i * 48271 + draw * 69621 + seed * 16807 + 12345) % PRIME
    x2 = (x1 * x1 + draw * 7919 + 1) % PRIME
    x3 = (x2 * 48271 + x1) % PRIME
    return ((x3 * x3 + x3 + draw) % PRIME) / PRIME


def test_uniform_is_reproducible_and_uniform(spark):
    u = spark.range(20000).select(uniform("id", 3, 11).alias("a"), uniform("id", 4, 11).alias("b")).toPandas()
    assert u["a"].tolist()[:50] == [python_uniform(i, 3, 11) for i in range(50)]
    assert u["a"].between(0, 1, inclusive="left").all()
    assert abs(u["a"].mean() - 0.5) < 0.01 and abs(u["a"].std() - 1 / math.sqrt(12)) < 0.01
    assert abs(u["a"].corr(u["b"])) < 0.03 and abs(u["a"].autocorr()) < 0.03


def test_classes_are_balanced_in_every_chunk(spark):
    plan = generation.class_plan(samples(spark, 240), F.lit(240), 100)
    counts = {(r[0], r[1], r[2]): r[3] for r in plan.groupBy("split_set", "chunk", "class").count().collect()}
    for chunk, size in ((0, 100), (1, 100), (2, 40)):
        for kind in generation.CLASSES:
            assert counts["concatenated", chunk, kind] == size // 4
        for name, kinds in (("false", generation.CLASSES[:2]), ("true", generation.CLASSES[2:])):
            for kind in kinds:
                assert counts[name, chunk, kind] == size // 2
            assert not any((name, chunk, k) in counts for k in set(generation.CLASSES) - set(kinds))


def test_unbalanced_chunks_are_refused(spark):
    with pytest.raises(ValueError):
        generation.class_plan(samples(spark), F.lit(120), 30)
    with pytest.raises(PySparkException):
        generation.class_plan(samples(spark, 102), F.lit(102), 100).collect()


def test_same_seed_same_set_whatever_the_partitioning(spark, backgrounds):
    one = cells_of(batch(spark, backgrounds))
    spread = generation.generate_batch(samples(spark).repartition(7), backgrounds.repartition(3), FULL, seed=3, par=PAR)
    two = cells_of(spread)
    assert one.keys() == two.keys() and len(one) == 120 * 3 * 6
    assert all((one[k] == two[k]).all() for k in one)
    other = cells_of(batch(spark, backgrounds, seed=4))
    assert any((one[k] != other[k]).any() for k in one)


def test_everything_is_normalised_and_both_engines_agree(spark, backgrounds):
    expr = batch(spark, backgrounds, engine="expr")
    report = spectral.range_check(expr).collect()
    assert len(report) == 3 and all(r["in_range"] and r["min_value"] == 0 and r["max_value"] == 1 for r in report)
    assert spectral.require_normalised(expr).count() == 120 * 18
    a, b = cells_of(expr), cells_of(batch(spark, backgrounds, engine="arrow"))
    for k in a:
        np.testing.assert_allclose(a[k], b[k], atol=1e-9)


def test_tracks_go_where_the_class_says(spark, backgrounds):
    """Rebuild each kind of sample with numpy from its drawn parameters."""
    base = {
        r["cadence_id"]: np.array(r["obs_cells"]).reshape(FULL.stacked_rows, FULL.width)
        for r in backgrounds.collect()
    }
    order = {r["background_idx"]: r["cadence_id"] for r in generation.index_backgrounds(backgrounds).collect()}
    plan = generation.class_plan(samples(spark), F.lit(120), 100)
    params = generation.draw_params(plan, FULL, seed=3, par=PAR).where("split_set = 'concatenated'").collect()
    got = cells_of(batch(spark, backgrounds))
    rate = FULL.time_resolution_s / FULL.freq_resolution_hz

    def add(block, track, snr):
        sigma = track["width_hz"] / (2 * math.sqrt(2 * math.log(2))) / FULL.freq_resolution_hz
        t, f = np.arange(FULL.stacked_rows)[:, None], np.arange(FULL.width)[None, :]
        centre = track["start_bin"] + track["drift_hz_s"] * rate * t
        level = snr * block.std() / math.sqrt(FULL.stacked_rows)
        return block + level * np.exp(-((f - centre) ** 2) / (2 * sigma**2))

    seen = set()
    for p in params:
        block = base[order[int(len(order) * p["background_u"])]]
        one = add(block, p["track1"], p["snr"]) if p["track1"] else block
        two = add(one, p["track2"], p["snr"]) if p["track2"] else one
        for o in range(6):
            rows_ = slice(o * FULL.time_bins, (o + 1) * FULL.time_bins)
            part = two[rows_] if o % 2 == 0 else (block if p["class"] == "true_single" else one)[rows_]
            logs = np.log(part + 1e-10)
            logs = (logs - logs.min()) / (logs.max() - logs.min())
            np.testing.assert_allclose(got["concatenated", p["sample_idx"], o], logs.ravel(), atol=1e-9)
        seen.add((p["class"], p["track1"] is not None, p["track2"] is not None))
    assert seen == {
        ("false_no_signal", False, False), ("false_with_rfi", True, False),
        ("true_single", True, False), ("true_double", True, True),
    }


def crossing_row(a, b, total):
    x = (b["intercept"] - a["intercept"]) / (a["slope_pixel"] - b["slope_pixel"])
    return total - (a["slope_pixel"] * x + a["intercept"])


@pytest.mark.parametrize("reversed_axis", [False, True])
def test_pairs_never_cross_while_on_target(spark, reversed_axis):
    sql = generation.track_pair_sql("sample_idx", "5", FULL, reversed_axis=reversed_axis)
    drawn = samples(spark, 2000).select("sample_idx", F.expr(sql).alias("p")).collect()
    assert len(drawn) == 2000 and {r["p"]["draw_no"] for r in drawn} > {0, 1}
    for r in drawn:
        row = crossing_row(r["p"]["rfi"], r["p"]["eti"], FULL.stacked_rows)
        row = FULL.stacked_rows - row if reversed_axis else row
        assert not any(lo <= row <= hi for lo, hi in FULL.on_row_ranges())


def test_search_goes_on_beyond_the_first_candidates(spark, monkeypatch):
    sql = lambda: generation.track_pair_sql("sample_idx", "5", FULL)
    wide = rows(samples(spark, 500).select("sample_idx", F.expr(sql()).alias("p")))
    monkeypatch.setattr(generation, "FIRST_CANDIDATES", 1)
    narrow = rows(samples(spark, 500).select("sample_idx", F.expr(sql()).alias("p")))
    assert wide == narrow


def test_track_parameters(spark):
    drawn = samples(spark, 3000).select(F.expr(generation.track_sql("sample_idx", "9", 10, FULL)).alias("t"))
    for r in drawn.collect():
        t = r["t"]
        assert 1 <= t["start_bin"] <= FULL.width - 1 and t["direction"] in (-1, 1)
        span = t["start_bin"] if t["direction"] > 0 else t["start_bin"] - FULL.width
        assert t["slope_pixel"] == pytest.approx(FULL.stacked_rows / span)
        assert t["intercept"] == pytest.approx(FULL.stacked_rows - t["slope_pixel"] * t["start_bin"])
        assert t["drift_hz_s"] * t["slope_pixel"] < 0
        noise = -1 / t["drift_hz_s"] - t["slope_pixel"] * FULL.time_resolution_s / FULL.freq_resolution_hz
        assert 0 <= noise * t["direction"] < 3
        assert 0 <= t["width_hz"] - 18 * abs(t["drift_hz_s"]) < 50


def test_augmenters_and_triples(spark, backgrounds):
    zero = lambda df: df.withColumn("cells", F.transform("cells", lambda x: F.lit(0.0)))
    built = batch(spark, backgrounds, n=40, augmenters={"true_single": zero})
    assert built.count() == 40 * 18
    assert built.where("class = 'true_single'").agg(F.max(F.array_max("cells"))).first()[0] == 0.0
    part = lambda name: built.where(F.col("split_set") == name)
    triples = generation.aligned_triples(part("concatenated"), part("true").where("sample_idx < 30"), part("false"))
    assert triples.count() == 30 * 6
    assert triples.where("main_cells <> target_cells").count() == 0


def test_written_batch_is_partitioned_by_round_and_set(spark, backgrounds, tmp_path):
    staged = generation.with_difficulty(samples(spark, 40).withColumn("round_idx", F.lit(0)), "exponential")
    built = generation.generate_batch(staged, backgrounds, FULL, seed=1, par=PAR)
    generation.write_batch(built, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.schema["cells"].dataType.simpleString() == "array<float>"
    assert {(r[0], r[1], r[2]) for r in back.groupBy("round_idx", "split_set").count().collect()} == {
        (0, s, 240) for s in generation.SPLIT_SETS
    }


def test_splice(spark):
    data = lambda v: spark.createDataFrame([(o, v) for o in range(6)], "obs bigint, v string")
    assert rows(generation.splice_on_off(data("on"), data("off"))) == [
        (o, "on" if o % 2 == 0 else "off") for o in range(6)
    ]


def test_schedules(spark):
    cur = Curriculum()
    rounds = spark.range(20).select(
        *[generation.difficulty(F.col("id"), s, cur).alias(s) for s in ("linear", "exponential", "step")]
    ).collect()
    for s in ("linear", "exponential", "step"):
        assert rounds[0][s] == 40 and rounds[19][s] == 10
        assert all(a[s] >= b[s] for a, b in zip(rounds, rounds[1:]))
    for i, r in enumerate(rounds):
        decay = (math.exp(-3 * i / 19) - math.exp(-3)) / (1 - math.exp(-3))
        assert r["exponential"] == int(10 + 30 * decay) and r["linear"] == int(40 - i / 19 * 30)
    late = spark.range(20, 21).select(generation.difficulty(F.col("id"), "step", cur))
    with pytest.raises(PySparkException):
        late.collect()
    single = spark.range(1).select(generation.difficulty(F.col("id"), "step", Curriculum(total_rounds=1)))
    assert single.first()[0] == 40
    with pytest.raises(ValueError):
        generation.difficulty(F.col("id"), "exponential", Curriculum(decay_rate=0.0))


def test_dense_index_with_small_blocks_and_hot_files(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'a', concat('f', id % 7)) as file", "id * 5 as pos")
    got = indexing.dense_index(df, "pos", major=["file"], block_size=64).collect()
    ordered = sorted(got, key=lambda r: (r["file"], r["pos"]))
    assert [r["idx"] for r in ordered] == list(range(1000))
    restarted = indexing.dense_index(df, "pos", major=["file"], restart=True, block_size=64).collect()
    for name in {r["file"] for r in restarted}:
        own = sorted((r["pos"], r["idx"]) for r in restarted if r["file"] == name)
        assert [i for _, i in own] == list(range(len(own)))


def test_split_is_positional_trimmed_and_disjoint(spark):
    df = spark.range(1000).withColumnRenamed("id", "idx")
    split = indexing.split_trim(df, indexing.row_count(df), train_fraction=0.8, train_batch=300, val_batch=90)
    parts = {p: sorted(r["idx"] for r in split.where(F.col("part") == p).collect()) for p in ("train", "val")}
    assert parts == {"train": list(range(600)), "val": list(range(800, 980))}


def test_shuffle_is_a_permutation_that_depends_on_epoch_and_seed(spark):
    df = spark.range(500)
    orders = {}
    for epoch, seed in ((0, 1), (1, 1), (0, 2)):
        out = indexing.epoch_shuffle(df.repartition(3), "id", epoch, seed, blocks=16)
        orders[epoch, seed] = [r["id"] for r in out.orderBy("shuffle_pos").collect()]
        assert sorted(orders[epoch, seed]) == list(range(500))
        assert sorted(r["shuffle_pos"] for r in out.collect()) == list(range(500))
    assert len({tuple(o) for o in orders.values()}) == 3
    again = indexing.epoch_shuffle(df, "id", 0, 1, blocks=4)
    assert [r["id"] for r in again.orderBy("shuffle_pos").collect()] == orders[0, 1]


def test_step_counts(spark):
    got = spark.range(5000).agg(F.count("*").alias("n")).select(*indexing.step_counts(F.col("n"), 2048, 128)).first()
    assert tuple(got) == (2, 16)


def test_full_width_cadence_survives_both_engines(spark):
    geo = Geometry(n_obs=2, time_bins=4, width=1024, factor=8)
    obs = spark.range(4).selectExpr(
        "id div 2 as cadence_id", "id % 2 as obs", "'f' as source_file", "id div 2 as row_idx",
        "transform(sequence(0, 4095), i -> double((i * 7919 + id * 104729) % 1000 + 1)) as cells",
    )
    a, b = (
        rows(clean.load_backgrounds(obs, geo, engine=e), "cadence_id", "obs_cells") for e in ("expr", "arrow")
    )
    for x, y in zip(a, b):
        np.testing.assert_allclose(x[1], y[1])


def test_a_users_generator_sees_its_chunk_in_order_and_makes_any_number_of_rows(spark):
    planned = spark.createDataFrame(
        [("true", "c", i // 4, i, 0, [[1.0, 2.0], [3.0, 4.0]]) for i in range(10)],
        "split_set string, class string, chunk bigint, sample_idx bigint, background_idx bigint, obs_cells array<array<double>>",
    ).repartition(5)

    def make():
        seen = []

        def generate(sample, obs):
            seen.append(sample["sample_idx"])
            assert seen == sorted(seen) and len({i // 4 for i in seen}) == 1
            for n in range(sample["sample_idx"] % 3):
                yield obs[n] + len(seen)

        return generate

    made = plug.generate_with(planned, make).collect()
    assert sorted((r.chunk, r.sample_idx, r.nth) for r in made) == sorted((i // 4, i, n) for i in range(10) for n in range(i % 3))
    assert {tuple(r.cells) for r in made if r.sample_idx == 5} == {(3.0, 4.0), (5.0, 6.0)}
