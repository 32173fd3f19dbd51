import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadentia.operators import features, profile, telemetry, tracking
from cadentia.settings import LossWeights, Plateau
from conftest import plan, rows

RNG = np.random.default_rng(5)
Z = RNG.normal(size=(7, 6, 3))


def latents(spark, z=Z):
    data = [(c, o, [float(x) for x in z[c, o]]) for c in range(len(z)) for o in range(6)]
    return spark.createDataFrame(data, "cadence_id bigint, obs bigint, z array<double>").repartition(3)


def test_features_are_in_observation_order_and_partial_cadences_drop_out(spark):
    partial = latents(spark).where("not (cadence_id = 2 and obs = 4)")
    got = {r["cadence_id"]: r["features"] for r in features.cadence_features(partial, 6).collect()}
    assert sorted(got) == [0, 1, 3, 4, 5, 6]
    for c, values in got.items():
        np.testing.assert_allclose(values, Z[c].ravel())
    assert features.require_complete(latents(spark), 6).first()[0] == 7
    with pytest.raises(PySparkException):
        features.require_complete(partial, 6).collect()


def pair_mean(measure, a, b):
    return np.mean([measure(((Z[c, a] - Z[c, b]) ** 2).sum()) for c in range(len(Z))])


def test_separations_match_the_pairwise_definition(spark):
    near, far = (lambda d: d), (lambda d: 1 / (d + 1e-8))
    on, off = (0, 2, 4), (1, 3, 5)
    same = sum(pair_mean(near, a, b) for kind in (on, off) for a in kind for b in kind if a != b)
    whole = features.cadence_latents(latents(spark), 6)
    got = whole.agg(features.separation_true(6).alias("t"), features.separation_false(6).alias("f"))
    t, f = got.first()
    assert t == pytest.approx(same + sum(pair_mean(far, a, b) for a in on for b in off))
    assert f == pytest.approx(same + sum(pair_mean(near, a, b) for a in on for b in off))


def test_pairs_are_listed_without_a_join(spark):
    pairs = features.latent_pairs(latents(spark), 6)
    assert "Join" not in plan(pairs)
    got = rows(pairs, "cadence_id", "obs_a", "obs_b", "kind", "weight")
    assert len(got) == 7 * 15 and sum(r[4] for r in got) == 7 * (9 + 6 * 2)


def test_composite_loss_weights(spark):
    one = lambda name, v: spark.createDataFrame([(v,)], f"{name} double")
    total = features.composite_loss(
        one("reconstruction", 2.0), one("kl", 3.0), one("true_loss", 5.0), one("false_loss", 7.0), LossWeights()
    )
    assert total.first()["total"] == pytest.approx(2 + 1.5 * 3 + 10 * 12)


def test_cross_entropy_is_clipped(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], [0.0, 0.0])], "cadence_id bigint, target array<double>, predicted array<double>")
    got = features.reconstruction_bce(df, 2).first()[0]
    assert got == pytest.approx((-math.log(1e-7) - math.log(1 - 1e-7)) / 2)


def test_metrics(spark):
    data = [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)]
    got = features.eval_metrics(spark.createDataFrame(data, "label int, prediction int")).first()
    assert tuple(got) == pytest.approx((0.5, 1 / 3, 0.6))


def python_plateau(losses, par):
    best, misses, lr, out = math.inf, 0, par.base_lr, []
    for loss in losses:
        if lr > par.min_lr:
            if loss < best * (1 - par.min_improvement):
                best, misses = loss, 0
            else:
                misses += 1
            if misses >= par.patience:
                lr, misses = max(lr * (1 - par.reduction), par.min_lr), 0
        out.append((misses, lr))
    return out


def test_plateau_matches_a_sequential_run(spark):
    par = Plateau(min_lr=5e-4)
    series = {r: [float(x) for x in RNG.uniform(1, 2, size=40)] for r in range(4)}
    series[4] = [3.0, 2.0, 2.0, 2.0, 2.0, 1.0]
    data = [("t", r, e, v) for r, vs in series.items() for e, v in enumerate(vs)]
    df = spark.createDataFrame(data, "tag string, round bigint, epoch bigint, val_loss double").repartition(5)
    got = {(r["round"], r["epoch"]): (r["misses"], r["lr"]) for r in tracking.plateau(df, par).collect()}
    for r, vs in series.items():
        for e, (misses, lr) in enumerate(python_plateau(vs, par)):
            assert got[r, e][0] == misses and got[r, e][1] == pytest.approx(lr)
    assert min(lr for _, lr in got.values()) == pytest.approx(5e-4)


def test_plateau_rejects_a_round_that_is_not_one(spark):
    schema = "tag string, round bigint, epoch bigint, val_loss double"
    for data in ([("t", 0, -1, 1.0)], [("t", 0, 1, 1.0), ("t", 0, 1, 2.0)]):
        with pytest.raises(PySparkException):
            tracking.plateau(spark.createDataFrame(data, schema)).collect()


def test_two_level_mean(spark):
    data = [(0, 0, 1.0), (0, 0, 1.0), (0, 0, 1.0), (0, 1, 3.0)]
    got = tracking.epoch_losses(spark.createDataFrame(data, "epoch int, step int, loss double")).first()
    assert (got["steps"], got["loss"]) == (2, 2.0)


TAGS = ["final_v2", "final_v10", "final_x", "round_03", "round_12", "20250101_120000", "20259901_120000", "test_v9", "junk"]


def test_latest_tag_order(spark):
    def latest(tags):
        return [r["tag"] for r in tracking.latest_tag(spark.createDataFrame([("f", t) for t in tags], "family string, tag string")).collect()]

    assert latest(TAGS) == ["final_v10"]
    assert latest(TAGS[2:]) == ["final_x"]
    assert latest(TAGS[3:]) == ["round_12"]
    assert latest(TAGS[5:]) == ["20250101_120000"]
    assert latest(TAGS[6:]) == ["20259901_120000"]
    assert latest(TAGS[7:]) == ["test_v9"]
    assert latest(TAGS[8:]) == []


def test_pairs_need_both_halves(spark):
    paths = ["a/vae_encoder_final_v1.keras", "a/vae_decoder_final_v1.keras", "a/vae_encoder_final_v2.keras", "x.joblib"]
    parsed = tracking.parse_artifacts(spark.createDataFrame([("f", p) for p in paths], "family string, path string"))
    assert rows(tracking.artifact_pairs(parsed)) == [("f", "final_v1")]


def test_drift_by_initializer(spark):
    values = lambda std: [float(v) for v in RNG.normal(0, std, 4000)]
    data = [
        ("he", "he_normal", 50, 10, values(0.2)),
        ("glorot", "glorot_normal", 50, 50, values(math.sqrt(0.02))),
        ("moved", "he_normal", 50, 10, values(0.4)),
        ("other", "zeros", 50, 10, values(9.0)),
    ]
    df = spark.createDataFrame(data, "layer string, initializer string, fan_in bigint, fan_out bigint, values array<double>")
    assert rows(tracking.weight_drift(df), "layer", "drifted") == [("glorot", False), ("he", False), ("moved", True)]
    assert tracking.looks_trained(df).first()[0] is True
    assert tracking.looks_trained(df.where("layer <> 'moved'")).first()[0] is False


def test_history_has_all_series(spark):
    wide = spark.createDataFrame([(0, *map(float, range(11)))], f"epoch int, {', '.join(f'{s} double' for s in tracking.HISTORY_SERIES)}")
    assert rows(tracking.history_long(wide), "series", "value") == sorted(zip(tracking.HISTORY_SERIES, map(float, range(11))))


def test_telemetry_bounds_are_inclusive_and_zero_is_a_bound(spark):
    df = spark.range(5).selectExpr("id", "double(id) as ts_unix")
    ids = lambda **kw: [r["id"] for r in telemetry.telemetry_range(df, **kw).collect()]
    assert ids() == [0, 1, 2, 3, 4] and ids(lo=1.0, hi=3.0) == [1, 2, 3] and ids(hi=0.0) == [0]


def test_telemetry_bounds_reach_the_scan(spark, sf):
    from cadentia.plans.queries import QUERIES

    text = plan(QUERIES["telemetry_range"](spark, sf))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text and "LessThanOrEqual(ts,2024-01-19T23:59:59.999999)" in text


def test_device_keys(spark):
    data = [("gpu_A_B_utilization", 1.0), ("gpu_A_B_memory", 2.0), ("gpu_memory", 3.0), ("cpu_total", 4.0)]
    df = spark.createDataFrame(data, "series string, value double").withColumn("minutes", F.lit(0.0))
    assert rows(telemetry.parse_device_key(df), "device", "metric") == [("", "memory"), ("A_B", "memory"), ("A_B", "utilization")]
    assert rows(telemetry.device_metric_pivot(df), "device", "utilization", "memory")[1] == ("A_B", 1.0, 2.0)


def test_merge_keeps_one_row_per_key_in_any_order(spark):
    schema = "k int, v double"
    a, b = spark.createDataFrame([(1, 5.0), (2, 6.0)], schema), spark.createDataFrame([(2, 4.0), (3, 7.0)], schema)
    expected = [(1, 5.0), (2, 4.0), (3, 7.0)]
    assert rows(telemetry.merge_stores(a, b, keys=("k",))) == expected == rows(telemetry.merge_stores(b, a, keys=("k",)))


def test_percent_of_nothing_is_zero(spark):
    got = spark.sql("select 5D as u, 0D as t").select(telemetry.percent_of(F.col("u"), F.col("t"))).first()[0]
    assert got == 0.0


def test_sample_positions_match_numpy(spark):
    sizes = [1, 2, 3, 49, 50, 51, 120, 265, 997, 4999, 19999]
    files = spark.createDataFrame([(str(n), n) for n in sizes], "file string, n_rows bigint")
    got = rows(profile.sample_rows(files))
    for n in sizes:
        want = np.linspace(0, n - 1, min(50, n), dtype=int)
        assert sorted(i for f, i in got if f == str(n)) == sorted(want.tolist())


def test_profile_samples_rows_and_sums_sizes(spark):
    df = spark.range(200).selectExpr("'a' as file", "id as row_idx", "'[2, 3]' as shape", "'float32' as dtype", "array(double(id), -1D) as cells")
    every = profile.file_profile(df).first()
    assert (every["sampled_rows"], every["sample_mean"]) == (200, pytest.approx(np.mean([(i - 1) / 2 for i in range(200)])))
    got = profile.file_profile(df, max_rows=50).first()
    idx = np.linspace(0, 199, 50, dtype=int)
    assert (got["n_rows"], got["sampled_rows"], got["sample_min"], got["sample_max"]) == (200, 50, -1.0, 199.0)
    assert got["sample_mean"] == pytest.approx(np.mean((idx - 1) / 2)) and got["expected_bytes"] == 200 * 6 * 4
    whole = profile.profile_consistency(profile.file_profile(df)).first().asDict()
    assert whole == {"files": 1, "shapes": 1, "dtypes": 1, "total_rows": 200, "total_bytes": 4800}


def test_strict_features_refuse_an_incomplete_cadence(spark):
    whole = [(c, o, [float(o), 1.0]) for c in range(3) for o in range(6)]
    df = spark.createDataFrame(whole[:-1], "cadence_id bigint, obs bigint, z array<double>")
    assert features.cadence_features(df, 6).count() == 2
    with pytest.raises(PySparkException, match="lacks an observation"):
        features.cadence_features(df, 6, strict=True).collect()
    complete = spark.createDataFrame(whole, df.schema)
    assert features.cadence_features(complete, 6, strict=True).count() == 3
