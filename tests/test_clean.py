import math

import pytest
from pyspark.errors import PySparkException

from cadentia.geometry import Geometry
from cadentia.operators import clean, spectral
from conftest import plan, rows

GEO = Geometry(n_obs=2, time_bins=1, width=4, factor=2)
SCHEMA = "cadence_id bigint, obs bigint, source_file string, row_idx bigint, cells array<double>"


def table(spark, *cadences):
    """Each cadence: (id, [cells of obs 0, cells of obs 1])."""
    data = [
        (cid, obs, f"f{cid % 2}", cid // 2, cells)
        for cid, observations in cadences
        for obs, cells in enumerate(observations)
    ]
    return spark.createDataFrame(data, SCHEMA)


GOOD = [1.0, 2.0, 3.0, 4.0]


def mixed(spark):
    return table(
        spark,
        (0, [GOOD, GOOD]),
        (1, [GOOD, [1.0, math.nan, 1.0, 1.0]]),
        (2, [[math.inf, 1.0, 1.0, 1.0], GOOD]),
        (3, [[0.0] * 4, [-1.0] * 4]),
        (4, [GOOD]),
        (5, [[0.0] * 4, [0.0, 0.0, 0.0, 0.1]]),
    )


def test_validity_drops_whole_cadences(spark):
    kept = rows(clean.valid_cadences(mixed(spark), 2), "cadence_id", "obs")
    assert kept == [(0, 0), (0, 1), (5, 0), (5, 1)]


def test_load_backgrounds_agrees_with_the_separate_steps(spark):
    loaded = clean.load_backgrounds(mixed(spark), GEO)
    stepwise = spectral.downsample(clean.valid_cadences(mixed(spark), 2), GEO)
    got = rows(clean.explode_observations(loaded), "cadence_id", "obs", "cells")
    assert got == rows(stepwise, "cadence_id", "obs", "cells")
    assert got[0][2] == [1.5, 3.5]


def test_width_must_divide():
    with pytest.raises(ValueError):
        Geometry(width=10, factor=4)


def test_limit_counts_valid_rows_only_in_file_order(spark):
    many = table(spark, *[(i, [GOOD, [math.nan] * 4 if i % 3 == 0 else GOOD]) for i in range(20)])
    kept = {r[0] for r in rows(clean.limit_cadences(many, 5, GEO), "cadence_id")}
    order = sorted((f"f{i % 2}", i // 2, i) for i in range(20) if i % 3)
    assert kept == {i for _, _, i in order[:5]}
    every = clean.limit_cadences(many, 1000, GEO)
    assert every.select("cadence_id").distinct().count() == 13


def test_row_subset_is_half_open_and_cap_follows_it(spark):
    df = spark.range(10).selectExpr("'a' as source_file", "id as row_idx").unionAll(
        spark.range(10).selectExpr("'b' as source_file", "id as row_idx")
    )
    kept = rows(clean.row_subset(df, {"a": (2, 5)}))
    assert [r for r in kept if r[0] == "a"] == [("a", i) for i in (2, 3, 4)]
    assert len([r for r in kept if r[0] == "b"]) == 10
    capped = rows(clean.row_subset(df, {"a": (2, None)}, rows_per_file=3))
    assert capped == [("a", i) for i in (2, 3, 4)] + [("b", i) for i in (0, 1, 2)]
    with pytest.raises(ValueError):
        clean.row_subset(df, {"a": (-3, None)})


def test_row_subset_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("'a' as source_file", "id as row_idx", "id as payload").write.parquet(path)
    text = plan(clean.row_subset(spark.read.parquet(path), {"a": (2, 5)}).select("payload"))
    assert "PushedFilters: [Or(" in text and "GreaterThanOrEqual(row_idx,2)" in text


def test_complete_cadence_files(spark):
    names = [f"/x/cadence_0001_obs_{i}.npy" for i in range(3)] + ["/x/cadence_0002_obs_0.npy", "/x/notes.txt"]
    names.append("/x/cadence_0002_obs_0.npy")
    files = spark.createDataFrame([(n,) for n in names], "path string")
    assert rows(clean.complete_cadence_files(files, 3), "cadence_id", "obs") == [(1, 0), (1, 1), (1, 2)]


def test_guards(spark):
    report = clean.guard_report(mixed(spark), 4).first().asDict()
    assert report == {"rows": 11, "nan_rows": 1, "inf_rows": 1, "wrong_width_rows": 0}
    clean.require_clean(mixed(spark).where("cadence_id = 0"), 4).collect()
    for bad in (mixed(spark), mixed(spark).where("cadence_id = 2")):
        with pytest.raises(PySparkException):
            clean.require_clean(bad, 4).collect()
    with pytest.raises(PySparkException):
        clean.require_clean(mixed(spark).where("cadence_id = 0"), 8).collect()


def test_second_row_for_an_observation_is_an_error(spark):
    twice = table(spark, (0, [GOOD, GOOD])).unionAll(table(spark, (0, [GOOD])))
    with pytest.raises(PySparkException):
        clean.assemble_cadences(twice, 2).collect()


def test_wide_payload_is_not_shuffled_to_drop_rejects(spark):
    kept = clean.valid_cadences(mixed(spark), 2)
    text = plan(kept)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
