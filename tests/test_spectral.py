import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadentia.geometry import Geometry
from cadentia.operators import spectral
from conftest import rows

GEO = Geometry(n_obs=1, time_bins=2, width=8, factor=4)
LIGHT = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
CELLS = st.lists(
    st.lists(st.floats(1e-6, 1e6), min_size=16, max_size=16), min_size=1, max_size=6
)


def obs(spark, arrays):
    return spark.createDataFrame(
        [(i, 0, [float(x) for x in a]) for i, a in enumerate(arrays)],
        "cadence_id bigint, obs bigint, cells array<double>",
    )


def matrix(df):
    return np.array([r["cells"] for r in df.orderBy("cadence_id").collect()])


@LIGHT
@given(CELLS)
def test_log_norm_against_numpy(spark, arrays):
    logs = np.log(np.array(arrays) + 1e-10)
    logs -= logs.min(axis=1, keepdims=True)
    top = logs.max(axis=1, keepdims=True)
    expected = np.where(top > 0, logs / np.where(top > 0, top, 1), logs)
    for engine in ("expr", "arrow"):
        got = matrix(spectral.log_normalise(obs(spark, arrays), GEO, engine=engine))
        np.testing.assert_allclose(got, expected, atol=1e-12)
        assert (got.min(axis=1) == 0).all() and got.max() <= 1


@LIGHT
@given(CELLS)
def test_downsample_keeps_the_mean(spark, arrays):
    expected = np.array(arrays).reshape(len(arrays), -1, 4).mean(axis=2)
    for engine in ("expr", "arrow"):
        got = matrix(spectral.downsample(obs(spark, arrays), GEO, engine=engine))
        np.testing.assert_allclose(got, expected, rtol=1e-12)
        np.testing.assert_allclose(got.mean(axis=1), np.array(arrays).mean(axis=1), rtol=1e-9)


def test_constant_observation_becomes_zero(spark):
    for engine in ("expr", "arrow"):
        assert (matrix(spectral.log_normalise(obs(spark, [[3.0] * 16]), GEO, engine=engine)) == 0).all()


def test_undefined_logarithm_gives_nan_and_is_flagged(spark):
    bad = [[-1.0] + [2.0] * 15]
    for engine in ("expr", "arrow"):
        done = spectral.log_normalise(obs(spark, bad), GEO, engine=engine)
        assert np.isnan(matrix(done)).all()
        report = spectral.range_check(done.selectExpr("'s' as split_set", "cells")).first()
        assert report["nan_rows"] == 1 and not report["in_range"]


def test_range_check_and_requirement(spark):
    df = obs(spark, [[0.0, 0.5], [0.2, 1.0]]).selectExpr("'s' as split_set", "cells")
    report = spectral.range_check(df).first()
    assert (report["min_value"], report["max_value"], report["in_range"]) == (0.0, 1.0, True)
    assert report["mean_value"] == pytest.approx(0.425)
    assert spectral.require_normalised(df).count() == 2
    above = obs(spark, [[0.0, 1.5]]).selectExpr("'s' as split_set", "cells")
    assert not spectral.range_check(above).first()["in_range"]
    with pytest.raises(Exception, match="outside"):
        spectral.require_normalised(above).collect()


def test_snippets_drop_the_tail_and_cut_every_time_row(spark):
    cells = [list(range(16))]
    cut = spectral.overlap_snippets(obs(spark, cells), GEO, size=3, overlap=0.5)
    got = {r["start_index"]: r["cells"] for r in cut.collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5]
    assert got[5] == [5, 6, 7, 13, 14, 15]
    wide = spectral.overlap_snippets(obs(spark, cells), GEO, size=6, overlap=0.5)
    assert sorted(r["start_index"] for r in wide.collect()) == [0]
    assert spectral.overlap_snippets(obs(spark, cells), GEO, size=9).count() == 0
    with pytest.raises(ValueError):
        spectral.overlap_snippets(obs(spark, cells), GEO, size=1, overlap=0.5)


def test_cell_view_round_trip(spark):
    view = spectral.cell_view(obs(spark, [list(range(16))]), GEO)
    assert rows(view, "t", "f", "v") == sorted((i // 8, i % 8, float(i)) for i in range(16))


def test_unequal_rows_are_refused_by_the_kernel(spark):
    ragged = obs(spark, [[1.0] * 16, [1.0] * 8]).coalesce(1)
    with pytest.raises(Exception, match="same number of cells"):
        spectral.downsample(ragged, GEO, engine="arrow").collect()


def test_not_a_number_in_statistics(spark):
    df = obs(spark, [[math.nan, 1.0], [0.0, 1.0]]).selectExpr("'s' as split_set", "cells")
    report = spectral.range_check(df).first()
    assert (report["max_value"], report["mean_value"], report["in_range"]) == (1.0, 0.5, False)
