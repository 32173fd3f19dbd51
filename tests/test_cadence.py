import math

import pytest

from cadentia.geometry import Geometry
from cadentia.operators import cadence
from cadentia.sources import tables
from conftest import rows

GEO = Geometry()


def scores(spark, data, band=0):
    return spark.createDataFrame(
        [(band, o, s, float(p)) for s, o, p in data], "band bigint, obs bigint, start_index bigint, p double"
    )


DATA = [
    (0, 0, 0.9), (0, 2, 0.7), (0, 1, 0.5),   # two ON, the OFF sits on the threshold
    (1, 0, 0.9), (1, 1, 0.8),                 # ON and OFF
    (2, 4, 0.99),                             # a single ON
    (3, 1, 0.9), (3, 3, 0.9),                 # OFF only
    (4, 2, 0.6), (4, 0, 0.8), (4, 0, 0.7),    # a duplicate ON
    (5, 0, math.nan), (5, 2, 0.9),            # NaN is not a positive
]


def test_pattern_rule(spark):
    found = {r["frequency_index"]: r for r in cadence.detect(scores(spark, DATA), GEO).collect()}
    assert {k: v["classification"] for k, v in found.items()} == {
        0: "ETI_candidate", 1: "RFI_likely", 4: "ETI_candidate"
    }
    assert found[0]["observation_pattern"] == "[0, 2]"
    assert found[4]["observation_pattern"] == "[0, 0, 2]"
    assert found[1]["observation_pattern"] == "[0, 1]"
    assert found[0]["confidence"] == pytest.approx(0.8)
    assert found[4]["frequency_MHz"] == pytest.approx(1100 + 4 * 8 * 2.7939677238464355 / 1e6)


def test_order_and_partitioning_do_not_matter(spark):
    base = rows(cadence.detect(scores(spark, DATA), GEO))
    for n in (1, 5):
        assert rows(cadence.detect(scores(spark, DATA[::-1]).repartition(n), GEO)) == base


def test_bands_have_their_own_frequencies_and_rank_together(spark):
    both = scores(spark, DATA).unionAll(scores(spark, DATA, band=3))
    ranked = cadence.rank_detections(cadence.detect(both, GEO)).collect()
    keys = [(-r["confidence"], r["band"], r["frequency_index"]) for r in ranked]
    assert keys == sorted(keys)
    assert {round(r["frequency_MHz"]) for r in ranked} == {1100, 1250}
    apart = [cadence.detect(scores(spark, DATA, band=b), GEO) for b in (0, 3)]
    assert rows(cadence.combine_bands(apart)) == sorted(tuple(r) for r in ranked)


def test_confidence_of_the_predicted_class(spark):
    out = rows(cadence.predict_confidence(scores(spark, [(0, 0, 0.5), (1, 0, 0.75)])), "p", "prediction", "confidence")
    assert out == [(0.5, 0, 0.5), (0.75, 1, 0.75)]


def test_empty_results_keep_their_schema(spark, tmp_path):
    nothing = cadence.detect(scores(spark, [(0, 0, 0.1)]), GEO)
    path = str(tmp_path / "none.csv")
    tables.write_detections(nothing, path)
    back = tables.read_detections(spark, path)
    assert back.count() == 0 and back.columns == list(cadence.REPORT_COLUMNS)
    assert not (tmp_path / "none_high_confidence.csv").exists()


def test_confident_detections_are_written_beside(spark, tmp_path):
    path = str(tmp_path / "some.csv")
    sure = cadence.detect(scores(spark, [*DATA, (9, 0, 0.95), (9, 2, 0.97), (8, 0, 0.9), (8, 2, 0.9)]), GEO)
    tables.write_detections(sure, path)
    high = tables.read_detections(spark, tables.high_confidence_path(path))
    assert [r["frequency_index"] for r in high.collect()] == [9]
    assert tables.read_detections(spark, path).count() == sure.count()


def test_score_join_keeps_matching_keys_only(spark):
    left = scores(spark, [(0, 0, 0), (0, 1, 0), (1, 0, 0)]).drop("p")
    right = scores(spark, [(0, 0, 0.5), (1, 0, 0.6), (7, 0, 0.7)])
    assert rows(cadence.score_join(left, right), "start_index", "obs", "p") == [(0, 0, 0.5), (1, 0, 0.6)]
