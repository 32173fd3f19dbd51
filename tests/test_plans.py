import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from cadentia.functions import arrays
from cadentia.geometry import Geometry
from cadentia.operators import cadence, clean, spectral
from cadentia.plans import detection, fixtures, training
from cadentia.plans.queries import QUERIES
from cadentia.settings import ForestParams, Injection, LoadLimits, SplitSizes
from cadentia.sources import npy, tables
from cadentia.sources.npy import headers, read_npy, read_snippets
from conftest import SF, plan, rows

RAW = Geometry(n_obs=6, time_bins=4, width=32, factor=2)
SMALL = RAW.downsampled()


@pytest.fixture(scope="module")
def background_files(tmp_path_factory):
    rng = np.random.default_rng(1)
    folder, data = tmp_path_factory.mktemp("bg"), {}
    for name, n in (("a.npy", 30), ("b.npy", 12)):
        cells = rng.chisquare(2, size=(n, 6, 4, 32)).astype(np.float32)
        cells[3, 1, 0, 5] = np.nan
        cells[5, 0, 2, 1] = np.inf
        cells[7] = -1.0
        np.save(folder / name, cells)
        data[name] = cells
    return [str(folder / "a.npy"), str(folder / "absent.npy"), str(folder / "b.npy")], data


def test_loading_files(spark, background_files):
    paths, data = background_files
    limits = LoadLimits(chunk_size=10, chunks_per_file=2, target=25)
    loaded = training.load_background_files(spark, paths, RAW, subsets={"a.npy": (2, None)}, limits=limits)
    got = {(r["source_file"].rsplit("/", 1)[-1], r["row_idx"]): np.array(r["obs_cells"]) for r in loaded.collect()}
    valid_a = [("a.npy", i) for i in range(2, 22) if i not in (3, 5, 7)]
    valid_b = [("b.npy", i) for i in range(12) if i not in (3, 5, 7)]
    assert set(got) == set((valid_a + valid_b)[:25])
    for (name, i), cells in got.items():
        want = data[name][i].reshape(6, -1, 2).mean(axis=2)
        np.testing.assert_allclose(cells, want, rtol=1e-6)


def test_nothing_is_left_out_by_default_and_listed_order_counts(spark, background_files, tmp_path):
    paths, data = background_files
    (tmp_path / "other").mkdir()
    np.save(tmp_path / "other" / "a.npy", data["a.npy"])  # a second file of one name
    listed = [str(tmp_path / "other" / "a.npy"), paths[2], paths[0]]
    loaded = training.load_background_files(spark, listed, RAW)
    keys = [(r["source_file"], r["row_idx"]) for r in loaded.select("source_file", "row_idx").collect()]
    assert len(keys) == len(set(keys)) == 2 * (len(data["a.npy"]) - 3) + len(data["b.npy"]) - 3
    first = training.load_background_files(spark, listed, RAW, limits=LoadLimits(target=len(data["a.npy"])))
    of = {r[0] for r in first.select("source_file").distinct().collect()}
    assert {f.rsplit("/", 2)[-2:][1] for f in of} == {"a.npy", "b.npy"} and not any(f.endswith(paths[0]) for f in of)


def test_a_target_opens_no_more_files_than_it_needs(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    paths = []
    for i in range(40):
        cells = rng.random((5, 6, 4, 32), np.float32)
        if i % 4 == 1:
            cells[:] = 0  # a whole file of invalid cadences
        paths.append(str(tmp_path / f"f{i:02d}.npy"))
        np.save(paths[-1], cells)
    opened = []
    real = training.read_backgrounds
    monkeypatch.setattr(training, "read_backgrounds", lambda s, files, **k: opened.extend(files) or real(s, files, **k))
    every = training.load_background_files(spark, paths, RAW)
    key = lambda df: sorted((r.source_file, r.row_idx) for r in df.select("source_file", "row_idx").collect())
    for target, most in ((1, 1), (12, 6), (33, 14), (10_000, 40)):
        opened.clear()
        got = training.load_background_files(spark, paths, RAW, limits=LoadLimits(target=target))
        assert key(got) == key(every)[:target] and len(opened) == len(set(opened)) <= most


def test_filters_prune_what_is_read(spark, tmp_path):
    paths = []
    for i in range(3):
        paths.append(str(tmp_path / f"f{i}.npy"))
        np.save(paths[-1], np.arange(20 * 2 * 3, dtype=np.float32).reshape(20, 2, 3) + i)
    scan = read_npy(spark, paths, rows_per_split=4)
    one = scan.where(f"source_file like '%f1.npy' and row_idx >= 5 and row_idx < 9")
    assert sorted(r.row_idx for r in one.collect()) == [5, 6, 7, 8]
    name = scan.select("source_file").where("source_file like '%f1.npy'").first()[0]
    both = scan.where((F.col("source_file") == name) & F.col("row_idx").between(5, 8))
    assert sorted(r.row_idx for r in both.collect()) == [5, 6, 7, 8]
    assert not re.search(r"\bFilter \(", plan(both))
    # the same ranges, as a task sees them
    folder, parts = npy._planned(spark, paths, npy._row_ranges(None, None, 4), 1)
    assert parts == 15
    reader = npy.SpectrogramReader({"manifest": folder, "parts": str(parts)})
    filters = [EqualTo(("source_file",), name), GreaterThan(("row_idx",), 4), LessThanOrEqual(("row_idx",), 8), In(("shape",), ("x",))]
    assert list(reader.pushFilters(filters)) == filters[3:]
    left = [(r.path, r.lo, r.hi) for part in reader.partitions() for r in reader.ranges(part)]
    assert left == [(name, 5, 8), (name, 8, 9)]


def test_a_table_of_paths_is_a_listing(spark, tmp_path):
    for n in ("b", "a"):
        np.save(tmp_path / f"{n}.npy", np.ones((3, 2, 2), np.float32))
    table = spark.createDataFrame([(npy.qualified(spark, str(tmp_path / f"{n}.npy")),) for n in ("b", "a", "gone")], "path string")
    assert read_npy(spark, table).count() == 6
    assert headers(spark, table).where("fault = 'absent'").count() == 1


def test_both_engines_load_the_same(spark, background_files):
    paths, _ = background_files
    raw = read_npy(spark, paths)
    a, b = (rows(clean.load_cadence_rows(raw, RAW, engine=e)) for e in ("expr", "arrow"))
    assert [r[:2] for r in a] == [r[:2] for r in b] and len(a) == 36
    np.testing.assert_allclose([r[2] for r in a], [r[2] for r in b], rtol=1e-6)


def test_nothing_valid_is_an_error(spark, tmp_path):
    np.save(tmp_path / "z.npy", np.zeros((3, 6, 4, 32), np.float32))
    with pytest.raises(ValueError):
        training.load_background_files(spark, [str(tmp_path / "z.npy")], RAW)
    for engine in ("expr", "arrow"):
        assert clean.load_cadence_rows(read_npy(spark, [str(tmp_path / "z.npy")]), RAW, engine=engine).count() == 0


def test_train_and_evaluate(spark, background_files):
    from cadentia.session import materialise

    paths, _ = background_files
    backgrounds = training.load_background_files(spark, paths, RAW)
    par = Injection(chunk_size=40)
    batch = materialise(training.training_round(backgrounds, 0, 80, SMALL, seed=1, par=par), "round")
    assert batch.count() == 80 * 3 * 6
    later = training.training_round(backgrounds, 1, 80, SMALL, seed=1, par=par)
    assert rows(later.limit(5), "sample_idx", "obs", "cells") != rows(batch.limit(5), "sample_idx", "obs", "cells")
    embedding, model = training.fit_classifier(batch, 6, latent_dim=4, par=ForestParams(n_trees=20, max_depth=6))
    labelled = training.labelled_features(batch, embedding, 6)
    assert labelled.groupBy("label").count().count() == 2 and labelled.count() == 160
    metrics = training.evaluate(labelled, model).first()
    assert metrics["accuracy"] > 0.8 and metrics["tpr"] > metrics["fpr"]
    split = training.train_and_validation(batch, 80, SplitSizes(0.8, 32, 8))
    parts = {r[0]: r[1] for r in split.groupBy("part").agg(F.count_distinct("sample_idx")).collect()}
    assert parts == {"train": 64, "val": 16}


@pytest.fixture(scope="module")
def observation_files(tmp_path_factory):
    """Three bands; a bright patch ON only in band 0, everywhere in band 1; band 2 incomplete."""
    folder, rng = tmp_path_factory.mktemp("obs"), np.random.default_rng(2)
    for band in range(3):
        for obs in range(6 if band < 2 else 5):
            cells = rng.uniform(0, 0.2, size=(4, 200)).astype(np.float32)
            if band == 1 or obs % 2 == 0:
                cells[:, 64:96] += 0.75
            np.save(folder / f"cadence_{band:04d}_obs_{obs}.npy", cells)
    return sorted(str(p) for p in folder.iterdir())


def mean_scorer(df):
    return df.withColumn("p", arrays.array_sum(F.col("cells").cast("array<double>")) / F.size("cells"))


def test_snippets_cut_while_reading_equal_those_cut_afterwards(spark, observation_files):
    path = observation_files[0]
    cells = np.load(path)
    got = {r["start_index"]: np.array(r["cells"]) for r in read_snippets(spark, [path], size=16, factor=2, snippets_per_split=3).collect()}
    assert sorted(got) == list(range(0, 100 - 16 + 1, 8))
    geo = Geometry(n_obs=1, time_bins=4, width=200, factor=2)
    obs = spark.createDataFrame([(0, 0, [float(x) for x in cells.ravel()])], "cadence_id int, obs int, cells array<double>")
    cut = spectral.overlap_snippets(spectral.downsample(obs, geo), geo.downsampled(), 16, 0.5)
    for r in cut.collect():
        np.testing.assert_allclose(got[r["start_index"]], r["cells"], rtol=1e-6)


def test_inference_end_to_end(spark, observation_files, tmp_path):
    out = str(tmp_path / "found.csv")
    counts = rows(detection.run_inference(spark, observation_files, mean_scorer, out, RAW))
    assert counts == [("ETI_candidate", 1), ("RFI_likely", 1)]
    found = tables.read_detections(spark, out).collect()
    channel = RAW.freq_resolution_hz * RAW.factor
    for r in found:
        band = 0 if r["classification"] == "ETI_candidate" else 1
        assert r["frequency_index"] == 32
        assert r["frequency_MHz"] == pytest.approx(1100 + 50 * band + 32 * channel / 1e6)
        assert r["observation_pattern"] == ("[0, 2, 4]" if band == 0 else "[0, 1, 2, 3, 4, 5]")
    with pytest.raises(FileNotFoundError):
        detection.run_inference(spark, observation_files[-5:], mean_scorer, out, RAW)


def test_damaged_off_observations_make_no_candidate(spark, observation_files, tmp_path):
    """Band 1 is bright everywhere; without its OFF files it would look like a signal."""
    folder = tmp_path / "obs"
    folder.mkdir()
    for path in observation_files:
        raw = Path(path).read_bytes()
        off = "cadence_0001" in path and int(path[-5]) % 2
        (folder / Path(path).name).write_bytes(raw[: len(raw) // 2] if off else raw)
    paths = sorted(str(p) for p in folder.iterdir())
    counts = rows(detection.run_inference(spark, paths, mean_scorer, str(tmp_path / "found.csv"), RAW))
    assert counts == [("ETI_candidate", 1)]  # band 0 alone
    skipped = {Path(r["path"]).name for r in headers(spark, paths).where("fault IS NOT NULL").collect()}
    assert skipped == {f"cadence_0001_obs_{i}.npy" for i in (1, 3, 5)}


MODELS = {"rf_fit", "rf_score", "model_roundtrip", "embed_observations"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODELS))
def test_no_plan_crosses_tables(spark, key):
    text = plan(QUERIES[key](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    assert "BatchEvalPython" not in text  # no row-at-a-time Python


def test_scan_reads_only_what_the_scan_needs(spark):
    text = plan(cadence.detection_counts(cadence.detect(fixtures.scores(spark, SF), RAW)))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
