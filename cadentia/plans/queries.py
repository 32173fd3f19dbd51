"""Registered queries: one per operator, each over whole tables.

Doubles are rounded (to 6 places, or to more where 6 could fall on an exact tie) and
integers are BIGINT, so that results compare by value with another SQL engine.
"""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.functions import arrays, text
from cadentia.functions.hashing import uniform
from cadentia.ml import embed, forest
from cadentia.operators import (
    cadence,
    clean,
    features,
    generation,
    indexing,
    plug,
    profile,
    spectral,
    telemetry,
    tracking,
)
from cadentia.plans import fixtures as fx
from cadentia.session import materialise, scratch_dir
from cadentia.settings import Curriculum, ForestParams
from cadentia.sources import npy, tables
from cadentia.streaming import flush
from cadentia.streaming import plateau as stream_state
from cadentia.streaming import telemetry as streams

QUERIES: dict = {}

GEO, FULL = fx.OBS_GEOMETRY, fx.FULL_GEOMETRY
SEED = 7


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, places) for c in columns})


def digest(cells: str = "cells") -> list[Column]:
    """Size, extremes, sum and position-weighted sum of an array."""
    c = F.col(cells).cast("array<double>")
    return [
        F.size(c).cast("bigint").alias("n_cells"),
        r6(F.array_min(c)).alias("lo"),
        r6(F.array_max(c)).alias("hi"),
        r6(arrays.array_sum(c)).alias("total"),
        r6(arrays.position_sum(c)).alias("weighted"),
    ]


# --- scans, sources, sinks -------------------------------------------------------


@query
def scan_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and finite content per source file."""
    bad = arrays.has_nan(F.col("cells")) | arrays.has_inf(F.col("cells"))
    per_row = fx.observations(spark, sf_dir).select(
        "source_file",
        F.size("cells").cast("bigint").alias("n"),
        bad.alias("bad"),
        F.when(~bad, arrays.array_sum(F.col("cells"))).alias("total"),
    )
    return per_row.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("observations"),
        F.sum("n").alias("cells"),
        F.count_if("bad").alias("bad_observations"),
        r6(F.sum("total")).alias("total"),
    )


@query
def scan_npy(spark, sf_dir):
    """The embeddings stored as ``.npy`` files and scanned by row range."""
    folder = scratch_dir(spark, "npy")
    files = fx.write_npy(spark, sf_dir, folder)
    rows = npy.read_npy(spark, files)
    name = F.element_at(F.split("source_file", "/"), -1).alias("source_file")
    return rows.select(name, "row_idx", "shape", "dtype", *digest())


@query
def scan_missing_ok(spark, sf_dir):
    paths = [f"{sf_dir}/{name}.parquet" for name in ("absent_before", "embeddings", "absent_after")]
    return tables.read_existing(spark, paths).groupBy(F.col("label").cast("bigint").alias("label")).agg(
        F.count(F.lit(1)).alias("vectors")
    )


SUBSETS = {"file_0": (5, 20), "file_1": (None, 15), "file_2": (10, None)}


@query
def scan_row_subset(spark, sf_dir):
    kept = clean.row_subset(fx.observations(spark, sf_dir), SUBSETS)
    return kept.select("source_file", "row_idx", "cadence_id", "obs")


@query
def scan_file_cap(spark, sf_dir):
    """The cap is the operator's feature; here it follows the size of the table."""
    obs = fx.observations(spark, sf_dir)
    cap = obs.select("cadence_id").distinct().count() // 7
    kept = clean.row_subset(obs, SUBSETS, rows_per_file=cap)
    return kept.select("source_file", "row_idx", "cadence_id", "obs")


@query
def complete_cadences(spark, sf_dir):
    listing = fx.observations(spark, sf_dir).select(
        F.format_string("/cadences/cadence_%04d_obs_%d.npy", "cadence_id", "obs").alias("path")
    )
    return clean.complete_cadence_files(listing, fx.N_OBS)


def _detections(spark, sf_dir, bands: int = 1) -> DataFrame:
    return cadence.detect(fx.scores(spark, sf_dir, bands), GEO)


@query
def detections_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "detections") + ".csv"
    tables.write_detections(_detections(spark, sf_dir, 4), path)
    return rounded(tables.read_detections(spark, path), "frequency_MHz", "confidence")


@query
def high_confidence(spark, sf_dir):
    return rounded(cadence.high_confidence(_detections(spark, sf_dir)), "frequency_MHz", "confidence")


@query
def high_confidence_sink(spark, sf_dir):
    """The second report, written beside the first only if a detection is confident enough."""
    path = scratch_dir(spark, "report") + ".csv"
    tables.write_detections(_detections(spark, sf_dir), path)
    return rounded(tables.read_high_confidence(spark, path), "frequency_MHz", "confidence")


@query
def telemetry_route(spark, sf_dir):
    path = scratch_dir(spark, "routed")
    tables.write_routed(fx.queue(spark, sf_dir), path)
    return _route_summary(spark.read.parquet(path))


def _route_summary(stored: DataFrame) -> DataFrame:
    return stored.groupBy(F.col("table").cast("string").alias("table")).agg(
        F.count(F.lit(1)).alias("rows"),
        r6(F.sum("value")).alias("total"),
        r6(F.min("timestamp")).alias("first_ts"),
        r6(F.max("timestamp")).alias("last_ts"),
        F.count("resource_name").alias("resource_names"),
        F.count("epoch_number").alias("epoch_numbers"),
        F.count("filename").alias("filenames"),
        F.count("round_number").alias("round_numbers"),
    )


@query
def model_roundtrip(spark, sf_dir):
    """Both scores of every vector: of the model in memory, and of the stored one, found again by the newest tag."""
    model, folder = _fitted(spark, sf_dir), scratch_dir(spark, "models")
    pairs = tracking.artifact_pairs(tracking.parse_artifacts(fx.registry(spark, sf_dir)), keys=())
    forest.save_model(model, folder, tracking.latest_tag(pairs, keys=()).first()["tag"])
    data = _labelled_vectors(spark, sf_dir)
    before = forest.forest_scores(model, data).withColumnRenamed("p", "p_before")
    again = forest.load_latest(fx.registry(spark, sf_dir), folder)
    return rounded(forest.forest_scores(again, before).selectExpr("vec_id", "p_before", "p as p_after"), "p_before", "p_after", places=12)


# --- projections and filters -----------------------------------------------------


@query
def valid_cadences(spark, sf_dir):
    kept = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    return kept.select("cadence_id", "obs", *digest())


@query
def guard_backgrounds(spark, sf_dir):
    return clean.guard_report(fx.observations(spark, sf_dir), GEO.cells_per_obs)


def _normalised_sets(spark, sf_dir) -> DataFrame:
    """Normalised observations as they are, squared and mirrored: three sets of one shape."""
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    main = spectral.require_normalised(spectral.log_normalise(clean.require_clean(obs, GEO.cells_per_obs), FULL))
    main = main.select(F.col("cadence_id").alias("sample_idx"), "obs", "cells")
    sets = {
        "concatenated": F.col("cells"),
        "true": F.transform("cells", lambda x: x * x),
        "false": F.transform("cells", lambda x: 1 - x),
    }
    return tracking.union_all(
        [main.select("sample_idx", "obs", F.lit(name).alias("split_set"), c.alias("cells")) for name, c in sets.items()]
    )


@query
def norm_range_check(spark, sf_dir):
    """The three sets of normalised observations."""
    checked = spectral.range_check(_normalised_sets(spark, sf_dir))
    return rounded(checked, "min_value", "max_value", "mean_value")


@query
def telemetry_range(spark, sf_dir):
    """Bounds of the stored column's own type, so that the scan prunes by them."""
    lo, hi = (F.to_timestamp_ntz(F.lit(t)) for t in ("2024-01-05 00:00:00", "2024-01-19 23:59:59.999999"))
    kept = telemetry.telemetry_range(fx.telemetry(spark, sf_dir), lo, hi, ts="ts")
    return kept.select("id", r6("ts_unix").alias("ts_unix"), "resource_type", "resource_name", "value", "tag")


@query
def telemetry_range_stored(spark, sf_dir):
    """The same range from a store laid out by time: days as folders, rows sorted inside."""
    path = scratch_dir(spark, "clustered")
    tables.write_clustered(fx.telemetry(spark, sf_dir).drop("metadata"), path)
    lo, hi = datetime(2024, 1, 5), datetime(2024, 1, 19, 23, 59, 59, 999999)
    kept = tables.read_clustered(spark, path, lo, hi)
    return kept.select("id", r6("ts_unix").alias("ts_unix"), "resource_type", "resource_name", "value", "tag")


@query
def threshold_predict(spark, sf_dir):
    scored = cadence.threshold_predict(fx.scores(spark, sf_dir))
    return scored.select("start_index", "obs", F.col("prediction").cast("bigint").alias("prediction"))


@query
def predict_confidence(spark, sf_dir):
    probabilities = fx.scores(spark, sf_dir).withColumn("p", F.least("p", F.lit(1.0)))
    scored = cadence.predict_confidence(probabilities)
    return scored.select(
        "start_index", "obs", F.col("prediction").cast("bigint").alias("prediction"), r6("confidence").alias("confidence")
    )


@query
def detection_frequency(spark, sf_dir):
    found = cadence.classify(cadence.cadence_patterns(fx.scores(spark, sf_dir, 4), fx.N_OBS))
    return rounded(cadence.to_frequency(found, GEO), "frequency_MHz").select(
        "band", "frequency_index", "frequency_MHz"
    )


@query
def history_long(spark, sf_dir):
    return rounded(tracking.history_long(fx.history(spark, sf_dir)), "value")


@query
def utilisation_pct(spark, sf_dir):
    total = (F.col("id") % 3) * 500
    return fx.telemetry(spark, sf_dir).select("id", r6(telemetry.percent_of(F.col("value"), total)).alias("percent"))


# --- joins -----------------------------------------------------------------------


def _plan(spark, sf_dir, kind: str | None = None) -> DataFrame:
    """The balanced plan, or every sample as one given class."""
    samples = fx.samples(spark, sf_dir)
    if kind is None:
        return generation.class_plan(samples, indexing.row_count(samples), 1000, remainder="last")
    return samples.withColumn("split_set", F.lit("concatenated")).withColumn("class", F.lit(kind))


def _backgrounds(spark, sf_dir) -> DataFrame:
    return materialise(fx.backgrounds(spark, sf_dir), "backgrounds")


def _batch(spark, sf_dir) -> DataFrame:
    return generation.generate_batch(fx.samples(spark, sf_dir), _backgrounds(spark, sf_dir), FULL, seed=SEED, remainder="last")


@query
def sample_backgrounds(spark, sf_dir):
    params = generation.draw_params(_plan(spark, sf_dir, "false_no_signal"), FULL, seed=SEED)
    picked = generation.sample_backgrounds(params, _backgrounds(spark, sf_dir))
    return picked.select("sample_idx", "background_idx", "cadence_id")


@query
def onoff_splice(spark, sf_dir):
    """Log-normalised ON observations beside raw OFF ones."""
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    spliced = generation.splice_on_off(spectral.log_normalise(obs, FULL), obs)
    return spliced.select("cadence_id", "obs", *digest())


@query
def aligned_triples(spark, sf_dir):
    batch = _normalised_sets(spark, sf_dir)
    part = lambda name: batch.where(F.col("split_set") == name)
    rows = generation.aligned_triples(part("concatenated"), part("true"), part("false"))
    return rows.select(
        "sample_idx",
        "obs",
        *[
            r6(arrays.array_sum(F.col(f"{s}_cells"))).alias(f"{s}_total")
            for s in ("main", "true", "false", "target")
        ],
    )


@query
def score_join(spark, sf_dir):
    """Snippet keys from events, scores from orders; the longer side's rest drops out."""
    snippets = fx.scores(spark, sf_dir).drop("p")
    scores = fx.table(spark, sf_dir, "orders").selectExpr(
        "0L as band", "o_orderkey % 6 as obs", "o_orderkey div 6 as start_index", "o_totalprice as p"
    )
    return rounded(cadence.score_join(snippets, scores), "p")


@query
def artifact_pairs(spark, sf_dir):
    return tracking.artifact_pairs(tracking.parse_artifacts(fx.registry(spark, sf_dir)))


@query
def latent_pairs(spark, sf_dir):
    return rounded(features.latent_pairs(fx.latents(spark, sf_dir), fx.N_OBS), "distance")


@query
def track_nonintersect(spark, sf_dir):
    """First pair of tracks that do not cross while on target, per event."""
    ids = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("sample_idx"))
    pair = generation.track_pair_sql("sample_idx", str(SEED), FULL)
    return ids.withColumn("pair", F.expr(pair)).select(
        "sample_idx",
        F.col("pair.draw_no").alias("draw_no"),
        F.col("pair.rfi.start_bin").alias("rfi_start"),
        F.col("pair.eti.start_bin").alias("eti_start"),
        r6("pair.rfi.slope_pixel").alias("rfi_slope"),
        r6("pair.eti.slope_pixel").alias("eti_slope"),
    )


# --- aggregations ----------------------------------------------------------------


@query
def downsample_mean(spark, sf_dir):
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    view = spectral.cell_view(spectral.downsample(obs, GEO), GEO.downsampled())
    return view.select("cadence_id", "obs", "t", "f", r6("v").alias("v"))


@query
def background_summary(spark, sf_dir):
    loaded = clean.load_backgrounds(fx.observations(spark, sf_dir), GEO)
    return rounded(spectral.dataset_summary(loaded), "min_value", "max_value", "mean_value")


@query
def cadence_pattern(spark, sf_dir):
    grouped = cadence.cadence_patterns(fx.scores(spark, sf_dir), fx.N_OBS)
    return rounded(grouped, "confidence").withColumn("pattern", text.pattern_string(F.col("pattern")))


@query
def detections(spark, sf_dir):
    return rounded(_detections(spark, sf_dir), "frequency_MHz", "confidence")


@query
def detection_counts(spark, sf_dir):
    return cadence.detection_counts(_detections(spark, sf_dir))


@query
def pair_distance(spark, sf_dir):
    return rounded(features.pair_distance(fx.latents(spark, sf_dir), fx.N_OBS), "mean_distance")


@query
def pair_inverse_distance(spark, sf_dir):
    return rounded(
        features.pair_inverse_distance(fx.latents(spark, sf_dir), fx.N_OBS), "mean_inverse_distance"
    )


def _cadence_latents(spark, sf_dir) -> DataFrame:
    """Assembled latents; a cadence is a true one if its first label is below 5."""
    is_true = F.max(F.when(F.col("obs") == 0, F.col("label") < 5)).alias("is_true")
    return features.cadence_latents(fx.latents(spark, sf_dir), fx.N_OBS, extra=(is_true,))


@query
def separation_true(spark, sf_dir):
    return _cadence_latents(spark, sf_dir).groupBy("is_true").agg(
        r6(features.separation_true(fx.N_OBS)).alias("separation")
    )


@query
def separation_false(spark, sf_dir):
    return _cadence_latents(spark, sf_dir).groupBy("is_true").agg(
        r6(features.separation_false(fx.N_OBS)).alias("separation")
    )


@query
def kl_divergence(spark, sf_dir):
    return rounded(features.kl_divergence(fx.latents(spark, sf_dir)), "kl")


def _reconstruction(spark, sf_dir) -> DataFrame:
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    pairs = spectral.log_normalise(obs, FULL).select(
        "cadence_id",
        F.col("cells").alias("target"),
        F.transform("cells", lambda x: x * 0.8 + 0.1).alias("predicted"),
    )
    return features.reconstruction_bce(pairs, FULL.width)


@query
def reconstruction_bce(spark, sf_dir):
    return rounded(_reconstruction(spark, sf_dir), "reconstruction")


@query
def total_loss(spark, sf_dir):
    whole = _cadence_latents(spark, sf_dir)
    true = whole.where("is_true").agg(features.separation_true(fx.N_OBS).alias("true_loss"))
    false = whole.where("not is_true").agg(features.separation_false(fx.N_OBS).alias("false_loss"))
    losses = features.composite_loss(
        _reconstruction(spark, sf_dir), features.kl_divergence(fx.latents(spark, sf_dir)), true, false
    )
    return rounded(losses, *losses.columns)


@query
def epoch_losses(spark, sf_dir):
    return rounded(tracking.epoch_losses(fx.loss_steps(spark, sf_dir)), "loss", places=9)


@query
def eval_metrics(spark, sf_dir):
    return rounded(features.eval_metrics(fx.predictions(spark, sf_dir)), "tpr", "fpr", "accuracy")


@query
def table_stats(spark, sf_dir):
    stats = telemetry.table_stats(
        {
            "system_resources": fx.telemetry(spark, sf_dir),
            "background_stats": fx.table(spark, sf_dir, "documents"),
            "injection_stats": fx.table(spark, sf_dir, "labels"),
            "training_losses": fx.losses(spark, sf_dir),
        }
    )
    return rounded(stats, "min_timestamp", "max_timestamp")


@query
def store_size(spark, sf_dir):
    """Bytes on disk of a store: the events' properties as lines of text, a folder per type."""
    path = scratch_dir(spark, "sizes")
    fx.table(spark, sf_dir, "events").select("event_type", "props").write.partitionBy("event_type").text(path)
    return rounded(telemetry.stored_size(spark, path), "size_mb")


@query
def file_profile(spark, sf_dir):
    return rounded(profile.file_profile(fx.file_rows(spark, sf_dir)), "sample_min", "sample_max", "sample_mean")


@query
def profile_consistency(spark, sf_dir):
    return profile.profile_consistency(profile.file_profile(fx.file_rows(spark, sf_dir)))


@query
def weight_drift(spark, sf_dir):
    drift = tracking.weight_drift(fx.weights(spark, sf_dir), threshold=0.1)
    return rounded(drift, "actual_std", "expected_std", "relative_deviation")


@query
def process_rollup(spark, sf_dir):
    rolled = telemetry.process_rollup(fx.process_samples(spark, sf_dir), cores=8, ram_bytes=64e9)
    rolled = rounded(rolled, "ram_percent", places=10)
    return rounded(rolled, "cpu_percent", "ram_gb").withColumn("ram_bytes", F.round("ram_bytes", 3))


# --- ordered operators -----------------------------------------------------------


@query
def log_norm(spark, sf_dir):
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    view = spectral.cell_view(spectral.log_normalise(obs, FULL), FULL)
    return view.select("cadence_id", "obs", "t", "f", r6("v").alias("v"))


SNIPPET, OVERLAP = 6, 0.5


@query
def overlap_snippets(spark, sf_dir):
    """Every snippet of every valid observation, cell by cell."""
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    cut = spectral.overlap_snippets(obs, FULL, SNIPPET, OVERLAP)
    cells = cut.select("cadence_id", "obs", "start_index", F.posexplode_outer("cells").alias("cell", "v"))
    return cells.select("cadence_id", "obs", "start_index", F.col("cell").cast("bigint").alias("cell"), r6("v").alias("v"))


@query
def cadence_snippets(spark, sf_dir):
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS)
    cut = spectral.overlap_snippets(obs, FULL, 8, 0.5)
    return cut.select("cadence_id", "obs", "start_index", *digest())


def _indexed_events(spark, sf_dir) -> DataFrame:
    ids = fx.table(spark, sf_dir, "events").select("event_id")
    return indexing.dense_index(ids, "event_id")


@query
def split_trim(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return indexing.split_trim(
        _indexed_events(spark, sf_dir),
        indexing.row_count(events),
        train_fraction=0.8,
        train_batch=128,
        val_batch=96,
    )


@query
def batch_assign(spark, sf_dir):
    return indexing.assign_batches(_indexed_events(spark, sf_dir), 2048, 128)


@query
def epoch_shuffle(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "events").select("event_id")
    return indexing.epoch_shuffle(ids, "event_id", epoch=3, seed=11).orderBy("shuffle_pos")


@query
def difficulty_schedule(spark, sf_dir):
    """SNR ranges of all three schedules for each sample's round."""
    plan = fx.table(spark, sf_dir, "events").selectExpr("event_id as sample_idx", "event_id % 20 as round_idx")
    cur = Curriculum()
    return plan.select(
        "sample_idx",
        "round_idx",
        F.lit(cur.snr_base).cast("bigint").alias("snr_base"),
        *[
            generation.difficulty(F.col("round_idx"), s, cur).alias(f"{s}_range")
            for s in ("linear", "exponential", "step")
        ],
    )


@query
def lr_plateau(spark, sf_dir):
    out = tracking.plateau(fx.losses(spark, sf_dir))
    return out.withColumn("lr", F.round("lr", 12))


@query
def latest_tag(spark, sf_dir):
    pairs = tracking.artifact_pairs(tracking.parse_artifacts(fx.registry(spark, sf_dir)))
    latest = tracking.latest_tag(pairs)
    return latest.withColumn("version", F.coalesce("version", F.lit(-1).cast("bigint")))


SERIES_START = 1704067200.0  # 2024-01-01 00:00:00 UTC


@query
def telemetry_series(spark, sf_dir):
    return telemetry.telemetry_series(fx.telemetry(spark, sf_dir), SERIES_START)


@query
def device_metric_pivot(spark, sf_dir):
    series = telemetry.telemetry_series(fx.telemetry(spark, sf_dir), SERIES_START)
    hourly = series.withColumn("minutes", F.floor(F.col("minutes") / 360) * 360)
    return rounded(telemetry.device_metric_pivot(hourly), "utilization", "memory", places=10)


# --- sorts, limits, set operations -----------------------------------------------


@query
def detections_ranked(spark, sf_dir):
    return rounded(cadence.rank_detections(_detections(spark, sf_dir, 4)), "frequency_MHz", "confidence")


@query
def target_limit(spark, sf_dir):
    """The first half of the cadences: a limit that follows the size of the table."""
    obs = fx.observations(spark, sf_dir)
    half = obs.select("cadence_id").distinct().count() // 2
    kept = clean.limit_cadences(obs, half, GEO)
    return kept.select("cadence_id", "obs", "source_file", "row_idx")


@query
def class_mix(spark, sf_dir):
    return _plan(spark, sf_dir).groupBy("split_set", "chunk", "class").agg(F.count(F.lit(1)).alias("samples"))


@query
def labelled_union(spark, sf_dir):
    whole = _cadence_latents(spark, sf_dir)
    both = features.labelled_union(whole.where("is_true"), whole.where("not is_true"))
    return both.select("cadence_id", "label", r6(arrays.array_sum(F.flatten("zs"))).alias("total"))


@query
def combine_bands(spark, sf_dir):
    """Bands stored apart, in a folder each, and read again as one table."""
    path = scratch_dir(spark, "bands")
    found = _detections(spark, sf_dir, 4)
    found.write.partitionBy("band").parquet(path)
    again = spark.read.schema(found.schema).parquet(path).select(*found.columns)
    return rounded(cadence.combine_bands([again]), "frequency_MHz", "confidence")


@query
def merge_stores(spark, sf_dir):
    """Two hosts' overlapping copies of the telemetry."""
    rows = fx.telemetry(spark, sf_dir).select(
        "ts_unix", "resource_type", "resource_name", "tag", F.lit("host").alias("host"), "value", "unit", "metadata"
    )
    keys = ("ts_unix", "resource_type", "resource_name", "tag", "host")
    return rounded(telemetry.merge_stores(rows, rows, keys=keys), "ts_unix")


# --- training-set generation -----------------------------------------------------


@query
def injection_params(spark, sf_dir):
    plan = fx.table(spark, sf_dir, "events").selectExpr(
        "event_id as sample_idx", "'concatenated' as split_set", "'true_single' as class"
    )
    params = generation.draw_params(plan, FULL, seed=SEED)
    return params.select(
        "sample_idx",
        r6("background_u").alias("background_u"),
        r6("snr").alias("snr"),
        F.col("track1.start_bin").alias("start_bin"),
        F.col("track1.direction").alias("direction"),
        *[r6(f"track1.{c}").alias(c) for c in ("slope_pixel", "drift_hz_s", "width_hz", "intercept")],
    )


@query
def class_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("split_set", "sample_idx", "chunk", "class")


def on_off_generator():
    """A user's generator: ON observations of a true sample are doubled, and numbered within the chunk."""
    seen = 0

    def generate(sample, obs):
        nonlocal seen
        seen += 1
        factor = 2.0 if sample["class"].startswith("true") else 1.0
        for number, cells in enumerate(obs):
            yield cells * (factor if number % 2 == 0 else 1.0) + seen

    return generate


@query
def generate_plugged(spark, sf_dir):
    """The plan's samples made by a user's generator from given backgrounds, taken in turn."""
    stored = _backgrounds(spark, sf_dir)
    numbered = generation.index_backgrounds(stored).select("cadence_id", "background_idx")
    backgrounds = stored.join(numbered, "cadence_id").select("background_idx", "obs_cells")
    n = stored.count()
    plan = _plan(spark, sf_dir).where("split_set = 'true'")
    planned = plug.planned_backgrounds(plan, backgrounds, F.pmod("sample_idx", F.lit(n)))
    made = plug.generate_with(planned, on_off_generator)
    return made.select("class", "sample_idx", "background_idx", F.col("nth").cast("bigint").alias("obs"), *digest())


@query
def augment_tracks(spark, sf_dir):
    """One track through all six observations of each valid cadence, not normalised."""
    whole = fx.backgrounds(spark, sf_dir)
    snr = uniform("cadence_id", generation.SNR_DRAW, SEED) * 40.0 + 10.0
    stacks = whole.select("cadence_id", F.flatten("obs_cells").alias("cells"), snr.alias("snr"))
    tracked = generation.with_track(stacks, "cadence_id", str(SEED), FULL, into="track")
    stacked = F.expr(generation.add_track_sql("cells", "track", "snr", FULL))
    return tracked.select("cadence_id", F.posexplode_outer(stacked).alias("cell", "v")).select(
        "cadence_id", F.col("cell").cast("bigint").alias("cell"), r6("v").alias("v")
    )


def _generated(spark, sf_dir, kind: str) -> DataFrame:
    params = generation.draw_params(_plan(spark, sf_dir, kind), FULL, seed=SEED)
    return _built(spark, sf_dir, params)


def _built(spark, sf_dir, params: DataFrame) -> DataFrame:
    samples = fx.samples(spark, sf_dir).count()
    parts = generation.generation_partitions(spark, 2 * samples, FULL)
    built = generation.build_samples(params, _backgrounds(spark, sf_dir), FULL, partitions=parts)
    return built.select("class", "sample_idx", "background_idx", "obs", *digest())


@query
def gen_false(spark, sf_dir):
    """Background alone, and with a track in all observations: both for every sample."""
    both = [_plan(spark, sf_dir, kind) for kind in generation.CLASSES[:2]]
    params = generation.draw_params(tracking.union_all(both), FULL, seed=SEED)
    return _built(spark, sf_dir, params)


@query
def gen_true_single(spark, sf_dir):
    return _generated(spark, sf_dir, "true_single")


@query
def gen_true_double(spark, sf_dir):
    return _generated(spark, sf_dir, "true_double")


@query
def generate_batch(spark, sf_dir):
    return _batch(spark, sf_dir).select(
        "split_set", "class", "sample_idx", "background_idx", "obs", *digest()
    )


# --- features, models, scoring ---------------------------------------------------


@query
def cadence_features(spark, sf_dir):
    whole = features.cadence_features(fx.latents(spark, sf_dir), fx.N_OBS)
    cells = whole.select("cadence_id", F.posexplode_outer("features").alias("feature", "v"))
    return cells.select("cadence_id", F.col("feature").cast("bigint").alias("feature"), r6("v").alias("v"))


def _labelled_vectors(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "cast(embedding as array<double>) as features",
        "if(label < 5, 1D, 0D) as label",
    )


def _fitted(spark, sf_dir) -> forest.Forest:
    """The forest of the default size, 1000 trees of any depth, on four fifths of the vectors."""
    return forest.fit_forest(_labelled_vectors(spark, sf_dir).where("vec_id % 5 <> 0"), ForestParams())


@query
def rf_fit(spark, sf_dir):
    """Every feature's importance."""
    return rounded(forest.importances(spark, _fitted(spark, sf_dir)), "importance", places=12)


@query
def rf_score(spark, sf_dir):
    """Every vector scored by a forest fitted on four fifths of them."""
    scored = forest.forest_predict(_fitted(spark, sf_dir), _labelled_vectors(spark, sf_dir))
    held_out = (F.col("vec_id") % 5 == 0).alias("held_out")
    return scored.select("vec_id", "label", held_out, r6("p").alias("p"), "prediction", r6("confidence").alias("confidence"))


@query
def forest_split(spark, sf_dir):
    """The first split of a tree over all vectors and features, in tenths: its threshold, gain and both leaves."""
    tenths = F.transform("embedding", lambda x: F.floor(x * 10).cast("double"))
    rows = fx.table(spark, sf_dir, "embeddings").select(tenths.alias("features"), F.expr("if(label < 5, 1D, 0D)").alias("label"))
    par = ForestParams(n_trees=1, max_depth=1, bootstrap=False, feature_subset="all")
    nodes = forest.fit_forest(rows, par).nodes
    return rounded(nodes.selectExpr("node", "feature", "threshold", "p", "weight", "gain"), "p", "gain")


WALK_NODES = 15


@query
def forest_walk(spark, sf_dir):
    """Every vector scored by a forest given as a table: each ``WALK_NODES`` vectors are the nodes of a tree.

    A node tests one cell of the vectors against its own; a leaf says its vector's label in tenths.
    """
    inner = WALK_NODES // 2
    table = fx.table(spark, sf_dir, "embeddings")
    n_trees = table.where(f"vec_id % {WALK_NODES} = {WALK_NODES - 1}").count()
    nodes = table.selectExpr(
        f"cast(vec_id div {WALK_NODES} as int) as tree", f"cast(vec_id % {WALK_NODES} as int) as node", "cast(vec_id * 7 % 64 as int) as cell",
        "embedding", "label / 10D as p",
    ).where(f"tree < {n_trees}").selectExpr(
        "tree", "node", f"if(node < {inner}, cell, -1) as feature", "cast(embedding[cell] as double) as threshold",
        f"if(node < {inner}, 2 * node + 1, -1) as left", f"if(node < {inner}, 2 * node + 2, -1) as right", "p", "1D as weight", "0D as gain",
    )
    rows = table.selectExpr("vec_id", "cast(embedding as array<double>) as features")
    return rounded(forest.forest_scores(forest.Forest(nodes, 64, n_trees), rows).select("vec_id", "p"), "p")


EMBEDDED = 3


@query
def embed_observations(spark, sf_dir):
    """The latent of every valid observation along the directions of the largest variance."""
    obs = spectral.downsample(clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS), GEO)
    model = embed.fit_embedding(obs, k=EMBEDDED)
    latents = embed.embed(model, obs)
    return latents.select("cadence_id", "obs", *[r6(F.col("z")[i], 5).alias(f"z{i + 1}") for i in range(EMBEDDED)])


def linear_model():
    """Mean of all values, weighted by position: stands in for a user's model."""

    def predict(batch: np.ndarray) -> np.ndarray:
        values = batch.astype(np.float64)
        return values @ np.arange(1, values.shape[1] + 1, dtype=np.float64) / values.shape[1]

    return predict


@query
def batch_score(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("cells"))
    return rounded(embed.batch_score(vectors, linear_model, 64).select("vec_id", "p"), "p")


@query
def band_scan(spark, sf_dir):
    """Each cadence is a band; a snippet's score is five times its mean."""
    obs = clean.valid_cadences(fx.observations(spark, sf_dir), fx.N_OBS).withColumn("band", F.col("cadence_id"))
    scorer = lambda df: df.withColumn(
        "p", arrays.array_sum(F.col("cells")) / F.size("cells") * 5
    )
    found = cadence.band_scan(obs, FULL, scorer, size=8, overlap=0.5)
    return rounded(cadence.rank_detections(found), "frequency_MHz", "confidence")


@query
def reparam_sample(spark, sf_dir):
    drawn = features.reparam_sample(fx.latents(spark, sf_dir))
    cells = drawn.select("cadence_id", "obs", F.posexplode_outer("sample").alias("dim", "v"))
    return cells.select("cadence_id", "obs", F.col("dim").cast("bigint").alias("dim"), r6("v").alias("v"))


# --- text ------------------------------------------------------------------------


@query
def metadata_json(spark, sf_dir):
    """Metadata text with sorted keys, and a number parsed back out of the stored JSON."""
    built = text.metadata_json(
        user_name=F.concat(F.lit("user_"), F.col("user_id")),
        machine_name=F.col("event_type"),
        ip_address=F.concat(F.lit("10.0.0."), F.col("user_id") % 256),
    )
    return fx.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        built.alias("metadata"),
        F.from_json("props", "k bigint")["k"].alias("k"),
    )


@query
def pattern_string(spark, sf_dir):
    """Pattern of every group with a positive, dropped ones included."""
    grouped = cadence.cadence_patterns(fx.scores(spark, sf_dir, 4), fx.N_OBS)
    return grouped.select("band", "start_index", text.pattern_string(F.col("pattern")).alias("observation_pattern"))


@query
def tag_parse(spark, sf_dir):
    tags = tracking.parse_artifacts(fx.registry(spark, sf_dir)).withColumn("r", text.tag_rank("tag"))
    return tags.groupBy(
        "tag",
        F.col("r.rank").cast("bigint").alias("rank"),
        F.coalesce("r.version", F.lit(-1).cast("bigint")).alias("version"),
    ).agg(F.count(F.lit(1)).alias("files"))


# --- streams ---------------------------------------------------------------------


def _event_stream(spark, sf_dir, columns: tuple[str, ...]) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    return streams.read_stream(spark, f"{sf_dir}/events*.parquet", schema).selectExpr(*columns)


@query
def stream_ingest(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    columns = tuple(c for c in fx.TELEMETRY_COLUMNS if c != "ts")
    rows = _event_stream(spark, sf_dir, columns)
    streams.drain(streams.ingest(rows, f"{root}/data", f"{root}/checkpoint", once=True))
    return rounded(spark.read.schema(rows.schema).parquet(f"{root}/data"), "ts_unix")


FLUSHES = 8


@query
def stream_ingest_flush(spark, sf_dir):
    """The flushes of the events, each an eighth of them: which rows went together."""
    root, events = scratch_dir(spark, "flush"), fx.table(spark, sf_dir, "events")
    # files whose names are in order, as the rows came in, each of a task
    events.orderBy("event_id").write.parquet(f"{root}/in")
    rows = max(1, -(-events.count() // FLUSHES))
    query = flush.ingest_in_flushes(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", rows=rows, seconds=0, order="name")
    flush.drain_flushes(query)
    stored = spark.read.parquet(f"{root}/out")
    return stored.groupBy(F.col("batch_id").cast("bigint").alias("flush")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), r6(F.sum("value")).alias("total")
    )


@query
def stream_route(spark, sf_dir):
    root = scratch_dir(spark, "route")
    rows = _event_stream(spark, sf_dir, fx.QUEUE_COLUMNS)
    streams.drain(streams.route(rows, f"{root}/data", f"{root}/checkpoint", once=True))
    return _route_summary(spark.read.parquet(f"{root}/data"))


TIMED_COLUMNS = tuple("cast(ts as timestamp) as ts" if c == "ts" else c for c in fx.TELEMETRY_COLUMNS)


def _newest_first(spark, sf_dir, columns: tuple[str, ...], root: str) -> DataFrame:
    """The events as a stream of files, the newest first and one to a micro-batch."""
    rows = fx.table(spark, sf_dir, "events").selectExpr(*columns)
    whole = fx.table(spark, sf_dir, "events")
    last = whole.agg(F.max("event_id")).first()[0] or 0
    arrival = F.floor((last - F.col("event_id")) * ARRIVALS / F.lit(last + 1)).cast("int")
    folder = f"{root}/arrivals"
    whole.withColumn("arrival", arrival).repartition("arrival").write.partitionBy("arrival").parquet(folder)
    stream = streams.read_stream(spark, f"{folder}/arrival=*", whole.schema, files_per_batch=1)
    return stream.selectExpr(*columns).select(*rows.columns)


ARRIVALS = 3


@query
def stream_series(spark, sf_dir):
    root = scratch_dir(spark, "series")
    rows = _newest_first(spark, sf_dir, TIMED_COLUMNS, root)
    streams.drain(streams.write_series(rows, f"{root}/data", f"{root}/checkpoint", once=True))
    return rounded(streams.metric_series(spark, f"{root}/data", f"{root}/checkpoint"), "mean_value", "max_value")


@query
def stream_dedup(spark, sf_dir):
    """Two hosts' overlapping streams, the newest rows first, each kept once."""
    root = scratch_dir(spark, "dedup")
    both = _newest_first(spark, sf_dir, TIMED_COLUMNS, f"{root}/a").unionByName(
        _event_stream(spark, sf_dir, TIMED_COLUMNS)
    )
    keys = ("ts", "resource_type", "resource_name", "tag")
    streams.drain(streams.dedup(both, f"{root}/data", f"{root}/checkpoint", keys, once=True))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema)
    stored = streams.deduplicated(spark, f"{root}/data", schema)
    return rounded(stored, "ts_unix").select("id", "ts_unix", "resource_type", "resource_name", "value", "tag")


@query
def stream_plateau(spark, sf_dir):
    root = scratch_dir(spark, "plateau")
    rows = _newest_first(spark, sf_dir, fx.LOSS_COLUMNS, root)
    streams.drain(stream_state.write_plateau(rows, f"{root}/data", f"{root}/checkpoint", once=True))
    return stream_state.stream_plateau(spark, f"{root}/data").withColumn("lr", F.round("lr", 12))
