"""Inference: observation files -> snippets -> scores -> ranked, stored detections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.functions.text import CADENCE_FILE_PATTERN
from cadentia.geometry import Geometry
from cadentia.ml import embed, forest
from cadentia.ml.embed import Embedding
from cadentia.ml.forest import Forest
from cadentia.operators import cadence, clean
from cadentia.session import materialise
from cadentia.settings import DetectionRule
from cadentia.sources import tables
from cadentia.sources.npy import Paths, headers, read_snippets

Scorer = Callable[[DataFrame], DataFrame]


def observation_scorer(embedding: Embedding, model: Forest) -> Scorer:
    """Scores each snippet by a forest over its own latent."""

    def score(snippets: DataFrame) -> DataFrame:
        latents = embed.embed(embedding, snippets, into="features")
        return forest.forest_scores(model, latents)

    return score


def cadence_snippets(
    spark: SparkSession, paths: Paths, geo: Geometry, *, overlap: float = 0.5
) -> DataFrame:
    """Snippets of all complete cadences among the files; the cadence number is the band.

    A cadence is complete if all its files can be read and have one shape: a damaged OFF
    observation must not pass for one without a signal. ``headers`` tells what is skipped.
    """
    listing = headers(spark, paths).where("fault IS NULL")
    shapes = clean.parse_cadence_files(listing).join(listing, "path").groupBy("cadence_id")
    uneven = shapes.agg(F.count_distinct("shape").alias("shapes")).where("shapes > 1")
    whole = clean.complete_cadence_files(listing, geo.n_obs).join(uneven, "cadence_id", "left_anti")
    complete = materialise(whole.select("path"), "complete")
    if complete.isEmpty():
        raise FileNotFoundError("no complete cadence among the files")
    cut = read_snippets(spark, complete, size=geo.out_width, overlap=overlap, factor=geo.factor)
    part = lambda i: F.regexp_extract("path", CADENCE_FILE_PATTERN, i).cast("bigint")
    return cut.select(part(1).alias("band"), part(2).alias("obs"), "start_index", "cells")


def run_inference(
    spark: SparkSession,
    paths: Paths,
    scorer: Scorer,
    out: str,
    geo: Geometry = Geometry(),
    *,
    overlap: float = 0.5,
    rule: DetectionRule = DetectionRule(),
) -> DataFrame:
    """Scan all bands, write the report, and return the counts per class of what was written."""
    scores = scorer(cadence_snippets(spark, paths, geo, overlap=overlap)).select("band", "obs", "start_index", "p")
    tables.write_detections(cadence.rank_detections(cadence.detect(scores, geo, rule)), out)
    return cadence.detection_counts(tables.read_detections(spark, out))
