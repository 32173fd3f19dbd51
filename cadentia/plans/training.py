"""Training: load backgrounds, generate rounds, fit the cadence classifier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.geometry import Geometry
from cadentia.ml import embed, forest
from cadentia.ml.embed import Embedding
from cadentia.ml.forest import Forest
from cadentia.operators import clean, features, generation, indexing
from cadentia.session import materialise
from cadentia.settings import Curriculum, ForestParams, Injection, LoadLimits, SplitSizes
from cadentia.sources.npy import headers, qualified, read_backgrounds


def load_background_files(
    spark: SparkSession,
    paths: list[str],
    geo: Geometry = Geometry(),
    *,
    subsets: Mapping[str, tuple[int | None, int | None]] | None = None,
    limits: LoadLimits = LoadLimits(),
) -> DataFrame:
    """Background files -> stored table of valid, downsampled cadences.

    Subset and cap prune before reading; the reader drops invalid cadences and takes
    the block mean, so raw cells never leave the task that reads them. The target
    counts valid rows, and files beyond those that it needs are not opened.
    """
    read = lambda files: read_backgrounds(
        spark, files, n_obs=geo.n_obs, factor=geo.factor, subsets=subsets, rows_per_file=limits.rows_per_file
    )
    if limits.target is None:
        stored = materialise(read(paths), "cadences")
    else:
        stored = _first_valid(spark, read, paths, limits.target)
    if stored is None or stored.isEmpty():
        raise ValueError("no valid background was loaded")
    return stored


def _first_valid(spark: SparkSession, read, paths: list[str], target: int) -> DataFrame | None:
    """The first ``target`` valid cadences in file order, from no more files than they need, or nearly so.

    Files are read and stored a run of them at a time until the stored ones are enough. How many
    files the next run has follows from the valid rows that a file had so far; the first has one.
    """
    stored, found, done, run = None, 0, 0, 1
    while found < target and done < len(paths):
        files = paths[done : done + run]
        done += len(files)
        if headers(spark, files).where("fault IS NULL").isEmpty():
            run *= 2
            continue
        more = materialise(read(files), "cadences")
        found += more.count()
        stored = more if stored is None else stored.unionByName(more)
        missing = target - found
        run = max(1, min(2 * done, -(-missing * done // found) if found else 2 * run))
    return None if stored is None else clean.first_cadences(stored, target, [qualified(spark, p) for p in paths[:done]])


def training_round(
    backgrounds: DataFrame,
    round_idx: int,
    n_samples: int,
    geo: Geometry,
    *,
    seed: int,
    schedule: str = "exponential",
    cur: Curriculum = Curriculum(),
    par: Injection = Injection(),
) -> DataFrame:
    """One round's balanced sets at the round's difficulty. ``geo`` is the downsampled shape."""
    samples = backgrounds.sparkSession.range(n_samples).select(
        F.col("id").alias("sample_idx"), F.lit(round_idx).cast("bigint").alias("round_idx")
    )
    staged = generation.with_difficulty(samples, schedule, cur)
    return generation.generate_batch(
        staged, backgrounds, geo, seed=seed * cur.total_rounds + round_idx, par=par, precision="float"
    )


def train_and_validation(batch: DataFrame, n_samples: int, sizes: SplitSizes = SplitSizes()) -> DataFrame:
    """Adds ``part`` (train, val) by sample position."""
    return indexing.split_trim(
        batch,
        F.lit(n_samples),
        train_fraction=sizes.train_fraction,
        train_batch=sizes.train_batch,
        val_batch=sizes.val_batch,
        index="sample_idx",
    )


def labelled_features(batch: DataFrame, embedding: Embedding, n_obs: int) -> DataFrame:
    """Latents of the ``true`` and ``false`` sets, regrouped per cadence and labelled."""
    latents = embed.embed(embedding, batch.where(F.col("split_set") != "concatenated")).select(
        "split_set", "sample_idx", "obs", "z"
    )

    def part(name: str) -> DataFrame:
        chosen = latents.where(F.col("split_set") == name).withColumnRenamed("sample_idx", "cadence_id")
        return features.cadence_features(chosen, n_obs, strict=True)

    return features.labelled_union(part("true"), part("false"))


def fit_classifier(
    batch: DataFrame, n_obs: int, *, latent_dim: int = 8, par: ForestParams = ForestParams()
) -> tuple[Embedding, Forest]:
    """Embedding from the mixed set, forest from the labelled sets of a stored batch."""
    embedding = embed.fit_embedding(batch.where(F.col("split_set") == "concatenated"), latent_dim)
    labelled = materialise(labelled_features(batch, embedding, n_obs), "features")
    return embedding, forest.fit_forest(labelled, par)


def evaluate(labelled: DataFrame, model: Forest, threshold: float = 0.5) -> DataFrame:
    """True and false positive rate and accuracy on labelled features."""
    return features.eval_metrics(forest.forest_predict(model, labelled, threshold))
