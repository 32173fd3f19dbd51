"""Training history, learning-rate plateaus, losses and model artifacts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadentia.functions.text import ARTIFACT_PATTERN, TAG_RANKS, tag_rank
from cadentia.settings import Plateau

# The series of a training history.
HISTORY_SERIES = (
    "loss",
    "reconstruction_loss",
    "kl_loss",
    "true_loss",
    "false_loss",
    "val_loss",
    "val_reconstruction_loss",
    "val_kl_loss",
    "val_true_loss",
    "val_false_loss",
    "learning_rate",
)


def history_long(history: DataFrame, series: tuple[str, ...] = HISTORY_SERIES) -> DataFrame:
    """One row per epoch and series."""
    return history.unpivot("epoch", list(series), "series", "value")


def epoch_losses(steps: DataFrame, losses: tuple[str, ...] = ("loss",)) -> DataFrame:
    """Mean of the sub-steps of each step, then mean of the steps: not one flat mean."""
    per_step = steps.groupBy("epoch", "step").agg(*[F.avg(c).alias(c) for c in losses])
    return per_step.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("steps"), *[F.avg(c).alias(c) for c in losses]
    )


class PlateauFold:
    """The rule's state along the epochs of a round."""

    __slots__ = ("par", "best", "misses", "lr")

    def __init__(self, par: Plateau, best: float | None = None, misses: int | None = None, lr: float | None = None):
        self.par = par
        self.best = math.inf if best is None else best
        self.misses = misses or 0
        self.lr = par.base_lr if lr is None else lr

    def step(self, loss: float | None) -> tuple[int, float]:
        """Misses and rate after one more epoch."""
        par = self.par
        if self.lr > par.min_lr:
            if loss is not None and loss < self.best * (1 - par.min_improvement):
                self.best, self.misses = loss, 0
            else:
                self.misses += 1
            if self.misses >= par.patience:
                self.lr, self.misses = max(self.lr * (1 - par.reduction), par.min_lr), 0
        return self.misses, self.lr


def plateau(
    losses: DataFrame, par: Plateau = Plateau(), keys: tuple[str, ...] = ("tag", "round"), start: DataFrame | None = None
) -> DataFrame:
    """Learning rate and miss count after each epoch of every round.

    An epoch improves if its loss is below ``best * (1 - min_improvement)``; after
    ``patience`` epochs without one the rate shrinks, down to a floor at which the
    state freezes. An epoch below 0 or given twice is an error.

    A segmented scan: rounds share tasks, and each task passes once over its rows in order,
    with one round's state carried along, so many short rounds cost no more than their rows
    and a long one needs no more memory. ``start(keys, best, misses, lr)`` has the state
    that a round goes on from.
    """
    slim = losses.select(*keys, F.col("epoch").cast("bigint").alias("epoch"), F.col("val_loss").cast("double").alias("val_loss"))
    state = ["best", "misses", "lr"]
    if start is not None:
        slim = slim.join(start.select(*keys, *[F.col(c).alias(f"_{c}") for c in state]), list(keys), "left")
    else:
        slim = slim.select("*", *[F.lit(None).cast(t).alias(f"_{c}") for c, t in zip(state, ("double", "bigint", "double"), strict=True)])
    ordered = slim.repartition(*keys).sortWithinPartitions(*keys, "epoch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, now, last = None, None, -1
        for batch in batches:
            cells = [batch.column(c).to_pylist() for c in (*keys, "epoch", "val_loss", "_best", "_misses", "_lr")]
            misses, rates = [], []
            for *key, epoch, loss, best, missed, lr in zip(*cells, strict=True):
                if key != now:
                    now, last, fold = key, -1, PlateauFold(par, best, missed, lr)
                if epoch is None or epoch < 0:
                    raise ValueError("epoch lies outside the round")
                if epoch == last:
                    raise ValueError("an epoch has two losses")
                last = epoch
                m, r = fold.step(loss)
                misses.append(m)
                rates.append(r)
            kept = [batch.column(c) for c in (*keys, "epoch", "val_loss")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(misses, pa.int64()), pa.array(rates, pa.float64())], [*keys, "epoch", "val_loss", "misses", "lr"]
            )

    kinds = dict(ordered.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, "epoch", "val_loss"))
    return ordered.mapInArrow(run, f"{schema}, misses bigint, lr double")


def parse_artifacts(registry: DataFrame, path: str = "path") -> DataFrame:
    """``vae_encoder_<tag>.keras`` -> ``(kind, tag)``; other files are left out."""
    name = F.col(path)
    return registry.where(name.rlike(ARTIFACT_PATTERN)).select(
        "*",
        F.regexp_extract(name, ARTIFACT_PATTERN, 1).alias("kind"),
        F.regexp_extract(name, ARTIFACT_PATTERN, 2).alias("tag"),
    )


def artifact_pairs(artifacts: DataFrame, keys: tuple[str, ...] = ("family",)) -> DataFrame:
    """Tags that have both an encoder and a decoder: one aggregate, no join."""
    has = lambda kind: F.bool_or(F.col("kind") == kind)
    return (
        artifacts.groupBy(*keys, "tag")
        .agg(has("encoder").alias("_enc"), has("decoder").alias("_dec"))
        .where(F.col("_enc") & F.col("_dec"))
        .select(*keys, "tag")
    )


def latest_tag(pairs: DataFrame, keys: tuple[str, ...] = ("family",)) -> DataFrame:
    """The newest tag of each family: best form first, then highest version, then text.

    A maximum over a sort key, combined map-side, instead of a ranking window. A
    family with no recognised tag has no row.
    """
    ranked = pairs.withColumn("_r", tag_rank("tag"))
    order = F.struct(-F.col("_r.rank"), F.coalesce(F.col("_r.version"), F.lit(0)), F.col("tag"))
    best = F.max_by(F.struct("tag", "_r"), order)
    return ranked.groupBy(*keys).agg(best.alias("_b")).select(
        *keys,
        F.col("_b.tag").alias("tag"),
        F.col("_b._r.rank").cast("bigint").alias("rank"),
        F.col("_b._r.version").alias("version"),
    ).where(F.col("rank") < TAG_RANKS["other"])


def weight_drift(weights: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Standard deviation per layer against what its initialiser would give.

    ``weights`` has one row per weight vector: ``layer, initializer, fan_in, fan_out,
    values``. The vectors are unnested inside the partial aggregate, so the shuffle
    carries one small row per layer and task. Layers with another initializer have
    no expectation and are left out.
    """
    fan = F.when(F.col("initializer") == "he_normal", F.col("fan_in")).when(
        F.col("initializer") == "glorot_normal", F.col("fan_in") + F.col("fan_out")
    )
    unnested = weights.withColumn("_fan", fan).where(F.col("_fan").isNotNull()).select(
        "layer", "_fan", F.explode("values").alias("_v")
    )
    stats = unnested.groupBy("layer").agg(
        F.stddev_pop(F.col("_v").cast("double")).alias("actual_std"),
        F.sqrt(F.lit(2.0) / F.max("_fan")).alias("expected_std"),
    )
    deviation = F.abs(F.col("actual_std") - F.col("expected_std")) / F.col("expected_std")
    return stats.withColumn("relative_deviation", deviation).withColumn(
        "drifted", F.col("relative_deviation") > threshold
    )


def looks_trained(weights: DataFrame, threshold: float = 0.2) -> DataFrame:
    """True if any layer drifted from its initialiser."""
    return weight_drift(weights, threshold).agg(F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("trained"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
