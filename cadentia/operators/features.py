"""Latent vectors regrouped per cadence, and scores over observation pairs."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadentia.functions import arrays
from cadentia.operators.clean import assemble_cadences
from cadentia.settings import LossWeights


def cadence_latents(latents: DataFrame, n_obs: int, value: str = "z", extra: tuple = (), strict: bool = False) -> DataFrame:
    """``zs``: the cadence's latents in observation order; incomplete cadences drop out, or fail the job if ``strict``."""
    return assemble_cadences(latents, n_obs, value, into="zs", extra=extra, strict=strict)


def require_complete(latents: DataFrame, n_obs: int) -> DataFrame:
    """One row, or an error when the number of latents is no multiple of ``n_obs``."""
    rows = F.count(F.lit(1))
    fault = F.raise_error(F.lit(f"number of latents is not a multiple of {n_obs}")).cast("bigint")
    return latents.agg(F.when(rows % n_obs != 0, fault).otherwise(rows / n_obs).cast("bigint").alias("cadences"))


def cadence_features(latents: DataFrame, n_obs: int, value: str = "z", extra: tuple = (), strict: bool = False) -> DataFrame:
    """``features``: all latents of a cadence, concatenated in observation order.

    What a classifier is given must be whole: with ``strict`` an incomplete cadence fails the job.
    """
    whole = cadence_latents(latents, n_obs, value, extra, strict)
    return whole.withColumn("features", F.flatten("zs")).drop("zs")


def labelled_union(true: DataFrame, false: DataFrame) -> DataFrame:
    return true.withColumn("label", F.lit(1.0)).unionByName(false.withColumn("label", F.lit(0.0)))


def _pairs(n_obs: int) -> list[tuple[int, int]]:
    return list(combinations(range(n_obs), 2))


def _same(a: int, b: int) -> bool:
    return a % 2 == b % 2


def latent_pairs(latents: DataFrame, n_obs: int) -> DataFrame:
    """Every observation pair of a cadence with its squared distance.

    The pairs are a fixed list over one assembled row (15 for six observations), so
    there is no self-join; pairs of one kind weigh 2.
    """
    listed = ", ".join(
        f"""named_struct('obs_a', {a}L, 'obs_b', {b}L,
            'kind', '{"same" if _same(a, b) else "cross"}',
            'weight', {2 if _same(a, b) else 1}L,
            'distance', {arrays.squared_distance_sql(f"zs[{a}]", f"zs[{b}]")})"""
        for a, b in _pairs(n_obs)
    )
    return cadence_latents(latents, n_obs).selectExpr("cadence_id", f"inline_outer(array({listed}))")


Measure = Callable[[str, str], str]


def pair_means(latents: DataFrame, n_obs: int, measure: Measure, into: str) -> DataFrame:
    """Mean of ``measure`` per observation pair: one global aggregate, then 15 rows."""
    means = [
        F.expr(f"avg({measure(f'zs[{a}]', f'zs[{b}]')})").alias(f"_m{a}_{b}") for a, b in _pairs(n_obs)
    ]
    listed = ", ".join(
        f"named_struct('obs_a', {a}L, 'obs_b', {b}L, '{into}', _m{a}_{b})" for a, b in _pairs(n_obs)
    )
    return cadence_latents(latents, n_obs).agg(*means).selectExpr(f"inline_outer(array({listed}))")


def pair_distance(latents: DataFrame, n_obs: int) -> DataFrame:
    return pair_means(latents, n_obs, arrays.squared_distance_sql, "mean_distance")


def pair_inverse_distance(latents: DataFrame, n_obs: int) -> DataFrame:
    return pair_means(latents, n_obs, arrays.inverse_distance_sql, "mean_inverse_distance")


def _total(n_obs: int, cross: Measure) -> Column:
    """Pair means of ``zs`` summed: same-kind pairs twice, ON-OFF pairs once."""
    terms = [
        f"2D * avg({arrays.squared_distance_sql(f'zs[{a}]', f'zs[{b}]')})"
        if _same(a, b)
        else f"avg({cross(f'zs[{a}]', f'zs[{b}]')})"
        for a, b in _pairs(n_obs)
    ]
    return F.expr(" + ".join(terms))


def separation_true(n_obs: int) -> Column:
    """Aggregate over assembled latents of a signal set: ON and OFF each close
    together, and far from one another."""
    return _total(n_obs, arrays.inverse_distance_sql)


def separation_false(n_obs: int) -> Column:
    """Aggregate over assembled latents of a background set: all close together."""
    return _total(n_obs, arrays.squared_distance_sql)


def kl_divergence(latents: DataFrame, mean: str = "z", log_var: str = "log_var") -> DataFrame:
    return latents.agg(F.avg(arrays.kl_term(F.col(mean), F.col(log_var))).alias("kl"))


def reconstruction_bce(pairs: DataFrame, width: int, target: str = "target", predicted: str = "predicted") -> DataFrame:
    """Cross-entropy: mean over frequency, sum over observations and time, mean over cadences.

    Sums per row, then per cadence, then the mean: not one flat average.
    """
    per_row = pairs.select(
        "cadence_id", (arrays.cross_entropy(F.col(target), F.col(predicted)) / width).alias("_e")
    )
    return (
        per_row.groupBy("cadence_id").agg(F.sum("_e").alias("_e")).agg(F.avg("_e").alias("reconstruction"))
    )


def composite_loss(
    reconstruction: DataFrame, kl: DataFrame, true: DataFrame, false: DataFrame, weights: LossWeights = LossWeights()
) -> DataFrame:
    """Total and parts, from four one-row tables joined as scalar subqueries."""
    parts = reconstruction.select(
        F.col("reconstruction"),
        kl.select("kl").scalar().alias("kl"),
        true.select("true_loss").scalar().alias("true_loss"),
        false.select("false_loss").scalar().alias("false_loss"),
    )
    return parts.withColumn(
        "total",
        F.col("reconstruction")
        + F.col("kl") * weights.beta
        + (F.col("true_loss") + F.col("false_loss")) * weights.alpha,
    )


def reparam_sample(latents: DataFrame, mean: str = "z", log_var: str = "log_var", eps: str = "eps") -> DataFrame:
    return latents.withColumn("sample", arrays.reparameterise(F.col(mean), F.col(log_var), F.col(eps)))


def eval_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True and false positive rate and accuracy, in one conditional aggregate."""
    positive, hit = F.col(label) == 1, F.col(prediction) == 1
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return predictions.agg(
        F.avg(F.when(positive, flag(hit))).alias("tpr"),
        F.avg(F.when(~positive, flag(hit))).alias("fpr"),
        F.avg(flag(hit == positive)).alias("accuracy"),
    )
