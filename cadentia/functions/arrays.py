"""Array expressions over flat cell and latent vectors (all JVM-side)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_EPS = 1e-10
DISTANCE_EPS = 1e-8
CLIP_EPS = 1e-7


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times in ``body``.

    Without the binding, projection collapsing may inline a computed array into a
    lambda, where it would be evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def steps(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def array_sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def is_inf(x: Column) -> Column:
    return F.abs(x) == F.lit(math.inf)


def has_nan(xs: Column) -> Column:
    """NaN sorts above every number, so the compiled ``array_max`` finds it."""
    return F.coalesce(F.isnan(F.array_max(xs)), F.lit(False))


def has_inf(xs: Column) -> Column:
    """From the extremes; only a row whose maximum is NaN is searched cell by cell."""
    extremes = (F.array_max(xs) == math.inf) | (F.array_min(xs) == -math.inf)
    return F.when(has_nan(xs), F.exists(xs, is_inf)).otherwise(F.coalesce(extremes, F.lit(False)))


def not_finite(xs: Column) -> Column:
    """Any NaN or infinity."""
    finite = (F.array_max(xs) < math.inf) & (F.array_min(xs) > -math.inf)
    return F.coalesce(~finite, F.lit(False))


def block_mean(cells: Column, n_out: int, factor: int) -> Column:
    """Mean of each run of ``factor`` cells. ``factor`` divides the width, so no run
    crosses from one time row to the next."""
    return let(
        cells,
        lambda c: F.transform(
            steps(n_out), lambda i: array_sum(F.slice(c, i * factor + 1, factor)) / factor
        ),
    )


def log_norm(cells: Column) -> Column:
    """``ln(x + eps)`` shifted to start at 0 and scaled to end at 1.

    ``ln`` is monotone, so its extremes come from the array's extremes and the
    array is transformed only once. A constant array gives zeros. A value the
    logarithm is not defined for makes the whole array NaN.
    """

    def scaled(c: Column) -> Column:
        log = lambda x: F.ln(x + LOG_EPS)
        extremes = F.struct(
            log(F.array_min(c)).alias("lo"), (log(F.array_max(c)) - log(F.array_min(c))).alias("span")
        )
        return let(
            extremes,
            lambda e: F.transform(
                c,
                lambda x: F.when(e["lo"].isNull(), F.lit(math.nan))
                .when(e["span"] > 0, (log(x) - e["lo"]) / e["span"])
                .otherwise(log(x) - e["lo"]),
            ),
        )

    return let(cells, scaled)


def std_pop(xs: Column) -> Column:
    """Population standard deviation, two-pass."""
    return let(
        xs,
        lambda v: let(
            array_sum(v) / F.size(v),
            lambda mean: F.sqrt(
                F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / F.size(v)
            ),
        ),
    )


def position_sum(xs: Column) -> Column:
    """Sum of ``position * value``: tells two arrays of equal content but other order apart."""
    return F.aggregate(
        F.transform(xs, lambda x, i: x * i), F.lit(0.0), lambda acc, x: acc + x
    )


def time_row_slices(cells: Column, time_bins: int, width: int, start: Column, size: int) -> Column:
    """Columns ``start .. start+size`` of every time row, flattened again."""
    return let(
        cells,
        lambda c: F.flatten(
            F.transform(steps(time_bins), lambda t: F.slice(c, t * width + start + 1, size))
        ),
    )


def squared_distance_sql(a: str, b: str) -> str:
    """SQL text, as one plan holds it once per observation pair."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (acc, d) -> acc + d)"


def inverse_distance_sql(a: str, b: str) -> str:
    return f"(1D / ({squared_distance_sql(a, b)} + {DISTANCE_EPS!r}D))"


def kl_term(mean: Column, log_var: Column) -> Column:
    """Divergence of N(mean, exp(log_var)) from N(0, 1), summed over dimensions."""
    return array_sum(
        F.zip_with(mean, log_var, lambda m, v: F.lit(-0.5) * (F.lit(1.0) + v - m * m - F.exp(v)))
    )


def reparameterise(mean: Column, log_var: Column, eps: Column) -> Column:
    scaled = F.zip_with(log_var, eps, lambda v, e: F.exp(v * 0.5) * e)
    return F.zip_with(mean, scaled, lambda m, s: m + s)


def cross_entropy(target: Column, predicted: Column) -> Column:
    """Binary cross-entropy of each cell, summed; predictions clipped away from 0 and 1."""

    def cell(t: Column, p: Column) -> Column:
        clipped = F.greatest(F.lit(CLIP_EPS), F.least(F.lit(1.0 - CLIP_EPS), p))
        return -(t * F.ln(clipped) + (F.lit(1.0) - t) * F.ln(F.lit(1.0) - clipped))

    return array_sum(F.zip_with(target, predicted, cell))
