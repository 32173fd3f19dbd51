"""Cell-level transforms of observations. All are row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadentia.functions import arrays, kernels
from cadentia.geometry import Geometry


def _use_arrow(engine: str | None) -> bool:
    """Expressions unless the caller asks for the kernel; never by the size of a row."""
    if engine not in (None, "expr", "arrow"):
        raise ValueError(f"unknown engine {engine!r}")
    return engine == "arrow"


def downsample(obs: DataFrame, geo: Geometry, *, engine: str | None = None) -> DataFrame:
    """Block mean along frequency, per time row."""
    if geo.factor == 1:
        return obs
    if _use_arrow(engine):
        return obs.withColumn("cells", kernels.block_mean_kernel(geo.factor)(F.col("cells")))
    n_out = geo.cells_per_obs // geo.factor
    return obs.withColumn("cells", arrays.block_mean(F.col("cells"), n_out, geo.factor))


def log_normalise(obs: DataFrame, geo: Geometry, *, engine: str | None = None) -> DataFrame:
    """Each observation to [0, 1] on a log scale."""
    if _use_arrow(engine):
        return obs.withColumn("cells", kernels.log_norm_kernel()(F.col("cells")))
    return obs.withColumn("cells", arrays.log_norm(F.col("cells")))


def overlap_snippets(obs: DataFrame, geo: Geometry, size: int, overlap: float = 0.5) -> DataFrame:
    """Windows of ``size`` channels every ``int(size * (1 - overlap))``; a short tail is dropped."""
    step = int(size * (1 - overlap))
    if step < 1:
        raise ValueError("overlap leaves no step between snippets")
    if size > geo.width:
        starts = F.array().cast("array<bigint>")
    else:
        starts = F.sequence(F.lit(0).cast("bigint"), F.lit(geo.width - size).cast("bigint"), F.lit(step).cast("bigint"))
    cut = obs.withColumn("start_index", F.explode(starts))
    return cut.withColumn(
        "cells",
        arrays.time_row_slices(
            F.col("cells"), geo.time_bins, geo.width, F.col("start_index").cast("int"), size
        ),
    )


def cell_view(obs: DataFrame, geo: Geometry) -> DataFrame:
    """One row per cell ``(…, t, f, v)``. For inspection; operators stay on arrays."""
    rest = [c for c in obs.columns if c != "cells"]
    cells = obs.select(*rest, F.posexplode_outer("cells").alias("_i", "v"))
    return cells.select(
        *rest,
        F.floor(F.col("_i") / F.lit(geo.width)).alias("t"),
        (F.col("_i") % geo.width).cast("bigint").alias("f"),
        "v",
    )


def dataset_summary(cadences: DataFrame, value: str = "obs_cells") -> DataFrame:
    """Count, min, max and mean over all cells: per-row partials, then one small row."""
    flat = cadences.select(F.flatten(value).alias("_c"))
    per_row = flat.select(
        F.array_min("_c").alias("_lo"),
        F.array_max("_c").alias("_hi"),
        arrays.array_sum(F.col("_c")).alias("_sum"),
        F.size("_c").cast("bigint").alias("_n"),
    )
    return per_row.agg(
        F.count(F.lit(1)).alias("cadences"),
        F.min("_lo").alias("min_value"),
        F.max("_hi").alias("max_value"),
        (F.sum("_sum") / F.sum("_n")).alias("mean_value"),
    )


def range_check(samples: DataFrame, by: str = "split_set", *, engine: str = "expr") -> DataFrame:
    """Per set: extremes, mean, NaN and Inf rows, and whether all cells lie in [0, 1].

    NaN is tested on its own: it compares as greater than every number. Wide rows are
    summed faster with ``engine="arrow"``.
    """
    c = F.col("cells")
    total = kernels.row_sum_kernel()(c) if engine == "arrow" else arrays.array_sum(c)
    per_row = samples.select(
        by,
        arrays.has_nan(c).alias("_nan"),
        arrays.has_inf(c).alias("_inf"),
        F.array_min(c).alias("_lo"),
        F.array_max(c).alias("_hi"),
        total.alias("_sum"),
        F.size(c).cast("bigint").alias("_n"),
    )
    stats = per_row.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("_nan").alias("nan_rows"),
        F.count_if("_inf").alias("inf_rows"),
        F.min(F.when(~F.col("_nan"), F.col("_lo"))).alias("min_value"),
        F.max(F.when(~F.col("_nan"), F.col("_hi"))).alias("max_value"),
        (F.sum(F.when(~F.col("_nan"), F.col("_sum"))) / F.sum(F.when(~F.col("_nan"), F.col("_n")))).alias(
            "mean_value"
        ),
    )
    inside = (F.col("min_value") >= 0) & (F.col("max_value") <= 1)
    return stats.withColumn("in_range", (F.col("nan_rows") == 0) & (F.col("inf_rows") == 0) & inside)


def require_normalised(samples: DataFrame) -> DataFrame:
    """Fail the job on a cell that is NaN, Inf or outside [0, 1]."""
    c = F.col("cells")
    wrong = F.exists(c, lambda x: F.isnan(x) | (x < 0) | (x > 1))
    fault = F.raise_error(F.lit("normalised cell outside [0, 1]")).cast("array<double>")
    return samples.withColumn("cells", F.when(wrong, fault).otherwise(c))
