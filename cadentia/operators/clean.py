"""Row subsets, validity, completeness and guards on observation tables.

An observation table has one row per ``(cadence_id, obs)`` with flat ``cells``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadentia.functions import arrays, kernels
from cadentia.functions.text import CADENCE_FILE_PATTERN
from cadentia.geometry import Geometry
from cadentia.operators.indexing import dense_index
from cadentia.operators.spectral import downsample
from cadentia.session import materialise

RowRange = tuple[int | None, int | None]


def row_subset(
    df: DataFrame,
    subsets: Mapping[str, RowRange] | None = None,
    rows_per_file: int | None = None,
    *,
    file: str = "source_file",
    row: str = "row_idx",
) -> DataFrame:
    """Half-open row range per file, then at most ``rows_per_file`` rows of it.

    ``row`` is the row's position in its file, so the cap needs no ranking: both
    rules are one predicate on two stored columns, which reaches the Parquet scan.
    """

    def bounds(lo: int | None, hi: int | None) -> Column:
        lo = lo or 0
        if lo < 0 or (hi is not None and hi < 0):
            raise ValueError("row ranges count from the start of the file")
        ends = [e for e in (hi, lo + rows_per_file if rows_per_file is not None else None) if e is not None]
        inside = F.col(row) >= lo
        return inside & (F.col(row) < min(ends)) if ends else inside

    keep = bounds(None, None)
    if subsets:
        keep = ~F.col(file).isin(*subsets) & keep
    for name, (lo, hi) in (subsets or {}).items():
        keep = keep | ((F.col(file) == name) & bounds(lo, hi))
    return df.where(keep)


def complete_cadences(df: DataFrame, n_obs: int) -> DataFrame:
    """Ids that have every observation; a bit per observation, combined map-side."""
    return (
        df.groupBy("cadence_id")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(obs as int))")).alias("_seen"))
        .where(F.col("_seen") == (1 << n_obs) - 1)
        .select("cadence_id")
    )


def parse_cadence_files(files: DataFrame, path: str = "path") -> DataFrame:
    """``cadence_0007_obs_3.npy`` -> ``(cadence_id, obs)``; other names are dropped."""
    name = F.col(path)
    return files.where(name.rlike(CADENCE_FILE_PATTERN)).select(
        F.col(path),
        F.regexp_extract(name, CADENCE_FILE_PATTERN, 1).cast("bigint").alias("cadence_id"),
        F.regexp_extract(name, CADENCE_FILE_PATTERN, 2).cast("bigint").alias("obs"),
    )


def complete_cadence_files(files: DataFrame, n_obs: int, path: str = "path") -> DataFrame:
    """Files of those cadences for which all ``n_obs`` files are listed."""
    parsed = parse_cadence_files(files, path)
    return parsed.join(complete_cadences(parsed, n_obs), "cadence_id", "left_semi")


def cadence_flags(obs: DataFrame, n_obs: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """One slim row per cadence: seen observations, any NaN, any Inf, largest cell.

    ``carry`` names columns that are the same in all rows of a cadence.
    """
    cells = F.col("cells")
    per_row = obs.select(
        "cadence_id",
        "obs",
        *carry,
        arrays.has_nan(cells).alias("_nan"),
        arrays.has_inf(cells).alias("_inf"),
        F.array_max(cells).cast("double").alias("_top"),
    )
    return per_row.groupBy("cadence_id").agg(
        (F.bit_or(F.expr("shiftleft(1L, cast(obs as int))")) == (1 << n_obs) - 1).alias("complete"),
        F.bool_or("_nan").alias("has_nan"),
        F.bool_or("_inf").alias("has_inf"),
        F.max("_top").alias("top"),
        *[F.min(c).alias(c) for c in carry],
    )


def invalid() -> Column:
    """True for a cadence to drop whole: NaN, Inf, nothing above zero, or incomplete."""
    return ~F.col("complete") | F.col("has_nan") | F.col("has_inf") | (F.col("top") <= 0)


def valid_cadences(obs: DataFrame, n_obs: int) -> DataFrame:
    """Observations of complete, finite cadences with something above zero.

    Rejects are few, so their ids are stored and the payload is anti-joined with them
    where it lies. Only if they outgrow the broadcast threshold is it shuffled.
    """
    rejects = cadence_flags(obs, n_obs).where(invalid()).select("cadence_id")
    return obs.join(materialise(rejects, "rejects"), "cadence_id", "left_anti")


def guard_report(obs: DataFrame, cells_per_obs: int) -> DataFrame:
    """One row counting what :func:`require_clean` rejects."""
    cells = F.col("cells")
    return obs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(arrays.has_nan(cells)).alias("nan_rows"),
        F.count_if(arrays.has_inf(cells)).alias("inf_rows"),
        F.count_if(F.size(cells) != cells_per_obs).alias("wrong_width_rows"),
    )


def require_clean(obs: DataFrame, cells_per_obs: int) -> DataFrame:
    """Fail the job on the first NaN, Inf or wrong width; no extra pass over the data."""
    cells = F.col("cells")
    fault = (
        F.when(F.size(cells) != cells_per_obs, F.lit("observation has the wrong number of cells"))
        .when(arrays.has_nan(cells), F.lit("observation contains NaN"))
        .when(arrays.has_inf(cells), F.lit("observation contains Inf"))
    )
    checked = F.when(fault.isNull(), cells).otherwise(F.raise_error(fault).cast("array<double>"))
    return obs.withColumn("cells", checked)


def assemble_cadences(
    obs: DataFrame, n_obs: int, value: str = "cells", *, into: str = "obs_cells", extra: tuple = (), strict: bool = False
) -> DataFrame:
    """One row per complete cadence with its observations as an array in order; an incomplete one is an error if ``strict``.

    Each observation has its own slot in the aggregate, so the state per cadence is
    bounded by ``n_obs`` arrays whatever arrives under one id; a second row for the
    same observation is an error. ``extra`` are more aggregates to carry along.
    """
    at = lambda i: F.col("obs") == i
    slots = [F.any_value(F.when(at(i), F.col(value)), F.lit(True)).alias(f"_v{i}") for i in range(n_obs)]
    counts = [F.count_if(at(i)).alias(f"_n{i}") for i in range(n_obs)]
    grouped = obs.groupBy("cadence_id").agg(*slots, *counts, *extra)
    numbers = F.array(*[F.col(f"_n{i}") for i in range(n_obs)])
    once = F.when(
        F.exists(numbers, lambda n: n > 1),
        F.raise_error(F.lit("a cadence has two rows for one observation")).cast("boolean"),
    ).otherwise(F.forall(numbers, lambda n: n == 1))
    if strict:
        once = F.when(once, True).otherwise(F.raise_error(F.lit("a cadence lacks an observation")).cast("boolean"))
    return grouped.where(once).select(
        *[c for c in grouped.columns if not c.startswith(("_v", "_n"))],
        F.array(*[F.col(f"_v{i}") for i in range(n_obs)]).alias(into),
    )


def explode_observations(cadences: DataFrame, value: str = "obs_cells") -> DataFrame:
    """Back to one row per observation.

    The outer form keeps the planner from adding a non-empty filter below, which
    would compute the array a second time.
    """
    rest = [c for c in cadences.columns if c != value]
    return cadences.select(*rest, F.posexplode_outer(value).alias("obs", "cells")).withColumn(
        "obs", F.col("obs").cast("bigint")
    )


def limit_cadences(
    obs: DataFrame, n: int, geo: Geometry, *, file: str = "source_file", row: str = "row_idx"
) -> DataFrame:
    """The first ``n`` *valid* cadences in file order, with all their observations.

    A sorted limit would move all kept payload through one task. Here only slim keys
    are numbered, and the payload is semi-joined with the chosen ids.
    """
    keys = cadence_flags(obs, geo.n_obs, carry=(file, row)).where(~invalid()).select("cadence_id", file, row)
    chosen = dense_index(keys, row, major=[file]).where(F.col("idx") < n).select("cadence_id")
    return obs.join(materialise(chosen, "chosen"), "cadence_id", "left_semi")


def load_cadence_rows(rows: DataFrame, geo: Geometry, *, engine: str | None = None) -> DataFrame:
    """Rows that are whole cadences -> valid, downsampled ones. No shuffle at all.

    ``cells`` holds the observations one after the other, as a background file stores
    them; the result has ``source_file, row_idx, obs_cells``.
    """
    cells = F.col("cells")
    if engine == "arrow":
        loaded = kernels.load_kernel(geo.n_obs, geo.factor)(cells)
    else:
        n = geo.cells_per_obs
        ok = ~arrays.not_finite(cells) & (F.array_max(cells) > 0)
        means = F.transform(
            arrays.steps(geo.n_obs),
            lambda o: arrays.block_mean(F.slice(cells, o * n + 1, n), n // geo.factor, geo.factor),
        )
        loaded = F.when(ok, means).cast("array<array<float>>")
    return rows.select("source_file", "row_idx", loaded.alias("obs_cells")).where(
        F.col("obs_cells").isNotNull()
    )


def first_cadences(cadences: DataFrame, n: int, files: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a stored cadence table in file order, by its slim keys.

    The order of the files is the listed one, or that of their names without a list.
    """
    keys = cadences.select("source_file", "row_idx")
    major = "source_file"
    if files is not None:
        listed = cadences.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], "source_file string, _file_no int")
        keys, major = keys.join(listed, "source_file"), "_file_no"
    keys = dense_index(keys, "row_idx", major=[major]).drop("_file_no")
    chosen = materialise(keys.where(F.col("idx") < n).drop("idx"), "chosen")
    return cadences.join(chosen, ["source_file", "row_idx"], "left_semi")


def load_backgrounds(obs: DataFrame, geo: Geometry, *, engine: str | None = None) -> DataFrame:
    """Validate, downsample and assemble in one shuffle of already reduced rows.

    Flags are read from the raw cells, so the raw payload itself is never shuffled.
    """
    cells = F.col("cells")
    flagged = obs.withColumn(
        "_bad", arrays.not_finite(cells)
    ).withColumn("_top", F.array_max(cells))
    small = downsample(flagged, geo, engine=engine)
    carried = (
        F.bool_or("_bad").alias("bad"),
        F.max("_top").alias("top"),
        *[F.min(c).alias(c) for c in ("source_file", "row_idx") if c in obs.columns],
    )
    whole = assemble_cadences(small, geo.n_obs, extra=carried)
    return whole.where(~F.col("bad") & (F.col("top") > 0)).drop("bad", "top")
