"""Class-balanced training sets: sample plan, drawn parameters, augmentation.

Everything random is drawn into *columns* from ``(sample_idx, draw, seed)``; one
join brings in the backgrounds, and from there on each sample is built in place.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.functions import arrays, kernels
from cadentia.functions.hashing import let_sql, uniform_sql
from cadentia.geometry import Geometry
from cadentia.operators.clean import explode_observations
from cadentia.operators.indexing import dense_index, row_count
from cadentia.settings import Curriculum, Injection

# Sample classes and training sets.
CLASSES = ("false_no_signal", "false_with_rfi", "true_single", "true_double")
SPLIT_SETS = ("concatenated", "true", "false")

# Draw numbers: 0 background, 1 snr, then five per track of each candidate pair.
BACKGROUND_DRAW, SNR_DRAW, FIRST_TRACK_DRAW, DRAWS_PER_TRACK = 0, 1, 10, 5

FWHM_PER_SIGMA = 2.0 * math.sqrt(2.0 * math.log(2.0))

FIRST_CANDIDATES = 32
MORE_CANDIDATES = 65536

TRACK_TYPE = (
    "struct<start_bin:bigint,direction:bigint,slope_pixel:double,"
    "drift_hz_s:double,width_hz:double,intercept:double>"
)
PAIR_TYPE = f"struct<draw_no:bigint,rfi:{TRACK_TYPE},eti:{TRACK_TYPE}>"


def _run_of(within: Column, size: Column, runs: int) -> Column:
    """Which of ``runs`` equal runs a row lies in; what is left over belongs to the last."""
    length = F.floor(size / runs)
    nth = F.floor(F.try_divide(within, length))
    return F.when(within.isNull(), None).when(nth.between(0, runs - 1), nth).otherwise(runs - 1)


def class_plan(samples: DataFrame, n: Column, chunk_size: int, *, remainder: str = "error") -> DataFrame:
    """One row per ``(split_set, sample_idx)`` with its chunk and class.

    ``samples`` has a dense ``sample_idx``; ``n`` is their number. Every chunk, the
    last one too, gives each class of its set an equal run of rows: quarters in
    ``concatenated``, halves in ``true`` and ``false``. A chunk that is no multiple of
    4 samples is an error, or with ``remainder="last"`` its last class gets the rows
    left over.
    """
    if chunk_size % 4:
        raise ValueError("chunk_size must be a multiple of 4")
    if remainder not in ("error", "last"):
        raise ValueError(f"unknown remainder {remainder!r}")
    idx = F.col("sample_idx")
    size = F.least(F.lit(chunk_size).cast("bigint"), n - F.col("chunk") * chunk_size)
    balanced = F.when(
        size % 4 != 0, F.raise_error(F.lit("a chunk is not a multiple of 4 samples")).cast("bigint")
    ).otherwise(size)
    within = idx % chunk_size
    if remainder == "last":
        balanced = size
        quarter, half = (_run_of(within, F.col("_size"), runs) for runs in (4, 2))
    else:
        quarter = F.floor(within * 4 / F.col("_size"))
        half = F.floor(within * 2 / F.col("_size"))
    number = (
        F.when(F.col("split_set") == "concatenated", quarter)
        .when(F.col("split_set") == "false", half)
        .otherwise(half + 2)
    )
    return (
        samples.withColumn("chunk", F.floor(idx / F.lit(chunk_size)))
        .withColumn("_size", balanced)
        .withColumn("split_set", F.explode(F.array(*map(F.lit, SPLIT_SETS))))
        .withColumn("class", F.get(F.array(*map(F.lit, CLASSES)), number.cast("int")))
        .drop("_size")
    )


def set_seed_sql(seed: int) -> str:
    """A seed of its own for each training set."""
    numbers = " ".join(f"when '{name}' then {i}" for i, name in enumerate(SPLIT_SETS))
    return f"({seed * len(SPLIT_SETS)}L + case split_set {numbers} end)"


def _track_terms(u: Callable[[int], str], geo: Geometry, par: Injection) -> tuple[dict, str, str, dict]:
    """SQL of a track's four draws, of its slope ``s``, drift ``r`` and final fields.

    The track leaves the band after the cadence's last row; slope noise is added in
    physical units only, so ``slope_pixel`` and ``intercept`` stay noise-free.
    """
    total, width = geo.stacked_rows, geo.width
    drawn = {
        "start": f"cast(floor({u(0)} * {width - 1}) + 1 as bigint)",
        "dir": f"if({u(1)} < 0.5D, -1L, 1L)",
        "noise": f"{u(2)} * {par.slope_noise}D",
        "base": f"{u(3)} * {par.width_hz}D",
    }
    slope = f"{float(total)}D / if(d.dir > 0, d.start, d.start - {width}L)"
    drift = f"-1D / (s * {geo.time_resolution_s / geo.freq_resolution_hz!r}D + d.dir * d.noise)"
    fields = {
        "start_bin": "d.start",
        "direction": "d.dir",
        "slope_pixel": "s",
        "drift_hz_s": "r",
        "width_hz": f"d.base + abs(r) * {par.width_per_drift}D",
        "intercept": f"{float(total)}D - s * d.start",
    }
    return drawn, slope, drift, fields


def _struct_sql(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{name!r}, {value}' for name, value in fields.items())})"


def track_sql(id_: str, seed: str, first_draw: str | int, geo: Geometry, par: Injection = Injection()) -> str:
    """Parameters of one drifting track as one expression, for use inside lambdas."""
    u = lambda k: uniform_sql(id_, f"{first_draw} + {k}", seed, bind=True)
    drawn, slope, drift, fields = _track_terms(u, geo, par)
    return let_sql("d", _struct_sql(drawn), let_sql("s", slope, let_sql("r", drift, _struct_sql(fields))))


def with_track(
    df: DataFrame, id_: str, seed: str, geo: Geometry, par: Injection = Injection(), *, into: str
) -> DataFrame:
    """The same track as a column, built up in steps so that all of it compiles."""
    u = lambda k: uniform_sql(id_, FIRST_TRACK_DRAW + k, seed)
    drawn, slope, drift, fields = _track_terms(u, geo, par)
    steps = df.selectExpr("*", f"{_struct_sql(drawn)} as d")
    steps = steps.selectExpr("*", f"{slope} as s").selectExpr("*", f"{drift} as r")
    return steps.selectExpr(*df.columns, f"{_struct_sql(fields)} as {into}")


def apart_sql(first: str, second: str, geo: Geometry, *, reversed_axis: bool = False) -> str:
    """True if the two tracks do not cross while on target.

    ``y = slope * x + intercept`` runs from the last row to the first, so the row of
    the crossing is ``rows - y``; ``reversed_axis`` applies the ON ranges to ``y``
    itself. Equal slopes count as crossing here: such a pair is redrawn.
    """
    x = f"try_divide({second}.intercept - {first}.intercept, {first}.slope_pixel - {second}.slope_pixel)"
    y = f"{first}.slope_pixel * {x} + {first}.intercept"
    row = y if reversed_axis else f"{float(geo.stacked_rows)}D - ({y})"
    clear = " and ".join(f"not y between {lo} and {hi}" for lo, hi in geo.on_row_ranges())
    return f"coalesce({let_sql('y', row, clear)}, false)"


def track_pair_sql(
    id_: str, seed: str, geo: Geometry, par: Injection = Injection(), *, reversed_axis: bool = False
) -> str:
    """First candidate pair ``(draw_no, rfi, eti)`` that does not cross while on target.

    Both tracks are redrawn together. The fold draws nothing more once a pair is
    found; the second, long run is only entered by a sample without one in the
    first, and a sample without one in 65536 (a chance of 0 in double precision)
    is an error, never a dropped row.
    """
    start = lambda j: f"{FIRST_TRACK_DRAW + j * DRAWS_PER_TRACK} + k * {2 * DRAWS_PER_TRACK}"
    pair = f"""named_struct('draw_no', cast(k as bigint),
        'rfi', {track_sql(id_, seed, start(0), geo, par)},
        'eti', {track_sql(id_, seed, start(1), geo, par)})"""
    apart = apart_sql("p.rfi", "p.eti", geo, reversed_axis=reversed_axis)
    candidate = let_sql("p", pair, f"if({apart}, p, null)")

    def search(lo: int, n: int) -> str:
        ks = f"sequence({lo}, {lo + n - 1})"
        return f"aggregate({ks}, cast(null as {PAIR_TYPE}), (found, k) -> coalesce(found, {candidate}))"

    fault = f"cast(raise_error('no pair of tracks without a crossing') as {PAIR_TYPE})"
    return f"coalesce({search(0, FIRST_CANDIDATES)}, {search(FIRST_CANDIDATES, MORE_CANDIDATES)}, {fault})"


def draw_params(
    plan: DataFrame, geo: Geometry, *, seed: int, par: Injection = Injection(), reversed_axis: bool = False
) -> DataFrame:
    """Adds ``background_u``, ``snr`` and up to two tracks per sample.

    ``track1`` goes into all observations, or only the ON ones for ``true_single``;
    ``track2`` is the ON-only second track of ``true_double``.
    """
    base = "snr_base" if "snr_base" in plan.columns else f"{float(par.snr_base)}D"
    span = "snr_range" if "snr_range" in plan.columns else f"{float(par.snr_range)}D"
    pair = track_pair_sql("sample_idx", "_seed", geo, par, reversed_axis=reversed_axis)
    tracks = f"""case
        when class = '{CLASSES[3]}' then {pair}
        when class <> '{CLASSES[0]}' then cast(
            named_struct('draw_no', 0L, 'rfi', _single, 'eti', cast(null as {TRACK_TYPE})) as {PAIR_TYPE})
        end"""
    seeded = plan.selectExpr("*", f"{set_seed_sql(seed)} as _seed")
    return (
        with_track(seeded, "sample_idx", "_seed", geo, par, into="_single")
        .selectExpr(
            "*",
            f"{uniform_sql('sample_idx', BACKGROUND_DRAW, '_seed')} as background_u",
            f"{uniform_sql('sample_idx', SNR_DRAW, '_seed')} * {span} + {base} as snr",
            f"{tracks} as _t",
        )
        .selectExpr("*", "_t.rfi as track1", "_t.eti as track2")
        .drop("_t", "_seed", "_single")
    )


def sample_backgrounds(params: DataFrame, backgrounds: DataFrame) -> DataFrame:
    """Sampling with replacement: ``int(n * u)`` as the dense index of the background.

    Reads only the key columns of ``backgrounds``. An equi-join on uniform indexes,
    so no side is skewed; the planner broadcasts whichever side measures small enough.
    """
    picked = params.withColumn(
        "background_idx", F.floor(F.col("background_u") * row_count(backgrounds)).cast("bigint")
    )
    return picked.join(index_backgrounds(backgrounds), "background_idx")


def index_backgrounds(cadences: DataFrame) -> DataFrame:
    """Dense ``background_idx`` in file order, ranked on the keys alone."""
    keys = cadences.drop("obs_cells")
    return dense_index(keys, "row_idx", major=["source_file"], into="background_idx")


def add_track_sql(cells: str, track: str, snr: str, geo: Geometry) -> str:
    """Adds a linear track with a Gaussian profile in frequency, constant in time.

    ``cells`` names the stacked rows of a whole cadence. The level is set by the
    standard deviation of the cells it is added to.
    """
    rate = geo.time_resolution_s / geo.freq_resolution_hz
    add = lambda f: f"aggregate({cells}, 0D, (acc, x) -> acc + {f}) / size({cells})"
    level = let_sql("mean", add("x"), f"sqrt({add('(x - mean) * (x - mean)')})")
    shape = f"""named_struct(
        'start', double({track}.start_bin),
        'step', {track}.drift_hz_s * {rate!r}D,
        'sigma', {track}.width_hz / {FWHM_PER_SIGMA * geo.freq_resolution_hz!r}D,
        'level', {snr} * {level} / {math.sqrt(geo.stacked_rows)!r}D)"""
    offset = f"(i % {geo.width}) - (g.start + g.step * (i div {geo.width}))"
    profile = let_sql("o", offset, "exp(-(o * o) / (2D * g.sigma * g.sigma))")
    return let_sql("g", shape, f"transform({cells}, (x, i) -> x + g.level * {profile})")


def splice_on_off(on_source: DataFrame, off_source: DataFrame) -> DataFrame:
    """Even observations of one table with the odd ones of another: two filtered scans."""
    return on_source.where(F.col("obs") % 2 == 0).unionByName(off_source.where(F.col("obs") % 2 == 1))


def _build_expr(geo: Geometry) -> Column:
    n = geo.cells_per_obs

    def augmented(cells: str, track: str, snr: str) -> str:
        return f"if({track} is null, {cells}, {add_track_sql(cells, track, snr, geo)})"

    source = f"if(o % 2 = 0, two, if(class = '{CLASSES[2]}', base, one))"
    spliced = f"transform(sequence(0, {geo.n_obs - 1}), o -> slice({source}, o * {n} + 1, {n}))"
    built = let_sql(
        "base",
        "cast(flatten(obs_cells) as array<double>)",
        let_sql(
            "one",
            augmented("base", "track1", "snr"),
            let_sql("two", augmented("one", "track2", "snr * dynamic_range"), spliced),
        ),
    )
    return F.transform(F.expr(built), arrays.log_norm)


KERNEL_CELLS = 1 << 20
TASK_BYTES = 64 << 20
# exp() below this is too small to show beside the logarithm's 1e-10, and slow (denormal)
EXPONENT_FLOOR = -700.0


def _build_kernel(geo: Geometry, precision: str):
    """The same sample construction on Arrow batches, about a million cells at a time."""
    rows, width, size = geo.stacked_rows, geo.width, geo.stacked_rows * geo.width
    rate = geo.time_resolution_s / geo.freq_resolution_hz
    freq, time = np.arange(width, dtype=np.float64), np.arange(rows, dtype=np.float64)
    on_rows = (np.arange(rows) // geo.time_bins % 2 == 0)[:, None]

    def with_track(block: np.ndarray, track: pa.StructArray, snr: np.ndarray) -> np.ndarray:
        """Adds each row's track to its cells; rows without a track stay as they are."""
        has = np.flatnonzero(~track.is_null().to_numpy(zero_copy_only=False))
        if not len(has):
            return block
        start, drift, width_hz = (
            track.field(name).to_numpy(zero_copy_only=False).astype(np.float64)[has][:, None, None]
            for name in ("start_bin", "drift_hz_s", "width_hz")
        )
        sigma = width_hz / (FWHM_PER_SIGMA * geo.freq_resolution_hz)
        profile = freq - (start + drift * rate * time[:, None])
        profile *= profile
        profile /= -2.0 * sigma * sigma
        np.exp(np.maximum(profile, EXPONENT_FLOOR, out=profile), out=profile)
        level = snr[has] * block[has].std(axis=(1, 2)) / math.sqrt(rows)
        profile *= level[:, None, None]
        out = block.copy()
        out[has] += profile
        return out

    value = pa.float32() if precision == "float" else pa.float64()

    @F.arrow_udf(f"array<array<{precision}>>")
    def build(
        cells: pa.Array, kind: pa.Array, snr: pa.Array, second: pa.Array, one: pa.Array, two: pa.Array
    ) -> pa.Array:
        step = max(1, KERNEL_CELLS // size)
        parts = []
        for lo in range(0, len(cells), step):
            base = kernels.to_matrix(cells.slice(lo, step)).astype(np.float64).reshape(-1, rows, width)
            snrs = snr.slice(lo, step).to_numpy(zero_copy_only=False)
            factor = second.slice(lo, step).to_numpy(zero_copy_only=False)
            first = with_track(base, one.slice(lo, step), snrs)
            on = with_track(first, two.slice(lo, step), snrs * factor)
            on_only = np.array([k == CLASSES[2] for k in kind.slice(lo, step).to_pylist()])
            off = np.where(on_only[:, None, None], base, first)
            chosen = np.where(on_rows, on, off).reshape(-1, geo.cells_per_obs)
            parts.append(kernels.log_norm_matrix(chosen).astype(value.to_pandas_dtype(), copy=False))
        if not parts:
            return pa.array([], pa.list_(pa.list_(value)))
        flat = kernels.to_lists(np.concatenate(parts), value)
        offsets = pa.array(np.arange(len(cells) + 1) * geo.n_obs, pa.int32())
        return pa.ListArray.from_arrays(offsets, flat)

    return build


def generation_partitions(spark: SparkSession, n_rows: int, geo: Geometry) -> int:
    """At most ``TASK_BYTES`` of generated cells per task, and no idle cores."""
    row_bytes = geo.n_obs * geo.cells_per_obs * 8
    return max(spark.sparkContext.defaultParallelism, -(-n_rows * row_bytes // TASK_BYTES))


def build_samples(
    params: DataFrame,
    backgrounds: DataFrame,
    geo: Geometry,
    *,
    par: Injection = Injection(),
    engine: str | None = None,
    partitions: int | None = None,
    precision: str = "double",
) -> DataFrame:
    """Parameters + assembled backgrounds -> log-normalised observations.

    ``backgrounds`` is a stored table ``source_file, row_idx, obs_cells``: it is read several times per round (count, keys, payload) and in every round, and
    without the table each would load and validate the raw observations again. Two joins (slim keys, then payload); augmentation, splice and normalisation are
    row-local because a cadence travels as one row.

    A sample is a few bytes before the payload join and hundreds of KB after it, so
    sizes measured before the join say nothing about the work behind it.
    ``partitions`` fixes the parallelism: slim rows are spread by background (drawn
    uniformly, so evenly) and merged with the payload, which is shuffled once.
    """
    picked = sample_backgrounds(params, backgrounds)
    key = ["source_file", "row_idx"]
    payload = backgrounds.select(*key, "obs_cells")
    if partitions:
        picked, payload = picked.repartition(partitions, *key), payload.hint("merge")
    rows = picked.join(payload, key).withColumn("dynamic_range", F.lit(par.dynamic_range))
    if precision not in ("float", "double"):
        raise ValueError("precision is float or double")
    if engine not in (None, "expr", "arrow"):
        raise ValueError(f"unknown engine {engine!r}")
    if engine != "expr":  # measured 2.4 times as fast even at 384 cells per cadence
        built = _build_kernel(geo, precision)(
            F.flatten("obs_cells"), F.col("class"), F.col("snr"), F.col("dynamic_range"),
            F.col("track1"), F.col("track2"),
        )
    else:
        built = _build_expr(geo).cast(f"array<array<{precision}>>")
    keep = [c for c in ("split_set", "round_idx", "chunk") if c in params.columns]
    finished = rows.select(*keep, "class", "sample_idx", "background_idx", built.alias("obs_cells"))
    return explode_observations(finished)


def generate_batch(
    samples: DataFrame,
    backgrounds: DataFrame,
    geo: Geometry,
    *,
    seed: int,
    par: Injection = Injection(),
    engine: str | None = None,
    precision: str = "double",
    augmenters: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    remainder: str = "error",
) -> DataFrame:
    """The balanced ``concatenated`` / ``true`` / ``false`` sets as one long table.

    ``remainder`` is that of ``class_plan``. ``augmenters`` maps a class to a DataFrame function applied to its finished
    observations, for user-defined generation.
    """
    n = samples.count()
    plan = class_plan(samples, F.lit(n), par.chunk_size, remainder=remainder)
    params = draw_params(plan, geo, seed=seed, par=par)
    parts = generation_partitions(samples.sparkSession, n * len(SPLIT_SETS), geo)
    built = build_samples(
        params, backgrounds, geo, par=par, engine=engine, partitions=parts, precision=precision
    )
    for kind, fn in (augmenters or {}).items():
        built = built.where(F.col("class") != kind).unionByName(fn(built.where(F.col("class") == kind)))
    return built


def write_batch(batch: DataFrame, path: str) -> None:
    """Generated rows in float precision, one folder per set.

    Cells hardly repeat, so building a dictionary of them would only cost time.
    """
    stored = batch.withColumn("cells", F.col("cells").cast("array<float>"))
    by = [c for c in ("round_idx", "split_set") if c in batch.columns]
    writer = stored.write.mode("overwrite").partitionBy(*by)
    writer.option("parquet.enable.dictionary#cells.list.element", "false").parquet(path)


def aligned_triples(main: DataFrame, true: DataFrame, false: DataFrame, by=("sample_idx", "obs")) -> DataFrame:
    """Row i of the three sets as one training row; the target is the main cells."""
    named = [
        df.select(*by, F.col("cells").alias(f"{name}_cells"))
        for df, name in ((main, "main"), (true, "true"), (false, "false"))
    ]
    return named[0].join(named[1], list(by)).join(named[2], list(by)).withColumn(
        "target_cells", F.col("main_cells")
    )


def difficulty(round_idx: Column, schedule: str, cur: Curriculum = Curriculum()) -> Column:
    """SNR range of a round (0-based), truncated to an integer."""
    wide, narrow = float(cur.initial_range), float(cur.final_range)
    if cur.total_rounds == 1:
        return F.lit(cur.initial_range).cast("bigint")
    progress = round_idx / F.lit(float(cur.total_rounds - 1))
    if schedule == "linear":
        span = F.lit(wide) - progress * (wide - narrow)
    elif schedule == "exponential":
        if cur.decay_rate >= 0:
            raise ValueError("the exponential schedule needs a negative decay rate")
        end = F.exp(F.lit(cur.decay_rate))
        decay = (F.exp(progress * cur.decay_rate) - end) / (F.lit(1.0) - end)
        span = F.lit(narrow) + decay * (wide - narrow)
    elif schedule == "step":
        span = (
            F.when(round_idx < cur.easy_rounds, wide)
            .when(round_idx < cur.easy_rounds + cur.hard_rounds, narrow)
            .otherwise(F.raise_error(F.lit("round lies beyond the step schedule")).cast("double"))
        )
    else:
        raise ValueError(f"unknown schedule {schedule!r}")
    return span.cast("bigint")


def with_difficulty(plan: DataFrame, schedule: str, cur: Curriculum = Curriculum()) -> DataFrame:
    """``snr_base`` and ``snr_range`` of each sample from its ``round_idx``."""
    return plan.withColumn("snr_base", F.lit(cur.snr_base)).withColumn(
        "snr_range", difficulty(F.col("round_idx"), schedule, cur)
    )
