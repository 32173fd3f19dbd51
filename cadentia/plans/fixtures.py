"""Inputs of the registered queries, derived row by row from the given tables.

``events`` plays per-observation scores, telemetry, losses and the artifact
registry; ``embeddings`` plays observations, latents and weights; ``documents`` the
rows of spectrogram files. Whole tables, no subsets.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.functions.hashing import let_sql
from cadentia.geometry import Geometry
from cadentia.operators.clean import load_backgrounds
from cadentia.session import materialise
from cadentia.sources.npy import open_system, qualified

# 64 embedding values as 4 time rows of 16 channels
OBS_GEOMETRY = Geometry(n_obs=6, time_bins=4, width=16, factor=4)
FULL_GEOMETRY = Geometry(n_obs=6, time_bins=4, width=16, factor=1)
N_OBS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scores(spark, sf_dir, bands: int = 1) -> DataFrame:
    """``band, obs, start_index, p`` with one row per event."""
    return table(spark, sf_dir, "events").selectExpr(
        f"user_id % {bands} as band" if bands > 1 else "0L as band",
        "event_id % 6 as obs",
        "event_id div 6 as start_index",
        "value / 100 as p",
    )


def observations(spark, sf_dir) -> DataFrame:
    """Observation table with NaN, Inf and all-zero cadences among good ones."""
    raw = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id div 6 as cadence_id",
        "vec_id % 6 as obs",
        "concat('file_', (vec_id div 6) % 3) as source_file",
        "vec_id div 6 div 3 as row_idx",
        "embedding",
    )
    return raw.selectExpr(
        "cadence_id",
        "obs",
        "source_file",
        "row_idx",
        """transform(embedding, x -> case
             when cadence_id % 10 = 7 and obs = 2 then double('NaN')
             when cadence_id % 11 = 3 and obs = 4 then double('Infinity')
             when cadence_id % 13 = 5 then 0D
             else abs(double(x)) end) as cells""",
    )


NPY_ROWS = 120


def write_npy(spark, sf_dir, folder: str) -> DataFrame:
    """Embeddings as ``.npy`` files of up to 120 observations each, written by the tasks; a table of their paths."""
    root = qualified(spark, folder)

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        cells = np.stack(rows["embedding"].to_numpy()).astype(np.float32)
        buffer = io.BytesIO()
        np.save(buffer, cells.reshape(-1, OBS_GEOMETRY.time_bins, OBS_GEOMETRY.width))
        system, base = open_system(root)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/part_{key[0]:05d}.npy") as out:
            out.write(buffer.getvalue())
        return rows.assign(path=f"{root}/part_{key[0]:05d}.npy")[["path"]].head(1)

    chunked = table(spark, sf_dir, "embeddings").select(
        F.expr(f"vec_id div {NPY_ROWS}").alias("part"), "vec_id", "embedding"
    )
    return materialise(chunked.groupBy("part").applyInPandas(write, "path string"), "paths")


def backgrounds(spark, sf_dir) -> DataFrame:
    """Valid cadences at full width, one row each."""
    return load_backgrounds(observations(spark, sf_dir), FULL_GEOMETRY)


def samples(spark, sf_dir) -> DataFrame:
    """A dense ``sample_idx`` per embedding."""
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id as sample_idx")


def latents(spark, sf_dir) -> DataFrame:
    """``z``, ``log_var`` and ``eps`` per observation."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id div 6 as cadence_id",
        "vec_id % 6 as obs",
        "cast(embedding as array<double>) as z",
        "cast(reverse(embedding) as array<double>) as log_var",
        "cast(concat(slice(embedding, 33, 32), slice(embedding, 1, 32)) as array<double>) as eps",
        "label",
    )


TELEMETRY_COLUMNS = (
    "event_id as id",
    "ts",
    "cast(cast(ts as timestamp) as double) as ts_unix",
    "if(event_type = 'view', 'gpu', event_type) as resource_type",
    """if(event_type = 'view',
          concat('DEV_A:', user_id % 2, '_', if(event_id % 2 = 0, 'utilization', 'memory')),
          concat('user_', user_id % 5)) as resource_name""",
    "value",
    "'percent' as unit",
    "concat('run_', user_id % 3) as tag",
    "props as metadata",
)


def telemetry(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*TELEMETRY_COLUMNS)


# The queue of mixed rows the telemetry writer receives; one name has no table.
QUEUE_COLUMNS = (
    """case when cast(get_json_object(props, '$.k') as int) >= 95 then 'unknown_stats'
            when event_type = 'click' then 'background_stats'
            when event_type = 'signup' then 'injection_stats'
            when event_type = 'purchase' then 'training_losses'
            else 'system_resources' end as table""",
    "cast(cast(ts as timestamp) as double) as timestamp",
    "event_type as resource_type",
    "concat('user_', user_id % 5) as resource_name",
    "event_type as stat_name",
    "'forest' as model_name",
    "event_type as loss_name",
    "value",
    "'percent' as unit",
    "concat('file_', user_id % 3) as filename",
    "cast(user_id as int) as process_id",
    "cast(event_id div 1000 as int) as round_number",
    "cast(event_id % 1000 as int) as epoch_number",
    "cast(event_id div 100 as int) as chunk_number",
    "value / 1000 as duration_seconds",
    "value / 1e6 as learning_rate",
    "concat('run_', user_id % 3) as tag",
    "props as metadata",
)


def queue(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*QUEUE_COLUMNS)


LOSS_COLUMNS = (
    "'run' as tag",
    "event_id div 50 as round",
    "event_id % 50 as epoch",
    "value as val_loss",
)


def losses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*LOSS_COLUMNS)


def loss_steps(spark, sf_dir) -> DataFrame:
    """Sub-steps; a step of an epoch has as many as events fall into it."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id div 40 as epoch", "user_id % 10 as step", "value as loss"
    )


def history(spark, sf_dir) -> DataFrame:
    """Wide history: means as training, maxima as validation series."""
    kinds = {"loss": "view", "reconstruction_loss": "click", "kl_loss": "signup",
             "true_loss": "purchase", "false_loss": "error"}
    of = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.expr("event_id div 40").alias("epoch"))
        .agg(
            *[F.avg(of(k)).alias(name) for name, k in kinds.items()],
            *[F.max(of(k)).alias(f"val_{name}") for name, k in kinds.items()],
            (F.min("value") / 1000).alias("learning_rate"),
        )
    )


def process_samples(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.unix_timestamp(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("tick"),
        F.col("user_id").alias("process"),
        F.col("value").alias("cpu"),
        (F.col("value") * 1e6).alias("pss"),
    )


def registry(spark, sf_dir) -> DataFrame:
    """Model artifacts: every event saved one file, in ten forms of tag, per user's family."""
    tag = let_sql(
        "k",
        "cast(get_json_object(props, '$.k') as bigint)",
        """concat(
            get(array('final_v', 'round_0', 'round_1', '2024010', '2024990',
                      'test_v', 'test_x', 'final_x', 'round_x', 'misc'), int(k div 10)),
            k % 10,
            if(k div 10 in (3, 4), '_120000', ''))""",
    )
    return table(spark, sf_dir, "events").selectExpr(
        "concat('family_', user_id) as family",
        f"""concat(
            case when event_type in ('view', 'click') then 'vae_encoder_'
                 when event_type in ('error', 'signup') then 'vae_decoder_'
                 else 'random_forest_' end,
            {tag},
            if(event_type = 'purchase', '.joblib', '.keras')) as path""",
    )


def weights(spark, sf_dir) -> DataFrame:
    """Weight vectors of ten layers, alternating between the two initializers."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "concat('layer_', label) as layer",
        "if(label % 2 = 0, 'he_normal', 'glorot_normal') as initializer",
        "cast(100 + 10 * label as bigint) as fan_in",
        "cast(10 * label as bigint) as fan_out",
        "embedding as values",
    )


def file_rows(spark, sf_dir) -> DataFrame:
    """Rows of four files, one per language; a row's cells are the sizes of its text."""
    return table(spark, sf_dir, "documents").selectExpr(
        "lang as file",
        "doc_id",
        "if(lang = 'fr', '[6, 16, 512]', '[6, 16, 4096]') as shape",
        "if(lang = 'es', 'float64', 'float32') as dtype",
        """array(double(coalesce(char_length(text), 0)), double(coalesce(octet_length(text), 0)),
            double(n_chars), double(doc_id)) as cells""",
    ).drop("doc_id")


def predictions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr("quality as label", "toxic as prediction")
