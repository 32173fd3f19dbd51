"""Dense 0..n-1 indexes, splits and shuffles without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadentia.functions.hashing import PRIME, hashed_int


def dense_index(
    df: DataFrame,
    position: str,
    *,
    major: Sequence[str] = (),
    restart: bool = False,
    tie: Sequence[str] = (),
    block_size: int = 65536,
    fan_in: int = 1 << 20,
    into: str = "idx",
) -> DataFrame:
    """Number rows 0..n-1 in the order ``(*major, position, *tie)``.

    Rows are cut into blocks of ``block_size`` consecutive positions and ranked inside
    their block, in parallel. Block counts are summed up in order inside groups of
    ``fan_in`` consecutive blocks, group counts inside each ``major`` group, so sparse
    positions (a block for each row) are summed by many tasks too. What is summed in one
    task are the counts of the groups of one file and, unless ``restart`` numbers each
    ``major`` group from 0, one total per ``major`` group: a row per file.
    """
    blocked = df.withColumn("_block", F.expr(f"{position} div {block_size}")).withColumn(
        "_group", F.expr(f"_block div {fan_in}")
    )
    blocks = blocked.groupBy(*major, "_group", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    groups = blocks.groupBy(*major, "_group").agg(F.sum("_rows").alias("_rows"))
    before = lambda own, order: F.coalesce(
        F.sum("_rows").over(Window.partitionBy(*own).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # a few groups even for very sparse positions: those of 2**40 positions and more
    wide = F.shiftright("_group", 20).alias("_wide")
    group_offsets = groups.select(*major, "_group", "_rows", wide)
    wides = group_offsets.groupBy(*major, "_wide").agg(F.sum("_rows").alias("_rows"))
    wide_offsets = wides.select(*major, "_wide", before([*major, F.lit(0)], "_wide").alias("_before_wide"))
    group_offsets = group_offsets.select(*major, "_group", "_wide", before([*major, "_wide"], "_group").alias("_before_group"))
    offsets = (
        blocks.select(*major, "_group", "_block", before([*major, "_group"], "_block").alias("_before_block"))
        .join(group_offsets, [*major, "_group"])
        .join(wide_offsets, [*major, "_wide"])
    )
    offset = F.col("_before_block") + F.col("_before_group") + F.col("_before_wide")
    if major and not restart:
        totals = wides.groupBy(*major).agg(F.sum("_rows").alias("_rows"))
        in_order = Window.orderBy(*major).rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(*major, F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_before_major"))
        offsets = offsets.join(totals, list(major))
        offset = offset + F.col("_before_major")
    offsets = offsets.select(*major, "_block", offset.alias("_offset"))
    in_block = Window.partitionBy(*major, "_block").orderBy(position, *tie)
    return (
        blocked.withColumn("_rank", F.row_number().over(in_block) - 1)
        .join(offsets, [*major, "_block"])
        .withColumn(into, F.col("_offset") + F.col("_rank"))
        .select(*df.columns, into)
    )


def row_count(df: DataFrame) -> Column:
    """The row count as a scalar subquery: no driver round trip, no cross join."""
    return df.agg(F.count(F.lit(1))).scalar()


def split_trim(
    df: DataFrame,
    n: Column,
    *,
    train_fraction: float,
    train_batch: int,
    val_batch: int,
    index: str = "idx",
) -> DataFrame:
    """Positional train/validation split.

    The first ``int(n * fraction)`` rows train, trimmed to whole batches; validation
    starts at the *untrimmed* boundary and is trimmed to its own batch. The trimmed
    rest gets no part and is left out, as a trainer needs whole batches.
    """
    n_train = F.floor(n * F.lit(train_fraction))
    n_val = n - n_train
    train_end = F.floor(n_train / F.lit(train_batch)) * train_batch
    val_end = n_train + F.floor(n_val / F.lit(val_batch)) * val_batch
    idx = F.col(index)
    part = F.when(idx < train_end, "train").when((idx >= n_train) & (idx < val_end), "val")
    return df.withColumn("part", part).where(F.col("part").isNotNull())


def assign_batches(df: DataFrame, batch: int, micro_batch: int, *, index: str = "idx") -> DataFrame:
    """Step number, and micro-batch number inside the step."""
    idx = F.col(index)
    return df.withColumn("step", F.floor(idx / F.lit(batch))).withColumn(
        "micro_step", F.floor((idx % batch) / F.lit(micro_batch))
    )


def step_counts(n: Column, batch: int, micro_batch: int) -> list[Column]:
    """Whole steps in ``n`` rows and micro-batches in one step."""
    return [
        F.floor(n / F.lit(batch)).alias("steps"),
        F.lit(batch // micro_batch).cast("bigint").alias("micro_steps_per_step"),
    ]


def epoch_shuffle(
    df: DataFrame, id_: str, epoch: int, seed: int, *, blocks: int | None = None, into: str = "shuffle_pos"
) -> DataFrame:
    """Seeded random order, as a dense position.

    The key is two hashes of ``(id, epoch, seed)``, 62 bits; as it is uniform, so are the
    blocks it is ranked in, whatever the ids look like. Their number follows the row
    count unless it is given.
    """
    first, second = hashed_int(id_, epoch, seed), hashed_int(id_, epoch, seed + 1)
    keyed = df.withColumn("_key", first * PRIME + second)
    count = F.lit(blocks) if blocks else F.floor(row_count(df) / 65536) + 1
    width = F.floor(F.lit(PRIME * PRIME) / count) + 1
    return dense_index(
        keyed.withColumn("_place", F.floor(F.col("_key") / width)), "_place", tie=["_key", id_], block_size=1, into=into
    ).drop("_key", "_place")
