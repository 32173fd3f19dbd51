"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target gives its documents a number of copies, a whole part and a fractional
probability. Pairs of documents exchange words of fractional mass, in a random direction that
keeps every document's expectation, until one of the two is integral. A source's mass is kept
exactly by each exchange. Blocks of a source leave one fractional document each; those
residuals meet in blocks again, level by level, until one document per source is left to a coin.
So a source that holds a third of all rows is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadentia.llm.shingles import mix64
from cadentia.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST_COPIES = 1.5, 2
SEED = 20240607
#: Documents of a source that are paired in one block, and residuals of blocks in one of the next level.
BLOCK, FAN_IN = 1024, 64
#: Blocks per task: many small sources share one.
BLOCKS_PER_TASK = 4

def size_of(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Dense ``k`` from 0 in the order of ``source``, null last: positions in sorted ranges plus their offsets."""
    placed = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    part = F.spark_partition_id()
    placed = placed.withColumn("part", part).withColumn(
        "at", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33)
    )
    placed = materialise(placed, "sources")
    counts = sorted((r[0], r[1]) for r in placed.groupBy("part").count().collect())  # a row per range
    offsets, total = {}, 0
    for part_, n in counts:
        offsets[part_] = total
        total += n
    if not offsets:
        return placed.withColumn("k", F.col("at")).drop("part", "at")
    starts = placed.sparkSession.createDataFrame(list(offsets.items()), "part int, start long")
    return placed.join(F.broadcast(starts), "part").withColumn("k", F.col("start") + F.col("at")).drop("part", "at", "start")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``source, k, n_docs, source_size, target`` of ``sizes(source, size, ...)``.

    Sources in code point order, null last, take the weights in turn and share ``share`` times
    all words; a target above ``most`` times its source is cut and the excess shared again by
    weight until none is above.
    """
    grouped = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("k", F.lit(len(weights))) + 1).cast("int"))
    table = materialise(_numbered(grouped).withColumn("weight", weight).withColumn("most", most * F.col("source_size")), "sources")
    wanted = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    # words per unit of weight among the sources below their cap; it only rises, as caps only join
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * level
        n, held, free = table.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (wanted - (held or 0)) / free
    return table.select(
        "source", "k", "n_docs", "source_size", F.least("most", F.col("weight") * level).alias("target")
    )


def _pair_up(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> int:
    """Round ``p`` in place to 0 or 1, but for at most one place, which is returned (or -1).

    Two documents exchange words: the sum of ``p * size`` stays, and so does every expectation.
    """
    open_ = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b = open_, i
        sa, sb = size[a], size[b]
        gain_a = min((1.0 - p[a]) * sa, p[b] * sb)
        gain_b = min(p[a] * sa, (1.0 - p[b]) * sb)
        if u[i] * (gain_a + gain_b) < gain_b:
            fills, drains, moved = a, b, gain_a
        else:
            fills, drains, moved = b, a, gain_b
        up, down = p[fills] + moved / size[fills], p[drains] - moved / size[drains]
        p[fills] = 1.0 if up > 1.0 - 1e-12 else up
        p[drains] = 0.0 if down < 1e-12 else down
        open_ = a if 0.0 < p[a] < 1.0 else b if 0.0 < p[b] < 1.0 else -1
    return open_


def _round_blocks(last: bool, seed: int):
    """Rounds every ``(k, block)`` of a task; a fractional document left over keeps its ``p`` and no copies."""

    def rounded(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        ids = rows["doc_id"].fillna(-1).astype("int64").to_numpy()
        nth = rows["nth"].to_numpy().astype(np.uint64)
        mixed = mix64(mix64(ids.astype(np.uint64) + np.uint64(seed)) + nth)
        order = np.lexsort((mixed, -rows["size"].to_numpy(), rows["block"], rows["k"]))
        rows, mixed = rows.iloc[order].reset_index(drop=True), mixed[order]
        u = (mix64(mixed) >> np.uint64(11)).astype(float) / 2.0**53
        p, size = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
        begins = (np.diff(rows["k"], prepend=-1) != 0) | (np.diff(rows["block"], prepend=-1) != 0)
        cuts = np.append(np.flatnonzero(begins), len(rows))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            left = _pair_up(part := p[a:b].copy(), size[a:b], u[a:b])
            if last and left >= 0:
                part[left] = float(u[a + left] < part[left])
            p[a:b] = part
        done = (p == 0.0) | (p == 1.0)
        rows["p"] = p
        rows["copies"] = np.where(done, rows["base"] + p, np.nan)
        rows["copies"] = rows["copies"].astype("Int32")
        return rows

    return rounded


def copies(docs: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: a row per row of ``docs(doc_id, source, text, ...)``.

    Texts that are null or without words have size 0 and take nothing. Rows that repeat a
    doc_id, source and size are told apart by a number only, so which of them is taken more
    often is arbitrary but how often they are taken together is not. The result depends on
    the rows and ``seed``, not on their order or partitions.
    """
    sizes = docs.select("doc_id", "source", size_of("text").alias("size"))
    units = materialise(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    rows = units.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")
    table = materialise(targets(rows, **shares), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio + 1e-12).cast("int")
    blocks = F.ceil(F.col("n_docs") / BLOCK).cast("long")
    joined = rows.join(table.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    level = joined.select(
        "doc_id", "source", "size", "nth", "k", "source_size", "target", "n_docs",
        F.pmod(F.xxhash64("doc_id", "nth", F.lit(seed)), blocks).alias("block"),
        base.alias("base"), F.greatest(ratio - base, F.lit(0.0)).alias("p"), F.lit(None).cast("int").alias("copies"),
    )
    # nothing to round: no words, or a whole number of copies
    whole = (F.col("size") == 0) | (F.col("p") < 1e-12)
    level = materialise(level, "mix")
    done = [level.filter(whole).withColumn("copies", F.col("base"))]
    level = level.filter(~whole)
    widest = table.agg(F.max(blocks), F.sum(blocks)).first()
    width, total = (widest[0] or 1), (widest[1] or 1)
    while True:
        task = F.pmod(F.xxhash64("k", "block"), F.lit(total // BLOCKS_PER_TASK + 1))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in level.schema.fields)
        rounded = _round_blocks(width <= 1, seed)
        level = materialise(level.groupBy(task.alias("task")).applyInPandas(rounded, schema), "mix")
        done.append(level.filter("copies IS NOT NULL"))
        if width <= 1:
            break
        width, total = -(-width // FAN_IN), -(-total // FAN_IN)
        level = level.filter("copies IS NULL").withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept."""
    key = F.struct("doc_id", "source", "size").alias("_mix_key")  # nulls are equal inside a struct
    taken = copies(docs, seed, **shares).groupBy(key).agg(F.count("*").alias("_mix_n"), F.sum("copies").alias("_mix_taken"))
    taken = materialise(taken.filter("_mix_taken > 0"), "copies")
    keyed = docs.withColumn("_mix_key", F.struct("doc_id", "source", size_of("text").alias("size")))
    n, total = F.col("_mix_n"), F.col("_mix_taken")
    if taken.filter(n > 1).isEmpty():
        nth = F.lit(1)
    else:  # rows that repeat are told apart by a number
        nth = F.row_number().over(Window.partitionBy("_mix_key").orderBy(F.lit(0)))
    times = F.floor(total / n).cast("int") + (nth <= total % n).cast("int")
    # a row for every document: never broadcast, so the plan is the same at every size
    drawn = keyed.join(taken.hint("merge"), "_mix_key").withColumn("_mix_times", times).filter("_mix_times > 0")
    return drawn.withColumn("_mix_times", F.explode(F.sequence(F.lit(1), "_mix_times"))).select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
