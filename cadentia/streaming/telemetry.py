"""Telemetry as streams: ingest, routing, metric series, dedup of merged stores."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadentia.settings import IngestLimits
from cadentia.sources.tables import routed

LIMITS = IngestLimits()


def read_stream(spark: SparkSession, path: str, schema, *, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files arriving in a folder, or in all that match a pattern."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _start(writer, *, once: bool) -> StreamingQuery:
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{LIMITS.interval_seconds:g} seconds").start()


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query."""
    query.awaitTermination()


def ingest(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Micro-batches into Parquet every few seconds; the checkpoint makes it exactly-once."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, once=once)


def route(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Each row to its table's folder, rejects included.

    ``foreachBatch`` may run a batch again after a failure, so a batch overwrites its
    own partitions instead of appending.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            routed(batch)
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("table", "batch_id")
            .parquet(path)
        )

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once=once)


def _per_batch(stream: DataFrame, write, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once=once)


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, below their checkpoint; the session stays as it was."""
    name, kind = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _exists(spark: SparkSession, path: str) -> bool:
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    return files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier batches wrote below ``path``; nothing, before the first of them."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


class _Horizon:
    """The watermark that Spark derives from the batches so far, one tiny file a batch below ``path``.

    A batch that runs again finds the file of the batch before it, so it sees the same watermark.
    """

    def __init__(self, spark: SparkSession, path: str, delay_seconds: float):
        self.spark, self.path, self.delay = spark, path, delay_seconds

    def latest(self, batch_id: int) -> datetime | None:
        """The latest time in batches up to this one."""
        if batch_id < 0:
            return None
        row = _stored(self.spark, f"{self.path}/{batch_id}", "latest timestamp").first()
        return row.latest if row else None

    def add(self, batch_id: int, latest: datetime | None) -> None:
        known = [t for t in (self.latest(batch_id - 1), latest) if t is not None]
        row = [(max(known, default=None),)]
        self.spark.createDataFrame(row, "latest timestamp").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{batch_id}")

    def before(self, batch_id: int, ts: Column) -> Column:
        """Whether a time lies before the watermark of all batches up to this one."""
        latest = self.latest(batch_id)
        if latest is None:
            return F.lit(False)
        # a watermark counts whole milliseconds
        return F.unix_millis(ts) < F.unix_millis(F.lit(latest)) - int(self.delay * 1000)


def _ddl(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *more])


SERIES_KEYS = ("window_start", "resource_type", "resource_name")
_SUMS = "total double, max_value double, samples bigint"
_SERIES = f"window_start bigint, resource_type string, resource_name string, {_SUMS}"


def write_series(
    stream: DataFrame, path: str, checkpoint: str, *, seconds: int = 60, delay: float = 3600, once: bool = False
) -> StreamingQuery:
    """Sums per window, type and name of a stream with a TIMESTAMP ``ts``.

    Open windows are state of Spark's: a window is written once, when it ends more than ``delay``
    seconds before the latest row, so what is stored grows with the windows and not with the batches.
    Rows that come after their window was written, however late, are kept as partial sums beside it,
    which merge on read. A batch that runs again overwrites what it wrote.
    """
    spark = stream.sparkSession
    start = F.expr(f"timestamp_seconds(unix_timestamp(ts) - pmod(unix_timestamp(ts), {seconds}))")
    keys = ("resource_type", "resource_name")
    sums = [F.sum("value").alias("total"), F.max("value").alias("max_value"), F.count("value").alias("samples")]
    slim = stream.select("ts", *keys, F.col("value").cast("double").alias("value"))
    # the window's end is the event time of the state, so a window is dropped and closed by its end
    ends = slim.withColumn("ts", start + F.expr(f"interval {seconds} seconds")).withWatermark("ts", f"{round(delay * 1000)} milliseconds")
    closed = ends.where("ts is not null").groupBy("ts", *keys).agg(*sums).withColumn("raw", F.lit(False))
    raw = slim.select("ts", *keys, F.col("value").alias("total"), F.lit(None).cast("double").alias("max_value"), F.lit(1).cast("bigint").alias("samples"), F.lit(True).alias("raw"))
    both = closed.unionByName(raw)
    horizon = _Horizon(spark, f"{path}/horizon", delay)
    end = start + F.expr(f"interval {seconds} seconds")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            arrived = batch.where("raw").withColumn("end", end)
            # Spark drops a row late by the watermark of the batch before: by the batches up to the last but one
            late = arrived.where(F.col("end").isNull() | ~_after(horizon, batch_id - 2, F.col("end")))
            partial = late.groupBy(F.unix_timestamp(start).alias("window_start"), *keys).agg(
                F.sum("total").alias("total"), F.max("total").alias("max_value"), F.count("total").alias("samples")
            )
            done = batch.where("not raw").withColumn("window_start", F.unix_timestamp("ts") - seconds)
            columns = [f.split()[0] for f in _SERIES.split(", ")]
            for name, rows in (("closed", done), ("late", partial)):
                rows = rows.select(columns)
                if not rows.isEmpty():  # a batch that closes nothing leaves no file
                    rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            horizon.add(batch_id, arrived.agg(F.max("end")).first()[0])
        finally:
            batch.unpersist()

    writer = both.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once=once)


def _after(horizon: _Horizon, batch_id: int, end: Column) -> Column:
    """Whether a window that ends then was still open to a batch: its end lies after the watermark."""
    latest = horizon.latest(batch_id)
    if latest is None:
        return F.unix_millis(end) > 0
    return F.unix_millis(end) > F.greatest(F.unix_millis(F.lit(latest)) - int(horizon.delay * 1000), F.lit(0))


def metric_series(spark: SparkSession, path: str, checkpoint: str, *, seconds: int = 60) -> DataFrame:
    """Mean, maximum and count per window, type and name of all rows so far.

    Merges the windows written, the partial sums of late rows, and the open windows of the
    stream's state.
    """
    parts = [_stored(spark, f"{path}/{name}", f"{_SERIES}, batch_id bigint").drop("batch_id") for name in ("closed", "late")]
    if _exists(spark, f"{checkpoint}/state"):
        state = spark.read.format("statestore").load(checkpoint)
        opened = state.select(*_open_windows(state))
        parts.append(opened.withColumn("window_start", F.unix_timestamp("end") - seconds).drop("end"))
    merged = reduce(DataFrame.unionByName, parts).groupBy(*SERIES_KEYS).agg(
        F.sum("total").alias("total"), F.max("max_value").alias("max_value"), F.sum("samples").alias("samples")
    )
    return merged.select(*SERIES_KEYS, (F.col("total") / F.col("samples")).alias("mean_value"), "max_value", "samples")


def _open_windows(state: DataFrame) -> list[Column]:
    """The series' columns from the aggregation's state: its keys, and its buffers in the order of the sums."""
    total, most, count = (F.col(f"value.`{f.name}`") for f in state.schema["value"].dataType.fields[-3:])
    end, *names = (F.col(f"key.`{f.name}`") for f in state.schema["key"].dataType.fields)
    return [end.alias("end"), *[n.alias(k) for n, k in zip(names, SERIES_KEYS[1:], strict=True)],
            total.alias("total"), most.alias("max_value"), count.alias("samples")]


def dedup(
    stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...], *, ts: str = "ts", delay: float = 3600, once: bool = False
) -> StreamingQuery:
    """Rows whose key is new, appended to a table by day; ``keys`` contain the time ``ts``.

    Two tiers. Rows of the last ``delay`` seconds before the latest row are told apart by Spark's own
    state, which forgets a key when the watermark has passed it. Only rows older than that are looked up
    in the stored table, in the folders of their own days, which stand in the scan as literals: what a
    batch reads doesn't grow with the table. Null keys are equal; rows without a time always count as
    old. A batch that runs again overwrites what it wrote.
    """
    if ts not in keys:
        raise ValueError("copies must share their time, by which the table is partitioned")
    spark, tier = stream.sparkSession, "_tier"
    timed = stream.where(F.col(ts).isNotNull()).withWatermark(ts, f"{round(delay * 1000)} milliseconds")
    recent = timed.dropDuplicatesWithinWatermark(list(keys)).withColumn(tier, F.lit("new"))
    both = recent.select(*stream.columns, tier).unionByName(stream.withColumn(tier, F.lit("arrived")))
    horizon = _Horizon(spark, f"{path}-horizon", delay)
    same = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            new = batch.where(F.col(tier) == "new").drop(tier)
            arrived = batch.where(F.col(tier) == "arrived").drop(tier)
            old = arrived.where(F.col(ts).isNull() | horizon.before(batch_id - 1, F.col(ts))).dropDuplicates(list(keys))
            old = old.join(new, same(old, new), "left_anti").withColumn("day", F.to_date(ts))
            seen = stored_days(spark, path, old, batch_id)
            fresh = old.join(seen, same(old, seen), "left_anti").unionByName(new.withColumn("day", F.to_date(ts)))
            (
                fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day", "batch_id")
                .parquet(path)
            )
            horizon.add(batch_id, arrived.agg(F.max(ts)).first()[0])
        finally:
            batch.unpersist()

    return _start(both.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint), once=once)


def stored_days(spark: SparkSession, path: str, rows: DataFrame, batch_id: int) -> DataFrame:
    """What batches before this one stored for the days of ``rows``: the days are literals, so no other folder is read."""
    table = _stored(spark, path, _ddl(rows, "batch_id bigint"))
    days = [r.day for r in rows.select("day").distinct().collect()]  # a batch has few days
    wanted = F.col("day").isin([d for d in days if d is not None])
    wanted = wanted | F.col("day").isNull() if None in days else wanted
    return table.where(wanted & (F.col("batch_id") < batch_id))


def deduplicated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table that :func:`dedup` keeps."""
    return _stored(spark, path, f"{schema}, day date, batch_id bigint").drop("day", "batch_id")
