"""Telemetry tables: range queries, series, roll-ups, merging and statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.functions.text import series_key


def telemetry_range(
    df: DataFrame, lo=None, hi=None, *, ts: str = "ts_unix", tie: str = "id"
) -> DataFrame:
    """Rows between two inclusive, optional bounds, in time order.

    ``lo`` and ``hi`` are literals of the column's own type, so the filter is pushed
    to the scan. ``None`` alone means "no bound"; 0 is a bound.
    """
    if lo is not None:
        df = df.where(F.col(ts) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(ts) <= F.lit(hi))
    return df.orderBy(ts, tie)


def telemetry_series(df: DataFrame, start: float) -> DataFrame:
    """Series key and minutes since ``start``, the lower bound of the query."""
    return df.select(
        series_key(F.col("resource_type"), F.col("resource_name")).alias("series"),
        ((F.col("ts_unix") - F.lit(start)) / 60).alias("minutes"),
        "value",
        "id",
    )


def parse_device_key(series: DataFrame) -> DataFrame:
    """``gpu_<device>_<metric>``: the last part is the metric, the middle the device."""
    pattern = r"^gpu_(?:(.*)_)?([^_]*)$"
    return series.where(F.col("series").startswith("gpu_")).select(
        "*",
        F.regexp_extract("series", pattern, 1).alias("device"),
        F.regexp_extract("series", pattern, 2).alias("metric"),
    )


def device_metric_pivot(series: DataFrame, metrics: tuple[str, ...] = ("utilization", "memory")) -> DataFrame:
    """One row per device and time with a column per metric.

    The metrics are listed, so the pivot needs no pass to discover them.
    """
    keyed = parse_device_key(series)
    return keyed.groupBy("device", "minutes").agg(
        *[F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


def percent_of(used: Column, total: Column) -> Column:
    """``used / total * 100``, and 0 where there is no total."""
    return F.when(total > 0, used / total * 100).otherwise(0.0)


def process_rollup(samples: DataFrame, cores: int, ram_bytes: float) -> DataFrame:
    """CPU and memory of all processes per tick, as shares of the machine."""
    totals = samples.groupBy("tick").agg(F.sum("cpu").alias("_cpu"), F.sum("pss").alias("ram_bytes"))
    return totals.select(
        "tick",
        (F.col("_cpu") / cores if cores > 0 else F.lit(0.0)).alias("cpu_percent"),
        (F.col("ram_bytes") / ram_bytes * 100).alias("ram_percent"),
        "ram_bytes",
        (F.col("ram_bytes") / 1e9).alias("ram_gb"),
    )


def merge_stores(*stores: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Union of several hosts' rows with one row per key.

    Kept is the smallest remaining row, so the result does not depend on arrival
    order; duplicates are combined before the shuffle.
    """
    merged = stores[0]
    for store in stores[1:]:
        merged = merged.unionByName(store)
    rest = [c for c in merged.columns if c not in keys]
    return (
        merged.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
    )


def table_stats(tables: Mapping[str, DataFrame], clock: str = "system_resources") -> DataFrame:
    """Rows per table and the time range of ``clock``, in one row and one shuffle."""
    tagged = None
    for name, df in tables.items():
        stamp = F.col("ts_unix") if name == clock else F.lit(None).cast("double")
        part = df.agg(
            F.count(F.lit(1)).alias("rows"), F.min(stamp).alias("lo"), F.max(stamp).alias("hi")
        ).withColumn("table", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = [
        F.sum(F.when(F.col("table") == name, F.col("rows"))).alias(f"{name}_row_count") for name in tables
    ]
    return tagged.agg(*counts, F.min("lo").alias("min_timestamp"), F.max("hi").alias("max_timestamp"))


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """Bytes on disk below ``path``; only the listing is read, not the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(
        F.sum("length").alias("size_bytes"), (F.sum("length") / (1024 * 1024)).alias("size_mb")
    )
