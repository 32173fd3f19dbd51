"""Parquet inputs, result files and the routed telemetry tables."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.operators.cadence import REPORT_COLUMNS, high_confidence

# The telemetry tables, their columns and the ones that may not be null.
TABLES = {
    "system_resources": (
        "timestamp double, resource_type string, resource_name string, value double, "
        "unit string, tag string, metadata string"
    ),
    "background_stats": (
        "timestamp double, stat_name string, value double, unit string, filename string, "
        "process_id int, chunk_number int, duration_seconds double, tag string, metadata string"
    ),
    "injection_stats": (
        "timestamp double, stat_name string, value double, unit string, model_name string, "
        "round_number int, process_id int, chunk_number int, duration_seconds double, "
        "tag string, metadata string"
    ),
    "training_losses": (
        "timestamp double, model_name string, loss_name string, value double, round_number int, "
        "epoch_number int, learning_rate double, duration_seconds double, tag string, metadata string"
    ),
}
REQUIRED = {
    "system_resources": ("timestamp", "resource_type", "resource_name", "value"),
    "background_stats": ("timestamp", "stat_name", "value"),
    "injection_stats": ("timestamp", "stat_name", "value"),
    "training_losses": ("timestamp", "model_name", "loss_name", "value"),
}
REJECTS = "_rejects"
#: What Spark says of a path that is absent, empty, or not a Parquet file.
SKIPPED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")

REPORT_SCHEMA = (
    "frequency_MHz double, confidence double, classification string, "
    "observation_pattern string, frequency_index bigint"
)


def columns_of(table: str) -> list[str]:
    return [field.split()[0] for field in TABLES[table].split(", ")]


def read_existing(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Parquet files that exist and are such files; an error if none is, or if one breaks during the scan.

    Only "absent" and "no Parquet" are skipped. A refused permission, a network fault or
    damage behind a good footer fails: fewer rows without a word would be worse.
    """
    reader = spark.read
    good = []
    for path in paths:
        try:
            reader.parquet(path)
            good.append(path)
        except (PySparkException, Py4JJavaError) as fault:
            if not any(known in str(fault) for known in SKIPPED):
                raise
    if not good:
        raise FileNotFoundError("none of the given files could be read")
    return reader.parquet(*good)


def write_detections(detections: DataFrame, path: str) -> None:
    """Detections as CSV with a header, and the confident ones beside them if there are any.

    The second file is filtered from the first, so the scan behind it runs only once; one of an
    earlier run goes, so it never stands beside a report that it doesn't belong to.
    """
    spark = detections.sparkSession
    _folder(spark, high_confidence_path(path), delete=True)
    detections.select(*REPORT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
    confident = high_confidence(read_detections(spark, path))
    if not confident.isEmpty():
        confident.write.mode("overwrite").option("header", True).csv(high_confidence_path(path))


def _folder(spark: SparkSession, path: str, *, delete: bool = False) -> bool:
    """Whether there is such a folder, which may go."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    there = system.exists(folder)
    if there and delete:
        system.delete(folder, True)
    return there


def read_high_confidence(spark: SparkSession, path: str) -> DataFrame:
    """The confident detections of the report at ``path``; none if there was no second file to write."""
    beside = high_confidence_path(path)
    return read_detections(spark, beside) if _folder(spark, beside) else spark.createDataFrame([], REPORT_SCHEMA)


def high_confidence_path(path: str) -> str:
    return path.replace(".csv", "_high_confidence.csv") if path.endswith(".csv") else f"{path}_high_confidence"


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).option("header", True).csv(path)


def routed(queue: DataFrame) -> DataFrame:
    """Rows labelled with the table they belong to.

    An unknown table, or a null where the table allows none, goes to ``_rejects``
    with the asked-for name kept; columns a table does not have become null.
    """
    asked = F.col("table")
    known = asked.isin(*TABLES)
    ok = F.lit(False)
    for name, required in REQUIRED.items():
        filled = F.lit(True)
        for c in required:
            filled = filled & F.col(c).isNotNull()
        ok = ok | ((asked == name) & filled)

    def kept(column: str) -> Column:
        owners = [t for t in TABLES if column in columns_of(t)]
        return F.when(asked.isin(*owners) | ~known, F.col(column)).alias(column)

    every = list(dict.fromkeys(c for t in TABLES for c in columns_of(t)))
    return queue.select(
        F.when(known & ok, asked).otherwise(REJECTS).alias("table"),
        asked.alias("asked_table"),
        *[kept(c) for c in every],
    )


def write_routed(queue: DataFrame, path: str) -> None:
    """Append every row to its table's folder in one write, without a shuffle."""
    routed(queue).write.mode("append").partitionBy("table").parquet(path)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One telemetry table with its own columns; the folder is pruned to it."""
    return spark.read.parquet(path).where(F.col("table") == table).select(*columns_of(table))


def write_clustered(rows: DataFrame, path: str, ts: str = "ts", *, files_per_day: int = 1) -> None:
    """Stores telemetry by time: a folder for each day, rows sorted inside its files.

    A range of times then lies in the folders of its days and, inside them, in the row groups
    whose bounds meet it. A hot day may be cut into several files by time of day.
    """
    dated = rows.withColumn("day", F.to_date(ts))
    slot = F.floor(F.pmod(F.unix_seconds(F.col(ts).cast("timestamp")), F.lit(86400)) * files_per_day / 86400)
    dealt = dated.repartition("day", slot).sortWithinPartitions("day", ts)
    dealt.write.mode("overwrite").partitionBy("day").parquet(path)


def read_clustered(spark: SparkSession, path: str, lo=None, hi=None, ts: str = "ts") -> DataFrame:
    """Stored telemetry between two inclusive, optional bounds (Python datetimes): only their days' folders are read."""
    rows = spark.read.parquet(path)
    for bound, above in ((lo, True), (hi, False)):
        if bound is not None:
            day, at = F.lit(bound.date()), F.lit(bound).cast(rows.schema[ts].dataType)
            rows = rows.where(F.col("day") >= day if above else F.col("day") <= day)
            rows = rows.where(F.col(ts) >= at if above else F.col(ts) <= at)
    return rows.drop("day")
