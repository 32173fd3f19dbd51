"""Profiles of stored spectrogram files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadentia.functions.arrays import array_sum
from cadentia.session import materialise

SAMPLE_ROWS = 50
FLOAT_BYTES = {"float32": 4, "float64": 8}


def sample_rows(files: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Evenly spaced row positions per file, first and last included.

    ``files`` has ``file, n_rows``; positions truncate ``k * (n - 1) / (m - 1)``.
    """
    m = F.least(F.col("n_rows"), F.lit(max_rows).cast("bigint"))
    last = F.col("n_rows") - 1
    k = F.col("_k")
    position = F.when(k == m - 1, last).otherwise(F.floor(k * (last.cast("double") / (m - 1))))
    return (
        files.where(F.col("n_rows") > 0)
        .select("file", "n_rows", F.explode(F.sequence(F.lit(0).cast("bigint"), m - 1)).alias("_k"))
        .select("file", F.when(m == 1, F.lit(0).cast("bigint")).otherwise(position).alias("row_idx"))
    )


def file_profile(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Extremes and mean of all rows of each file, and its full size, in one aggregation.

    ``rows`` has ``file, shape, dtype, cells``. The mean is the mean of row means. With
    ``max_rows`` only so many evenly spaced rows of each file are looked at (``rows``
    then needs ``row_idx``): their positions, a few per file, are joined on ``(file,
    row_idx)``, so the cells stay where they are.
    """
    whole = (F.count(F.lit(1)).alias("n_rows"), F.min("shape").alias("shape"), F.min("dtype").alias("dtype"))
    of_cells = (
        F.count(F.lit(1)).alias("sampled_rows"),
        F.min(F.array_min("cells")).alias("sample_min"),
        F.max(F.array_max("cells")).alias("sample_max"),
        F.avg(array_sum(F.col("cells")) / F.size("cells")).alias("sample_mean"),
    )
    if max_rows is None:
        profiles = rows.groupBy("file").agg(*whole, *of_cells)
    else:
        files = materialise(rows.groupBy("file").agg(*whole), "files")
        positions = materialise(sample_rows(files, max_rows), "positions")
        sampled = rows.join(positions, ["file", "row_idx"], "left_semi")
        profiles = files.join(sampled.groupBy("file").agg(*of_cells), "file")
    per_row = F.aggregate(
        F.transform(F.split(F.regexp_replace("shape", r"[\[\] ]", ""), ","), lambda s: s.cast("bigint")),
        F.lit(1).cast("bigint"),
        lambda a, b: a * b,
    )
    item = F.when(F.col("dtype") == "float64", FLOAT_BYTES["float64"]).otherwise(FLOAT_BYTES["float32"])
    return profiles.withColumn("expected_bytes", F.col("n_rows") * per_row * item)


def profile_consistency(profiles: DataFrame) -> DataFrame:
    """Do all files share one row shape and one type, and how large are they together?"""
    return profiles.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct("shape").alias("shapes"),
        F.count_distinct("dtype").alias("dtypes"),
        F.sum("n_rows").alias("total_rows"),
        F.sum("expected_bytes").alias("total_bytes"),
    )
