"""Spectrogram ``.npy`` files as Spark data sources.

``spectrogram_npy`` splits every file by row range, ``spectrogram_snippets`` by
channel range, so a task reads only the bytes of its own rows or snippets and no
observation is ever held whole. Headers are read in tasks, which write the ranges to read as a
table, a folder for each partition; the driver opens no file and knows the number of
partitions only. Filters on ``source_file`` and ``row_idx`` are pushed into the ranges. Paths may
be local (a folder mounted on every executor) or URIs, in a list or a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from cadentia.functions.kernels import valid_means
from cadentia.operators.indexing import dense_index
from cadentia.session import materialise, scratch_dir

BATCH_BYTES = 32 << 20
#: Bytes of a file that a task reads, by default and counting four for a cell.
SPLIT_BYTES = 128 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark itself resolves it: one without a scheme lies on the default file system."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toUri().toString()


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a qualified path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _header(path: str) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape, dtype and the byte the data starts at."""
    system, inner = open_system(path)
    with system.open_input_file(inner) as f:
        size = f.size()
        version = np.lib.format.read_magic(f)
        read = (
            np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        )
        shape, fortran, dtype = read(f)
        if fortran or dtype.hasobject or len(shape) < 2:
            raise ValueError(f"{path}: expected a row-major numeric array of rows")
        if size < f.tell() + int(np.prod(shape)) * dtype.itemsize:
            raise ValueError(f"{path}: the data behind the header are cut off")
        return shape, dtype, f.tell()


def _shape(path: str) -> tuple[tuple[int, ...] | None, str | None]:
    """Shape of a file, or why it is skipped: it is absent, no such array, or cut off.

    Anything else, a refused permission or a network fault, is an error.
    """
    try:
        return _header(path)[0], None
    except FileNotFoundError:
        return None, "absent"
    except ValueError as fault:
        return None, str(fault)


Paths = list[str] | DataFrame


def _listed(spark: SparkSession, paths: Paths) -> DataFrame:
    """``file_no, path``: the files in their order, by name if they come in a table (column ``path``)."""
    if isinstance(paths, DataFrame):
        named = paths.select("path", F.lit(0).alias("at")).distinct()
        return dense_index(named, "at", major=["path"]).select(F.col("idx").cast("bigint").alias("file_no"), "path")
    root = qualified(spark, "/").removesuffix("/")
    named = [p if "://" in p else root + p if p.startswith("/") else qualified(spark, p) for p in paths]
    return spark.createDataFrame(list(enumerate(named)), "file_no bigint, path string")


def headers(spark: SparkSession, paths: Paths) -> DataFrame:
    """``path, shape, fault`` of every listed file, looked at in the tasks: what is skipped and why."""

    def look(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [_shape(p) for p in part["path"]]
            yield part.assign(shape=[str(list(s)) if s else None for s, _ in found], fault=[f for _, f in found])

    return _listed(spark, paths).mapInPandas(look, "file_no bigint, path string, shape string, fault string").drop("file_no")


def _planned(spark: SparkSession, paths: Paths, cut, per_part: int | None) -> tuple[str, int]:
    """Writes the ranges that ``cut(path, shape)`` gives of every readable file, a folder for each partition.

    Returns the table's path and the number of partitions. A partition has ``per_part`` ranges, or
    as many as come to about ``SPLIT_BYTES``.
    """

    def ranges(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for number, path in zip(part["file_no"], part["path"], strict=True):
                shape, _ = _shape(path)
                if shape:
                    rows += [(number, path, lo, hi, size) for lo, hi, size in cut(path, shape)]
            yield pd.DataFrame(rows, columns=["file_no", "path", "lo", "hi", "size"])

    found = _listed(spark, paths).mapInPandas(ranges, "file_no bigint, path string, lo bigint, hi bigint, size bigint")
    found = materialise(found, "ranges")
    n, total = found.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return "", 0
    each = per_part or max(1, min(n, SPLIT_BYTES * n // max(total, 1)))
    folder = scratch_dir(spark, "manifest")
    dense = dense_index(found, "lo", major=["file_no"]).withColumn("part", F.floor(F.col("idx") / each))
    dense.select("part", "file_no", "path", "lo", "hi").repartition("part").write.partitionBy("part").parquet(folder)
    return qualified(spark, folder), -(-n // each)


def _list_array(matrix: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


class Part(InputPartition):
    """The ranges in one folder of the manifest."""

    def __init__(self, number: int):
        self.number = number


class RowRange:
    def __init__(self, path: str, lo: int, hi: int):
        self.path, self.lo, self.hi = path, lo, hi


class ManifestReader(DataSourceReader):
    """Reads ranges that were planned before, and only what pushed filters leave of them."""

    def __init__(self, options: Mapping[str, str]):
        self.manifest, self.parts = options["manifest"], int(options["parts"])
        self.files: set[str] | None = None
        self.lo, self.hi = 0, 1 << 62

    def partitions(self) -> list[Part]:
        if not self.parts:
            raise FileNotFoundError("none of the given files could be read")
        return [Part(number) for number in range(self.parts)]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Bounds of ``row_idx`` and names of ``source_file``; whatever else there is stays with Spark."""
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        column = getattr(f, "attribute", None)
        if isinstance(f, IsNotNull):
            return column in (("source_file",), ("row_idx",))
        if column == ("source_file",) and isinstance(f, EqualTo | In):
            named = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.files = named if self.files is None else self.files & named
            return True
        if column == ("row_idx",) and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                self.lo = max(self.lo, f.value + isinstance(f, GreaterThan))
            if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                self.hi = min(self.hi, f.value + (not isinstance(f, LessThan)))
            return True
        return False

    def ranges(self, part: Part) -> Iterator[RowRange]:
        system, inner = open_system(f"{self.manifest}/part={part.number}")
        table = pq.read_table(inner, filesystem=system, partitioning=None).sort_by([("file_no", "ascending"), ("lo", "ascending")])
        for row in table.to_pylist():
            lo, hi = max(row["lo"], self.lo), min(row["hi"], self.hi)
            if lo < hi and (self.files is None or row["path"] in self.files):
                yield RowRange(row["path"], lo, hi)


class SpectrogramReader(ManifestReader):
    def blocks(self, split: RowRange) -> Iterator[tuple[int, np.ndarray, tuple[int, ...]]]:
        """First row, cells of some consecutive rows, and the shape of one row."""
        shape, dtype, start = _header(split.path)
        per_row = int(np.prod(shape[1:]))
        row_bytes = per_row * dtype.itemsize
        rows = max(1, BATCH_BYTES // row_bytes)
        system, inner = open_system(split.path)
        with system.open_input_file(inner) as f:
            for lo in range(split.lo, split.hi, rows):
                n = min(rows, split.hi - lo)
                f.seek(start + lo * row_bytes)
                yield lo, np.frombuffer(f.read(n * row_bytes), dtype).reshape(n, per_row), shape[1:]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        for split in self.ranges(part):
            yield from self.rows(split)

    def rows(self, split: RowRange) -> Iterator[pa.RecordBatch]:
        name = split.path  # the whole path: two folders may hold one file name
        for lo, cells, row_shape in self.blocks(split):
            n = len(cells)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n),
                    pa.array(np.arange(lo, lo + n)),
                    pa.array([str(list(row_shape))] * n),
                    pa.array([cells.dtype.name] * n),
                    _list_array(cells),
                ],
                names=["source_file", "row_idx", "shape", "dtype", "cells"],
            )


class BackgroundReader(SpectrogramReader):
    """Rows are whole cadences; yields the valid ones, downsampled.

    The reduction happens before a row leaves the reader: an eighth of the cells
    (by the default factor) reaches Spark, and none of an invalid cadence.
    """

    def __init__(self, options: Mapping[str, str]):
        super().__init__(options)
        self.n_obs, self.factor = int(options["nObs"]), int(options["factor"])

    def rows(self, split: RowRange) -> Iterator[pa.RecordBatch]:
        name, n_obs, factor = split.path, self.n_obs, self.factor
        for lo, cells, row_shape in self.blocks(split):
            if row_shape[0] != n_obs or row_shape[-1] % factor:
                raise ValueError(f"{split.path}: a row of shape {row_shape} is not a cadence")
            valid, means = valid_means(cells, n_obs, factor)
            offsets = pa.array(np.arange(valid.sum() + 1) * n_obs, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * int(valid.sum()), pa.string()),
                    pa.array(lo + np.flatnonzero(valid)),
                    pa.ListArray.from_arrays(offsets, _list_array(means)),
                ],
                names=["source_file", "row_idx", "obs_cells"],
            )


class SpectrogramSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "spectrogram_npy"

    def schema(self) -> str:
        return "source_file string, row_idx bigint, shape string, dtype string, cells array<float>"

    def reader(self, schema) -> SpectrogramReader:
        return SpectrogramReader(self.options)


class BackgroundSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "spectrogram_backgrounds"

    def schema(self) -> str:
        return "source_file string, row_idx bigint, obs_cells array<array<float>>"

    def reader(self, schema) -> BackgroundReader:
        return BackgroundReader(self.options)


def _load(spark: SparkSession, source: type[DataSource], planned: tuple[str, int], options: dict) -> DataFrame:
    spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format(source.name()).option("manifest", planned[0]).option("parts", planned[1])
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def _row_ranges(subsets: Mapping, rows_per_file: int | None, rows_per_split: int | None):
    """Cuts a file into row ranges, after subset and cap."""
    subsets = dict(subsets or {})

    def cut(path: str, shape: tuple[int, ...]) -> list[tuple[int, int, int]]:
        known = (path, open_system(path)[1], path.rsplit("/", 1)[-1])
        lo, hi = next((subsets[k] for k in known if k in subsets), (None, None))
        lo, hi = lo or 0, min(shape[0], hi if hi is not None else shape[0])
        if rows_per_file is not None:
            hi = min(hi, lo + rows_per_file)
        row = 4 * int(np.prod(shape[1:]))
        step = rows_per_split or max(1, SPLIT_BYTES // row)
        return [(start, min(start + step, hi), row * (min(start + step, hi) - start)) for start in range(lo, hi, step)]

    return cut


RowRanges = Mapping[str, tuple[int | None, int | None]]


def read_npy(
    spark: SparkSession,
    paths: Paths,
    *,
    subsets: RowRanges | None = None,
    rows_per_file: int | None = None,
    rows_per_split: int | None = None,
) -> DataFrame:
    """One row per first-axis entry of each file, ``cells`` flattened row-major.

    ``source_file`` is the whole path. ``subsets`` (half-open row ranges by path or file name) and ``rows_per_file``, applied
    after them, prune before anything is read.
    """
    cut = _row_ranges(subsets, rows_per_file, rows_per_split)
    return _load(spark, SpectrogramSource, _planned(spark, paths, cut, 1 if rows_per_split else None), {})


def read_backgrounds(
    spark: SparkSession,
    paths: list[str],
    *,
    n_obs: int,
    factor: int,
    subsets: RowRanges | None = None,
    rows_per_file: int | None = None,
    rows_per_split: int | None = None,
) -> DataFrame:
    """Valid cadences of background files, downsampled while reading."""
    cut = _row_ranges(subsets, rows_per_file, rows_per_split)
    planned = _planned(spark, paths, cut, 1 if rows_per_split else None)
    return _load(spark, BackgroundSource, planned, {"nObs": n_obs, "factor": factor})


class SnippetReader(ManifestReader):
    """Snippets of ``(time, channel)`` files; a start counts downsampled channels."""

    def __init__(self, options: Mapping[str, str]):
        super().__init__(options)
        self.size, self.step, self.factor = int(options["size"]), int(options["step"]), int(options["factor"])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        yield from filters

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        for split in self.ranges(part):
            yield from self.snippets(split.path, range(split.lo, split.hi, self.step))

    def snippets(self, path: str, all_starts: range) -> Iterator[pa.RecordBatch]:
        shape, dtype, start = _header(path)
        width, time_bins = shape[-1], int(np.prod(shape[:-1]))
        system, inner = open_system(path)
        with system.open_input_file(inner) as f:
            snippet_bytes = time_bins * self.size * self.factor * dtype.itemsize
            per_batch = max(1, BATCH_BYTES // snippet_bytes)
            for i in range(0, len(all_starts), per_batch):
                starts = all_starts[i : i + per_batch]
                lo, hi = starts[0] * self.factor, (starts[-1] + self.size) * self.factor
                block = np.empty((time_bins, hi - lo), dtype)
                for t in range(time_bins):
                    f.seek(start + (t * width + lo) * dtype.itemsize)
                    block[t] = np.frombuffer(f.read((hi - lo) * dtype.itemsize), dtype)
                means = block.reshape(time_bins, -1, self.factor).mean(axis=2, dtype=np.float64)
                cut = [means[:, s - starts[0] : s - starts[0] + self.size].ravel() for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(cut)), pa.array(list(starts)), _list_array(np.stack(cut))],
                    names=["path", "start_index", "cells"],
                )


class SnippetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "spectrogram_snippets"

    def schema(self) -> str:
        return "path string, start_index bigint, cells array<float>"

    def reader(self, schema) -> SnippetReader:
        return SnippetReader(self.options)


def read_snippets(
    spark: SparkSession,
    paths: Paths,
    *,
    size: int,
    overlap: float = 0.5,
    factor: int = 1,
    snippets_per_split: int = 64,
) -> DataFrame:
    """Downsampled, overlapping snippets of observation files, cut while reading.

    A file has one row per time bin and any number of channels, far more than fit
    one row; a task reads only the channels its snippets cover.
    """
    step = int(size * (1 - overlap))
    if step < 1:
        raise ValueError("overlap leaves no step between snippets")

    def cut(path: str, shape: tuple[int, ...]) -> list[tuple[int, int, int]]:
        last = shape[-1] // factor - size + 1
        width = 4 * int(np.prod(shape[:-1])) * step * factor
        return [(lo, min(lo + step * snippets_per_split, last), width * snippets_per_split) for lo in range(0, last, step * snippets_per_split)]

    return _load(spark, SnippetSource, _planned(spark, paths, cut, 1), {"size": size, "step": step, "factor": factor})
