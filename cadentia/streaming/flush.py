"""Ingest in flushes: a micro-batch ends after so many rows, or after so much time with fewer.

A streaming data source over a growing folder of Parquet files. Its offsets are row numbers of
the files in order of arrival, so a batch is a range of rows that a replay reads again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadentia.settings import IngestLimits
from cadentia.sources.npy import open_system, qualified

LIMITS = IngestLimits()


class Rows(InputPartition):
    def __init__(self, path: str, lo: int, hi: int):
        self.path, self.lo, self.hi = path, lo, hi


class FlushReader(DataSourceStreamReader):
    """Admits at most ``rows`` rows to a batch, and fewer once the first of them has waited ``seconds``."""

    def __init__(self, options: Mapping[str, str]):
        self.folder, self.rows, self.seconds = options["path"], int(options["rows"]), float(options["seconds"])
        self.checkpoint, self.order = options["checkpoint"], options.get("order", "arrival")
        self.kinds = to_arrow_schema(StructType.fromJson(json.loads(options["schema"])))
        self.files: dict[str, int] = {}  # path -> rows, in order of arrival
        self.admitted: int | None = None
        self.waiting_since: float | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"row": 0}

    def _start(self) -> int:
        """Where the last batch that was planned ends: Spark's own log says so after a restart."""
        system, inner = open_system(f"{self.checkpoint}/offsets")
        if system.get_file_info(inner).type != fs.FileType.Directory:
            return 0
        logged = [f for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.isdigit()]
        if not logged:
            return 0
        with system.open_input_stream(max(logged, key=lambda f: int(f.base_name)).path) as log:
            return json.loads(log.read().decode().strip().split("\n")[-1])["row"]

    def _look(self) -> None:
        """Adds files that have arrived; only their footers are read."""
        system, inner = open_system(self.folder)
        found = [f for f in system.get_file_info(fs.FileSelector(inner, recursive=True)) if f.base_name.endswith(".parquet") and f.is_file]
        for f in sorted(found, key=lambda f: (f.mtime_ns if self.order == "arrival" else 0, f.path)):
            if f.path not in self.files:
                with system.open_input_file(f.path) as file:
                    self.files[f.path] = pq.ParquetFile(file).metadata.num_rows

    def latestOffset(self) -> dict:  # noqa: N802
        if self.admitted is None:
            self.admitted = self._start()
        self._look()
        there = sum(self.files.values()) - self.admitted
        if there >= self.rows:
            self.admitted += self.rows
            self.waiting_since = None
        elif there > 0:
            now = time.monotonic()
            self.waiting_since = now if self.waiting_since is None else self.waiting_since
            if now - self.waiting_since >= self.seconds:
                self.admitted += there
                self.waiting_since = None
        return {"row": self.admitted}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        if sum(self.files.values()) < end["row"]:
            self._look()
        out, first = [], 0
        for path, n in self.files.items():
            lo, hi = max(start["row"], first), min(end["row"], first + n)
            if lo < hi:
                out.append(Rows(path, lo - first, hi - first))
            first += n
        return out

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        """Rows of a file, from the row groups that hold them."""
        system, _ = open_system(self.folder)
        with system.open_input_file(part.path) as file:
            parquet, first = pq.ParquetFile(file, coerce_int96_timestamp_unit="us"), 0
            for group in range(parquet.num_row_groups):
                n = parquet.metadata.row_group(group).num_rows
                lo, hi = max(part.lo - first, 0), min(part.hi - first, n)
                if lo < hi:
                    yield from self._slices(parquet, group, lo, hi)
                first += n

    def _slices(self, parquet: pq.ParquetFile, group: int, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        """Rows ``lo`` to ``hi`` of a row group, a batch at a time."""
        first = 0
        for batch in parquet.iter_batches(row_groups=[group], columns=self.kinds.names):
            at, end = max(lo - first, 0), min(hi - first, batch.num_rows)
            if at < end:
                kept = pa.Table.from_batches([batch.slice(at, end - at)])
                yield from kept.select(self.kinds.names).cast(self.kinds).to_batches()
            first += batch.num_rows
            if first >= hi:
                return

    def commit(self, end: dict) -> None:
        pass


class FlushSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_flushes"

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.options["schema"]))

    def streamReader(self, schema) -> FlushReader:  # noqa: N802
        return FlushReader(self.options)


def ingest_in_flushes(
    spark: SparkSession, folder: str, out: str, checkpoint: str, *, rows: int = LIMITS.rows, seconds: float = LIMITS.interval_seconds, order: str = "arrival"
) -> StreamingQuery:
    """Writes the rows of ``folder``'s files below ``out``, a folder ``batch_id=n`` for each flush.

    A flush has ``rows`` rows, or fewer when no more came for ``seconds``; every row is written
    once, and a batch that runs again overwrites what it wrote. New files must be newer than those before;
    with ``order="name"`` files follow one another by their paths instead, as tasks that write
    side by side end in any order, and new ones must come behind those before.
    """
    if order not in ("arrival", "name"):
        raise ValueError(f"unknown order {order!r}")
    spark.dataSource.register(FlushSource)
    options = {"path": qualified(spark, folder), "checkpoint": qualified(spark, checkpoint), "rows": rows, "seconds": seconds, "order": order}
    options["schema"] = spark.read.parquet(folder).schema.json()
    stream = spark.readStream.format(FlushSource.name()).options(**options).load()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()


def drain_flushes(query: StreamingQuery) -> None:
    """Waits until everything that is there has been flushed, then stops."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
