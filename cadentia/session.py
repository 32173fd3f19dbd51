"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a raw observation is 256 KB: bound Arrow batches by bytes, not by row count
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a few folders per task (sets, tables) are written side by side, without sorting
    # the wide rows by folder first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # do not capture a Python call site for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "cadentia", master: str | None = None, **conf) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, where every executor can read it.

    Only a local-mode session, as in tests, may fall back to the machine's own
    temporary folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="cadentia-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if owner := _OWNER.get():
        _OWNED.setdefault(owner, []).append(path)
    return path


_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)
_OWNED: dict[str, list[str]] = {}


@contextmanager
def owned_scratch(owner: str) -> Iterator[None]:
    """Folders made inside belong to ``owner``, who drops them when nothing reads them any more."""
    token = _OWNER.set(owner)
    try:
        yield
    finally:
        _OWNER.reset(token)


def drop_scratch(spark: SparkSession, owner: str) -> None:
    """Deletes the scratch folders that belong to ``owner``."""
    for path in _OWNED.pop(owner, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the table's true
    size: it then broadcasts it in a join only if it is below the session's threshold,
    before the other, wide side has been shuffled for nothing.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
