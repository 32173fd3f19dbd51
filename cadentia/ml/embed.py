"""Observation embeddings and batch scoring with a user's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadentia.settings import DetectionRule

#: Directions beyond the ``k`` wanted, steps at most, and the residual, as a share of the largest variance, that ends them.
EXTRA, STEPS, TOLERANCE = 8, 12, 1e-9
#: Sums of the tasks that reach the driver.
SUMS = 16


@dataclass(frozen=True)
class Embedding:
    """``components`` (cells x k, orthonormal) and the ``variances`` along them; ``mean`` of the cells."""

    components: np.ndarray
    variances: np.ndarray
    mean: np.ndarray
    rows: int


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column(0).drop_null()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of a matrix over all batches of rows: in the tasks, then in ``SUMS`` groups, then here."""
    width = shape[0]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += of(_cells(batch, width))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId() % SUMS], "sum": [total.tobytes()]})

    def merged(group: pa.Table) -> pa.Table:
        total = np.zeros(shape)
        for one in group["sum"]:
            total += np.frombuffer(one.as_py()).reshape(shape)
        return pa.table({"sum": [total.tobytes()]})

    sums = rows.mapInArrow(partial, "part long, sum binary").groupBy("part").applyInArrow(merged, "sum binary")
    return sum((np.frombuffer(r[0]).reshape(shape) for r in sums.collect()), np.zeros(shape))


def fit_embedding(obs: DataFrame, k: int = 8, value: str = "cells", seed: int = 11) -> Embedding:
    """The ``k`` directions of the largest variance of the observations.

    A randomised block Krylov method: a step is one pass over the rows, in which every task multiplies its
    own rows with a block of directions, so no matrix of cells by cells exists anywhere; what the driver holds is
    the cells times the directions. The steps end when the directions wanted no longer move. A direction's
    largest entry is positive.
    """
    rows = obs.select(F.col(value).cast("array<double>").alias("cells")).where("cells is not null")
    first = rows.first()
    if first is None:
        raise ValueError("an embedding needs rows")
    d = len(first.cells)
    if not 1 <= k <= d:
        raise ValueError(f"{k} components of {d} cells")
    spark = rows.sparkSession

    def counted(x: np.ndarray) -> np.ndarray:
        return np.stack([x.sum(axis=0), np.full(d, float(len(x)))], axis=1)

    sums = _summed(rows, (d, 2), counted)
    n = int(sums[0, 1])
    mean = sums[:, 0] / n
    width = min(d, k + EXTRA)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    basis, images = np.empty((d, 0)), np.empty((d, 0))
    for _ in range(STEPS):
        held = spark.sparkContext.broadcast((mean, block))

        def image(x: np.ndarray, held=held) -> np.ndarray:
            centre, directions = held.value
            x = x - centre
            return x.T @ (x @ directions)

        found = _summed(rows, block.shape, image) / max(n - 1, 1)
        held.destroy()
        basis, images = np.hstack([basis, block]), np.hstack([images, found])
        values, vectors = np.linalg.eigh((basis.T @ images + images.T @ basis) / 2)
        top = vectors[:, ::-1][:, :k]
        variances = values[::-1][:k]
        components = basis @ top
        residual = np.linalg.norm(images @ top - components * variances, axis=0).max()
        if residual <= TOLERANCE * max(variances[0], 1e-300) or basis.shape[1] >= d:
            break
        rest = found - basis @ (basis.T @ found)
        rest -= basis @ (basis.T @ rest)
        q, r = np.linalg.qr(rest)
        block = q[:, np.abs(np.diag(r)) > 1e-12 * max(variances[0], 1e-300)][:, : d - basis.shape[1]]
        if not block.shape[1]:
            break
    largest = components[np.abs(components).argmax(axis=0), np.arange(k)]
    return Embedding(components * np.where(largest < 0, -1.0, 1.0), variances, mean, n)


def embed(model: Embedding, obs: DataFrame, value: str = "cells", into: str = "z") -> DataFrame:
    """Deterministic latent per observation: its cells along the components; row-local. Null cells give null."""
    held = obs.sparkSession.sparkContext.broadcast(model.components)

    def latent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        components = held.value
        d, k = components.shape
        for batch in batches:
            cells = batch.column(value)
            known = cells.is_valid().to_numpy(zero_copy_only=False)
            x = cells.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
            # a row's sum must not depend on the rows beside it
            z = np.stack([(x * c).sum(axis=1) for c in components.T], axis=1)
            offsets = np.concatenate([[0], np.cumsum(np.where(known, k, 0))])
            latents = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(z.ravel()), mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([*batch.columns, latents], [*batch.schema.names, into])

    return obs.mapInArrow(latent, T.StructType([*obs.schema.fields, T.StructField(into, T.ArrayType(T.DoubleType()))]))


def batch_score(
    df: DataFrame,
    make_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    n_values: int,
    *,
    value: str = "cells",
    into: str = "p",
    batch_size: int = DetectionRule.batch_size,
) -> DataFrame:
    """Scores with any model that maps a batch of rows to one number each.

    ``make_model`` runs once per Python worker, so a model is loaded once; the batch
    size bounds memory and never changes a result.
    """
    predict = predict_batch_udf(
        make_model,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[n_values]],
    )
    return df.withColumn(into, predict(F.col(value)))
