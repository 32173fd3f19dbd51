"""A user's generator over the sample plan, as a table function.

The generator sees the planned samples of one chunk after another, each with its background, and
makes any number of rows of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: One chunk of a set's class is a partition of the table function: the plan bounds its size.
CHUNK = ("split_set", "class", "chunk")
Generator = Callable[[Row, np.ndarray], Iterable[np.ndarray]]
_MADE = "sample_idx bigint, background_idx bigint, nth int, cells array<double>"


def planned_backgrounds(plan: DataFrame, backgrounds: DataFrame, pick) -> DataFrame:
    """``plan`` with the cadence that ``pick``, a column of it, names by its dense ``background_idx``.

    The payload moves once, to the samples; equal picks meet on uniform indexes.
    """
    return plan.withColumn("background_idx", pick.cast("bigint")).join(backgrounds, "background_idx")


def generate_with(planned: DataFrame, make: Callable[[], Generator]) -> DataFrame:
    """Rows ``split_set, class, chunk, sample_idx, background_idx, nth, cells`` of a user's generator.

    ``make`` is called once for a chunk and gives the generator, which maps a planned sample and
    its cadence (observations x cells) to arrays of cells. Chunks are dealt out whole and their
    samples arrive in order of ``sample_idx``, so a generator may keep state within a chunk.
    """

    class Generate:
        def __init__(self) -> None:
            self.generator = None

        def eval(self, row: Row) -> Iterator[tuple]:
            self.generator = self.generator or make()
            obs = np.array(row["obs_cells"], dtype=np.float64)
            for nth, cells in enumerate(self.generator(row, obs)):
                made = [float(c) for c in np.ravel(cells)]
                yield *(row[c] for c in CHUNK), row["sample_idx"], row["background_idx"], nth, made

    kinds = {f.name: f.dataType.simpleString() for f in planned.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in CHUNK) + ", " + _MADE
    function = F.udtf(Generate, returnType=schema, useArrow=True)
    table = planned.select(*CHUNK, "sample_idx", "background_idx", "obs_cells").asTable()
    return function(table.partitionBy(*CHUNK).orderBy("sample_idx"))

