"""The plateau rule over losses that arrive as a stream, in any order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cadentia.operators.tracking import PlateauFold, plateau
from cadentia.settings import Plateau
from cadentia.streaming.telemetry import _start, _stored, rocks_state

KEYS = ("tag", "round")
OUTPUT = "tag string, round bigint, epoch bigint, val_loss double, misses bigint, lr double"
_TRACE = f"{OUTPUT}, best double, settled boolean"
_ROW = Row(*[f.split()[0] for f in _TRACE.split(", ")])


class Follow(StatefulProcessor):
    """Keeps the state of a round after its first epochs without a gap, and the epochs that came too early.

    An epoch is *settled* as soon as all before it, from 0 on, are there: its row has the rule's
    state. One that comes too early waits in the round's map; its row says so. What a batch
    does to a round grows with the round's new epochs and those they set free.
    """

    def __init__(self, par: Plateau):
        self.par = par

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fold = handle.getValueState("fold", "following bigint, waiting bigint, best double, misses bigint, lr double")
        self.early = handle.getMapState("early", "epoch bigint", "val_loss double")

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:  # noqa: N802
        following, waiting, *state = self.fold.get() or (0, 0, None, None, None)
        fold = PlateauFold(self.par, *state)
        arrived: dict[int, float | None] = {}
        for row in rows:
            if row.epoch is None or row.epoch < 0:
                raise ValueError("epoch lies outside the round")
            if row.epoch < following or row.epoch in arrived or (waiting and self.early.containsKey((row.epoch,))):
                raise ValueError("an epoch has two losses")
            arrived[row.epoch] = row.val_loss
        while True:
            if following in arrived:
                loss = arrived.pop(following)
            elif waiting and self.early.containsKey((following,)):
                loss = self.early.getValue((following,))[0]
                self.early.removeKey((following,))
                waiting -= 1
            else:
                break
            misses, lr = fold.step(loss)
            yield _ROW(*key, following, loss, misses, lr, fold.best, True)
            following += 1
        for epoch, loss in sorted(arrived.items()):
            self.early.updateValue((epoch,), (loss,))
            yield _ROW(*key, epoch, loss, None, None, None, False)
        self.fold.update((following, waiting + len(arrived), fold.best, fold.misses, fold.lr))

    def close(self) -> None:
        pass


def write_plateau(
    losses: DataFrame, path: str, checkpoint: str, par: Plateau = Plateau(), *, once: bool = False
) -> StreamingQuery:
    """Follows every round of ``tag, round, epoch, val_loss`` as its epochs arrive; rows go below ``path``.

    The state lies in Spark's state store, so it survives a restart from the checkpoint, and a
    batch that runs again overwrites what it wrote.
    """
    rows = losses.select(*KEYS, F.col("epoch").cast("bigint").alias("epoch"), F.col("val_loss").cast("double").alias("val_loss"))
    with rocks_state(losses.sparkSession):
        trace = rows.groupBy(*KEYS).transformWithState(Follow(par), _TRACE, "Update", "None")

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        writer = trace.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return _start(writer, once=once)


def stream_plateau(spark: SparkSession, path: str, par: Plateau = Plateau()) -> DataFrame:
    """Learning rate after each epoch that has arrived so far, as :func:`plateau` has it.

    Epochs that still wait for an earlier one are followed from the round's settled state here.
    """
    trace = _stored(spark, path, f"{_TRACE}, batch_id bigint").drop("batch_id")
    settled = trace.where("settled")
    waiting = trace.where("not settled").select(*KEYS, "epoch", "val_loss").join(settled, [*KEYS, "epoch"], "left_anti")
    last = settled.groupBy(*KEYS).agg(F.max_by(F.struct("best", "misses", "lr"), "epoch").alias("s")).select(*KEYS, "s.*")
    names = [f.split()[0] for f in OUTPUT.split(", ")]
    return settled.select(names).unionByName(plateau(waiting, par, KEYS, last).select(names))
