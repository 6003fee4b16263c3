"""Start the continuous jobs."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillstone.operators.dedup import newest_per_key
from rillstone.operators.metrics import WINDOW, MetricTable
from rillstone.sources.store import PARTITIONS, with_partitions
from rillstone.streaming.fanout import Fanout

STORE_EVERY = "30 seconds"
SERVE_EVERY = "10 seconds"
SPREAD = 4  # tasks that share a directory of the store in one trigger


def _trigger(every: str | None) -> dict:
    """A processing-time trigger, or (every=None) work off what is there and stop."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def start_store(
    events: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = PARTITIONS,
    fmt: str = "parquet",
    every: str | None = STORE_EVERY,
    name: str | None = None,
    writers: int | None = None,
    spread: int = SPREAD,
) -> StreamingQuery:
    """Append cleaned events to a table by kind and day, exactly once through the file sink's own log.

    Kinds that are not known share one directory, as their names come from outside. Each trigger leaves a file per
    writing task and directory. If every state partition wrote, that would be hundreds a directory: rows are therefore
    shuffled by directory first, and at most `spread` tasks write to each. With `writers`, that many tasks write to all.
    """
    events = with_partitions(events)
    slot = F.pmod(F.xxhash64("event_id"), F.lit(spread))
    events = events.repartition(writers) if writers else events.repartition(*partition_by, slot)
    writer = events.writeStream.format(fmt).outputMode("append").partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start(path)


def start_fanout(
    checked: DataFrame,
    fanout: Fanout,
    checkpoint: str,
    every: str | None = SERVE_EVERY,
    name: str | None = None,
) -> StreamingQuery:
    """Feed every micro-batch of `checked_stream` to the fan-out. One query, so one set of offsets."""
    writer = checked.writeStream.outputMode("append").foreachBatch(fanout)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def _replace_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_windows(
    metrics: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = SERVE_EVERY,
    mode: str = "update",
    writers: int | None = None,
) -> StreamingQuery:
    """Write window metrics: in `update` mode the rows that changed with each micro-batch, windows that are still
    open included (read them with `current_windows`); in `append` mode each window once, when it has closed."""
    metrics = metrics.repartition(writers) if writers else metrics
    writer = metrics.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**_trigger(every))
    if mode == "update":
        return writer.foreachBatch(_replace_batch(path)).start()
    return writer.format("parquet").start(path)


def current_windows(spark: SparkSession, path: str, table: MetricTable) -> DataFrame:
    """The newest row of every window that `start_windows` has written as updates."""
    rows = spark.read.parquet(path)
    return newest_per_key(rows, [*WINDOW, *table.dims], ["batch_id"]).drop("batch_id")


def await_any(spark: SparkSession) -> None:
    """Block until one query ends; its error, if any, is raised here."""
    spark.streams.awaitAnyTermination()


@dataclass(frozen=True)
class Attempt:
    """One run of a supervised query: its place among the query's runs, and the error that ended it, if one did."""

    name: str
    number: int
    run_id: str
    error: str | None


def supervise(starts: Mapping[str, Callable[[], StreamingQuery]], most: int = 3, every: float = 0.2) -> list[Attempt]:
    """Run queries side by side until all have ended; returns their runs in the order in which they ended.

    A query that fails is started again, from its own checkpoint, while the others go on. One that has failed `most`
    times is given up: the others are stopped and its error is raised.
    """
    running = {name: (1, start()) for name, start in starts.items()}
    ended: list[Attempt] = []
    try:
        while running:
            for name, (number, query) in list(running.items()):
                if query.isActive:
                    continue
                error = query.exception()
                ended.append(Attempt(name, number, str(query.runId), str(error) if error else None))
                del running[name]
                if error and number >= most:
                    raise error
                if error:
                    running[name] = (number + 1, starts[name]())
            time.sleep(every if running else 0)
    finally:
        for _, query in running.values():
            query.stop()
    return ended
