"""Progress of streaming queries as tables, taken from Spark's own reports.

Spark remembers a query's last reports only. `ProgressLog` writes each one down as it comes, so that sums over a
query's life, restarts included, leave nothing out.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rillstone.streaming.snapshots import Part, Snapshots, due

PROGRESS = (
    "query_id string, batch_id bigint, started string, input_rows bigint, rows_per_second double, "
    "state_rows bigint, late_rows_dropped bigint, observed map<string, bigint>"
)
LAG = "source string, topic string, partition int, committed bigint, latest bigint, lag bigint"


def _plain(report) -> Mapping:
    return json.loads(report.json) if hasattr(report, "json") else report


def _observed(report: Mapping) -> dict[str, int]:
    metrics = report.get("observedMetrics") or {}
    return {f"{group}.{name}": int(value) for group, row in metrics.items() for name, value in row.items()}


def progress_report(spark: SparkSession, reports: Iterable) -> DataFrame:
    """One row per micro-batch of `query.recentProgress`, with the counts the plan observes."""
    rows = []
    for report in map(_plain, reports):
        operators = report.get("stateOperators") or []
        rows.append(
            (
                report["id"],
                report["batchId"],
                report["timestamp"],
                report.get("numInputRows", 0),
                float(report.get("processedRowsPerSecond") or 0.0),
                sum(op["numRowsTotal"] for op in operators),
                sum(op.get("numRowsDroppedByWatermark", 0) for op in operators),
                _observed(report),
            )
        )
    return spark.createDataFrame(rows, PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Writes every report down as a part of its query's table (see `snapshots`), merged in levels, so that a job that
    never ends leaves few files; the report of a repeated batch replaces the one before.

        log = ProgressLog(spark, folder)
        spark.streams.addListener(log)
    """

    def __init__(self, spark: SparkSession, root: str, fan: int = 32):
        self.spark, self.root, self.fan, self.last = spark, root, fan, {}
        self.snapshots = Snapshots(root)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        report = event.progress
        if report.numInputRows or report.observedMetrics:
            rows = progress_report(self.spark, [report]).drop("query_id")
            self._add(f"query_id={report.id}", Part(report.batchId, report.batchId), rows)
        self.last[str(report.id)] = report.batchId

    def _add(self, name: str, part: Part, rows: DataFrame) -> None:
        """Reports come one after the other, on one thread."""
        now = self.snapshots.newest(self.spark)
        if any(part.first in p for p in now.parts(name) if p.level):
            return
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{part.folder(name)}")
        if part in now.parts(name):
            return
        now = now.replacing(name, [], part)
        if found := due(now.parts(name), self.fan):
            group, merged = found
            held = self._read(name, group).drop("query_id", "first_batch", "last_batch")
            held.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{merged.folder(name)}")
            now = now.replacing(name, group, merged)
        self.snapshots.commit(self.spark, now)
        if found:
            self.snapshots.clean_up(self.spark)

    def _read(self, name: str, parts: Iterable[Part]) -> DataFrame:
        schema = f"{PROGRESS}, first_batch bigint, last_batch bigint"
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.parquet(*[f"{self.root}/{p.folder(name)}" for p in parts])

    def settled(self, query: StreamingQuery, patience: float = 60.0) -> None:
        """Wait until the last report of an ended query is written; reports arrive on another thread."""
        newest, until = query.lastProgress, time.monotonic() + patience
        while newest and self.last.get(str(query.id), -1) < newest["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {newest['batchId']}")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        """One row per query and micro-batch, from all runs that wrote to this folder."""
        tables = self.snapshots.newest(self.spark).tables
        rows = self.spark.createDataFrame([], PROGRESS)
        for name, parts in tables.items():
            rows = rows.unionByName(self._read(name, parts).drop("first_batch", "last_batch"))
        return rows


def _offsets(text) -> Mapping:
    value = json.loads(text) if isinstance(text, str) else text
    return value if isinstance(value, Mapping) else {}


def consumer_lag(spark: SparkSession, report) -> DataFrame:
    """Committed and latest offset of every topic partition of one progress report."""
    rows = []
    for source in _plain(report).get("sources", []):
        done, newest = _offsets(source.get("endOffset")), _offsets(source.get("latestOffset"))
        for topic, partitions in done.items():
            if not isinstance(partitions, Mapping):
                rows.append((source["description"], None, None, int(partitions), None, None))
                continue
            for number, offset in partitions.items():
                latest = (newest.get(topic) or {}).get(number)
                lag = None if latest is None else latest - offset
                rows.append((source["description"], topic, int(number), offset, latest, lag))
    return spark.createDataFrame(rows, LAG)


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """What a streaming dedup holds after a batch, or now: (event_id, expires_at), read by Spark's state data source."""
    reader = spark.read.format("statestore")
    reader = reader if batch_id is None else reader.option("batchId", batch_id)
    expires = F.timestamp_micros(F.col("value.expiresAtMicros")).alias("expires_at")
    return reader.load(checkpoint).select("key.*", expires)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful steps of a query: operator, its partitions, and the batches whose state can be read."""
    return spark.read.format("state-metadata").load(checkpoint)
