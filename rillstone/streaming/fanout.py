"""One micro-batch to many tables, safe to repeat and to read at any time.

Each batch writes a part of every table it has rows for, a folder of its own, and then one snapshot that names them all
(see `snapshots`). Until then nobody sees any of it; a batch that fails half-way is run again by Spark with the same rows
and the same id, and overwrites its folders. Nothing is caught: an error must stop the batch, or its rows would be
committed without being stored.

A batch is deduplicated against the ledger of all ids accepted before (see `ids`), not by a stream's state: there is no
horizon, and rejects pass by. It is kept while it is looked through and evaluated once, by the write of the records
table; everything after reads that table back, the directories and columns of its own kind only.

Now and then parts are merged in levels, so that a job that never ends keeps few folders and writes each row a few times.
What each batch added is kept apart from the merged state.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, StringType, StructField, StructType

from rillstone.functions import at_or_after_day, within
from rillstone.functions.timing import AsOf, cover
from rillstone.operators.clean import served
from rillstone.operators.dedup import distinct_events
from rillstone.operators.metrics import (
    CLICKSTREAM,
    LOG,
    MINUTE,
    SENSOR,
    TABLES,
    WINDOW,
    MetricTable,
    finish,
    finish_members,
    merge_state,
    metric_state,
    sketch_members,
)
from rillstone.operators.wire import keyed_records, keyed_rows
from rillstone.schemas import CLEANED_COLUMNS, TOPIC_CLEANED, TOPIC_CURATED, TOPIC_DEAD
from rillstone.session import fresh_folder
from rillstone.sinks.topics import FolderTopics, KafkaTopics
from rillstone.sources.folders import folder_exists
from rillstone.sources.jdbc import JdbcDatabase
from rillstone.sources.store import EventStore, cleaned_schema, partition_fields, placed, with_partitions
from rillstone.streaming.bitmaps import DICTIONARY_SCHEMA, bitmap_sizes, member_bitmaps, merge_bitmaps, numbered
from rillstone.streaming.ids import IDS, IdLedger
from rillstone.streaming.snapshots import FAN, Part, Snapshot, Snapshots, due

log = logging.getLogger("rillstone.fanout")

RECORDS = "records"
MEMBERS = "clickstream_members"
WINDOW_DATE = "window_date"
DAY_SLOT, DAY_SLOTS = "day_slot", 32
COUNTS = "batch_counts"
USERS, BITMAPS = "user_numbers", "clickstream_bitmaps"
AT = "@"  # between a metric table and the length of the longer windows it is rolled up to
LATE, TOO_LATE = "late_events", "window_closed"
ACCEPTED, REJECTED, NEWEST = "accepted", "rejected", "newest_event"
LAYOUT = ("outcome", "event_kind")  # a batch is small: days are a column here, and directories in the event store
ARRIVAL_ORDER = ("kafka_timestamp", "partition", "offset")
SPAN = [StructField("first_batch", LongType(), True), StructField("last_batch", LongType(), True)]
LATE_SCHEMA = "event_id string, event_type string, event_ts timestamp, closed_at timestamp, reason string, batch_id bigint"
COUNTS_SCHEMA = "batch_id bigint, table_name string, row_count bigint"
EXTRA_FIELDS = [
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("reject_reason", StringType(), True),
    StructField("field_fault", BooleanType(), True),
    StructField("raw_json", StringType(), True),
]
_STATE_SCHEMAS: dict[str, StructType] = {}


def records_schema() -> StructType:
    outcome = StructField("outcome", StringType(), True)
    kind, date = partition_fields()
    return StructType([*cleaned_schema().fields, *EXTRA_FIELDS, date, *SPAN, outcome, kind])


def by_batch(name: str) -> str:
    """The table of what each batch has added to a metric table, once its parts are merged."""
    return f"{name}_by_batch"


def rolled(name: str, every: str) -> str:
    """The table of a metric table's state in longer windows."""
    return f"{name}{AT}{every.replace(' ', '_')}"


def seconds_of(every: str) -> int:
    count, unit = every.split()
    return int(count) * {"minute": 60, "hour": 3600, "day": 86_400}[unit.removesuffix("s")]


def state_schema(spark: SparkSession, name: str) -> StructType:
    """The columns of a state table, with its directories and the day."""
    name = name.partition(AT)[0]
    if name == BITMAPS and name not in _STATE_SCHEMAS:
        dims = [StructField(d, StringType(), True) for d in CLICKSTREAM.dims]
        rest = "window_start timestamp, window_end timestamp, bitmap_bucket bigint, bits binary"
        _STATE_SCHEMAS[name] = StructType([*dims, *StructType.fromDDL(rest).fields])
    if name not in _STATE_SCHEMAS:
        none = spark.createDataFrame([], StructType([*cleaned_schema().fields, *partition_fields()]))
        _STATE_SCHEMAS[name] = metric_state(none, TABLES.get(name, CLICKSTREAM), members=name == MEMBERS).schema
    return StructType([*_STATE_SCHEMAS[name].fields, *SPAN, StructField(WINDOW_DATE, DateType(), True)])


@dataclass(frozen=True)
class Tables:
    """Reads what a fan-out job has written below `root`, as of its newest snapshot or a given one."""

    root: str
    pinned: Snapshot | None = None

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.root)

    def snapshot(self, spark: SparkSession) -> Snapshot:
        return self.pinned or self.snapshots.newest(spark)

    def at(self, snapshot: Snapshot) -> Tables:
        """The same tables as of one snapshot, for several reads that must agree."""
        return Tables(self.root, snapshot)

    def path(self, name: str, part: Part) -> str:
        return f"{self.root}/{part.folder(name)}"

    def read(self, spark: SparkSession, name: str, parts: Sequence[Part], schema: StructType) -> DataFrame:
        """The rows of some parts. A part without rows is a folder without files."""
        if not parts:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[self.path(name, p) for p in parts]).drop(DAY_SLOT)

    def records(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        parts = self.snapshot(spark).parts(RECORDS) if batch_id is None else [Part(batch_id, batch_id)]
        return self.read(spark, RECORDS, parts, records_schema()).withColumnRenamed("first_batch", "batch_id").drop("last_batch")

    def accepted(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        rows = self.records(spark, batch_id).where(F.col("outcome") == ACCEPTED)
        return rows.drop("outcome", "reject_reason", "raw_json")

    def rejected(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        rows = self.records(spark, batch_id).where(F.col("outcome") == REJECTED)
        return rows.select(
            "kafka_key", "kafka_timestamp", "partition", "offset", "event_id", "reject_reason", "raw_json", "batch_id"
        )

    def ids(self, spark: SparkSession) -> DataFrame:
        """Every id ever accepted, with its batch."""
        return IdLedger(self.root).table(spark, self.snapshot(spark).parts(IDS)).select("event_id", "batch_id")

    def state(self, spark: SparkSession, name: str, span: str | None = None, as_of: AsOf = None) -> DataFrame:
        """State rows of all batches, optionally of the windows of a time range; that reads its days only."""
        rows = self.part_state(spark, name, self.snapshot(spark).parts(name))
        if span is None:
            return rows
        return rows.where(within("window_start", span, as_of) & at_or_after_day(WINDOW_DATE, span, as_of))

    def part_state(self, spark: SparkSession, name: str, parts: Sequence[Part]) -> DataFrame:
        return self.read(spark, name, parts, state_schema(spark, name))

    def state_by_batch(self, spark: SparkSession, name: str) -> DataFrame:
        """State rows as the batches wrote them, with `batch_id`: of merged parts as kept apart, of others themselves."""
        snapshot = self.snapshot(spark)
        schema = state_schema(spark, name)
        schema = StructType([StructField("batch_id", LongType(), True), *schema.fields])
        merged = self.read(spark, by_batch(name), snapshot.parts(by_batch(name)), schema)
        recent = self.part_state(spark, name, [p for p in snapshot.parts(name) if not p.level])
        return merged.unionByName(recent.withColumn("batch_id", F.col("first_batch")))

    def row_counts(self, spark: SparkSession) -> DataFrame:
        """`batch_id`, `table_name`, `row_count`: what each micro-batch wrote, as counted while it was written."""
        snapshot = self.snapshot(spark)
        recent = spark.createDataFrame(count_rows(snapshot), COUNTS_SCHEMA)
        if not snapshot.parts(COUNTS):
            return recent
        return spark.read.schema(COUNTS_SCHEMA).parquet(*[self.path(COUNTS, p) for p in snapshot.parts(COUNTS)]).unionByName(recent)

    def lag(self, spark: SparkSession, wire: DataFrame) -> DataFrame:
        """How far the job is behind each partition of a topic: newest offset there is, newest one processed, and the
        difference. `wire` has the columns of a broker's records."""
        done = self.snapshot(spark).offsets
        rows = [(int(number), offset) for number, offset in done.items()]
        processed = spark.createDataFrame(rows, "partition int, processed bigint")
        newest = wire.groupBy("partition").agg(F.max("offset").alias("newest"))
        joined = newest.join(F.broadcast(processed), "partition", "left")  # one row a partition
        return joined.select("partition", "newest", "processed", (F.col("newest") - F.col("processed")).alias("lag"))

    def users(self, spark: SparkSession, parts: Sequence[Part] | None = None) -> DataFrame:
        """The dictionary of users: (member, number)."""
        parts = self.snapshot(spark).parts(USERS) if parts is None else parts
        schema = StructType([*StructType.fromDDL(DICTIONARY_SCHEMA).fields, *SPAN])
        return self.read(spark, USERS, parts, schema).drop(*[f.name for f in SPAN])

    def late(self, spark: SparkSession) -> DataFrame:
        """Events that came after their window had closed, with the time it was closed by."""
        return self.late_parts(spark, self.snapshot(spark).parts(LATE))

    def late_parts(self, spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
        schema = StructType([*StructType.fromDDL(LATE_SCHEMA).fields, *SPAN])
        return self.read(spark, LATE, parts, schema).drop(*[f.name for f in SPAN])

    def batch_metrics(self, spark: SparkSession, table: MetricTable) -> DataFrame:
        """The rows each batch contributed: a window that spans batches has several, told by batch_id."""
        return finish(self.state_by_batch(spark, table.name), table, "batch_id")

    def metrics(
        self,
        spark: SparkSession,
        table: MetricTable,
        every: str | None = None,
        exact: bool = True,
        span: str | None = None,
        as_of: AsOf = None,
    ) -> DataFrame:
        """One final row per window: all batches added up, distinct counts exact unless declined."""
        if table.distinct and exact:
            return finish_members(self.state(spark, MEMBERS, span, as_of), table, every)
        return finish(merge_state(self.state(spark, table.name, span, as_of), table, every), table)

    def metrics_of_bitmaps(self, spark: SparkSession, every: str | None = None) -> DataFrame:
        """Click metrics with exact distinct counts from merged bitmaps; `every` may name longer windows."""
        keys = [*WINDOW, *CLICKSTREAM.dims]
        bitmaps, states = self.state(spark, BITMAPS), self.state(spark, CLICKSTREAM.name)
        if every:
            bitmaps = bitmaps.withColumn("_w", F.window("window_start", every))
            bitmaps = bitmaps.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        sizes = bitmap_sizes(merge_bitmaps(bitmaps, keys), keys, "_members")
        rows = finish(merge_state(states, CLICKSTREAM, every), CLICKSTREAM).alias("s")
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
        counted = F.coalesce(F.col("m._members"), F.lit(0).cast("bigint")).alias(CLICKSTREAM.distinct[0])
        columns = [counted if c == CLICKSTREAM.distinct[0] else F.col(f"s.{c}") for c in CLICKSTREAM.columns]
        return rows.join(sizes.alias("m"), same, "left").select(*columns)

    def covered(self, spark: SparkSession, table: MetricTable, steps: Sequence[str], start: dt.datetime, end: dt.datetime) -> DataFrame:
        """State rows that make up the time from `start` to `end`, from the largest windows that fit: whole days out of
        the days' table, what is left at both ends out of hours, and of those out of minutes. Times are UTC."""
        at = [int(t.replace(tzinfo=dt.timezone.utc).timestamp()) for t in (start, end)]
        found = None
        for k, low, high in cover(*at, [seconds_of(s) for s in steps]):
            rows = self.state(spark, rolled(table.name, steps[k]) if k else table.name)
            first, last = (F.timestamp_seconds(F.lit(t)) for t in (low, high))
            rows = rows.where((F.col("window_start") >= first) & (F.col("window_start") < last))
            rows = rows.where(F.col(WINDOW_DATE).between(F.to_date(first), F.to_date(last)))
            found = rows if found is None else found.unionByName(rows)
        return found if found is not None else self.state(spark, table.name).limit(0)

    def touched_metrics(self, spark: SparkSession, table: MetricTable, batch_id: int, span: tuple | None = None) -> DataFrame:
        """The final rows, over all batches so far, of the windows that one batch has changed. Read are the days the
        batch has written to, and of these the files' row groups between its first and its last window."""
        name, own = MEMBERS if table.distinct else table.name, Part(batch_id, batch_id)
        keys = [WINDOW_DATE, *WINDOW, *table.dims]
        mine = self.part_state(spark, name, [own])
        changed = mine.select(*keys).distinct()
        days = [r[0] for r in mine.select(WINDOW_DATE).distinct().collect()]  # one row a day
        low, high = (F.timestamp_micros(F.lit(x)) for x in span or mine.agg(*ends_of_windows()).first())
        states = self.state(spark, name).where(F.col(WINDOW_DATE).isin(days) & F.col("window_start").between(low, high))
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
        rows = states.alias("s").join(changed.alias("c"), same, "left_semi")
        return finish_members(rows, table) if table.distinct else finish(merge_state(rows, table), table)


def ends_of_windows() -> list[Column]:
    """Starts of the first and the last window, in microseconds."""
    return [F.unix_micros(f("window_start")).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]


def count_rows(snapshot: Snapshot) -> list[tuple[int, str, int]]:
    return [(number, name, n) for number, row in snapshot.counts.items() for name, n in row.items()]


def archive_days(
    spark: SparkSession, tables: Tables, store: EventStore, first: dt.date, last: dt.date, undated: bool = True
) -> None:
    """Write the accepted rows of whole days into the event store, in well-sized files, each id once.

    Micro-batches leave many small files; this adds all batches' rows of the given days, and those without a readable
    time, to what the store has of them. Run it when a day is over, and again if late rows have come in: repeating it
    changes nothing. An id that was accepted twice, as by two jobs, keeps its earliest arrival.
    """
    wanted = F.col("event_date").between(F.lit(first), F.lit(last))
    _archive(spark, tables, store, wanted | F.col("event_date").isNull() if undated else wanted)


def _archive(spark: SparkSession, tables: Tables, store: EventStore, wanted: Column) -> None:
    rows = tables.accepted(spark).where(wanted).select(*CLEANED_COLUMNS, "partition", "offset")
    if folder_exists(spark, store.path):
        # What is stored has its place in the topic no more; among equal arrivals it comes first.
        held = store.scan(spark).where(wanted).select(*CLEANED_COLUMNS)
        place = {"partition": F.lit(-1), "offset": F.lit(-1).cast("bigint")}
        rows = rows.unionByName(held.withColumns(place))
    staged = fresh_folder(spark, "archive")
    distinct_events(rows).select(*CLEANED_COLUMNS).write.parquet(staged)
    store.replace_days(spark.read.schema(cleaned_schema()).parquet(staged))


def archive_batches(spark: SparkSession, tables: Tables, store: EventStore, upto: int) -> None:
    """Move the events of all batches up to `upto` into the event store, with whole days, and let go of their records.

    The days are those the batches have written to, however far apart. Rejects go as well: they have been published.
    """
    snapshot = tables.snapshots.newest(spark)
    old = [p for p in snapshot.parts(RECORDS) if p.last <= upto]
    if not old:
        return
    rows = tables.read(spark, RECORDS, old, records_schema()).where(F.col("outcome") == ACCEPTED)
    days = [r[0] for r in rows.select("event_date").distinct().collect()]  # one row a day
    wanted = F.col("event_date").isin([d for d in days if d]) | (F.col("event_date").isNull() if None in days else F.lit(False))
    _archive(spark, tables.at(snapshot), store, wanted)
    drop_batches(spark, tables, upto)


def drop_batches(spark: SparkSession, tables: Tables, upto: int) -> None:
    """Let go of the records of batches up to `upto`. Their days must have been archived, undated rows as well. The
    folders are deleted when no snapshot that is still kept names them."""
    snapshot = tables.snapshots.newest(spark)
    gone = [p for p in snapshot.parts(RECORDS) if p.last <= upto]
    if gone:
        tables.snapshots.commit(spark, snapshot.replacing(RECORDS, gone))


def merge_parts(spark: SparkSession, tables: Tables, fan: int = FAN) -> list[tuple[str, Part]]:
    """Merge what is due in every table, in one new snapshot; returns the new parts.

    State is added up, and what the batches it came from had written is kept apart once. If a run ends half-way, its
    folders are named nowhere and the next run overwrites them.
    """
    old = now = tables.snapshots.newest(spark)
    at, steps, made = tables.at(old), [], []

    def add(name: str, part: Part, write: Callable[[str], None]) -> None:
        made.append((name, part))
        steps.append(lambda: write(tables.path(name, part)))

    for name in [n for n in old.tables if n.partition(AT)[0] in (MEMBERS, *TABLES)]:
        if found := due(now.parts(name), fan):
            group, part = found
            table = TABLES.get(name.partition(AT)[0], CLICKSTREAM)
            add(name, part, lambda folder, n=name, g=group, t=table: write_state(merge_state(at.part_state(spark, n, g), t), folder))
            now = now.replacing(name, group, part)
            fresh = [p for p in group if not p.level]
            if name in TABLES:
                chunk = Part(fresh[0].first, fresh[-1].last, 1)
                rows = at.part_state(spark, name, fresh).withColumn("batch_id", F.col("first_batch"))
                add(by_batch(name), chunk, lambda folder, r=rows: write_state(r.drop(*[f.name for f in SPAN], WINDOW_DATE), folder))
                now = now.replacing(by_batch(name), [], chunk)
    if len(old.counts) >= fan:
        chunk = Part(min(old.counts), max(old.counts), 1)
        rows = spark.createDataFrame(count_rows(old), COUNTS_SCHEMA).coalesce(1)
        add(COUNTS, chunk, lambda folder: rows.write.mode("overwrite").parquet(folder))
        now = now.replacing(COUNTS, [], chunk).forgetting_counts()
    if found := due(now.parts(BITMAPS), fan):
        group, part = found
        bitmaps = merge_bitmaps(at.part_state(spark, BITMAPS, group), [*WINDOW, *CLICKSTREAM.dims])
        add(BITMAPS, part, lambda folder: write_state(bitmaps, folder))
        now = now.replacing(BITMAPS, group, part)
    if found := due(now.parts(USERS), fan):
        group, part = found
        users = at.users(spark, group).hint("rebalance")
        add(USERS, part, lambda folder: users.write.mode("overwrite").parquet(folder))
        now = now.replacing(USERS, group, part)
    if found := due(now.parts(LATE), fan):
        group, part = found
        late = at.late_parts(spark, group).hint("rebalance")
        add(LATE, part, lambda folder: late.write.mode("overwrite").parquet(folder))
        now = now.replacing(LATE, group, part)
    if found := due(now.parts(IDS), fan):
        group, part = found
        ledger = IdLedger(tables.root)
        add(IDS, part, lambda folder, g=group, p=part: ledger.write(ledger.table(spark, g), p, ledger.table(spark, g).count()))
        now = now.replacing(IDS, group, part)
    if not steps:
        return []
    together(spark, steps)
    tables.snapshots.commit(spark, now)
    merge_kept_apart(spark, tables, fan)
    return made


def merge_kept_apart(spark: SparkSession, tables: Tables, fan: int = FAN) -> None:
    """Merge what is due of the tables whose rows are only put together."""
    old = now = tables.snapshots.newest(spark)
    at, steps = tables.at(old), []
    for name in TABLES:
        if found := due(now.parts(by_batch(name)), fan, 1):
            group, part = found
            schema = StructType([StructField("batch_id", LongType(), True), *state_schema(spark, name).fields])
            rows = at.read(spark, by_batch(name), group, schema).drop(*[f.name for f in SPAN], WINDOW_DATE)
            steps.append(partial(write_state, rows, tables.path(by_batch(name), part)))
            now = now.replacing(by_batch(name), group, part)
    if found := due(now.parts(COUNTS), fan, 1):
        group, part = found
        rows = spark.read.schema(COUNTS_SCHEMA).parquet(*[tables.path(COUNTS, p) for p in group]).coalesce(1)
        steps.append(partial(rows.write.mode("overwrite").parquet, tables.path(COUNTS, part)))
        now = now.replacing(COUNTS, group, part)
    if steps:
        together(spark, steps)
        tables.snapshots.commit(spark, now)


def write_state(rows: DataFrame, folder: str, seen: Observation | None = None, parts: Sequence[Column] = ()) -> None:
    """State rows by day of their window, sorted by time, replacing the folder; optionally observed on the way.

    Days are dealt over DAY_SLOTS directories, in which they follow each other: a part that reaches over years is no more
    files than one of a month, and a scan of some days skips the row groups of others.
    """
    dated = rows.withColumn(WINDOW_DATE, F.to_date("window_start"))
    dated = dated.withColumn(DAY_SLOT, F.pmod(F.unix_date(WINDOW_DATE), F.lit(DAY_SLOTS))).hint("rebalance", DAY_SLOT)
    dated = dated.sortWithinPartitions(DAY_SLOT, WINDOW_DATE, "window_start")
    dated = dated.observe(seen, *parts) if seen else dated
    dated.write.mode("overwrite").partitionBy(DAY_SLOT).parquet(folder)


def window_key(table: MetricTable) -> Column:
    """One key per window and dimensions: a consumer that keeps the newest record of each key has the final rows."""
    dims = [F.coalesce(F.col(d), F.lit("")) for d in table.dims]
    return F.concat_ws("|", F.lit(table.name), F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"), *dims)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the tables of a batch.

    Spark runs a stateful query's session without it, as the width of the state must not change. At this
    point the stateful plan is fixed, and what follows is ordinary batch work: without adaptive execution
    its rebalancing would be ignored and every state partition would write to every directory.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def together(spark: SparkSession, steps: Sequence[Callable[[], None]]) -> None:
    """Run independent writes of one batch at the same time, so that small ones do not queue for the cluster.

    The threads inherit the query's job group, so stopping the query stops them. All have ended when this
    returns; the first error is raised.
    """
    if not steps:
        return
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


@dataclass(frozen=True)
class Fanout:
    """The foreachBatch callback for `checked_stream`. Publishing to topics and a database is optional."""

    root: str
    every: str = MINUTE
    fan: int = FAN  # parts of a level that are merged into one
    roll_to: tuple[str, ...] = ()  # longer windows that the state is kept in as well, such as ("1 hour", "1 day")
    bitmaps: bool = False  # keep users as bitmaps besides
    lateness: str | None = None  # a window that ends so long before the newest event is closed; None: it never is
    topics: FolderTopics | KafkaTopics | None = None
    database: JdbcDatabase | None = None
    archive: EventStore | None = None  # where the records of old batches go
    archive_every: int = 8640  # batches after which those before the last as many are archived; a day of ten seconds each

    @property
    def tables(self) -> Tables:
        return Tables(self.root)

    @property
    def ledger(self) -> IdLedger:
        return IdLedger(self.root)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            self._write(batch, batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        """A batch that a snapshot has already lacks at most what is published: that is done again."""
        spark = batch.sparkSession
        before = self.tables.snapshot(spark)
        if before.has(batch_id):
            if Part(batch_id, batch_id) in before.parts(RECORDS):
                self._publish_again(spark, batch_id, before)
        else:
            counts, offsets = self._land(batch, batch_id, before)
            log.info("batch %s: %s", batch_id, counts)
            written = self._tables_of(spark, batch_id, counts, before) if counts[RECORDS] else {}
            names = [n for n in written if n != ACCEPTED]
            now = before.after_batch(batch_id, names, written, offsets, counts[NEWEST])
            self.tables.snapshots.commit(spark, now)
        self._upkeep(spark, batch_id)

    def _tables_of(self, spark: SparkSession, batch_id: int, counts: dict[str, int], before: Snapshot) -> dict[str, int]:
        """Write everything that follows from the landed records; returns the rows of each table that has any."""
        events, kept, spans = self.tables.accepted(spark, batch_id), {}, {}
        closed = self._closed(before)
        on_time = events if closed is None else events.where(F.col("event_ts").isNull() | ~closed)

        def metrics() -> None:
            steps = [partial(self._state, on_time, t, batch_id, kept, spans) for t in (SENSOR, LOG) if counts[t.kind]]
            steps += [partial(self._members, on_time, batch_id, kept, spans)] if counts[CLICKSTREAM.kind] else []
            steps += [partial(self._late, events.where(closed), batch_id, before, kept)] if closed is not None else []
            together(spark, steps)
            now = before.after_batch(batch_id, [n for n, rows in kept.items() if rows], {})
            steps = [partial(self._sketches, spark, batch_id, kept)] if kept.get(MEMBERS) else []
            if self.bitmaps and kept.get(MEMBERS):
                steps.append(partial(self._bitmaps, spark, batch_id, before, kept))
            together(spark, [*steps, partial(self._publish_curated, spark, batch_id, now, spans)])
            rolls = [(name, every) for name in TABLES if kept.get(name) for every in self.roll_to]
            together(spark, [partial(self._roll, spark, batch_id, name, every, kept) for name, every in rolls])

        steps = [metrics, *self._publish_steps(events, batch_id)]
        if counts[ACCEPTED]:
            steps.append(partial(self._ids, events, batch_id, counts[ACCEPTED]))
        together(spark, steps)
        written = {RECORDS: counts[RECORDS], ACCEPTED: counts[ACCEPTED], IDS: counts[ACCEPTED], **kept}
        return {name: rows for name, rows in written.items() if rows}

    def _publish_again(self, spark: SparkSession, batch_id: int, snapshot: Snapshot) -> None:
        steps = self._publish_steps(self.tables.accepted(spark, batch_id), batch_id)
        together(spark, [*steps, partial(self._publish_curated, spark, batch_id, snapshot, {})])

    def _land(self, batch: DataFrame, batch_id: int, before: Snapshot) -> tuple[dict[str, int], dict[str, int]]:
        """Write the batch's rejects and new events, evaluating it once; returns rows by outcome and kind, and the newest
        offset of each partition, repeats included."""
        spark, known = batch.sparkSession, before.parts(IDS)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected = F.col("reject_reason").isNotNull()
            with self.ledger.naming(spark):
                rows = self.ledger.unseen(batch.where(~rejected), known, ARRIVAL_ORDER).unionByName(batch.where(rejected))
                outcome = F.when(rejected, REJECTED).otherwise(ACCEPTED)
                columns = [*CLEANED_COLUMNS, *[f.name for f in EXTRA_FIELDS], "event_date", *LAYOUT]
                rows = placed(with_partitions(rows.withColumn("outcome", outcome)).select(*columns), *LAYOUT)
                is_new = F.col("outcome") == ACCEPTED
                counts = {RECORDS: F.count(F.lit(1)), ACCEPTED: F.count_if(is_new)}
                counts |= {t.kind: F.count_if(is_new & (F.col("event_type") == t.kind)) for t in TABLES.values()}
                counts[NEWEST] = F.unix_micros(F.max(F.when(is_new, F.col("event_ts"))))
                seen, offsets = Observation(), {}
                rows = rows.observe(seen, *[expr.alias(name) for name, expr in counts.items()])
                writer = rows.write.mode("overwrite").partitionBy(*LAYOUT)
                newest = batch.groupBy("partition").agg(F.max("offset")).where("partition is not null")
                together(
                    spark,
                    [
                        partial(writer.parquet, self.tables.path(RECORDS, Part(batch_id, batch_id))),
                        lambda: offsets.update({str(number): offset for number, offset in newest.collect()}),
                    ],
                )
                return seen.get, offsets
        finally:
            batch.unpersist()

    def _state(self, events: DataFrame, table: MetricTable, batch_id: int, kept: dict, spans: dict) -> None:
        self._replace(metric_state(events, table, self.every), table.name, batch_id, kept, spans)

    def _closed(self, before: Snapshot) -> Column | None:
        """Whether an event's window was closed by what earlier batches had seen; None if no window closes."""
        if self.lateness is None or before.newest_event is None:
            return None
        end = F.window("event_ts", self.every).getField("end")
        return end <= self._watermark(before)

    def _watermark(self, before: Snapshot) -> Column:
        return F.timestamp_micros(F.lit(before.newest_event)) - F.expr(f"INTERVAL {self.lateness}")

    def _late(self, late: DataFrame, batch_id: int, before: Snapshot, kept: dict) -> None:
        """Keep what the windows leave out. The split is made before any state, by the same rule for every row."""
        closed_at, reason = self._watermark(before).alias("closed_at"), F.lit(TOO_LATE).alias("reason")
        number, seen = F.lit(batch_id).cast("bigint").alias("batch_id"), Observation()
        rows = late.select("event_id", "event_type", "event_ts", closed_at, reason, number)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").parquet(self.tables.path(LATE, Part(batch_id, batch_id)))
        kept[LATE] = seen.get["n"]

    def _members(self, events: DataFrame, batch_id: int, kept: dict, spans: dict) -> None:
        self._replace(metric_state(events, CLICKSTREAM, self.every, members=True), MEMBERS, batch_id, kept, spans)

    def _sketches(self, spark: SparkSession, batch_id: int, kept: dict) -> None:
        members = self.tables.part_state(spark, MEMBERS, [Part(batch_id, batch_id)])
        self._replace(sketch_members(members, CLICKSTREAM), CLICKSTREAM.name, batch_id, kept, {})

    def _replace(self, rows: DataFrame, name: str, batch_id: int, kept: dict, spans: dict) -> None:
        """Write a batch's state, counting its rows and noting its first and last window."""
        seen = Observation()
        parts = [F.count(F.lit(1)).alias("n"), *ends_of_windows()]
        write_state(rows, self.tables.path(name, Part(batch_id, batch_id)), seen, parts)
        kept[name], spans[name] = seen.get["n"], (seen.get["low"], seen.get["high"])

    def _roll(self, spark: SparkSession, batch_id: int, name: str, every: str, kept: dict) -> None:
        """The batch's state in longer windows: nodes higher up in the tree of windows, of the same batch."""
        state = self.tables.part_state(spark, name, [Part(batch_id, batch_id)])
        self._replace(merge_state(state, TABLES[name], every), rolled(name, every), batch_id, kept, {})

    def _bitmaps(self, spark: SparkSession, batch_id: int, before: Snapshot, kept: dict) -> None:
        """Number the batch's new users, then write its member rows as bitmaps."""
        tables, own = self.tables.at(before), Part(batch_id, batch_id)
        members, seen = self.tables.part_state(spark, MEMBERS, [own]), Observation()
        known = tables.users(spark)
        rows = numbered(members.select(CLICKSTREAM.distinct[1]), known).observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").parquet(self.tables.path(USERS, own))
        kept[USERS] = seen.get["n"]
        dictionary = known.unionByName(tables.users(spark, [own]))
        bitmaps = member_bitmaps(members, [*WINDOW, *CLICKSTREAM.dims], CLICKSTREAM.distinct[1], dictionary)
        self._replace(bitmaps, BITMAPS, batch_id, kept, {})

    def _ids(self, events: DataFrame, batch_id: int, count: int) -> None:
        ids = events.select("event_id", F.lit(batch_id).cast("bigint").alias("batch_id"))
        self.ledger.write(ids, Part(batch_id, batch_id), count)

    def _publish_steps(self, events: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        steps = []
        if self.topics:
            steps.append(partial(self.topics.write, keyed_records(events), TOPIC_CLEANED, batch_id))
            steps.append(partial(self._publish_dead, events.sparkSession, batch_id))
        if self.database:
            tagged = served(events).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            steps.append(partial(self.database.append, tagged, "events_cleaned"))
        return steps

    def _publish_dead(self, spark: SparkSession, batch_id: int) -> None:
        dead = self.tables.rejected(spark, batch_id)
        letters = keyed_rows(dead, F.col("kafka_key"), "reject_reason", "partition", "offset", "raw_json")
        self.topics.write(letters, TOPIC_DEAD, batch_id)

    def _publish_curated(self, spark: SparkSession, batch_id: int, snapshot: Snapshot, spans: dict) -> None:
        """The final rows of the windows the batch has changed, of the tables it has rows for."""
        if not (self.topics or self.database):
            return
        tables, own = self.tables.at(snapshot), Part(batch_id, batch_id)
        names = {t.name: MEMBERS if t.distinct else t.name for t in TABLES.values()}
        changed = [t for t in TABLES.values() if own in snapshot.parts(names[t.name])]
        touched = {t.name: tables.touched_metrics(spark, t, batch_id, spans.get(names[t.name])) for t in changed}
        steps = []
        if self.topics and touched:
            records = [
                keyed_rows(rows.withColumn("metric_table", F.lit(name)), window_key(TABLES[name]))
                for name, rows in touched.items()
            ]
            steps.append(partial(self.topics.write, reduce(DataFrame.unionByName, records), TOPIC_CURATED, batch_id))
        if self.database:
            for name, rows in touched.items():
                tagged = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                steps.append(partial(self.database.append, tagged, name))
        together(spark, steps)

    def _upkeep(self, spark: SparkSession, batch_id: int) -> None:
        merged = merge_parts(spark, self.tables, self.fan)
        if self.archive and batch_id and batch_id % self.archive_every == 0:
            archive_batches(spark, self.tables, self.archive, batch_id - self.archive_every)
            merged = [*merged, (RECORDS, None)]
        if merged:
            self.tables.snapshots.clean_up(spark)
