"""The ids a job has ever accepted, so that a copy is known however late it returns.

The ledger is a table of parts (see `snapshots`): each batch adds its new ids, parts are merged in levels. Rows lie in
directories by a hash of the id and are sorted by id inside; files carry bloom filters. A micro-batch looks only into the
directories its ids fall into, and while it has few ids it names them in the scan, where the bloom filters skip nearly
every row group that does not hold one. Nothing is kept in a stream's state, and records without an id never come here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.dedup import first_per_key
from rillstone.streaming.snapshots import Part

IDS = "accepted_ids"
BUCKET = "id_bucket"
SCHEMA = f"event_id string, batch_id bigint, first_batch bigint, last_batch bigint, {BUCKET} int"
IN_FILTER = "spark.sql.parquet.pushdown.inFilterThreshold"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class IdLedger:
    """`named`: up to so many ids of a batch are named in the scan. `sent`: up to so many are sent to every task that
    reads the ledger; more are shuffled with it. The results are the same."""

    root: str
    buckets: int = 32
    named: int = 1000
    sent: int = 500_000
    false_hits: float = 1e-5  # of a bloom filter, for one id

    def bucket(self, event_id: Column) -> Column:
        """Changing the number of buckets of a ledger that has rows would hide them."""
        return F.pmod(F.xxhash64(event_id), F.lit(self.buckets)).cast("int")

    def table(self, spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], SCHEMA)
        reader = spark.read.schema(SCHEMA).option("basePath", f"{self.root}/{IDS}")
        return reader.parquet(*[f"{self.root}/{p.folder(IDS)}" for p in parts])

    def unseen(self, rows: DataFrame, parts: Sequence[Part], order_by: Sequence[str]) -> DataFrame:
        """Of each id the first row in the given order, unless one of the parts knows it. `rows` is read twice."""
        spark = rows.sparkSession
        first = first_per_key(rows, ["event_id"], order_by)
        if not parts:
            return first
        known, n = self.candidates(rows, parts)
        if n <= self.sent:
            ids = F.broadcast(rows.select("event_id").distinct())
            return first.join(F.broadcast(known.join(ids, "event_id", "left_semi").select("event_id")), "event_id", "left_anti")
        return first.join(known.select("event_id"), "event_id", "left_anti")

    def candidates(self, rows: DataFrame, parts: Sequence[Part]) -> tuple[DataFrame, int]:
        """What of the ledger can hold ids of these rows, and the number of rows."""
        spark = rows.sparkSession
        touched = rows.groupBy(self.bucket(F.col("event_id")).alias(BUCKET)).count().collect()  # one row a bucket
        n = sum(r["count"] for r in touched)
        known = self.table(spark, parts).where(F.col(BUCKET).isin([r[BUCKET] for r in touched]))
        if n <= self.named:
            known = known.where(F.col("event_id").isin([r[0] for r in rows.select("event_id").distinct().collect()]))
        return known, n

    def naming(self, spark: SparkSession):
        """While this holds, ids named in a scan reach the files' bloom filters."""
        return _set(spark, IN_FILTER, str(self.named))

    def write(self, ids: DataFrame, part: Part, count: int) -> None:
        """(event_id, batch_id) rows as a part, replacing what a failed attempt has left."""
        rows = ids.select("event_id", "batch_id", self.bucket(F.col("event_id")).alias(BUCKET))
        rows = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "event_id")
        writer = rows.write.mode("overwrite").partitionBy(BUCKET)
        for key, value in {
            "parquet.bloom.filter.enabled#event_id": "true",
            "parquet.bloom.filter.expected.ndv#event_id": str(max(64, 2 * count // self.buckets)),
            "parquet.bloom.filter.fpp#event_id": str(self.false_hits),
            "parquet.enable.dictionary#event_id": "false",
        }.items():
            writer = writer.option(key, value)
        writer.parquet(f"{self.root}/{part.folder(IDS)}")
