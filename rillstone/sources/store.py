"""The long-term event store: cleaned rows in a partitioned table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from rillstone.functions import at_or_after_day, within
from rillstone.functions.timing import AsOf, as_instant
from rillstone.schemas import CLEANED_COLUMNS, KINDS, RECORD_FIELDS, BOOLEAN, STRING, TIMESTAMP
from rillstone.sources.folders import folder_exists

PARTITIONS = ("event_kind", "event_date")
OTHER = "other"


def with_partitions(rows: DataFrame) -> DataFrame:
    """Add the partition columns.

    The kind's directory has one name for everything unknown: kinds come from outside, and one directory
    per misspelling would not do. `event_type` itself stays a data column.
    """
    kind = F.coalesce(F.when(F.col("event_type").isin(*KINDS), F.col("event_type")), F.lit(OTHER))
    return rows.withColumns({"event_kind": kind, "event_date": F.to_date("event_ts")})


def placed(rows: DataFrame, *directories: str) -> DataFrame:
    """Lay rows out for a write partitioned by the given columns.

    Rebalancing lets AQE split directories that hold most rows over many tasks and pack small ones
    together, so files come out evenly sized. The writer sorts by directory anyway; sorting by time below
    that gives files whose page statistics let a scan of one hour skip the rest of the day.
    """
    return rows.hint("rebalance", *directories).sortWithinPartitions(*directories, "event_ts")


def cleaned_schema() -> StructType:
    types = {
        **RECORD_FIELDS,
        "kafka_key": STRING,
        "kafka_timestamp": TIMESTAMP,
        "event_ts": TIMESTAMP,
        "processed_at": TIMESTAMP,
        "pipeline_version": STRING,
        "is_slow_request": BOOLEAN,
    }
    return StructType([StructField(name, types[name], True) for name in CLEANED_COLUMNS])


def partition_fields() -> list[StructField]:
    return [StructField("event_kind", StringType(), True), StructField("event_date", DateType(), True)]


#: File systems write the same path in several ways; below the table it is the same.
_FIRST_LEVEL = f"/{PARTITIONS[0]}="


def _in_table(file: str) -> str:
    return _FIRST_LEVEL + file.rpartition(_FIRST_LEVEL)[2]


@dataclass(frozen=True)
class EventStore:
    path: str
    fmt: str = "parquet"

    def _write(self, rows: DataFrame):
        laid_out = placed(with_partitions(rows.select(*CLEANED_COLUMNS)), *PARTITIONS)
        return laid_out.write.format(self.fmt).partitionBy(*PARTITIONS)

    def append(self, rows: DataFrame) -> None:
        self._write(rows).mode("append").save(self.path)

    def replace_days(self, rows: DataFrame) -> None:
        """Overwrite exactly the kind/day partitions that occur in `rows`; repeating it changes nothing."""
        self._write(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(self.path)

    @property
    def zones_path(self) -> str:
        """Beside the table: names that begin with an underscore are no part of it."""
        return f"{self.path.rstrip('/')}/_arrivals"

    def note_arrivals(self, spark: SparkSession) -> None:
        """Write down the first and last arrival of every file that is not noted yet. Two columns of those are read."""
        files = self._rows(spark).inputFiles()
        known = {r[0] for r in self._zones(spark).select("file").collect()}  # one row a file, as the listing itself
        if fresh := [f for f in files if _in_table(f) not in known]:
            rows = self._reader(spark).option("basePath", self.path).load(fresh)
            below = F.concat(F.lit(_FIRST_LEVEL), F.substring_index("_metadata.file_path", _FIRST_LEVEL, -1))
            found = rows.groupBy(below.alias("file")).agg(
                F.min("kafka_timestamp").alias("first"), F.max("kafka_timestamp").alias("last"),
                F.count_if(F.col("kafka_timestamp").isNull()).alias("without"),
            )
            found.coalesce(1).write.mode("append").parquet(self.zones_path)

    def arrived_since(self, spark: SparkSession, since: AsOf) -> DataFrame:
        """Stored rows of the files that can hold arrivals after an instant, whatever days their events lie in.

        Files nobody has noted are read, as are those with rows that carry no arrival time; files that are gone are not
        looked for. The rows still have to be filtered.
        """
        since = as_instant(since)
        old = self._zones(spark).where((F.col("last") <= since) & (F.col("without") == 0)).select("file")
        gone = {r[0] for r in old.collect()}
        files = [f for f in self._rows(spark).inputFiles() if _in_table(f) not in gone]
        return self._reader(spark).option("basePath", self.path).load(files) if files else self._rows(spark).limit(0)

    def _zones(self, spark: SparkSession) -> DataFrame:
        schema = "file string, first timestamp, last timestamp, without bigint"
        if not folder_exists(spark, self.zones_path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.zones_path)

    def _reader(self, spark: SparkSession):
        reader = spark.read.format(self.fmt)
        if self.fmt != "delta":  # Delta tables carry their schema and accept no other
            reader = reader.schema(StructType([*cleaned_schema().fields, *partition_fields()]))
        return reader

    def _rows(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark).load(self.path)

    def scan(
        self,
        spark: SparkSession,
        kinds: Iterable[str] | None = None,
        span: str | None = None,
        as_of: AsOf = None,
    ) -> DataFrame:
        """Stored rows, optionally of some kinds and a time range; both prune directories."""
        rows = self._rows(spark)
        if kinds is not None:
            kinds = list(kinds)
            places = [k if k in KINDS else OTHER for k in kinds]
            rows = rows.where(F.col("event_kind").isin(*places) & F.col("event_type").isin(*kinds))
        if span is not None:
            rows = rows.where(within("event_ts", span, as_of) & at_or_after_day("event_date", span, as_of))
        return rows
