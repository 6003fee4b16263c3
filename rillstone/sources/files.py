"""Topics kept as files: the same columns a broker delivers, from folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.schemas import wire_schema


def wire_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(wire_schema()).parquet(path)


def wire_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream; files_per_trigger bounds a micro-batch."""
    reader = spark.readStream.schema(wire_schema())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _lines(raw: DataFrame) -> DataFrame:
    fixed = {"key": "binary", "partition": "int", "offset": "bigint"}
    missing = {name: F.lit(None).cast(kind) for name, kind in fixed.items()}
    return raw.select(
        missing["key"].alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_name").alias("topic"),
        missing["partition"].alias("partition"),
        missing["offset"].alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def line_table(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one JSON record per line; the arrival time is the file's."""
    return _lines(spark.read.text(path))


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _lines(reader.text(path))
