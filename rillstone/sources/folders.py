"""Folders on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    place, fs = _place(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(place)) if fs.exists(place) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    place, fs = _place(spark, path)
    return fs.getContentSummary(place).getLength() if fs.exists(place) else 0


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all, and never replaces one."""
    place, fs = _place(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    draft, _ = _place(spark, f"{place.getParent().toString()}/.{place.getName()}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, place):
        raise OSError(f"{draft.toString()} could not be moved to {path}")
