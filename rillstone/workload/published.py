"""Tables that many queries share, written once to the shared folder and read back from there.

Dashboards read stored tables; they do not parse the raw feed for every panel. A table is built on first
use per session and input, and again when the input file changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from rillstone.session import fresh_folder

_BUILT: dict[tuple, str] = {}


def _files_of(spark: SparkSession, path: str) -> tuple:
    """Path, size and time of each file of a table: folders themselves have neither on object stores."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listStatus(place)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def folder_of(
    spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None], source: str = "events"
) -> str:
    """The folder that holds table `label`, built by `build(folder)` if this session has none yet.

    It is remembered only after `build` has returned, so a failed build is not reused.
    """
    key = (spark.sparkContext.applicationId, label, _files_of(spark, f"{sf_dir}/{source}.parquet"))
    if key not in _BUILT:
        folder = fresh_folder(spark, label)
        build(folder)
        _BUILT[key] = folder
    return _BUILT[key]
