"""Helpers that several operators share: written intermediate tables, bounded bitmaps, components."""

from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.session import fresh_folder

BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: later steps do not compute them again, and a
    lost executor costs no more than the step it was in."""
    folder = fresh_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """The rows through `run` in Arrow batches of a few megabytes. A batch stands in the JVM twice, as it goes and as it
    comes back, and in Python, for each task at once; by Spark's own bound it has 64 MB. A bound that the session was
    given stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BOUND, None) is None:
        conf.set(BATCH_BOUND, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)


def width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(doc_id: str, text: str):
    """A hash by which equal rows meet, for tables whose ids may be NULL or repeated."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def row_of(df: DataFrame, but: str = ""):
    """All columns, or all but one, as one struct: whatever they are called, no other column clashes with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != but]).alias("row")


def with_text(changed: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """The columns of `df` from (row, text) rows; n_chars, where there is one, follows the text."""
    new = {text: F.col("text")} | ({"n_chars": F.char_length("text").cast("long")} if "n_chars" in df.columns else {})
    return changed.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in df.columns])


def bitmap(hashes: DataFrame, column: str, least: int = 1 << 23, most: int = 1 << 27) -> np.ndarray:
    """A bitmap of a column of 64-bit hashes, as bytes: eight bits for each hash, within bounds. However many hashes
    there are, the driver gets `most` / 64 words at most. A set bit means perhaps, a clear one means no."""
    bits = min(most, max(least, 1 << (8 * hashes.count()).bit_length()))
    place = F.pmod(F.col(column), F.lit(bits))
    words = (
        hashes.select(place.alias("at"))
        .select(F.shiftright("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def maybe_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the bit of each signed 64-bit hash."""
    at = np.mod(hashes.astype(np.int64), len(bits) * 64).astype(np.uint64)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def components(edges: DataFrame, label: str, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for each node that is not the smallest of its component.

    Alternates two steps until only stars are left: each node's children are hung under its smallest parent, then each
    node's parents are linked to the smallest of them. Both need one partial minimum and one join, which Spark can
    split where a node has very many children. Every round is written to the shared folder. Roots only ever get smaller,
    so the rounds end.
    """
    spark = edges.sparkSession
    a, b = F.col(left), F.col(right)
    now = settle(
        edges.where(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("up")).distinct(), f"{label}-0"
    )
    for i in count(1):
        state = now.groupBy("node").agg(F.count("*").alias("n"), F.min("up").alias("top"))
        chained = now.join(state.select(F.col("node").alias("up")), "up", "left_semi").limit(1).count()
        if not chained and not state.where("n > 1").limit(1).count():
            return now.select("node", F.col("up").alias("root"))
        tops = state.select(F.col("node").alias("up"), "top")
        hung = now.join(tops, "up", "left").select("node", F.coalesce("top", "up").alias("up")).distinct()
        hung = settle(hung, f"{label}-{i}h")
        tops = hung.groupBy("node").agg(F.min("up").alias("top"))
        joined = hung.join(tops, "node")
        now = settle(
            joined.where("up != top").select(F.col("up").alias("node"), F.col("top").alias("up")).union(tops).distinct(),
            f"{label}-{i}",
        )
