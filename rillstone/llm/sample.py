"""Bounded samples of labelled documents for classifiers that are fitted on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(
    df: DataFrame, labels: DataFrame, label: str, rows: int, room: int, learn: Column | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels (0 or 1) of at most `rows` documents of each label, in the order of a hash of id and text, with
    at most `room` bytes of text together.

    Rows that repeat id and text count once, and are dropped before anything is limited or collected. Of several labels
    of one id the largest counts; labels that are neither 0 nor 1, and ids that `learn` does not allow, are left out.
    """
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    if learn is not None:
        marked = marked.where(learn)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    sizes = keyed.select("doc_id", "key", F.octet_length("text").alias("size")).distinct().join(marked, "doc_id")
    keys, left = {}, room
    for value in (1, 0):
        share = left // (1 + value)
        for r in sizes.where(F.col("label") == value).orderBy("key", "doc_id").limit(rows).collect():
            if r["size"] <= share:
                share, left = share - r["size"], left - r["size"]
                keys[r["key"]] = value
    spark = df.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(k,) for k in keys], "key long"))
    found = keyed.join(chosen, "key").select("key", "text").dropDuplicates(["key"]).orderBy("key").toPandas()
    return pa.array(found["text"], pa.string()), np.array([keys[k] for k in found["key"]], dtype=np.int64)
