"""Drops lines that many documents share, found in a sharded minimal perfect hash index of all distinct lines.

Every distinct line hash of a shard gets a slot of its own: level by level, a key that lands alone on a bit of the
level's bitmap keeps it, the others go on to the next level, and a key's slot is the number of set bits before its own.
Slots address compact arrays of fingerprints and document counts. Documents send their line hashes to the shards and
probe the arrays; lines are never joined with lines. A shard that very many lines probe is copied under several salts,
as many as its probes need, which are known beforehand: they are the sum of its counts.

Defined results: NULL or empty text is one empty line; lines with an empty key stay; repeated rows are documents of
their own; NULL ids are kept; other columns are passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import map_batches, row_key, row_of, settle, with_text
from rillstone.llm.text import BLANKS, U, mix

SHARD_KEYS = 1 << 18
PROBES = 1 << 20
SHARD_SCHEMA = "shard long, copies int, sizes binary, bits binary, fingerprints binary, counts binary, of int, shards long"


def line_hash(line: bytes) -> int:
    """The signed 64-bit hash of a line's key, or 0 if the key is empty."""
    import xxhash

    key = line.strip(BLANKS).lower()
    return xxhash.xxh3_64_intdigest(key) - (1 << 63) or 1 if key else 0


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        words = np.concatenate([bits, np.zeros(-len(bits) % 8, dtype=np.uint8)]).view(U)
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def over(cls, keys: np.ndarray, room: float = 1.5) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = -(-int(len(left) * room + 1) // 64) * 64
            at = (mix(left, len(sizes)) % U(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate([*levels, np.zeros(0, dtype=np.uint8)]))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for a key that no level knows. Foreign keys may get a slot too."""
        out = np.full(len(keys), -1, dtype=np.int64)
        base, open_ = 0, np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = (mix(keys[open_], level) % U(size)).astype(np.int64) + base
            word, bit = at >> 6, (at & 63).astype(U)
            found = (self.words[word] >> bit) & U(1) == 1
            below = np.bitwise_count(self.words[word] & ((U(1) << bit) - U(1))).astype(np.int64)
            out[open_[found]] = (self.before[word] + below)[found]
            open_ = open_[~found]
            base += size
        return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1009) >> U(32)).astype(np.uint32)


def build_shard(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes, bytes, int]:
    """Sizes, bits, fingerprints and counts as bytes, and the bytes of one count."""
    index = PerfectHash.over(keys)
    slot = index.slot(keys)
    prints = np.zeros(len(keys), dtype=np.uint32)
    prints[slot] = _fingerprint(keys)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max(initial=0) <= np.iinfo(k).max)
    held = np.zeros(len(keys), dtype=kind)
    held[slot] = counts
    parts = (index.sizes, index.bits, prints, held)
    return *(p.tobytes() for p in parts), held.itemsize


def probe_shard(row, keys: np.ndarray) -> np.ndarray:
    """The document count of each key; 0 for lines that the index does not hold."""
    index = PerfectHash(np.frombuffer(row.sizes, dtype=np.int64), np.frombuffer(row.bits, dtype=np.uint8))
    prints = np.frombuffer(row.fingerprints, dtype=np.uint32)
    counts = np.frombuffer(row.counts, dtype=f"<u{row.of}")
    slot = index.slot(keys)
    out = np.zeros(len(keys), dtype=np.int64)
    hit = slot >= 0
    hit[hit] = prints[slot[hit]] == _fingerprint(keys[hit])
    out[hit] = counts[slot[hit]]
    return out


def _hashes(batches):
    """(key, line) for each distinct non-empty line key of each document."""
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for a in range(0, len(texts), 512):
            found = [
                list({line_hash(x) for x in (t.as_py() or "").encode().split(b"\n")} - {0}) for t in texts.slice(a, 512)
            ]
            sizes = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(keys.slice(a, 512).to_numpy(zero_copy_only=False), sizes)),
                    pa.array(np.array([h for f in found for h in f], dtype=np.int64)),
                ],
                names=["key", "line"],
            )


def build_index(lines: DataFrame) -> DataFrame:
    """The shards of an index over (key, line) rows; `salt` numbers the copies a shard needs for its probes."""
    counts = settle(lines.groupBy("line").agg(F.count("*").alias("n")), "line-counts")
    shards = max(1, -(-counts.count() // SHARD_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys, n = group["line"].to_numpy().view(np.uint64), group["n"].to_numpy()
        copies = max(1, -(-int(n.sum()) // PROBES))
        made = build_shard(keys, n.astype(np.uint64))
        return pd.DataFrame([(int(group["shard"].iat[0]), copies, *made, shards)], columns=_COLUMNS)

    by_shard = counts.withColumn("shard", F.pmod("line", F.lit(shards))).groupBy("shard")
    return settle(by_shard.applyInPandas(build, SHARD_SCHEMA), "line-index")


_COLUMNS = ["shard", "copies", "sizes", "bits", "fingerprints", "counts", "of", "shards"]


def common_lines(lines: DataFrame, index: DataFrame, least: int) -> DataFrame:
    """Those (key, line) rows whose line the index has seen in at least `least` documents."""
    sizes = index.select("shard", "copies")
    shards = index.agg(F.max("shards")).first()[0] or 1  # as it was dealt, whether or not every shard got a line
    probes = (
        lines.withColumn("shard", F.pmod("line", F.lit(shards)))
        .join(sizes, "shard")
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.col("copies")).cast("int"))
        .select("key", "line", "shard", "salt")
    )
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def probe(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(shard):
            return asked[["key", "line"]].iloc[:0]
        n = probe_shard(shard.iloc[0], asked["line"].to_numpy().view(np.uint64))
        return asked.loc[n >= least, ["key", "line"]]

    return (
        probes.groupBy("shard", "salt")
        .cogroup(copies.groupBy("shard", "salt"))
        .applyInPandas(probe, "key long, line long")
    )


def drop_common_lines(df: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with (row struct, kept text, n_lines, n_dropped): lines found in `least` documents are dropped
    wherever they stand, and what stays is joined by line ends."""
    docs = df.select(row_of(df, text), F.col(text).alias("text"), row_key(doc_id, text).alias("key"))
    lines = settle(map_batches(docs.select("key", "text"), _hashes, "key long, line long"), "lines")
    common = common_lines(lines, build_index(lines), least)
    dropped = common.groupBy("key").agg(F.collect_set("line").alias("common"))
    joined = docs.join(dropped, "key", "left").select("row", "text", "common")

    def rebuild(batches):
        for batch in batches:
            rows, texts, commons = (batch.column(i) for i in range(3))
            for a in range(0, len(texts), 512):
                kept, total, gone = [], [], []
                for t, c in zip(texts.slice(a, 512), commons.slice(a, 512)):
                    drop = set(c.as_py() or ())
                    every = (t.as_py() or "").encode().split(b"\n")
                    stay = [x for x in every if line_hash(x) not in drop] if drop else every
                    kept.append(b"\n".join(stay).decode())
                    total.append(len(every))
                    gone.append(len(every) - len(stay))
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(a, 512), pa.array(kept, pa.string()), pa.array(total), pa.array(gone)],
                    names=["row", "text", "n_lines", "n_dropped"],
                )

    kind = joined.schema["row"].dataType.simpleString()
    return map_batches(joined, rebuild, f"row {kind}, text string, n_lines long, n_dropped long")


def without_common_lines(df: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with their columns, the text without its common lines."""
    return with_text(drop_common_lines(df, least, doc_id, text), df, text)


def digests(df: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    kept = drop_common_lines(df, least)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))
