"""Best-fit decreasing packing of token pieces into sequences of a fixed length.

Best fit treats pieces of equal length alike, so it is run on the histogram of lengths, which has `room` entries at
most however many documents there are: longest first, a segment tree over remaining capacities gives the tightest open
bin in logarithmic time, and all bins of that capacity are filled in one step. The result is a table of runs ("the
pieces of this length with ranks from a on go to the bins from b on, k to a bin, from place o on"). Pieces get their
rank within their length by a salted count, and look up their run. The bins are those of best-fit decreasing, document
by document; no task sees more than its share of the pieces.

Runs: a step either empties an interval of bins or ends a length, each of the `room` lengths splits one interval at
most, and an interval moves `room` times at most; the bound depends on `room` alone.

Defined results: NULL and empty text is one piece, the end id alone; equal lengths are told apart by the number a piece
got when it was written; repeated rows are packed each; NULL ids are kept; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.bpe import Codec
from rillstone.llm.common import map_batches, settle, width

ROOM = 2048
END = 0


def cut(tokens: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one if it fits, else full ones after a first that may be shorter."""
    if tokens <= room:
        return [(0, tokens)]
    first = tokens % room
    return ([(0, first)] if first else []) + [(a, room) for a in range(first, tokens, room)]


def token_pieces(
    df: DataFrame, path: str, pattern: str, room: int = ROOM, doc_id: str = "doc_id", text: str = "text", added: bool = True
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each piece of each document's ids and the end id."""
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = Codec.of(path, pattern, added)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                which, rows = [], []
                for i, t in enumerate(part.column(1)):
                    ids = codec.encode(t.as_py() or "").tobytes() + end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, room)):
                        which.append(i)
                        rows.append((k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                numbers = np.array(rows, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(which)), pa.array(numbers[:, 0], pa.int32(), safe=False)]
                    + [pa.array(numbers[:, j]) for j in (1, 2, 3)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_batches(source, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Tightest:
    """A segment tree over remaining capacities: which capacities have open bins, and the smallest one that fits."""

    def __init__(self, room: int):
        self.leaves = 1 << (room + 1).bit_length()
        self.any = bytearray(2 * self.leaves)

    def mark(self, capacity: int, open_: bool) -> None:
        at = capacity + self.leaves
        self.any[at] = open_
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def at_least(self, need: int) -> int | None:
        at = need + self.leaves
        if self.any[at]:
            return need
        while at > 1:
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(histogram: dict[int, int], room: int = ROOM) -> np.ndarray:
    """Runs (length, first rank, first bin, pieces to a bin, place of the first) of best-fit decreasing."""
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # capacity: intervals of bins
    tree, runs, bins = Tightest(room), [], 0

    def put(capacity: int, first: int, last: int) -> None:
        if capacity and first < last:
            open_bins[capacity].append((first, last))
            tree.mark(capacity, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.at_least(length)
            if capacity is None:
                capacity, first = room, bins
                bins = last = bins + -(-left // (room // length))
            else:
                first, last = open_bins[capacity].pop()
                if not open_bins[capacity]:
                    tree.mark(capacity, False)
            each = capacity // length
            taken = min(left, (last - first) * each)
            full, rest = divmod(taken, each)
            runs.append((length, rank, first, each, room - capacity))
            put(capacity - each * length, first, first + full)
            put(capacity - rest * length, first + full, first + full + bool(rest))
            put(capacity, first + full + bool(rest), last)
            rank, left = rank + taken, left - taken
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset. `length` must lie between 1 and `room`."""
    spark = pieces.sparkSession
    salts = max(16, width(spark))
    numbered = settle(pieces.withColumn("at", F.monotonically_increasing_id()), "pieces")
    salted = numbered.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(histogram, room)
    # One ordered key for (length, rank): ranks are below 2**50.
    starts = (runs[:, 0] << 50) + runs[:, 1]
    order = np.argsort(starts)
    starts, runs = starts[order], runs[order]

    own = pieces.columns

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = runs[np.searchsorted(starts, (length << 50) + rank, side="right") - 1]
            nth = rank - run[:, 1]
            where = [run[:, 2] + nth // run[:, 3], run[:, 4] + nth % run[:, 3] * length]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array(w) for w in where], names=[*own, "sequence_id", "offset"]
            )

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("at")) - 1
    ranked = salted.withColumn("rank", rank).join(base, ["length", "salt"])
    ranked = ranked.select(*own, (F.col("rank") + F.col("base")).alias("rank"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return map_batches(ranked, place, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame, path: str, pattern: str, room: int = ROOM, doc_id: str = "doc_id", text: str = "text", added: bool = True
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    `path` may be a tokenizers file; the ids are those that library gives, here made by the faster one: with `added`
    those of its default settings, by which the file's added tokens are found in texts, else those that it gives with
    encode_special_tokens, by which their names are text like any other.
    """
    return pack(token_pieces(df, path, pattern, room, doc_id, text, added), room)
