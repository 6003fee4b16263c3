"""Near-duplicate embeddings by collision counting on one-dimensional random projections.

Two unit vectors at distance d differ by a normal deviate of scale d on a random line. On each of LINES lines a vector's
window reaches WINDOW * d to both sides, d being the distance at the threshold. A pair collides on a line if one lies in
the window centred on the other, and it is verified, by its exact cosine in double precision, if it collides on at least
`needed` lines: the count that all but MISSED of the pairs at the threshold reach. Pairs that are closer reach it oftener.

Counting on single lines alone would emit collisions of a third of all pairs, since independent vectors are only about
three times as far apart as linked ones. So the vectors are sorted into cells first, in several rounds, by the side they
take on further lines; only pairs of one cell are counted. With n distinct vectors a cell halves log2(n / CELL) times,
and the rounds follow from the recall asked for: a pair at the threshold stays on one side of a line with probability
1 - angle / pi. A pair that meets in several rounds counts in the first. A large cell is cut into blocks, and pairs of
blocks are dealt out as tiles, so no task holds a cell; a tile reports each vector's links and a spanning forest.

Equal vectors are one class, which counts as often as it occurs. Within a class, all link.

Defined results: NULL vectors, empty ones, zero ones and those with NULL, NaN or infinite components link with nothing,
not even with equal ones, and are kept; vectors of different length do not link; repeated ids are rows of their own and
have the same component_id if they link; a NULL id is never a component's, unless all of it are NULL; other columns are
not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rillstone.llm.common import components, settle, width

LINES, WINDOW, MISSED = 32, 1.5, 1e-4
CELL, TILE = 512, 2048
SEED = 20


@dataclass(frozen=True)
class Scheme:
    """Everything that follows from the threshold, the recall and the number of vectors."""

    cosine: float
    sides: int  # lines that tell a vector's cell in a round
    rounds: int
    item: str = "<f8"  # how components travel: in the type they have

    @classmethod
    def of(cls, cosine: float, recall: float, vectors: int, item: str = "<f8") -> Scheme:
        sides = max(0, math.ceil(math.log2(max(vectors, 1) / CELL)))
        meets = (1 - math.acos(cosine) / math.pi) ** sides
        return cls(cosine, sides, 1 if meets >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meets)), item)

    @property
    def reach(self) -> float:
        return WINDOW * math.sqrt(2 - 2 * self.cosine)

    @property
    def needed(self) -> int:
        """The largest count that a pair at the threshold misses with a probability of MISSED at most."""
        p, below = math.erf(WINDOW / math.sqrt(2)), 0.0
        for k in range(LINES + 1):
            below += math.comb(LINES, k) * p**k * (1 - p) ** (LINES - k)
            if below > MISSED:
                return k
        return LINES

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places on the counting lines, and the cell of each round."""
        lines = np.random.default_rng(SEED).standard_normal((LINES + self.rounds * self.sides, unit.shape[1])).T
        at = unit @ lines
        if not self.sides:
            return at.astype(np.float32), np.zeros((len(unit), self.rounds), dtype=np.int64)
        bits = (at[:, LINES:] > 0).reshape(len(unit), self.rounds, self.sides).astype(np.int64)
        return at[:, :LINES].astype(np.float32), bits @ (1 << np.arange(self.sides, dtype=np.int64))


def units(vectors: list[bytes], item: str = "<f8") -> np.ndarray:
    """Vectors of equal length, given as the bytes of their components, as doubles of unit length, without overflow."""
    x = np.frombuffer(b"".join(vectors), dtype=item).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def tile_links(unit: np.ndarray, side: np.ndarray, weight: np.ndarray, scheme: Scheme, round_: int):
    """For each vector of a tile: the weight it links to for the first time in this round, and the smallest row it is
    connected to. Rows of side 0 and 1 meet across, rows of side 2 with each other."""
    places, cells = scheme.project(unit)
    order = np.argsort(places[:, 0], kind="stable")
    places, line = np.ascontiguousarray(places[order].T), places[order, 0]
    side, n, needed, reach = side[order], len(unit), scheme.needed, np.float32(scheme.reach)
    links, label = np.zeros(n, dtype=np.int64), np.arange(n)
    # On one line a linked pair may well lie further apart than its window; beyond `far` it does with 1e-9 at most.
    far = 6.2 * math.sqrt(2 - 2 * scheme.cosine)
    for a in range(0, n, 128):
        b = min(a + 128, n)
        last = int(np.searchsorted(line, line[b - 1] + far, side="right"))
        counts = np.zeros((b - a, last - a), dtype=np.uint8)
        for own in places:
            counts += np.abs(own[a:last][None, :] - own[a:b][:, None]) <= reach
        x, y = np.nonzero(counts >= needed)
        x, y = x + a, y + a
        met = (x < y) & ((side[y] == 2) | (side[x] != side[y]))
        x, y = order[x[met]], order[y[met]]
        for c in range(0, len(x), 1 << 16):
            p, q = x[c : c + (1 << 16)], y[c : c + (1 << 16)]
            linked = np.einsum("ij,ij->i", unit[p], unit[q]) >= scheme.cosine
            p, q = p[linked], q[linked]
            first = ~(cells[p, :round_] == cells[q, :round_]).any(axis=1)
            p, q = p[first], q[first]
            links += np.bincount(p, weight[q], n).astype(np.int64) + np.bincount(q, weight[p], n).astype(np.int64)
            label = _joined(label, p, q)
    return links, label


def _joined(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Labels after joining the components of each p and q: the smallest row of each."""
    while True:
        low = np.minimum(label[p], label[q])
        new = label.copy()
        np.minimum.at(new, label[p], low)
        np.minimum.at(new, label[q], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if (new[p] == new[q]).all() and (new == label).all():
            return new
        label = new


def _tiles(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, links, root) from every tile."""

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                _, found = scheme.project(units(batch.column(1).to_pylist(), scheme.item))
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(found) + 1) * scheme.rounds, pa.int32()), pa.array(found.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=["key", "vector", "weight", "cells"])

    placed = settle(
        classes.select("key", "vector", "weight").repartition("key").mapInArrow(
            _by_length(cells), "key long, vector binary, weight long, cells array<bigint>"
        ),
        "vectors",
    )
    cell = ["length", "round", "cell"]
    dealt = placed.select("key", F.length("vector").alias("length"), F.posexplode("cells").alias("round", "cell"))
    full = dealt.groupBy(*cell).agg(F.count("*").alias("n")).where("n > 1")
    full = full.select(*cell, F.ceil(F.col("n") / TILE).alias("blocks"))
    rows = placed.select("key", "vector", "weight", F.length("vector").alias("length"), F.posexplode("cells").alias("round", "cell"))
    rows = rows.join(full, cell).withColumn("i", F.pmod("key", "blocks"))
    pairs = F.expr(
        "transform(sequence(0L, blocks - 1), j -> struct(least(i, j) as x, greatest(i, j) as y, "
        "int(if(i = j, 2, if(i < j, 0, 1))) as side))"
    )
    rows = rows.select("key", "vector", "weight", *cell, F.explode(pairs).alias("t"))
    rows = rows.select(*cell, "t.x", "t.y", "t.side", "key", "weight", "vector")
    tile = [*cell, "x", "y"]
    rows = rows.repartition(4 * width(classes.sparkSession), *tile).sortWithinPartitions(*tile)

    def compare(batches):
        now, held = None, []

        def flush():
            if len(held) < 2:
                return None
            side, key, weight, vector = zip(*held)
            unit, key = units(list(vector), scheme.item), np.array(key, dtype=np.int64)
            links, label = tile_links(unit, np.array(side), np.array(weight, dtype=np.float64), scheme, now[1])
            hit = np.flatnonzero(links)
            if not len(hit):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(key[hit]), pa.array(links[hit]), pa.array(key[label[hit]])], names=["key", "links", "root"]
            )

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in tile))
            for at, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in ("side", "key", "weight", "vector")))):
                if at != now:
                    if (found := flush()) is not None:
                        yield found
                    now, held = at, []
                held.append(row)
        if (found := flush()) is not None:
            yield found

    return settle(rows.mapInArrow(compare, "key long, links long, root long"), "links")


def _by_length(run):
    """Calls `run` with batches whose vectors have one length each."""

    def split(batches):
        for batch in batches:
            size = np.array([len(v) for v in batch.column(1).to_pylist()], dtype=np.int64)
            for length in np.unique(size):
                yield batch.filter(pa.array(size == length))

    return lambda batches: run(split(batches))


def _packed(item: str):
    """Vectors as the bytes of their components."""

    def run(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(item)
            offsets = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy())])
            made = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["id", "vector"])

    return run


def near_duplicates(
    df: DataFrame, cosine: float = 0.9, recall: float = 0.999, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(embedding).alias("e"))
    kind = rows.schema["id"].dataType.simpleString()
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(sound & F.exists("e", lambda x: x != 0), F.lit(False))
    single = rows.schema["e"].dataType.elementType == FloatType()
    of, item = ("float", "<f4") if single else ("double", "<f8")
    zero = F.lit(0).cast(of)  # added, it makes equal vectors of those that differ in the sign of a zero
    good = rows.where(sound).select("id", F.transform("e", lambda x: x.cast(of) + zero).alias("e"))
    packed = good.mapInArrow(_packed(item), f"id {kind}, vector binary").withColumn("key", F.xxhash64("vector"))
    ids = settle(packed, "embeddings")
    classes = ids.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    classes = settle(classes, "vector-classes")
    scheme = Scheme.of(cosine, recall, classes.count(), item)
    found = _tiles(classes, scheme)
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), "vectors")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = classes.select("key", "least", "weight").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").join(links, "key", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked = ids.select("id", "key").join(settle(known, "named-vectors"), "key").select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
