"""N-gram Jaccard join: size-banded tiles, hashed bitmaps as an upper bound, then exact sorted-array intersection.

1. Every document becomes a sorted array of distinct shingle hashes. Documents with equal sets form one class.
2. Two sets that link differ in at most d = 2 * size * (100 - j) / (100 + j) shingles. A scheme for each band of sizes
   deals the shingles into more than d parts by hash, so linked sets have at least one part in common, entirely.
   Equal parts make chains of classes, and chains make clusters: every link lies inside one. Empty parts would link
   everything; they are left out, and a set with more of them than the scheme has to spare is dealt out once more by
   another hash, so nothing is lost (after DEALS dealings, which no set will need, they count).
3. Inside each cluster, classes are dealt into tiles by size band (sizes that may link stand in the same or in the next
   band), and large bands into blocks. Rows of tiles are bitmaps of shingle parities, which bound every overlap from
   above: |A and B| <= (|A| + |B| - differing bits) / 2. What the bound connects makes smaller clusters.
4. Inside those, the same tiles hold the sets. What the bound leaves, and is not yet connected, is intersected exactly.
   A tile reports a spanning forest of its links, never the pairs of a group; the forests make the components.

Parts travel to shards in packed rows of nine bytes a part, each said once by a piece of text however many copies of a
document it holds, so a part that a third of all documents share is a short run in its shard.

Defined results: NULL or blank text has an empty set and links with nothing; fewer words than a shingle has make one
shingle; repeated rows link with each other; a NULL id stays NULL and the component is the smallest id that is not;
other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bitmap, components, map_batches, maybe_in, row_key, row_of, settle, width
from rillstone.llm.text import U, mix, shingles, words

BLOCK_ROWS, BLOCK_BYTES = 8192, 24 << 20
DEALS = 8
SHARD_PARTS = 1 << 20
MEMBER = (1 << 40) - 1  # the bits of a signature that stand for it while parts are gathered


@lru_cache(maxsize=None)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each size band: its smallest size, the parts of its scheme, and how many of them may be empty."""
    low, parts, spare = [1], [], []
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, -(-low[-1] * 3 // 2)))
        most = 2 * (low[-1] - 1) * (100 - percent) // (100 + percent)
        m = most + 1
        for _ in range(40):  # as many more as are empty, but for rare sets, when the band's smallest are dealt out
            empty = m * math.exp(-low[-2] / m)
            m = most + 1 + math.ceil(empty + 3 * math.sqrt(empty))
        parts.append(m if most else 0)
        spare.append(m - most - 1 if most else 0)
    return np.array(low[:-1]), np.array(parts), np.array(spare)


def part_keys(sets: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of every set, and how many each set has."""
    low, parts, spare = bands(percent)
    n = np.diff(bounds)
    band = np.searchsorted(low, n, side="right") - 1
    keys, owners = [], []
    for up in (0, 1):
        scheme = band + up
        used = (n > 0) & (parts[scheme] > 0)
        if up:
            used &= n * 100 >= percent * low[scheme]
        for deal in range(DEALS):
            which = np.flatnonzero(used)
            if not len(which):
                break
            key, out, owner, crowded = _dealt(sets, n, which, used, scheme, parts, spare, deal)
            if deal < DEALS - 1:
                used = np.zeros(len(n), dtype=bool)
                used[which[crowded]] = True
            else:
                out |= crowded[owner]
            keys.append(key[out])
            owners.append(which[owner[out]])
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(len(n), dtype=np.int64)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order].view(np.int64), np.bincount(owner, minlength=len(n))


def _dealt(sets, n, which, used, scheme, parts, spare, deal: int):
    """One dealing of some sets: keys, which of them have shingles, their sets, and the sets with too many empty parts.

    Two linked sets are both dealt until one has few enough: then a part with shingles is equal in both.
    """
    m = parts[scheme[which]]
    base = np.concatenate([[0], np.cumsum(m)])
    values, owner = sets[np.repeat(used, n)], np.repeat(np.arange(len(which)), n[which])
    slot = base[owner] + (mix(values, 100 + deal) % m[owner].astype(U)).astype(np.int64)
    body, total = mix(values, 12), int(base[-1])
    # Sums of 32 bits are exact as doubles.
    low_sum = np.bincount(slot, (body & U(0xFFFFFFFF)).astype(np.float64), total).astype(U)
    high_sum = np.bincount(slot, (body >> U(32)).astype(np.float64), total).astype(U)
    full = np.bincount(slot, minlength=total) > 0
    slot_owner = np.repeat(np.arange(len(which)), m)
    crowded = np.bincount(slot_owner[~full], minlength=len(which)) > spare[scheme[which]]
    place = (np.arange(total) - base[slot_owner]).astype(U) + (scheme[which][slot_owner].astype(U) << U(44))
    with np.errstate(over="ignore"):
        key = mix(mix(low_sum, 13) + mix(high_sum, 14) + mix(place * U(DEALS) + U(deal), 15), 16)
    return key, full, slot_owner, crowded


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash for each set; sets with the same shingles have the same."""
    n = np.diff(bounds)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix(sets, 21))])
        return mix(total[bounds[1:]] - total[bounds[:-1]] + mix(n.astype(U), 22), 23).view(np.int64)


def _profiles(size: int):
    def run(batches):
        for batch in batches:
            for w in words(batch.column(1)):
                sets, bounds = shingles(w, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first, w.docs),
                        batch.column(2).slice(w.first, w.docs),
                        pa.array(np.diff(bounds)),
                        pa.array(signatures(sets, bounds)),
                    ],
                    names=["doc_id", "key", "n_shingles", "sig"],
                )

    return run


def _parts(size: int, percent: int, shards: int):
    """One row per shard and piece of text: 32 bits of each part's key, and five bytes of its set's signature.

    Shorter keys make a few parts look equal that are not; what they bring together is compared and found different.
    """

    def run(batches):
        for batch in batches:
            for w in words(batch.column(0)):
                sets, bounds = shingles(w, size)
                keys, counts = part_keys(sets, bounds, percent)
                sig = np.repeat(signatures(sets, bounds) & MEMBER, counts)
                keys = keys.view(U)
                shard = (keys % U(shards)).astype(np.int64)
                keys = (keys >> U(32)).astype("<u4")
                order = np.lexsort((sig, keys, shard))
                shard, keys, sig = shard[order], keys[order], sig[order]
                fresh = np.ones(len(keys), dtype=bool)  # copies of a document in one piece say it once
                fresh[1:] = (keys[1:] != keys[:-1]) | (sig[1:] != sig[:-1]) | (shard[1:] != shard[:-1])
                shard, keys, sig = shard[fresh], keys[fresh], sig[fresh]
                cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
                spans = list(zip(cuts, [*cuts[1:], len(shard)]))
                low = (sig & 0xFFFFFFFF).astype("<u4")
                high = (sig >> 32).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[cuts]),
                        pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([low[a:b].tobytes() + high[a:b].tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["shard", "parts", "members"],
                )

    return run


def _chains(frame: pd.DataFrame) -> pd.DataFrame:
    """Edges from the first member of each part to the others."""
    parts = np.concatenate([np.frombuffer(x, dtype="<u4") for x in frame["parts"]])
    members = []
    for x in frame["members"]:
        n = len(x) // 5
        low, high = np.frombuffer(x, dtype="<u4", count=n), np.frombuffer(x, dtype=np.uint8, offset=4 * n)
        members.append(low.astype(np.int64) | high.astype(np.int64) << 32)
    members = np.concatenate(members)
    order = np.lexsort((members, parts))
    parts, members = parts[order], members[order]
    fresh = np.ones(len(parts), dtype=bool)
    fresh[1:] = parts[1:] != parts[:-1]
    heads = members[np.maximum.accumulate(np.where(fresh, np.arange(len(parts)), 0))]
    linked = heads != members
    pairs = np.unique(np.stack([heads[linked], members[linked]]), axis=1)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def _clusters(df: DataFrame, classes: DataFrame, total: int, size: int, percent: int, text: str) -> DataFrame:
    """(sig, cluster) of the classes that share parts with others. `total`: the sizes of all sets together."""
    shards = max(1, 4 * total * (100 - percent) // (100 + percent) // SHARD_PARTS)
    parts = map_batches(df.select(text), _parts(size, percent, shards), "shard long, parts binary, members binary")
    chains = settle(parts.groupBy("shard").applyInPandas(_chains, "a long, b long").distinct(), "chains")
    roots = components(chains, "clusters")
    heads = roots.select(F.col("root").alias("node"), "root").distinct()
    named = roots.union(heads).select(F.col("node").alias("member"), F.col("root").alias("cluster"))
    members = classes.select("sig", F.col("sig").bitwiseAND(MEMBER).alias("member"))
    return settle(members.join(named, "member").select("sig", "cluster"), "clusters")


def _members(df: DataFrame, members: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(sig, cluster, n, set) of one document of each clustered class, read from the documents once more."""
    wanted = members.select(F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("h"))
    bits = df.sparkSession.sparkContext.broadcast(bitmap(wanted, "h"))

    def near(batches):
        for batch in batches:
            keep = maybe_in(bits.value, batch.column(2).to_numpy())
            yield batch.filter(pa.array(keep)).select([0, 1])

    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    some = map_batches(hashed, near, f"doc_id {kind}, text string")
    found = some.join(members, some["doc_id"].eqNullSafe(members["doc_id"])).select("text", "sig", "cluster")

    def sets(batches):
        for batch in batches:
            sigs = batch.column(1).to_numpy()
            for w in words(batch.column(0)):
                values, bounds = shingles(w, size)
                real = np.flatnonzero(signatures(values, bounds) == sigs[w.first : w.first + w.docs])
                at = pa.array(real + w.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(at),
                        batch.column(2).take(at),
                        pa.array(np.diff(bounds)[real]),
                        pa.array([values[bounds[i] : bounds[i + 1]].tobytes() for i in real], pa.binary()),
                    ],
                    names=["sig", "cluster", "n", "set"],
                )

    schema = "sig long, cluster long, n long, set binary"
    return settle(map_batches(found, sets, schema).dropDuplicates(["sig"]), "members")


def _bitmaps(members: DataFrame) -> DataFrame:
    """The members with bitmaps in the place of sets."""

    def run(batches):
        for batch in batches:
            maps = [parity_bitmap(np.frombuffer(v.as_py(), dtype=U)).tobytes() for v in batch.column("set")]
            columns = [batch.column(c) for c in ("sig", "cluster", "n")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(maps, pa.binary())], names=["sig", "cluster", "n", "set"])

    return map_batches(members, run, "sig long, cluster long, n long, set binary")


def _regrouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members that are in a component of (node, root) rows, with its root as their cluster."""
    heads = roots.select(F.col("root").alias("node"), "root").distinct()
    named = roots.union(heads).select(F.col("node").alias("sig"), F.col("root").alias("cluster"))
    return members.drop("cluster").join(named, "sig").select("sig", "cluster", "n", "set")


class _Forest:
    """Components of the rows of one tile, as labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        self.label[self.label == max(x, y)] = min(x, y)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def parity_bitmap(values: np.ndarray) -> np.ndarray:
    """A bit for each of at least 256 hash values and twice the set's size: whether an odd number falls on it."""
    wide = 1 << max(8, min(16, int(2 * len(values)).bit_length()))
    odd = np.bincount((values & U(wide - 1)).astype(np.int64), minlength=wide) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps brought to the width of the narrowest: halves of a parity bitmap add up to the narrower one."""
    words_ = min(len(m) for m in maps)
    return np.stack([np.bitwise_xor.reduce(m.reshape(-1, words_), axis=0) for m in maps])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    return overlap(a, b) * (100 + percent) >= percent * (len(a) + len(b))


def tile_links(n: np.ndarray, maps: list[np.ndarray], sets: list[np.ndarray] | None, side: np.ndarray, percent: int):
    """The smallest row each row of a tile is connected to, by the bound alone if there are no sets. Rows of side 0
    and 1 link across, rows of side 2 with each other."""
    order = np.argsort(n, kind="stable")
    forest, sizes, sides, maps = _Forest(len(n)), n[order], side[order], folded(maps)[order]
    for x in range(len(order) - 1):
        last = int(np.searchsorted(sizes, sizes[x] * 100 // percent, side="right"))
        near = np.arange(x + 1, last)
        near = near[(forest.label[near] != forest.label[x]) & ((sides[near] == 2) | (sides[near] != sides[x]))]
        if not len(near):
            continue
        differing = np.bitwise_count(maps[near] ^ maps[x]).sum(axis=1, dtype=np.int64)
        both = sizes[near] + sizes[x]
        # inter / (both - inter) >= percent / 100  <=>  inter * (100 + percent) >= percent * both
        near = near[(both - differing) // 2 * (100 + percent) >= percent * both]
        for y in near.tolist():
            if forest.label[x] != forest.label[y]:
                if sets is None or _linked(sets[order[x]], sets[order[y]], percent):
                    forest.join(x, y)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = order[forest.label]
    return out


def _tiles(members: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Edges between the members, which have sets (if exact) or bitmaps, that link or that the bound lets link."""
    step = float(np.log(100 / percent)) * (1 + 1e-9) if percent < 100 else 1.0  # wide enough for rounded logarithms
    banded = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("long"))
    sizes = banded.groupBy("cluster", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("total") * (8 if exact else 1) / BLOCK_BYTES))
    sizes = settle(sizes.select("cluster", "band", blocks.cast("long").alias("blocks"), "rows"), "bands")
    here = sizes.select("cluster", "band", "blocks", "rows")
    above = sizes.select("cluster", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = sizes.select("cluster", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    around = here.join(above, ["cluster", "band"], "left").join(below, ["cluster", "band"], "left")
    dealt = banded.join(around, ["cluster", "band"]).withColumn("i", F.pmod("sig", F.col("blocks")))
    inside = F.expr(
        "case when rows < 2 then array() else transform(sequence(0L, blocks - 1), j -> "
        "struct(band as low, least(i, j) as x, 0L as up, greatest(i, j) as y, int(if(i = j, 2, if(i < j, 0, 1))) as side)) end"
    )
    upward = F.expr(
        "case when above is null then array() else transform(sequence(0L, above - 1), j -> "
        "struct(band as low, i as x, 1L as up, j as y, 0 as side)) end"
    )
    downward = F.expr(
        "case when below is null then array() else transform(sequence(0L, below - 1), j -> "
        "struct(band - 1 as low, j as x, 1L as up, i as y, 1 as side)) end"
    )
    placed = dealt.select("cluster", "sig", "set", "n", F.explode(F.concat(inside, upward, downward)).alias("t"))
    tile = ["cluster", "low", "x", "up", "y"]
    rows = placed.select(
        F.xxhash64("cluster", "t.low", "t.x", "t.up", "t.y").alias("tile"), F.col("t.side").alias("side"), "sig", "set", "n",
        "cluster", "t.low", "t.x", "t.up", "t.y",
    )
    rows = rows.repartition(width(members.sparkSession), "tile").sortWithinPartitions("tile", *tile)

    def compare(batches):
        key, held = None, []

        def flush():
            if len(held) < 2:
                return None
            sigs = np.array([h[1] for h in held], dtype=np.int64)
            body = [np.frombuffer(h[2], dtype=U) for h in held]
            maps, sets = ([parity_bitmap(b) for b in body], body) if exact else (body, None)
            root = tile_links(np.array([h[3] for h in held]), maps, sets, np.array([h[0] for h in held]), percent)
            linked = np.flatnonzero(root != np.arange(len(root)))
            if len(linked):
                return pa.RecordBatch.from_arrays([pa.array(sigs[root[linked]]), pa.array(sigs[linked])], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("side", "sig", "set", "n")]
            keys = zip(*[batch.column(c).to_pylist() for c in tile])
            for now, row in zip(keys, zip(*columns)):
                if now != key:
                    if (found := flush()) is not None:
                        yield found
                    key, held = now, []
                held.append(row)
        if (found := flush()) is not None:
            yield found

    return map_batches(rows, compare, "a long, b long")


def _joined(df: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(key, doc_id, n_shingles, root, component_id) of every row; root is NULL for empty sets."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row_key(doc_id, text).alias("key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, n_shingles long, sig long"
    profiles = settle(map_batches(docs, _profiles(size), schema), "profiles")
    by_set = profiles.where("n_shingles > 0").groupBy("sig")
    classes = settle(by_set.agg(F.min("doc_id").alias("doc_id")), "classes")
    total = profiles.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    clusters = _clusters(df, classes, total, size, percent, text)
    members = _members(df, classes.select("sig", "doc_id").join(clusters, "sig"), size, doc_id, text)
    bounded = components(_tiles(_bitmaps(members), percent, False), "bounded")
    roots = components(_tiles(_regrouped(members, bounded), percent, True), "links")
    grouped = classes.select("sig", "doc_id").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    grouped = grouped.select("sig", F.coalesce("root", "sig").alias("root"), F.col("doc_id").alias("least"))
    tops = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(grouped.join(tops, "root").select("sig", "root", "component_id"), "named")
    joined = profiles.select("key", "doc_id", "n_shingles", "sig").join(named, "sig", "left")
    full = F.col("n_shingles") > 0
    component = F.when(full, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return joined.select("key", "doc_id", "n_shingles", F.when(full, F.col("root")).alias("root"), component)


def join_classes(
    df: DataFrame, size: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents link when 100 * intersection >= percent * union."""
    return _joined(df, size, percent, doc_id, text).select("doc_id", "n_shingles", "component_id")


def keep_one(
    df: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The row with the smallest id of each component, with all its columns; rows with empty sets stay.

    Rows that a bitmap of fixed size does not know to be in a group pass by; only the others meet the decisions.
    """
    rows = settle(_joined(df, size, percent, doc_id, text).where("root is not null"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    groups = rows.groupBy("root").agg(first, F.count("*").alias("n")).where("n > 1")
    groups = groups.select("root", F.col("first.key").alias("kept"))
    marked = rows.join(groups, "root").select("key", (F.col("key") == F.col("kept")).alias("once"))
    marks = settle(marked.groupBy("key").agg(F.max("once").alias("once")), "marks")
    held = df.sparkSession.sparkContext.broadcast(bitmap(marks, "key"))
    source = df.select(row_of(df), row_key(doc_id, text).alias("key"))

    def known(wanted: bool):
        def run(batches):
            for batch in batches:
                hit = maybe_in(held.value, batch.column(1).to_numpy())
                yield batch.filter(pa.array(hit if wanted else ~hit))

        return run

    schema = f"row {source.schema['row'].dataType.simpleString()}, key long"
    met = map_batches(source, known(True), schema).join(marks, "key", "left")
    kept = map_batches(source, known(False), schema).select("row")
    kept = kept.union(met.where("once is null").select("row"))
    return kept.union(met.where("once").dropDuplicates(["key"]).select("row")).select("row.*")
