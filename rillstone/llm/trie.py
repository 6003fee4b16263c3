"""Conversations as a prefix trie, kept as balanced parentheses shard by shard.

A rebuilt conversation is the first turns of another one followed by its own; as a row it is the hashes of its turns,
one after the other, so its prefixes are prefixes of bytes and sorting brings shared openings together. Conversations
that are the same meet first, with partial sums, so a crowd of copies is one sequence afterwards. The distinct sequences
are dealt out in ranges of their order and every task cuts its range into shards of about NODES nodes.

A shard writes its trie as balanced parentheses in the order of its sequences. The excess after each parenthesis, with
the minimum of every block and a tree over the blocks, gives findclose, which delimits each subtree; ranks of "(" and of
the pairs "()" count its nodes and leaves, and cumulative arrays over the nodes give members and savings. Neighbouring
shards can share only the nodes on their first and last paths, the spines. Those leave the shard as one row a path, with
what hangs off each node, and are merged as a trie of the same kind with two sequences for each shard.

Defined results: NULL roles and texts are empty; rows without a conv_id belong to no conversation and are left out;
turns of one number are ordered by their hash, NULL numbers first; repeated rows are turns of their own; the beginning
comes from conversation `conv_id - conv_id % 5` with the remainder's sign that of conv_id; an empty table has no nodes;
other columns are not looked at. A conversation is one row of some 30 bytes a turn, so each must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import settle, width

KEY = 16  # bytes of a turn's hash
NODES = 1 << 18  # nodes of a shard, but for the last sequence it takes
BITS = 64  # parentheses in a block of the excess
STEP = 1 << 14  # subtrees whose ends are searched at once
IDS = 1 << 13  # ids written into one row of a crowd
SHARED = 5  # conversations that may begin like one of them
NONE = np.iinfo(np.int64).max

CHUNK = "end binary, first long, n long, ids binary"
CROWD = "end binary, n long, least long, sha string"
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
#: A path from the root, with what the shard knows of each of its nodes.
SPINE = "seq binary, sizes array<bigint>, ends array<bigint>, shas array<string>, least array<bigint>, " + ", ".join(
    f"{c} array<bigint>" for c in ("convs", "children", "leaves", "saved")
)
NOBODY = hashlib.sha256(b"").hexdigest()


class RangeMin:
    """Minima of any ranges of an array: inside blocks from both ends, across blocks from a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        blocks = max(1, -(-self.n // BITS))
        held = np.full(blocks * BITS, NONE, dtype=np.int64)
        held[: self.n] = values
        self.held = held.reshape(blocks, BITS)
        self.from_left = np.minimum.accumulate(self.held, axis=1).ravel()
        self.from_right = np.minimum.accumulate(self.held[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [self.held.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def over(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The minimum of values[a:b] for each pair; ranges must not be empty."""
        last = b - 1
        left, right = a // BITS, last // BITS
        out = np.minimum(self.from_right[a], self.from_left[last])
        wide = np.flatnonzero(right - left > 1)
        power = np.frexp((right[wide] - left[wide] - 1).astype(np.float64))[1] - 1
        for p in np.unique(power):
            at = wide[power == p]
            row = self.table[p]
            out[at] = np.minimum(out[at], np.minimum(row[left[at] + 1], row[right[at] - (1 << p)]))
        near = np.flatnonzero(left == right)
        for s in range(0, len(near), STEP):
            at = near[s : s + STEP]
            place = np.arange(BITS)
            inside = (place >= (a[at] % BITS)[:, None]) & (place <= (last[at] % BITS)[:, None])
            out[at] = np.where(inside, self.held[left[at]], NONE).min(axis=1)
        return out


class Parentheses:
    """A balanced sequence of parentheses, as a boolean array of the opening ones."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int64)
        blocks = max(1, -(-len(opens) // BITS))
        padded = np.full(blocks * BITS, NONE, dtype=np.int64)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(blocks, BITS)
        #: Minima of the blocks, of pairs of blocks, of fours ...
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            last = self.levels[-1]
            last = np.append(last, NONE) if len(last) % 2 else last
            self.levels.append(last.reshape(-1, 2).min(axis=1))
        self.rank = np.concatenate([[0], np.cumsum(opens, dtype=np.int64)])
        pairs = np.zeros(len(opens), dtype=bool)
        pairs[:-1] = opens[:-1] & ~opens[1:]
        self.leaf_rank = np.concatenate([[0], np.cumsum(pairs, dtype=np.int64)])

    def close(self, at: np.ndarray) -> np.ndarray:
        """findclose: where the parentheses opened at these places are closed."""
        out = np.empty(len(at), dtype=np.int64)
        for s in range(0, len(at), STEP):
            out[s : s + STEP] = self._close(at[s : s + STEP])
        return out

    def _in_block(self, block: np.ndarray, goal: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first place of each block that is behind `after` and at or below the goal; -1 if none."""
        hit = (self.blocks[block] <= goal[:, None]) & (np.arange(BITS) > after[:, None])
        first = hit.argmax(axis=1)
        return np.where(hit[np.arange(len(block)), first], block * BITS + first, -1)

    def _close(self, at: np.ndarray) -> np.ndarray:
        goal, block = self.excess[at] - 1, at // BITS
        out = self._in_block(block, goal, at % BITS)
        far = np.flatnonzero(out < 0)
        # Up, until the subtree to the right holds the goal, then down into its leftmost half that does.
        node, level, goal = block[far], np.zeros(len(far), dtype=np.int64), goal[far]
        open_ = np.arange(len(far))
        for up in range(len(self.levels) - 1):
            own = self.levels[up]
            beside = node[open_] + 1
            right = (node[open_] % 2 == 0) & (beside < len(own))
            found = right & (own[np.minimum(beside, len(own) - 1)] <= goal[open_])
            node[open_[found]] += 1
            level[open_[found]] = up
            open_ = open_[~found]
            node[open_] //= 2
        for down in range(len(self.levels) - 1, 0, -1):
            on = np.flatnonzero(level == down)
            left = node[on] * 2
            node[on] = left + (self.levels[down - 1][left] > goal[on])
            level[on] -= 1
        out[far] = self._in_block(node, goal, np.full(len(far), -1))
        return out


@dataclass
class Sequences:
    """Distinct sequences in ascending order: the hashes of their turns, and how long a beginning each shares with the
    one before."""

    keys: list[bytes]
    shared: list[int]

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(k) // KEY for k in self.keys], dtype=np.int64)


def shared_turns(a: bytes, b: bytes) -> int:
    """The number of turns two sequences begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    x, y = np.frombuffer(a, dtype=np.uint8, count=n), np.frombuffer(b, dtype=np.uint8, count=n)
    return int((x != y).argmax()) // KEY


class Trie:
    """The trie of some sequences. Its nodes are numbered in the order of their opening parentheses, from the root 0."""

    def __init__(self, sequences: Sequences):
        lengths, shared = sequences.lengths, np.array(sequences.shared, dtype=np.int64)
        new = lengths - shared
        new[0] = lengths[0] + 1  # with the root
        self.first = np.cumsum(new) - new  # of each sequence, its first node of its own
        self.count = int(new.sum())
        of = np.repeat(np.arange(len(new)), new)
        within = np.arange(self.count) - self.first[of]
        self.depth = shared[of] + 1 + within
        self.depth[: new[0]] -= 1
        self.sequence = of
        # Before a sequence opens its nodes, those of the one before close down to what both share.
        closes = np.concatenate([[0], lengths[:-1] - shared[1:]])
        runs = np.stack([closes, new], axis=1).ravel()
        opens = np.repeat(np.tile([False, True], len(new)), runs)
        self.shape = Parentheses(np.concatenate([opens, np.zeros(int(lengths[-1]) + 1, dtype=bool)]))
        at = np.flatnonzero(self.shape.opens)
        self.close = self.shape.close(at)
        self.open = at
        self.stop = self.shape.rank[self.close]  # nodes of the subtree of i: i to stop[i]
        # The parent is the last node before that lies one level higher.
        order = np.lexsort((np.arange(self.count), self.depth))
        place = self.depth[order] * self.count + order
        self.parent = np.full(self.count, -1, dtype=np.int64)
        below = np.arange(1, self.count)
        wanted = (self.depth[below] - 1) * self.count + below
        self.parent[1:] = order[np.searchsorted(place, wanted) - 1]

    def leaves(self) -> np.ndarray:
        return self.shape.leaf_rank[self.close] - self.shape.leaf_rank[self.open]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum over each node's subtree."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.stop] - total[:-1]

    def least(self, values: np.ndarray) -> np.ndarray:
        return RangeMin(values).over(np.arange(self.count), self.stop)

    def children(self) -> np.ndarray:
        return np.bincount(self.parent[1:], minlength=self.count)

    def ends(self) -> np.ndarray:
        """The node at which each sequence ends."""
        new = np.diff(np.append(self.first, self.count))
        return self.first + new - 1

    def path(self, node: int) -> np.ndarray:
        """The nodes from the root to a node."""
        out = [node]
        while out[-1]:
            out.append(int(self.parent[out[-1]]))
        return np.array(out[::-1], dtype=np.int64)


def _saved(convs: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (convs - 1) * size


@dataclass
class Shard:
    """Sequences with what is known of each: sizes of the texts, members that end there, the smallest, their hash."""

    keys: list
    shared: list
    sizes: list
    n: list
    least: list
    sha: list

    @classmethod
    def empty(cls) -> Shard:
        return cls([], [], [], [], [], [])


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column without copies."""
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _shards(batches, nodes: int) -> Iterator[Shard]:
    """The rows of a task, in order, in shards of about that many nodes."""
    shard, held = Shard.empty(), 0
    for batch in batches:
        seqs, n, least, shas = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
        for i, sizes in enumerate(_lists(batch.column(1))):
            if held >= nodes:
                yield shard
                shard, held = Shard.empty(), 0
            own = shared_turns(shard.keys[-1], seqs[i]) if shard.keys else 0
            shard.keys.append(seqs[i])
            shard.shared.append(own)
            shard.sizes.append(np.array(sizes, dtype=np.int64))
            shard.n.append(n[i])
            shard.least.append(least[i])
            shard.sha.append(shas[i])
            held += len(seqs[i]) // KEY - own
    if shard.keys:
        yield shard


def _node_values(trie: Trie, shard: Shard) -> tuple[np.ndarray, ...]:
    """For each node the size of its last text, and of the members that end there the number, the least and the hash."""
    sizes = np.concatenate([[0], *(s[k:] for s, k in zip(shard.sizes, shard.shared))]).astype(np.int64)
    ends = np.zeros(trie.count, dtype=np.int64)
    least = np.full(trie.count, NONE, dtype=np.int64)
    shas = np.full(trie.count, NOBODY, dtype=object)
    at = trie.ends()
    ends[at], least[at], shas[at] = shard.n, shard.least, shard.sha
    return sizes, ends, least, shas


def _named(kinds: str) -> list[str]:
    return [f.split()[0] for f in kinds.split(", ")]


#: A node's place on a spine; with an unfinished node, the place of its parent.
_PLACE = "shard binary, side int, on int"
_OUT = f"{NODE}, {_PLACE}, {SPINE}"


def _batch(rows: dict, count: int) -> pa.RecordBatch:
    """A batch of all columns of _OUT; those not given are NULL."""
    lists = {c: pa.int64() for c in ("sizes", "ends", "least", "convs", "children", "leaves", "saved")}
    kinds = {"ends_sha256": pa.string(), "shard": pa.binary(), "side": pa.int32(), "on": pa.int32(), "seq": pa.binary()}
    kinds |= {c: pa.list_(t) for c, t in lists.items()} | {"shas": pa.list_(pa.string())}
    names, columns = _named(_OUT), []
    for c in names:
        kind, given = kinds.get(c, pa.int64()), rows.get(c)
        if given is None:
            given = pa.nulls(count, kind)
        columns.append(given if isinstance(given, pa.Array) else pa.array(given, kind))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _solve(shard: Shard) -> Iterator[pa.RecordBatch]:
    """The finished nodes of a shard, and its two spines."""
    trie = Trie(Sequences(shard.keys, shard.shared))
    sizes, ends, least, shas = _node_values(trie, shard)
    tail = trie.ends()
    paths = [trie.path(int(tail[0])), trie.path(int(tail[-1]))]
    side = np.full(trie.count, -1, dtype=np.int64)
    side[paths[1]] = 1
    side[paths[0]] = 0
    hung = side < 0
    convs, leaves, mins = trie.sums(ends), trie.leaves(), trie.least(least)
    saved = trie.sums(np.where(hung, _saved(convs, sizes), 0))
    children = trie.children()
    name = hashlib.md5(shard.keys[0]).digest()

    own = np.flatnonzero(hung)
    parent = trie.parent[own]
    off = side[parent] >= 0
    yield _batch(
        {
            "conv_id": mins[own],
            "depth": trie.depth[own],
            "parent_conv_id": pa.array(mins[parent], mask=off),
            "n_convs": convs[own],
            "n_children": children[own],
            "n_leaves": leaves[own],
            "saved_tokens": saved[own],
            "ends_sha256": shas[own].tolist(),
            "shard": pa.array([name if o else None for o in off], pa.binary()),
            "side": pa.array(side[parent], pa.int32(), mask=~off),
            "on": pa.array(trie.depth[parent], pa.int32(), mask=~off),
        },
        len(own),
    )
    # What hangs off the nodes of the spines, without their subtrees on the spines.
    tops = own[off]
    to = trie.parent[tops]
    hung_sum = {k: np.bincount(to, v[tops], trie.count) for k, v in (("convs", convs), ("leaves", leaves))}
    hung_saved = np.zeros(trie.count, dtype=np.int64)
    np.add.at(hung_saved, to, saved[tops])
    hung_least = least.copy()
    np.minimum.at(hung_least, to, mins[tops])
    for s, path in enumerate(paths):
        if s == 1 and len(shard.keys) == 1:
            break
        mine = side[path] == s  # what both paths share is told once
        yield _batch(
            {
                "shard": [name],
                "side": [s],
                "seq": [shard.keys[0 if s == 0 else -1]],
                "sizes": [sizes[path]],
                "ends": [np.where(mine, ends[path], 0)],
                "shas": [[x if m else NOBODY for x, m in zip(shas[path], mine)]],
                "least": [np.where(mine, hung_least[path], NONE)],
                "convs": [np.where(mine, hung_sum["convs"][path].astype(np.int64), 0)],
                "children": [np.where(mine, np.bincount(to, minlength=trie.count)[path], 0)],
                "leaves": [np.where(mine, hung_sum["leaves"][path].astype(np.int64), 0)],
                "saved": [np.where(mine, hung_saved[path], 0)],
            },
            1,
        )


_MERGED = f"{NODE}, {_PLACE}"


def _merge(batches) -> Iterator[pa.RecordBatch]:
    """The nodes of all spines, once for each place where they stand; `ends_sha256` is NULL at all but the first."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["seq"])
    if not rows:
        return
    keys = [r["seq"] for r in rows]
    trie = Trie(Sequences(keys, [0, *map(shared_turns, keys, keys[1:])]))
    zero = lambda: np.zeros(trie.count, dtype=np.int64)
    size, ends, convs, children, leaves, saved = zero(), zero(), zero(), zero(), zero(), zero()
    least, shas = np.full(trie.count, NONE, dtype=np.int64), np.full(trie.count, NOBODY, dtype=object)
    paths = [trie.path(int(tail)) for tail in trie.ends()]
    for r, path in zip(rows, paths):
        size[path] = r["sizes"]
        for into, name in ((ends, "ends"), (convs, "convs"), (children, "children"), (leaves, "leaves"), (saved, "saved")):
            into[path] += np.array(r[name], dtype=np.int64)
        least[path] = np.minimum(least[path], np.array(r["least"], dtype=np.int64))
        for at, sha, n in zip(path, r["shas"], r["ends"]):
            if n:
                shas[at] = sha
    n_convs = trie.sums(ends + convs)
    n_children = children + trie.children()
    n_leaves = trie.sums(leaves + (n_children == 0))
    n_saved = trie.sums(saved + _saved(n_convs, size))
    mins = trie.least(least)
    told = np.zeros(trie.count, dtype=bool)
    for r, path in zip(rows, paths):
        fresh = ~told[path]
        told[path] = True
        up = trie.parent[path]
        columns = {
            "conv_id": mins[path],
            "depth": trie.depth[path],
            "parent_conv_id": pa.array(mins[up], mask=up < 0),
            "n_convs": n_convs[path],
            "n_children": n_children[path],
            "n_leaves": n_leaves[path],
            "saved_tokens": n_saved[path],
            "ends_sha256": [x if f else None for x, f in zip(shas[path], fresh)],
            "shard": pa.array([r["shard"]] * len(path), pa.binary()),
            "side": pa.array([r["side"]] * len(path), pa.int32()),
            "on": pa.array(trie.depth[path], pa.int32()),
        }
        made = [pa.array(columns[c]) for c in _named(_MERGED)]
        yield pa.RecordBatch.from_arrays(made, names=_named(_MERGED))


def prefix_nodes(crowds: DataFrame) -> DataFrame:
    """The nodes of the trie of distinct sequences (seq, sizes, n, least, sha): see `conversation_trie`."""
    parts = settle(
        crowds.repartitionByRange(width(crowds.sparkSession), "seq")
        .sortWithinPartitions("seq")
        .mapInArrow(lambda batches: (b for s in _shards(batches, NODES) for b in _solve(s)), _OUT),
        "trie-shards",
    )
    spines = parts.where("seq IS NOT NULL").select("shard", "side", *_named(SPINE)).repartition(1)
    merged = settle(spines.mapInArrow(_merge, _MERGED), "trie-spines")
    nodes = parts.where("seq IS NULL").select(*_named(_MERGED))
    places = merged.select("shard", "side", "on", F.col("conv_id").alias("up"))
    hung = nodes.where("shard IS NOT NULL").join(places, ["shard", "side", "on"])
    columns = _named(NODE)
    return (
        nodes.where("shard IS NULL").select(*columns)
        .unionByName(hung.withColumn("parent_conv_id", F.col("up")).select(*columns))
        .unionByName(merged.where("ends_sha256 IS NOT NULL").select(*columns))
    )


def _write_ids(batches):
    """Rows (end, conv_id), in order, as rows of up to IDS ids of one end, written out with commas between them."""
    for batch in batches:
        ends, ids = batch.column(0), batch.column(1).to_numpy()
        runs = ends.to_pylist()
        out, a = [], 0
        for b in range(1, len(runs) + 1):
            if b == len(runs) or runs[b] != runs[a] or b - a >= IDS:
                out.append((runs[a], int(ids[a]), b - a, ",".join(map(str, ids[a:b].tolist())).encode()))
                a = b
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.binary()))],
                names=_named(CHUNK),
            )


def _hash_ids(batches):
    """Rows of CHUNK, in order, as one row for each end."""
    now, n, least, sha, out = None, 0, 0, None, []
    for batch in batches:
        for end, first, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if end != now:
                if sha is not None:
                    out.append((now, n, least, sha.hexdigest()))
                now, n, least, sha = end, 0, first, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids)
            n += count
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=_named(CROWD))
            out = []
    if sha is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([now], pa.binary()), pa.array([n]), pa.array([least]), pa.array([sha.hexdigest()])],
            names=_named(CROWD),
        )


def begins_with(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes over."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq, sizes) of each conversation: the hashes of its turns, one after the other, and the bytes of its
    texts. It begins with the first turns of the conversation it belongs to and goes on with its own."""
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    key = F.md5(F.concat(F.char_length(by).cast("string"), F.lit(":"), by, said).cast("binary"))
    size = F.octet_length(said).cast("long")
    turns = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), key.alias("key"), size.alias("size")
    )
    # Dealt out by the conversation that lends the beginning, once; the grouping and the join both keep to that.
    turns = turns.withColumn("base", F.expr("conv_id - conv_id % " + str(SHARED))).repartition("base")
    convs = turns.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "size"))).alias("turns"))
    heads = convs.where("base = conv_id").select("base", F.slice("turns", 1, 8).alias("head"))
    joined = convs.join(heads, "base", "left").withColumn("h", begins_with(F.col("conv_id")))
    whole = joined.select(
        "conv_id",
        F.expr("concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, size(turns)))").alias("turns"),
    )
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.col("turns.key"), "")).alias("seq"),
        F.col("turns.size").alias("sizes"),
    )


def conversation_trie(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256 (of the members that end there)."""
    spark = df.sparkSession
    rows = rebuilt(df, conv_id, turn, role, text).withColumn("end", F.unhex(F.md5("seq")))
    rows = settle(rows, "conversations")
    chunks = (
        rows.select("end", "conv_id").repartitionByRange(width(spark), "end", "conv_id")
        .sortWithinPartitions("end", "conv_id").mapInArrow(_write_ids, CHUNK)
    )
    crowds = chunks.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_hash_ids, CROWD)
    # One of the copies, with its sequence: only sizes and hashes are compared before, in partial minima.
    lead = rows.join(crowds.toDF("of", "n", "least", "sha"), (F.col("of") == F.col("end")) & (F.col("least") == F.col("conv_id")))
    return prefix_nodes(settle(lead.select("seq", "sizes", "n", "least", "sha"), "sequences"))
