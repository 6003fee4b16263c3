"""Document fingerprints: a Merkle tree over sections, paragraphs and short runs of words.

A paragraph is a line; a section ends after a paragraph whose hash says so (one in four), so an insertion moves no
later border; a paragraph's leaves are runs of words that end after a word whose hash says so (one in four) or after MOST
words, the last one with the rest. Every blank and letter belongs to a leaf, so equal roots mean equal texts. A node's hash is made from
its children's. The fingerprint is text: the root, then the leaves' 30-bit hashes with marks between paragraphs and
sections, from which all inner nodes follow.

Two fingerprints are compared from the top: equal roots are equal documents; sections that both have are equal as a
whole; in what is left paragraphs are matched, and in what is then left leaves, which locates the edits. The likeness is
the shared part of all leaves (Dice's measure, each leaf as often as it occurs).

Defined results: NULL and empty text is one empty leaf; repeated ids are ordered by a hash of their text, and repeated
rows are one document when it comes to which is next; NULL ids come last; a table of one document is its own next; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import width
from rillstone.llm.text import BLANKS, U, mix

_DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", dtype=np.uint8)
PARAGRAPH, SECTION = ".", "/"
_LEAF_CHARS = 5  # of six bits each
_SHIFTS = np.arange(0, 6 * _LEAF_CHARS, 6).astype(U)
MOST = 8  # words of a leaf
LONG = 64  # bytes of a run without blanks that is not cut
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True
_LINE = 10
_PLACES = mix(np.arange(4096, dtype=U), 91) | U(1)


def _parts(data: np.ndarray) -> np.ndarray:
    """Where the parts of a text start: words with the blanks before them; nothing crosses a line end; long runs
    without blanks are cut where the bytes before say so."""
    blank = _BLANK[data]
    cuts = [np.zeros(1, dtype=np.int64), np.flatnonzero(data == _LINE) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1]
    starts = np.unique(np.concatenate(cuts))
    starts = starts[starts < len(data)]
    size = np.diff(np.append(starts, len(data)))
    if size.max() > LONG:
        code = np.zeros(len(data), dtype=U)
        for k in range(8):
            code[8:] = code[8:] * U(257) + data[k : len(data) - 8 + k]
        border = (mix(code, 95) & U(31) == 0) & np.repeat(size > LONG, size)
        starts = np.unique(np.concatenate([starts, np.flatnonzero(border)]))
    return starts


def _leaves(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every leaf of a text, and the paragraph of each."""
    starts = _parts(data)
    size = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        values = (data.astype(U) + U(1)) * (_PLACES[place & 4095] + (place >> 12).astype(U))
        part = mix(np.add.reduceat(values, starts) + size.astype(U), 92)
        paragraph = np.concatenate([[0], np.cumsum(data == _LINE)])[starts]
        fresh = np.ones(len(part), dtype=bool)
        fresh[1:] = ((part[:-1] & U(3)) == 0) | (paragraph[1:] != paragraph[:-1])
        heads = np.flatnonzero(fresh)
        since = np.arange(len(part)) - np.repeat(heads, np.diff(np.append(heads, len(part))))
        heads = np.flatnonzero(since % MOST == 0)
        count = np.diff(np.append(heads, len(part)))
        nth = np.arange(len(part)) - np.repeat(heads, count)
        leaf = mix(np.add.reduceat(mix(part, 93) * _PLACES[nth & 4095], heads) + count.astype(U), 94)
    return leaf, paragraph[heads]


def _node(children: bytes) -> bytes:
    return hashlib.blake2b(children, digest_size=12).digest()


def fingerprint(text: str) -> str:
    """The root in hex, a colon, and the leaves."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if not len(data):
        return f"{_node(b'').hex()}:00000"
    leaf, paragraph = _leaves(data)
    codes = _DIGITS[((leaf[:, None] >> _SHIFTS) & U(63)).astype(np.int64)].tobytes().decode()
    whole = leaf.tobytes()
    bounds = [0, *(np.flatnonzero(np.diff(paragraph)) + 1).tolist(), len(leaf)]
    out, section, sections = [], b"", b""
    for a, b in zip(bounds, bounds[1:]):
        node = _node(whole[8 * a : 8 * b])
        section += node
        ends = node[0] % 4 == 0 or b == len(leaf)
        out += [codes[a * _LEAF_CHARS : b * _LEAF_CHARS], SECTION if ends else PARAGRAPH]
        if ends:
            sections, section = sections + _node(section), b""
    return f"{_node(sections).hex()}:{''.join(out[:-1])}"


def _unmatched(a: list, b: list, key) -> tuple[list, list]:
    """What one list has that the other has not, each item as often as it occurs."""
    left, right = Counter(map(key, a)), Counter(map(key, b))
    both = left & right

    def rest(items):
        skip, out = dict(both), []
        for x in items:
            k = key(x)
            if skip.get(k, 0):
                skip[k] -= 1
            else:
                out.append(x)
        return out

    return rest(a), rest(b)


def differing(a: str, b: str) -> tuple[list[str], list[str]]:
    """The leaves that only one of two fingerprints has, found by going down differing branches alone."""
    if a == b:
        return [], []
    body_a, body_b = a.partition(":")[2], b.partition(":")[2]
    left, right = _unmatched(body_a.split(SECTION), body_b.split(SECTION), str)
    left, right = _unmatched([p for s in left for p in s.split(PARAGRAPH)], [p for s in right for p in s.split(PARAGRAPH)], str)
    cut = lambda ps: [p[i : i + _LEAF_CHARS] for p in ps for i in range(0, len(p), _LEAF_CHARS)]
    return _unmatched(cut(left), cut(right), str)


def _size(print_: str) -> int:
    body = print_.partition(":")[2]
    return (len(body) - body.count(PARAGRAPH) - body.count(SECTION)) // _LEAF_CHARS


def likeness(a: str, b: str) -> float:
    """1 for equal documents, 0 for those that share no leaf."""
    if a == b:
        return 1.0
    only_a, only_b = differing(a, b)
    total = _size(a) + _size(b)
    # Different texts of equal leaves exist only by a collision of 30-bit hashes, or in another order.
    return min((total - len(only_a) - len(only_b)) / total, 1 - 1e-9) if total else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the text's code points replaced by the first as many of the document that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ORDER = np.dtype([("none", "?"), ("down", "i8"), ("tie", "i8")])  # of the documents, as the ranges are cut
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like the next document's they are.

    Documents are cut into ranges of descending ids. The first document of each range is also sent to the end of the
    range before, and the first of all to the end of the last, so every range knows each of its documents' next one;
    the texts move once.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    keys = docs.select("doc_id", "tie").repartitionByRange(width(df.sparkSession), *order)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "tie")
    firsts = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.min(key).alias("first")).collect()
    # One for each range. NULL ids sort last, the others by their complement, which falls as they rise.
    firsts = np.array(sorted((r["first"]["none"], r["first"]["down"] or 0, r["first"]["tie"]) for r in firsts), dtype=_ORDER)
    last = len(firsts) - 1

    def ranges(batches):
        for batch in batches:
            ids, keys = batch.column(0), np.zeros(batch.num_rows, dtype=_ORDER)
            keys["none"] = ids.is_null().to_numpy(zero_copy_only=False)
            keys["down"] = np.where(keys["none"], 0, ~ids.fill_null(0).to_numpy().astype(np.int64))
            keys["tie"] = batch.column(2).to_numpy()
            at = np.searchsorted(firsts, keys, side="right") - 1
            rows = np.flatnonzero(firsts[np.maximum(at, 0)] == keys)
            copy = (at[rows] - 1) % (last + 1)
            both = batch.take(pa.array(np.concatenate([np.arange(batch.num_rows), rows])))
            where = pa.array(np.concatenate([at, copy]))
            extra = pa.array([False] * batch.num_rows + [True] * len(rows))
            yield pa.RecordBatch.from_arrays([where, extra, *both.columns], names=["range", "extra", "doc_id", "text", "tie"])

    schema = f"range long, extra boolean, doc_id {kind}, text string, tie long"
    dealt = docs.select("doc_id", "text", "tie").mapInArrow(ranges, schema)
    dealt = dealt.repartition(max(1, len(firsts)), "range").sortWithinPartitions("range", "extra", *order)

    def compare(batches):
        here, print_, times, now = None, None, 0, None
        out: list[tuple] = []

        def told(following, following_print):
            new = edited(here[1], following)
            new_print = fingerprint(new)
            row = (
                here[0], len(here[1]), hashlib.sha256(new.encode()).hexdigest(), print_, new_print,
                likeness(print_, new_print), likeness(print_, following_print),
            )
            out.extend([row] * times)

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for at, extra, i, t, tie in zip(*(c.to_pylist() for c in part.columns)):
                    if at != now:
                        now, here = at, None
                    if here is not None and not extra and (i, tie) == (here[0], here[2]):
                        times += 1
                        continue
                    if extra and here is None:
                        continue
                    new_print = fingerprint(t)
                    if here is not None:
                        told(t, new_print)
                    here, print_, times = None if extra else (i, t, tie), new_print, 1
                    if extra:
                        now = None
                if out:
                    yield _batch(out, part.schema.field("doc_id").type)
                    out = []

    return dealt.mapInArrow(compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                            "edited_fingerprint string, near_edited double, near_next double")  # fmt: skip


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=_RESULT)
