"""Byte-level BPE with the tiktoken library and a local rank file: encoding whole texts, decoding raw bytes.

Long texts are split before encoding at blanks where the pre-splitting pattern must start a new match: a single blank
between two word characters ends every match before it, and no branch looks back. A long run of white space is cut out
whole: a match starts with it and holds all of it, or all but its last character if something follows, so its bytes are
one piece for the merges and the pattern, whose look-ahead would walk back over them all, is not run on it. Encoding the
parts and joining their ids equals encoding the whole. Both rules are those of patterns with `\\s+(?!\\S)` and
optional blanks before words, as the public byte-level ones have it.

Defined results: NULL and empty text have no ids and decode to no bytes; NULL ids decode to no bytes; repeated rows
and NULL document ids are kept as they are; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 1 << 16
_SAFE = re.compile(r"(?<=\w) (?=\w)")
#: The characters of Unicode's White_Space property.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WHITE_RUN = re.compile(f"[{_WHITE}]{{2,}}")
_CODECS: dict[tuple[str, str, bool], object] = {}


def parts(text: str, most: int = LONG) -> Iterator[str]:
    """The text in parts of about `most` characters, cut only at safe boundaries."""
    a = 0
    while len(text) - a > most and (found := _SAFE.search(text, a + most)):
        yield text[a : found.start()]
        a = found.start()
    yield text[a:]


def stretches(text: str, most: int = LONG) -> Iterator[tuple[str, bool]]:
    """The text in order, with True for what of a long run of white space is one match."""
    a = 0
    for found in _WHITE_RUN.finditer(text) if len(text) > most else ():
        if found.end() - found.start() <= most:
            continue
        end = found.end() - (found.end() < len(text))
        if a < found.start():
            yield text[a : found.start()], False
        yield text[found.start() : end], True
        a = end
    if a < len(text):
        yield text[a:], False


def ranks_of(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file, or of a tokenizers file of a byte-level BPE whose ids follow its merges."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as text:
        model = json.load(text)["model"]
    # Such files write a byte as the character of that number if it is printable and no blank, else as the next
    # character from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][t] for t in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])) or min(ids, default=256) < 256:
        raise ValueError(f"the ids of {path} do not follow its merges")
    return {bytes(byte_of[c] for c in t): model["vocab"][t] for t in [*byte_of, *merged]}


def added_of(path: str) -> dict[str, int]:
    """The added tokens of a tokenizers file and their ids. That library finds them in texts unless told not to."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as text:
        tokens = [t for t in json.load(text).get("added_tokens") or [] if t["content"]]
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take in or look at what is around them")
    return {t["content"]: t["id"] for t in tokens}


class Codec:
    """A tiktoken encoding made from a local file; one per process, file, pattern and treatment of added tokens."""

    def __init__(self, path: str, pattern: str, added: bool = False):
        import tiktoken

        ranks = ranks_of(path)
        self.added = added_of(path) if added else {}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.added)
        self.ranks, self.whole = ranks, None
        # Leftmost matches, of several at one place the longest.
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None

    @classmethod
    def of(cls, path: str, pattern: str, added: bool = False) -> Codec:
        if (path, pattern, added) not in _CODECS:
            _CODECS[path, pattern, added] = cls(path, pattern, added)
        return _CODECS[path, pattern, added]

    def encode(self, text: str) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit integers."""
        ids = []
        for i, between in enumerate(self.splits.split(text) if self.splits else [text]):
            own = [[self.added[between]]] if i % 2 else self._between(between)
            ids += [np.array(o, dtype="<u4") for o in own]
        return ids[0] if len(ids) == 1 else np.concatenate([np.zeros(0, dtype="<u4"), *ids])

    def whole_encoding(self):
        """The encoding by whose pattern any text is one match."""
        import tiktoken

        if self.whole is None:
            made = {"mergeable_ranks": self.ranks, "special_tokens": self.added}
            self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", **made)
        return self.whole

    def _between(self, text: str) -> Iterator[list[int]]:
        for stretch, one in stretches(text):
            if one:
                yield self.whole_encoding().encode_ordinary(stretch)
            else:
                yield from map(self.encoding.encode_ordinary, parts(stretch))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def _per_row(df: DataFrame, column: str, doc_id: str, fields: str, row) -> DataFrame:
    """One output row per input row: the id and what `row(value)` gives, in Arrow batches."""
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(column).alias("value"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        for batch in batches:
            ids, values = batch.column(0), batch.column(1)
            for a in range(0, len(values), 512):
                part = [row(v.as_py()) for v in values.slice(a, 512)]
                made = [pa.array(list(c), type=t) for c, t in zip(zip(*part), row.types)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, 512), *made], names=["doc_id", *names])

    return source.mapInArrow(run, schema)


def _row(types, fn):
    def row(value):
        return fn(value)

    row.types = types
    return row


def encode(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<long>) of every row."""
    row = _row([pa.list_(pa.int64())], lambda t: (Codec.of(path, pattern).encode(t or "").tolist(),))
    return _per_row(df, text, doc_id, "ids array<bigint>", row)


def decode(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, bytes binary) of every row of ids."""

    def back(v):
        return (Codec.of(path, pattern).decode(np.array(v or [], dtype="<u4")),)

    return _per_row(df, ids, doc_id, "bytes binary", _row([pa.binary()], back))


def round_trip(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes each text and decodes its ids in the same task, so
    that ids do not pass through the JVM in between."""

    def both(value):
        codec = Codec.of(path, pattern)
        ids = codec.encode(value or "")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_row(df, text, doc_id, fields, _row([pa.int64(), pa.string(), pa.string()], both))
