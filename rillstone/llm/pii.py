"""Personal data: fixed patterns, and terms that disclose what the patterns found.

Entities are the classes of the values that the four patterns find: an e-mail's domain, an IP address's first three
numbers, a card's issuer (six digits), a phone number without its last four digits. What a term tells about a value it
tells about the value's class at least, so both are protected; the kind is not, as the placeholder says it. A term is a
run of letters, without case. The corpus tells how strongly a term t in an entity e's context (WINDOW words to each
side, on the same line) reveals it: by pointwise mutual information against the entity's information content,

    PMI(t; e) - IC(e) = log2 p(e | t) = log2( lines with e near t / lines with t ),

which is 0 if t stands nowhere else, and minus the bits that still hide e otherwise. Terms that leave at most one bit
(p >= 1/2) exceed the threshold: with p >= 0.9 they are removed, else generalised to a placeholder, wherever they stand.
Where fewer than CONTEXTS different lines have the pair (copies of a line are one), p is not that share but its lower
confidence bound (Wilson's, one-sided, SIGMAS standard deviations) on as many lines as differ: a term that is found
beside one entity only has p = 0.38 on one line, where any rare word would do, and 0.55 on two. Counts are over all lines
of all documents; only terms that some entity has in its context are counted, found again by a bitmap of fixed size and
an exact join.

Spans are in code points, end exclusive. Defined results: NULL and empty texts have no spans; repeated rows are counted
each and get the same spans; NULL ids are kept; the other columns are passed on by sanitise() and not looked at.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bitmap, map_batches, maybe_in, row_key, row_of, settle, with_text
from rillstone.llm.text import Words, words

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW, CONTEXTS, EXCEEDS, REMOVES = 10, 3, 0.5, 0.9
SIGMAS = 1.2816  # 90 % confidence
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is always taken from its first digit, so that a long one is read once.
_QUADS = re.compile(rb"[0-9]++(?:(?:\.[0-9]++){3})?+")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[list(range(97, 123)) + list(range(128, 256))] = True


def _digits(match: bytes) -> bytes:
    return match.translate(None, _NOT_DIGIT)


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = (d - 48) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(data: bytes) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, read from each @ to both sides."""
    out, end, at = [], 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > end and data[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(data, at + 1)):
            end = domain.end()
            out.append((start, end))
        at = data.find(b"@", max(at + 1, end))
    return out


def _is_ip(quads: bytes) -> bool:
    parts = [p.lstrip(b"0") for p in quads.split(b".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or b"0") <= 255 for p in parts)


def base_spans(data: bytes) -> dict[str, list[tuple[int, int]]]:
    """Byte spans of each kind. The patterns are ASCII, so bytes match as characters would."""
    return {
        "email": emails(data),
        "ip": [m.span() for m in _QUADS.finditer(data) if b"." in m[0] and _is_ip(m[0])],
        "card": [m.span() for m in _CARD.finditer(data) if m.end() - m.start() > 15 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(data) if 8 <= len(_digits(m[0])) <= 15] if b"+" in data else [],
    }


class _Points:
    """Code points of byte places."""

    def __init__(self, data: bytes):
        self.before = None
        if not data.isascii():
            heads = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
            self.before = np.concatenate([[0], np.cumsum(heads)])

    def __getitem__(self, place: int) -> int:
        return place if self.before is None else int(self.before[place])


def told(spans: dict[str, list[tuple[int, int]]], points: _Points) -> list[str]:
    return [f"{k}:{points[a]}:{points[b]}" for k in KINDS for a, b in spans[k]]


def class_of(kind: str, value: bytes) -> bytes:
    """What values of one kind have in common that may tell whose they are."""
    if kind == "email":
        return value.rpartition(b"@")[2].lower()
    if kind == "ip":
        return b".".join(p.lstrip(b"0") for p in value.split(b".")[:3])
    return _digits(value)[:6] if kind == "card" else _digits(value)[:-4]


def _signed_hash(value: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little", signed=True)


def _lines_of(w: Words) -> np.ndarray:
    """The line of each word, counted over all documents of the piece."""
    ends = np.flatnonzero(w.data == 10)
    return np.searchsorted(ends, w.start) + w.doc


def _contexts(w: Words, i: int, data: bytes, spans: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(entity, term, line text) of the entities of document i of the piece, each once for a line of the document."""
    base, a, b = int(w.offsets[i]), int(w.bounds[i]), int(w.bounds[i + 1])
    start, end, hashes = w.start[a:b] - base, w.end[a:b] - base, w.hashes[a:b].view(np.int64)
    covered = sorted(s for k in KINDS for s in spans[k])
    inside = np.zeros(len(start), dtype=bool)
    for x, y in covered:
        inside[np.searchsorted(end, x, side="right") : np.searchsorted(start, y)] = True
    out, texts = set(), {}
    breaks = np.concatenate([[-1], np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10), [len(data)]])
    for kind in KINDS:
        for x, y in spans[kind]:
            at = int(np.searchsorted(breaks, x)) - 1
            line, stop = int(breaks[at]) + 1, int(breaks[np.searchsorted(breaks, y)])
            entity = _signed_hash(kind.encode() + class_of(kind, data[x:y]))
            if (line, stop) not in texts:  # a line is hashed once, however many spans it has
                texts[line, stop] = _signed_hash(data[line:stop])
            text = texts[line, stop]
            low, high = np.searchsorted(start, line), np.searchsorted(start, stop)
            left, right = np.searchsorted(end, x, side="right"), np.searchsorted(start, y)
            for near in (slice(max(low, left - WINDOW), left), slice(right, min(high, right + WINDOW))):
                for t in hashes[near][~inside[near] & (end[near] - start[near] > 2)].tolist():
                    out.add((entity, t, text, line))
    return [(e, t, x) for e, t, x, _ in out]


def _found(batches):
    """Base spans of every row, and the contexts of its entities."""
    triple = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("line", pa.int64())])
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            datas = [(t.as_py() or "").encode() for t in part.column(2)]
            every = [base_spans(d) for d in datas]
            near: list[list] = [[] for _ in datas]
            having = [i for i, s in enumerate(every) if any(s.values())]
            for w in words(part.column(2).take(pa.array(having, pa.int64())), _LETTERS):
                for i in range(w.docs):
                    at = having[w.first + i]
                    near[at] = [dict(zip(("entity", "term", "line"), x)) for x in _contexts(w, i, datas[at], every[at])]
            lists = [told(s, _Points(d)) for s, d in zip(every, datas)]
            joined = [",".join(x) for x in lists]
            columns = [pa.array([len(s[k]) for s in every], pa.int64()) for k in KINDS]
            columns += [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]), pa.array(joined, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *columns, pa.array(near, pa.list_(triple))],
                names=["key", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "near"],
            )


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, base, near) of every row, written to the shared
    folder: base spans as text, and near the (entity, term, line) triples of their contexts."""
    kind = df.select(F.col(doc_id)).schema[0].dataType.simpleString()
    rows = df.select(row_key(doc_id, text).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"key long, doc_id {kind}, {counts}, base_sha256 string, base string, near array<struct<entity:long,term:long,line:long>>"
    return settle(map_batches(rows, _found, schema), "pii")


def known_share(share: Column, contexts: Column) -> Column:
    """The share that `contexts` different lines have made up; its lower confidence bound if they are few."""
    n, z = contexts / share, F.lit(SIGMAS)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    bound = (share + z * z / (2 * n) - spread) / (1 + z * z / n)
    return F.when(contexts >= CONTEXTS, share).otherwise(bound)


def disclosing_terms(df: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(term, p) of the terms that exceed the threshold for some entity."""
    near = found.select(F.explode("near").alias("x")).select("x.*")
    by_line = near.groupBy("entity", "term", "line").agg(F.count("*").alias("n"))
    pairs = by_line.groupBy("entity", "term").agg(F.sum("n").alias("near"), F.count("*").alias("contexts"))
    pairs = settle(pairs, "pii-pairs")
    bits = bitmap(pairs, "term")
    if not bits.any():
        return pairs.select("term", F.lit(1.0).alias("p"))  # no rows
    held = df.sparkSession.sparkContext.broadcast(bits)

    def count(batches):
        for batch in batches:
            for w in words(batch.column(0), _LETTERS):
                hit = np.flatnonzero(maybe_in(held.value, w.hashes.view(np.int64)))
                line, term = _lines_of(w)[hit], w.hashes[hit]
                order = np.lexsort((line, term))
                line, term = line[order], term[order]
                once = np.ones(len(term), dtype=bool)
                once[1:] = (term[1:] != term[:-1]) | (line[1:] != line[:-1])
                of, n = np.unique(term[once].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(n)], names=["term", "n"])

    counted = map_batches(df.select(text), count, "term long, n long").groupBy("term").agg(F.sum("n").alias("lines"))
    share = pairs.join(counted, "term").select("term", known_share(F.col("near") / F.col("lines"), F.col("contexts")).alias("p"))
    return settle(share.groupBy("term").agg(F.max("p").alias("p")).where(F.col("p") >= EXCEEDS), "pii-terms")


def term_spans(df: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, terms) of the rows that hold disclosing terms: where, and how much each reveals."""
    held = df.sparkSession.sparkContext.broadcast(bitmap(terms, "term"))

    def look(batches):
        for batch in batches:
            for w in words(batch.column(1), _LETTERS):
                hit = np.flatnonzero(maybe_in(held.value, w.hashes.view(np.int64)))
                if not len(hit):
                    continue
                before = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                doc = w.doc[hit]
                base = before[w.offsets[doc]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc + w.first)), pa.array(w.hashes[hit].view(np.int64))]
                    + [pa.array(before[x[hit]] - base) for x in (w.start, w.end)],
                    names=["key", "term", "start", "end"],
                )

    rows = df.select(row_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    places = map_batches(rows, look, "key long, term long, start long, end long").join(terms, "term")
    return places.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end", "p"))).alias("terms"))


def spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    found = find(df, doc_id, text)
    terms = disclosing_terms(df, found, text)
    shown: Column = F.col("base")
    if not terms.isEmpty():
        found = found.join(term_spans(df, terms, doc_id, text), "key", "left")
        listed = F.transform("terms", lambda x: F.concat_ws(":", F.lit(TERM), x["start"].cast("string"), x["end"].cast("string")))
        shown = F.concat_ws(",", F.nullif(F.col("base"), F.lit("")), F.nullif(F.concat_ws(",", listed), F.lit("")))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", shown.alias("spans"))


def redact(text: str, terms: list[tuple[int, int, float]]) -> str:
    """The text with base spans as placeholders, and disclosing terms removed or generalised."""
    data = text.encode()
    points = _Points(data)
    cuts = [(points[a], points[b], f"[{k.upper()}]") for k, found in base_spans(data).items() for a, b in found]
    cuts += [(a, b, "" if p >= REMOVES else f"[{TERM.upper()}]") for a, b, p in terms]
    out, at = [], 0
    for a, b, mark in sorted(cuts, key=lambda c: (c[0], -c[1])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with their columns, the text with its personal data replaced. NULL stays NULL."""
    terms = disclosing_terms(df, find(df, doc_id, text), text)
    rows = df.select(row_of(df, text), F.col(text).alias("text"), row_key(doc_id, text).alias("key"))
    none = F.lit(None).cast("array<struct<start:long,end:long,p:double>>").alias("terms")
    rows = rows.select("*", none) if terms.isEmpty() else rows.join(term_spans(df, terms, doc_id, text), "key", "left")
    rows = rows.select("row", "text", "terms")

    def replace(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                made = []
                for t, found in zip(part.column(1), part.column(2)):
                    t, found = t.as_py(), found.as_py() or []
                    made.append(None if t is None else redact(t, [(x["start"], x["end"], x["p"]) for x in found]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.string())], names=["row", "text"])

    changed = map_batches(rows, replace, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return with_text(changed, df, text)
