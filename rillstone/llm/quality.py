"""Quality scores by the votes of the nearest labelled documents in a latent-semantic space.

A document is a bag of what its bytes look like: runs of three bytes (letters lower-cased), runs of five byte classes
(small letter, capital, digit, blank; other signs are themselves) and, for every word, whether it repeats one of the
last few. Each feature is hashed into one of BUCKETS. Weights are 1 + ln(count), times the inverse document frequency
over all documents; vectors have length one. The singular vectors of a bounded sample of labelled documents span the
latent space. Every document is folded into it and compared, in blocks, with the vectors of all labelled documents,
which are broadcast: cosines are exact, and the labels of the NEAR nearest vote with a power of their similarity.

The sample: at most ROWS documents of each label, and at most BYTES of text together; so what is broadcast has a fixed
size of at most 2 * ROWS * DIMS + BUCKETS * (DIMS + 1) numbers. Document frequencies come from every whole text.

Defined results: NULL, empty and blank texts are like nothing, and so have the share of label 1 among the labelled
documents as their score; labels that are NULL or neither 0 nor 1 are left out, and of several labels of one document
the largest counts; with labelled documents of one class only, the score is that class, and 1/2 if there are none;
repeated rows are scored each; of equally near neighbours the one with the smaller hash votes; other columns are not
looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.sample import labelled
from rillstone.llm.text import U, mix, pieces, raw, words

ROWS, BYTES = 2000, 32 << 20
BITS = 12
BUCKETS = 1 << BITS
DIMS, ROUNDS = 64, 3
NEAR, POWER = 15, 16
BLOCK = 256  # documents whose cosines are computed at once
THRESHOLD = 0.5
RUNS = (3, 5)  # bytes and byte classes in a row
BEFORE = 3  # words among which a repeat is looked for

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91], _CLASS[48:58], _CLASS[9:14] = 65, 48, 32
_RUN = np.arange(256) >= 33


def bags(column: pa.Array):
    """(first row, counts of the buckets of some rows as a dense array), in pieces of the column."""
    data, offsets = raw(column)
    repeats = words(column, _RUN)
    for a, b in pieces(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        docs, out = b - a, np.zeros((b - a) * BUCKETS, dtype=np.int64)
        doc = np.repeat(np.arange(docs), np.diff(bounds)).astype(np.int64)
        for seed, (table, size) in enumerate(zip((_FOLD, _CLASS), RUNS)):
            if len(part) < size:
                continue
            value = table[part].astype(U)
            code = np.zeros(len(part) - size + 1, dtype=U)
            for k in range(size):
                code = (code << U(8)) | value[k : len(part) - size + 1 + k]
            inside = doc[: len(code)] == doc[size - 1 :]
            bucket = (mix(code[inside], 71 + seed) >> U(64 - BITS)).astype(np.int64)
            out += np.bincount(doc[: len(code)][inside] * BUCKETS + bucket, minlength=len(out))
        w = next(repeats)
        again = np.zeros(len(w.hashes), dtype=bool)
        for k in range(1, BEFORE + 1):
            again[k:] |= (w.hashes[k:] == w.hashes[:-k]) & (w.doc[k:] == w.doc[:-k])
        out += np.bincount(w.doc * BUCKETS + again, minlength=len(out))
        yield a, out.reshape(docs, BUCKETS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one; a row without features is zero."""
    out = np.zeros(counts.shape, dtype=np.float32)
    some = counts > 0
    out[some] = 1 + np.log(counts[some])
    out *= idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 1e-9, norm, np.inf)


def singular_vectors(x: np.ndarray, dims: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors of x, as columns, by subspace iteration from a random start."""
    q = np.random.default_rng(seed).standard_normal((x.shape[1], dims + 8)).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    small = np.linalg.svd(x @ q, full_matrices=False)[2]
    return (q @ small.T)[:, :dims].astype(np.float32)


@dataclass
class Model:
    """Inverse document frequencies, the axes of the latent space, and the labelled vectors."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def share(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def fold(self, counts: np.ndarray) -> np.ndarray:
        return unit(weighted(counts, self.idf) @ self.axes)

    def vote(self, folded: np.ndarray) -> np.ndarray:
        """Scores from the exact cosines with all labelled vectors."""
        cosine = np.maximum(folded @ self.vectors.T, 0).astype(np.float64)
        near = min(NEAR, len(self.labels))
        at = np.argsort(-cosine, axis=1, kind="stable")[:, :near]
        weight = np.take_along_axis(cosine, at, axis=1) ** POWER
        total = weight.sum(axis=1)
        votes = (weight * self.labels[at]).sum(axis=1)
        return np.where(total > 0, votes / np.where(total > 0, total, 1), self.share)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if not 0 < self.share < 1 or not len(self.labels):
            return out
        for first, counts in bags(texts):
            for a in range(0, len(counts), BLOCK):
                part = counts[a : a + BLOCK]
                out[first + a : first + a + len(part)] = self.vote(self.fold(part))
        return out


def document_frequencies(df: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """The number of all rows, and of those that have each bucket's features."""

    def count(batches):
        seen, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, counts in bags(batch.column(0)):
                seen += (counts > 0).sum(axis=0)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1).astype(np.int32)), pa.array(np.append(seen[held], rows))], names=["bucket", "n"]
        )

    found = df.select(F.col(text)).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, rows = np.zeros(BUCKETS, dtype=np.int64), 0
    for r in found.collect():  # BUCKETS + 1 rows at most
        if r["bucket"] < 0:
            rows = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return rows, out


def train(texts: pa.Array, labels: np.ndarray, rows: int, frequencies: np.ndarray) -> Model:
    idf = np.log((1 + rows) / (1 + frequencies)).astype(np.float32) + 0.1
    x = [weighted(counts, idf) for _, counts in bags(texts)]
    x = np.concatenate([np.zeros((0, BUCKETS), dtype=np.float32), *x])
    if not len(labels) or labels.min() == labels.max():
        return Model(idf, np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros((len(labels), 0), dtype=np.float32), labels)
    axes = singular_vectors(x, min(DIMS, len(x)))
    return Model(idf, axes, unit(x @ axes), labels)


def fit(df: DataFrame, labels: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from a bounded sample of the labelled rows, with statistics of all rows of `df`; `learn` says by id which
    labels may be used."""
    texts, marks = labelled(df, labels, "quality", ROWS, BYTES, learn, doc_id, text)
    return train(texts, marks, *document_frequencies(df, text))


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = pa.array(held.value.scores(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def held_out_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learnt from labelled rows that are not held out."""
    scored = score(df, fit(df, labels, ~is_held_out(F.col("doc_id"))))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
