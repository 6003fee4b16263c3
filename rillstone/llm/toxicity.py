"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (bytes, with marks at both ends) and of itself,
hashed into a fixed number of buckets. A document's vector is the weighted mean of its words' vectors, and two softmax
weights follow. How much a word weighs is learnt as well: every bucket has one more number, a word the mean of its
buckets', and its weight is the exponential of that, times 1 + ln(n) for a word found n times. So a few telling words are
not lost among thousands of others. One word more, without meaning and of a weight that is learnt too, stands in every
document and damps what a single odd word can do. Buckets found in fewer than SEEN documents of the sample stay silent.

Embeddings, word weights and softmax weights are trained jointly with Adam in numpy on a bounded sample of labelled
documents, so misspelt words that training never saw still share most of their n-grams with words it did see. As all is
linear but for the weights, a trained bucket has two numbers for scoring, and the model that tasks get has a fixed size.

The sample: at most ROWS documents of each label in the order of a hash, and at most BYTES of text together. Scoring reads
every whole text.

Defined results: NULL, empty and wordless texts have the score of the bias alone; labels that are NULL or neither 0 nor
1 are left out, and of several labels of one document the largest counts; without labelled rows of both classes every
score is the share of label 1 (0 if there are none); repeated rows are scored each, and learnt from once; other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import map_batches, row_of
from rillstone.llm.sample import labelled
from rillstone.llm.text import U, Words, mix, words

ROWS, BYTES = 3000, 48 << 20
BUCKETS, DIMS, SIZES = 1 << 16, 8, (3, 4, 5)
EPOCHS, BATCH, RATE, STEPS = 8, 64, 0.2, 600  # at least so many steps, however few documents there are
SEEN = 3
STEEP = 20.0  # bound of the exponent of a word's weight
THRESHOLD = 0.7
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[list(b"abcdefghijklmnopqrstuvwxyz0123456789@$*") + list(range(128, 256))] = True


def subwords(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `which`, bucket) of every n-gram of those words, and of the words themselves."""
    size = w.end[which] - w.start[which] + 2
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    owner = np.repeat(np.arange(len(which)), size)
    within = np.arange(len(owner)) - begin[owner]
    marked = w.data[np.clip(w.start[which][owner] - 1 + within, 0, max(len(w.data) - 1, 0))].astype(U)
    marked[within == 0] = 60
    marked[within == size[owner] - 1] = 62
    owners, buckets = [np.arange(len(which))], [mix(w.hashes[which], 61) % U(BUCKETS)]
    with np.errstate(over="ignore"):
        for n in SIZES:
            if len(marked) < n:
                continue
            code = np.zeros(len(marked) - n + 1, dtype=U)
            for k in range(n):
                code = code * U(257) + marked[k : len(marked) - n + 1 + k]
            fits = within[: len(code)] + n <= size[owner[: len(code)]]
            owners.append(owner[: len(code)][fits])
            buckets.append(mix(code[fits], 62 + n) % U(BUCKETS))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


@dataclass
class Model:
    """For each bucket, what it adds to the log-odds of label 1 and to the exponent of a word's weight; the bias, and the
    weight of the word that stands in every document."""

    values: np.ndarray
    tells: np.ndarray
    bias: float
    rest: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for w in words(texts, _INSIDE):
            _, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
            odds = np.zeros(w.docs)
            if len(first):
                owner, bucket = subwords(w, first)
                size = np.bincount(owner, minlength=len(first))
                of_word = np.bincount(owner, self.values[bucket], len(first)) / size
                weight = np.exp(np.clip(np.bincount(owner, self.tells[bucket], len(first)) / size, -STEEP, STEEP))
                pairs, n = np.unique(w.doc * len(first) + back, return_counts=True)
                doc, word = pairs // len(first), pairs % len(first)
                part = (1 + np.log(n)) * weight[word]
                odds = np.bincount(doc, part * of_word[word], w.docs) / (np.bincount(doc, part, w.docs) + self.rest)
            out[w.first : w.first + w.docs] = 1 / (1 + np.exp(-np.clip(odds + self.bias, -30, 30)))
        return out


class _Bags:
    """The documents of a sample as bags of words, and the words as bags of buckets, in a few flat arrays."""

    def __init__(self, texts: pa.Array):
        known, hashes, sizes, buckets, docs, words_, counts = np.zeros(0, dtype=U), [], [], [], [], [], []
        for w in words(texts, _INSIDE):
            own, first = np.unique(w.hashes, return_index=True)
            fresh = ~np.isin(own, known)
            known = np.union1d(known, own)
            owner, bucket = subwords(w, first[fresh])
            order = np.argsort(owner, kind="stable")
            hashes.append(own[fresh])
            sizes.append(np.bincount(owner, minlength=int(fresh.sum())).astype(np.int32))
            buckets.append(bucket[order].astype(np.uint16 if BUCKETS <= 1 << 16 else np.int32))
            for i in range(w.docs):
                found, n = np.unique(w.hashes[w.bounds[i] : w.bounds[i + 1]], return_counts=True)
                docs.append(len(found))
                words_.append(found)
                counts.append(n.astype(np.int32))
        self.buckets, size = np.concatenate([np.zeros(0, dtype=np.uint16), *buckets]), np.concatenate(sizes)
        self.ends = np.cumsum(size, dtype=np.int64)
        self.starts = self.ends - size
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes)
        self.words = order[np.searchsorted(hashes[order], np.concatenate(words_))].astype(np.int32)
        self.parts = (1 + np.log(np.concatenate(counts))).astype(np.float32)
        self.bounds = np.concatenate([[0], np.cumsum(docs)])

    def frequent(self, least: int) -> np.ndarray:
        """Whether each bucket is found in at least so many documents."""
        n = np.zeros(BUCKETS, dtype=np.int64)
        for a, b in zip(self.bounds[:-1], self.bounds[1:]):
            found = self.words[a:b]
            n[np.unique(self.buckets[_ranges(self.starts[found], self.ends[found])[0]])] += 1
        return n >= least

    def batch(self, which: np.ndarray):
        """Words of some documents: (document, word, 1 + ln of its count), and the buckets of those words."""
        at, doc = _ranges(self.bounds[which], self.bounds[which + 1])
        used, word = np.unique(self.words[at], return_inverse=True)
        part = self.parts[at].astype(np.float64)
        at, owner = _ranges(self.starts[used], self.ends[used])
        return doc, word, part, self.buckets[at].astype(np.int64), owner, len(used)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges, one range after the other, and the range of each."""
    size = ends - starts
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + starts[of], of


def train(texts: pa.Array, labels: np.ndarray, seed: int = 1) -> Model:
    """Embeddings, word weights and softmax weights by minibatches; both labels weigh the same."""
    share = float(np.mean(labels)) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 30.0 if share else -30.0, 1.0)
    bags, rng = _Bags(texts), np.random.default_rng(seed)
    known = bags.frequent(SEEN)
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    p = {"e": rng.uniform(-0.1, 0.1, (BUCKETS, DIMS)), "w": rng.uniform(-0.1, 0.1, (DIMS, 2)), "b": np.zeros(2)}
    p |= {"t": np.zeros(BUCKETS), "rest": np.zeros(1)}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    steps = max(EPOCHS * -(-len(labels) // BATCH), STEPS)
    order = np.concatenate([rng.permutation(len(labels)) for _ in range(-(-steps * BATCH // len(labels)))])
    # One dimension after the other, so that no array has all of them for every n-gram.
    summed = lambda at, n, of: np.stack([np.bincount(at, of(d), n) for d in range(DIMS)], axis=1)
    for step in range(steps):
        which = order[step * BATCH : (step + 1) * BATCH]
        doc, word, part, bucket, owner, count = bags.batch(which)
        size = np.maximum(np.bincount(owner, minlength=count), 1)
        heard = known[bucket]
        bucket, owner = bucket[heard], owner[heard]
        vectors = summed(owner, count, lambda d: p["e"][:, d][bucket]) / size[:, None]
        tell = np.bincount(owner, p["t"][bucket], count) / size
        weight, rest = part * np.exp(np.clip(tell[word], -STEEP, STEEP)), np.exp(p["rest"][0])
        total = np.bincount(doc, weight, len(which)) + rest
        weight /= total[doc]
        inner = summed(doc, len(which), lambda d: vectors[:, d][word] * weight)
        odds = inner @ p["w"] + p["b"]
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(which)), labels[which]] -= 1
        error *= balance[which, None] / len(which)
        of_doc = error @ p["w"].T
        mean = (of_doc * inner).sum(axis=1)
        back = summed(word, count, lambda d: of_doc[:, d][doc] * weight) / size[:, None]
        apart = (of_doc[doc] * vectors[word]).sum(axis=1) - mean[doc]
        told = np.bincount(word, weight * apart, count) / size
        g = {"w": inner.T @ error, "b": error.sum(axis=0), "e": summed(bucket, BUCKETS, lambda d: back[:, d][owner])}
        g |= {"t": np.bincount(bucket, told[owner], BUCKETS), "rest": -(mean * rest / total).sum(keepdims=True)}
        rate = RATE * (1 - step / steps)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            p[k] -= rate * (m[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(v[k] / (1 - 0.99 ** (step + 1))) + 1e-8)
    values = np.where(known, p["e"] @ (p["w"][:, 1] - p["w"][:, 0]), 0)
    return Model(values, np.where(known, p["t"], 0), float(p["b"][1] - p["b"][0]), float(np.exp(p["rest"][0])))


def fit(df: DataFrame, labels: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from a bounded sample of the labelled rows; `learn` says by id which of them may be used."""
    return train(*labelled(df, labels, "toxic", ROWS, BYTES, learn, doc_id, text))


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1)))], names=["doc_id", "score"]
            )

    return map_batches(docs, run, f"doc_id {kind}, score double")


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def held_out_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learnt from labelled rows that are not held out."""
    scored = score(df, fit(df, labels, ~is_held_out(F.col("doc_id"))))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def keep_clean(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    rows = df.select(row_of(df), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            kept = pa.array(model.scores(batch.column(1)) < THRESHOLD)
            yield batch.select([0]).filter(kept)

    return map_batches(rows, run, f"row {rows.schema['row'].dataType.simpleString()}").select("row.*")
