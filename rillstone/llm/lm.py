"""Bigram language model as a weighted backoff automaton, trained and traversed in blocks of documents.

States are histories: the root (no history) and one state for each word, the start of a text included. From the state
of h an arc for each seen successor w carries log10 P(w | h); the failure arc carries the state's left-over mass and
goes to the root, whose arcs carry the add-one unigram log-probabilities, with one arc for everything unknown:

    P(w | h) = max(c(h w) - D, 0) / c(h) + D * T(h) / c(h) * P(w),    P(w) = (c(w) + 1) / (N + V + 1)

(T: distinct successors, D: absolute discount), which sums to one over the V known tokens and the unknown one. A
traversal reads a text from left to right, carries the state, and adds up the arcs it takes.

The whole automaton is as large as the corpus, so no task gets it. Documents are dealt into blocks; each block asks the
shards for the bigrams and words it contains, with its own training counts, in one packed row per shard. A shard adds up
all blocks' counts and answers each block with the totals of what it asked for, in the same order. The block then builds
the part of the automaton its texts can reach, which gives the same scores. Bigrams live in the shard of their history,
so a shard also knows c(h) and T(h); the few histories that make up more than one in `HOT` of all tokens are spread over
all shards by their successors, and their T(h), at most `HOT` numbers, is added up over the shards.

Defined results: NULL, empty and blank texts are one token, the end; ids that are NULL are hashed as no text and
train; repeated rows count each; an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.text import U, Words, mix, words

DISCOUNT = 0.75
HOT = 1000
BLOCK_BYTES = 8 << 20
END, START = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each document, and the bounds of documents."""
    bounds = w.bounds + np.arange(w.docs + 1)
    out = np.full(int(bounds[-1]), END, dtype=U)
    inside = np.ones(len(out), dtype=bool)
    inside[bounds[1:] - 1] = False
    out[inside] = w.hashes
    return out, bounds


def histories(stream: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The history of each token: the word before it, or the start."""
    out = np.empty_like(stream)
    out[1:] = stream[:-1]
    out[bounds[:-1]] = START
    return out


def _stream(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for w in words(texts):
        yield w.first, *tokens(w)


def pair(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(history, 41) * U(3) + token, 42)


def _distinct(key: np.ndarray, n: np.ndarray, *others: np.ndarray):
    """Distinct keys in order, the sums of n, the others where the key stands, and each row's place among the keys.
    Equal keys must have equal others."""
    order = np.argsort(key)
    key = key[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(fresh)
    place = np.empty(len(key), dtype=np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return key[first], np.add.reduceat(n[order], first), [x[order[first]] for x in others], place


def among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Whether each value is one of a few sorted ones."""
    at = np.searchsorted(few, values)
    at[at == len(few)] = 0
    return few[at] == values


def _frequent(batches):
    """(token, n) of words that make up a thousandth of some piece of text, and (NULL, n) for all tokens."""
    for batch in batches:
        for _, stream, _ in _stream(batch.column(0)):
            token, n = np.unique(stream[stream != END], return_counts=True)
            often = n * HOT > len(stream)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *token[often].view(np.int64).tolist()], pa.int64()), pa.array([len(stream), *n[often].tolist()])],
                names=["token", "n"],
            )


def packed(n: np.ndarray) -> bytes:
    """Counts as bytes; 255 says that the next of the 64-bit numbers at the end is meant."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype("<i8").tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    small = np.frombuffer(data, dtype=np.uint8, count=size).astype(np.int64)
    small[small == 255] = np.frombuffer(data, dtype="<i8", offset=size)
    return small


class Request:
    """A block's pairs, dealt to shards and ordered by shard, history and hash: how it asks, and reads the answers."""

    def __init__(self, texts: pa.Array, train: np.ndarray, hot: np.ndarray, shards: int):
        parts, self.pieces = [], []
        for first, stream, bounds in _stream(texts):
            before = histories(stream, bounds)
            used = np.repeat(train[first : first + len(bounds) - 1], np.diff(bounds)).astype(np.int64)
            key, n, (before, token), place = _distinct(pair(before, stream), used, before, stream)
            parts.append((key, n, before, token))
            self.pieces.append((bounds, key, place))
        joined = [np.concatenate(x) for x in zip(*parts)]
        del parts
        key, n, (before, token), _ = _distinct(*joined)
        del joined
        shard = np.where(among(before, hot), mix(token, 51), mix(before, 52)) % U(shards)
        # Sorted by shard and history together; a stable sort keeps the order of keys within a history.
        bits = U(64 - int(shards).bit_length())
        order = np.argsort((shard << bits) | (mix(before, 53) >> (U(64) - bits)), kind="stable")
        self.sorted, self.order = key, order
        self.key, self.n, self.before, self.token = key[order], n[order], before[order], token[order]
        shard = shard[order].astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        self.parts = []
        for a, b in zip(cuts, [*cuts[1:], len(shard)]):
            heads = np.flatnonzero(np.concatenate([[True], self.before[a + 1 : b] != self.before[a : b - 1]]))
            self.parts.append((int(shard[a]), slice(a, b), self.before[a:b][heads], np.diff(np.append(heads, b - a))))

    def rows(self) -> list[tuple]:
        """One row for each shard: histories, how many pairs each has, 48 bits of the pairs' hashes, counts."""
        out = []
        for shard, part, own, runs in self.parts:
            high = (self.key[part] >> U(48)).astype("<u2"), (self.key[part] >> U(16)).astype("<u4")
            hashes = high[0].tobytes() + high[1].tobytes()
            out.append((shard, own.tobytes(), runs.astype("<u4").tobytes(), hashes, packed(self.n[part])))
        return out

    def model(self, answers: pd.DataFrame, hot: np.ndarray) -> Automaton:
        """The automaton of what the shards answered. The row of shard -1 has the sums over all shards."""
        by_shard = {row.shard: row for row in answers.itertuples()}
        sums = {h: (c, t) for h, c, t in zip(*(by_shard[-1][i] for i in _SUMMED))}
        hot_c, hot_t = (np.array([sums.get(h, (0, 0))[i] for h in _signed(hot)], dtype=np.int64) for i in (0, 1))
        total, c, t = (np.empty(len(self.key), dtype=np.int64) for _ in range(3))
        heads, seen = [hot], [hot_c]
        for shard, part, own, runs in self.parts:
            row = by_shard[shard]
            total[part] = unpacked(row.totals, part.stop - part.start)
            own_c, own_t, spread = unpacked(row.seen, len(own)), unpacked(row.kinds, len(own)), among(own, hot)
            at = np.searchsorted(hot, own[spread])
            own_c[spread], own_t[spread] = hot_c[at], hot_t[at]
            c[part], t[part] = np.repeat(own_c, runs), np.repeat(own_t, runs)
            heads.append(own[~spread])
            seen.append(own_c[~spread])
        heads, seen = np.concatenate(heads), np.concatenate(seen)
        # A word occurs as often as some token follows it; the end occurs as often as a text starts.
        ends = int(hot_c[hot == START].sum())
        n_types = sums[_N][1] + int((hot_c[hot != START] > 0).sum()) + int(ends > 0)
        words_, counts = np.append(heads[heads != START], END), np.append(seen[heads != START], ends)
        by_word = np.argsort(words_)
        n = counts[by_word][np.searchsorted(words_[by_word], self.token)]
        return Automaton(c, t, total, n, sums[_N][0], n_types)

    def scores(self, model: Automaton) -> np.ndarray:
        """Tokens, known tokens, base score and score of each document."""
        steps = np.empty((len(self.sorted), 3))
        for i, step in enumerate(model.steps()):
            steps[self.order, i] = step
        out = []
        for bounds, key, place in self.pieces:
            taken = steps[np.searchsorted(self.sorted, key)][place]
            out.append(np.column_stack([np.diff(bounds), np.add.reduceat(taken, bounds[:-1], axis=0)]))
        return np.concatenate(out)


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


_N = 0  # the "history" under which shards report all their tokens and how many of their words occur in training


def _answer(hot: np.ndarray):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """For each block, in the order it asked: its pairs' totals, its histories' c and T. Sums go to block -1."""
        asked = [
            (row.block, np.frombuffer(row.histories, dtype=U), np.frombuffer(row.runs, dtype="<u4").astype(np.int64))
            for row in frame.itertuples()
        ]
        heads = np.unique(np.concatenate([own for _, own, _ in asked]))
        places = [np.searchsorted(heads, own) for _, own, _ in asked]
        history, key, n = [], [], []
        for row, (_, _, runs), at in zip(frame.itertuples(), asked, places):
            size = int(runs.sum())
            top = np.frombuffer(row.pairs, dtype="<u2", count=size).astype(U) << U(48)
            key.append(top | np.frombuffer(row.pairs, dtype="<u4", offset=2 * size).astype(U) << U(16))
            history.append(np.repeat(at, runs).astype(U))
            n.append(unpacked(row.counts, size))
        history, key, n = np.concatenate(history), np.concatenate(key), np.concatenate(n)
        # History and pair in one number; up to 65,536 histories leave all 48 bits of the pair.
        bits = U(len(heads).bit_length())
        _, totals, (of,), place = _distinct((history << (U(64) - bits)) | (key >> bits), n, history)
        of = of.astype(np.int64)
        seen = np.bincount(of, totals, len(heads)).astype(np.int64)
        kinds = np.bincount(of[totals > 0], minlength=len(heads))
        total, rows, begin, shard = totals[place], [], 0, frame["shard"].iat[0]
        for (block, _, runs), at in zip(asked, places):
            end = begin + int(runs.sum())
            rows.append((block, shard, packed(total[begin:end]), packed(seen[at]), packed(kinds[at]), None, None, None))
            begin = end
        spread = among(heads, hot)
        sums = [_signed(heads[spread]) + [_N], seen[spread].tolist() + [int(totals.sum())]]
        sums.append(kinds[spread].tolist() + [int((seen[~spread] > 0).sum())])
        rows.append((-1, shard, None, None, None, *sums))
        return pd.DataFrame(rows, columns=_ANSWERED)

    return run


_SUMMED = [6, 7, 8]  # places of history, c and T in a named tuple of an answer
_ANSWERED = ["block", "shard", "totals", "seen", "kinds", "history", "c", "t"]
_ANSWER_SCHEMA = (
    "block int, shard long, totals binary, seen binary, kinds binary, "
    "history array<bigint>, c array<bigint>, t array<bigint>"
)


class Automaton:
    """The part of the backoff automaton that a block's texts can reach, one row for each (state, token) they step
    over: c and T of the state, the arc's count, and the token's count at the root."""

    def __init__(self, c, t, arc, n, n_tokens: int, n_types: int):
        self.c, self.t, self.arc, self.n, self.n_tokens, self.n_types = c, t, arc, n, n_tokens, n_types

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each step: whether the token is known, log10 of the root's arc, and log10 of the path taken: the state's
        own arc, where it has one, beside the failure arc and the root's. Reading a token leads to its own state
        whichever arcs were taken, so a text's score is the sum over its steps from left to right."""
        plain = (self.n + 1) / (self.n_tokens + self.n_types + 1)
        c = np.maximum(self.c, 1)
        path = np.maximum(self.arc - DISCOUNT, 0) / c + DISCOUNT * self.t / c * plain
        return self.n > 0, np.log10(plain), np.log10(np.where(self.c > 0, path, plain))


_SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _score(hot: np.ndarray, shards: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=_SCORED)
        texts = pa.array(docs["text"])
        request = Request(texts, docs["train"].to_numpy(), hot, shards)
        model = request.model(answers, hot)
        n, known, base, path = request.scores(model).T
        out = docs[["doc_id"]].copy()
        out["held_out"], out["n_tokens"], out["n_known"] = ~docs["train"], n.astype(np.int64), known.astype(np.int64)
        out["train_tokens"], out["base_score"], out["score"] = model.n_tokens, base, path
        return out

    return run


def held_out(doc_id: Column, of: int = 7, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves that remainder; never for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == remainder, F.lit(False))


def score(df: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; `train` says which rows
    are learnt from, by default those that are not held_out()."""
    train = ~held_out(F.col(doc_id)) if train is None else train
    docs = df.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), train.alias("train")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("text").mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # A word that makes up a thousandth of the corpus does so in some piece: the most frequent 1000 are few rows.
    often = counted.orderBy(F.col("token").isNotNull(), F.desc("n"), "token").limit(HOT + 1).collect()
    every = often[0]["n"] if often else 0
    frequent = [r["token"] for r in often[1:] if r["n"] * HOT > every]
    hot = np.sort(np.array([*frequent, int(START.view(np.int64))], dtype=np.int64).view(U))
    size = df.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")
    dealt = docs.select(block, "doc_id", "text", "train").repartition(blocks, "block")

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        rows = Request(pa.array(frame["text"]), frame["train"].to_numpy(), hot, blocks).rows()
        out = pd.DataFrame(rows, columns=["shard", "histories", "runs", "pairs", "counts"])
        out.insert(0, "block", frame["block"].iat[0])
        return out

    asked = dealt.groupBy("block").applyInPandas(
        ask, "block int, shard long, histories binary, runs binary, pairs binary, counts binary"
    )
    answered = asked.groupBy("shard").applyInPandas(_answer(hot), _ANSWER_SCHEMA)
    sums = answered.where("block < 0").select(F.explode(F.arrays_zip("history", "c", "t")).alias("x"))
    sums = sums.groupBy("x.history").agg(F.sum("x.c").alias("c"), F.sum("x.t").alias("t"))  # HOT + 2 rows at most
    listed = sums.agg(*[F.collect_list(x).alias(x) for x in ("history", "c", "t")])
    nothing = F.lit(None).cast("binary")
    summed = listed.select(
        F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))).alias("block"), F.lit(-1).cast("long").alias("shard"),
        nothing.alias("totals"), nothing.alias("seen"), nothing.alias("kinds"), "history", "c", "t",
    )
    answers = answered.where("block >= 0").unionByName(summed)
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(hot, int(blocks)), schema)
