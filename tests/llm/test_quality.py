"""The neighbours' votes against a slow version of the same formulas, and held-out accuracy on planted junk."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, frame, prose

from rillstone.llm import quality, sample
from rillstone.llm.text import mix


def slow_bag(text: str | None) -> Counter:
    data, out = (text or "").encode(), Counter()
    fold = lambda b: b + 32 if 65 <= b <= 90 else b

    def kind(b):
        if 97 <= b <= 122 or b >= 128:
            return 97
        return 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if 9 <= b <= 13 else b

    for seed, (of, size) in enumerate(((fold, 3), (kind, 5))):
        for i in range(len(data) - size + 1):
            code = 0
            for b in data[i : i + size]:
                code = code << 8 | of(b)
            out[int(mix(np.array([code], dtype=np.uint64), 71 + seed)[0]) >> (64 - quality.BITS)] += 1
    run = bytes(b if b >= 33 else 32 for b in map(fold, data)).split(b" ")
    run = [w for w in run if w]
    for i, w in enumerate(run):
        out[int(w in run[max(0, i - quality.BEFORE) : i])] += 1
    return out


def slow_vector(text: str | None, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(quality.BUCKETS)
    for b, n in slow_bag(text).items():
        out[b] = (1 + math.log(n)) * idf[b]
    return out / (np.linalg.norm(out) or 1)


def slow_scores(texts, model) -> list[float]:
    out = []
    for text in texts:
        v = slow_vector(text, model.idf) @ model.axes
        norm = np.linalg.norm(v)
        cosines = [max(0.0, float(v @ w) / norm) if norm > 1e-9 else 0.0 for w in model.vectors]
        near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEAR]
        total = sum(cosines[i] ** quality.POWER for i in near)
        votes = sum(cosines[i] ** quality.POWER * model.labels[i] for i in near)
        out.append(votes / total if total else model.share)
    return out


def planted(seed: int, n: int) -> list[tuple[int, str, int]]:
    """Prose, and four kinds of junk made of the same words."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        text, junk = prose(rng, rng.randint(20, 120)), rng.random() < 0.3
        if junk:
            words = text.split()
            kind = rng.randint(0, 3)
            text = (
                text.upper() if kind == 0 else " ".join(f"{w}{rng.choice('%$&')*3}" for w in words) if kind == 1
                else " | ".join(words) if kind == 2 else " ".join(w for w in words[:8] for _ in range(12))
            )
        rows.append((i, text, int(not junk)))
    return rows


def test_scores_against_brute_force():
    rows = planted(1, 90)
    odd = ["", None, "  ", "x", "日本", "a" * 4000, "\x00\x01", *(t for _, t, _ in planted(2, 25))]
    seen = Counter(b for _, t, _ in rows for b in slow_bag(t))
    seen = np.array([seen[b] for b in range(quality.BUCKETS)])
    texts = pa.array([t for _, t, _ in rows])
    counted = sum((counts > 0).sum(axis=0) for _, counts in quality.bags(texts))
    assert counted.tolist() == seen.tolist()
    model = quality.train(texts, np.array([y for *_, y in rows]), len(rows), seen)
    got = model.scores(pa.array(odd, pa.string()))
    assert np.allclose(got, slow_scores(odd, model), atol=2e-3)
    assert got[0] == got[1] == model.share


def test_axes_are_the_singular_vectors():
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((60, 6)) * [9, 7, 5, 3, 2, 1]) @ rng.standard_normal((6, 200))
    axes = quality.singular_vectors(x.astype(np.float32), 4, rounds=8)
    exact = np.linalg.svd(x, full_matrices=False)[2][:4]
    assert np.allclose(np.abs(exact @ axes), np.eye(4), atol=1e-3)


def test_held_out(spark):
    rows = planted(5, 600)
    df = frame(spark, [(i, t) for i, t, _ in rows] + awkward())
    marks = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (2, 5), (None, 1)], "doc_id long, quality int")
    got = quality.held_out_scores(df, marks)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) + len(awkward())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    truth = {i: y for i, _, y in rows if i > 400}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    rows_seen, n = quality.document_frequencies(df)
    assert rows_seen == df.count()
    all_texts = [r["text"] for r in df.collect()]
    want = Counter(b for t in all_texts for b in slow_bag(t))
    assert n.tolist() == [want[b] for b in range(quality.BUCKETS)]


@pytest.mark.parametrize("marks, score", [([], 0.5), ([(10, 1), (11, 1)], 1.0), ([(10, 0)], 0.0)])
def test_without_both_labels(spark, marks, score):
    df = frame(spark, awkward())
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.fit(df, labels)
    assert {r["score"] for r in quality.score(df, model).collect()} == {score}
    assert quality.score(frame(spark, []), model).count() == 0
    assert quality.fit(frame(spark, []), labels).share == 0.5


def test_sample_is_bounded_and_without_repeats(spark):
    rng = random.Random(8)
    texts = {i: prose(rng, 10) for i in range(60)}
    rows = [(7, texts[7])] * 500 + list(texts.items()) + [(7, "another"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, i % 2) for i in texts] + [(8, 1)], "doc_id long, toxic int")
    got, y = sample.labelled(df, marks, "toxic", 20, 1 << 20)
    assert len(got) == 40 and y.sum() == 20
    every, y = sample.labelled(df, marks, "toxic", 1000, 1 << 20)
    want = [(t or "", 1 if i == 8 else i % 2) for i, t in {(i, t) for i, t in rows}]
    assert sorted(zip(every.to_pylist(), y.tolist())) == sorted(want)
    few, _ = sample.labelled(df, marks, "toxic", 1000, 700)
    assert 5 < len(few) and sum(len(t.encode()) for t in few.to_pylist()) <= 700
