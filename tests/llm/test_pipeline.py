"""The registered queries of this subpackage and the pipeline."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from helpers import frame, labels, prose, shingle_set
from pyspark.sql import functions as F
from test_texts import brute_spans, line_key, naive_best_fit, slow_toxicity
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connect, difference  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from rillstone.llm import pii, toxicity  # noqa: E402
from rillstone.llm import queries as llm  # noqa: E402
from rillstone.llm.common import BATCH_BOUND, BATCH_BYTES, settle  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", llm.queries())
def test_query(spark, con, name):
    assert name in queries()
    got = queries()[name](spark, SF)
    assert difference(name, got, oracle_sql().get(name), con) is None
    source = {"op1": "embeddings", "op4": "pages"}.get(name.split("_")[0], "documents")
    if not name.startswith(("op10", "op11", "op12")):
        assert got.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram jaccard join", "personal data", "best-fit packing",
    ]
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        after = docs.count()
        assert 0.5 * before < after <= before
        before = after
    assert docs.where(F.col("n_chars") != F.char_length("text")).count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == before
    assert not os.path.exists(f"{SF}/_temporary")


def test_stages_take_small_batches(spark):
    """However wide the rows are, an operator gets a few megabytes of them at once, and loses none."""
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('wide ', 1500), id)").alias("text"))

    class Small:
        def scores(self, texts):
            return np.full(len(texts), float(texts.nbytes > 2 * BATCH_BYTES))

    given = spark.conf.get(BATCH_BOUND, None)
    try:
        spark.conf.unset(BATCH_BOUND)
        assert toxicity.keep_clean(docs, Small()).count() == 3000
        assert toxicity.score(docs, Small()).where("score > 0").isEmpty()
        spark.conf.set(BATCH_BOUND, "32m")  # what the session was given stays
        assert toxicity.score(docs, Small()).where("score > 0").count() > 0
    finally:
        spark.conf.set(BATCH_BOUND, given) if given else spark.conf.unset(BATCH_BOUND)


def small_corpus(rng):
    """Documents that every stage has something to do with, and labels for most of them."""
    rows, marks = [], []
    for i in range(260):
        toxic = i % 5 == 0
        words = prose(rng, rng.randint(40, 90)).split()
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["rotten", "vermin", "filthy"])
        text = " ".join(words)
        if i % 7 == 1:
            text = f"Shared  LINE of many\n{text}\n\tshared  line of many"
        if i % 9 == 2:
            text += f"\n{prose(rng, 3)} 7{i}@mail{i % 3}.org of +49 30 12345{i:03} The 10.0.{i % 200}.7"
        rows.append((i, text))
        if i % 6:
            marks.append((i, int(toxic), 1))
    for i in range(30):
        text = rows[3 * i][1].split(" ")
        rows.append((300 + i, " ".join(text[:-1] + ["changed"]) if i % 2 else rows[3 * i][1]))
    rows += [(400, None), (401, ""), (402, "x " * 3000), (403, " \n "), (403, " \n ")]
    return rows, marks


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's whole result from slow versions of its rule, on what the stage before has kept."""
    rows, marks = small_corpus(random.Random(2))
    frame(spark, rows).drop("label", "n_chars").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(marks, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    def result(name, docs):
        out = stages[name](spark, docs, sf)
        assert out.columns == docs.columns
        return settle(out, "stage"), sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)

    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~toxicity.is_held_out(F.col("doc_id")))
    want = [r for r in rows if slow_toxicity(r[1], model) < toxicity.THRESHOLD]
    docs, got = result("toxicity", docs)
    assert got == sorted(want, key=str) and 30 < len(rows) - len(want) < 90

    seen = Counter(k for _, t in want for k in {line_key(x) for x in (t or "").split("\n")})
    common = {k for k, n in seen.items() if k and n >= 10}
    assert common == {"shared  line of many"}
    want = [(i, "\n".join(x for x in (t or "").split("\n") if line_key(x) not in common)) for i, t in want]
    docs, got = result("line dedup", docs)
    assert [(i, t or "") for i, t in got] == sorted(want, key=str)

    sets = [shingle_set(t, 5) for _, t in want]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    top, least = labels(len(want), links), {}
    for at, (i, _) in zip(top, want):
        least[at] = min(least.get(at, i), i)
    want = [r for at, r in zip(top, want) if r[0] == least[at]]
    docs, got = result("n-gram jaccard join", docs)
    assert [(i, t or "") for i, t in got] == sorted(want, key=str) and links

    # All words around the values stand everywhere else as well, so none discloses anything.
    assert pii.disclosing_terms(docs, pii.find(docs)).isEmpty()
    docs, got = result("personal data", docs)
    plain = []
    for i, t in want:
        out, at = [], 0
        for a, b, k in sorted((a, b, k) for k, found in brute_spans(t).items() for a, b in found):
            if a >= at:
                out += [t[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        plain.append((i, "".join([*out, t[at:]])))
    assert [(i, t or "") for i, t in got] == sorted(plain, key=str) and any("[EMAIL]" in (t or "") for _, t in got)

    packed = stages["best-fit packing"](spark, docs, sf).collect()
    reference, sizes = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for i, t in got:
        sizes[i] += len(reference.encode(t or "", add_special_tokens=False).ids) + 1
    held = Counter()
    for r in packed:
        held[r["doc_id"]] += r["length"]
    assert held == sizes
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in b) <= 2048 and [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] for b in bins.values())
    assert len(bins) == len(naive_best_fit([r["length"] for r in packed], 2048))
