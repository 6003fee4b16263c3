"""Divergence of sources against a brute-force count, with stripes that spill and blocks that are cut."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import lower

from rillstone.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def table(spark, rows, parts: int = 5):
    """The rows under ids, with columns named as the operator's own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(parts)
    for name in ("term", "sources", "n", "docs", "block", "kept", "total", "value", "rank", "item", "part"):
        df = df.withColumn(name, F.lit("x"))
    return df


def brute(rows, least: int, top: int) -> list[tuple]:
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(lower(text))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        groups = sorted(s for g, s in counts if g == lang)
        held = {s: {t: counts[lang, s][t] for t in kept} for s in groups}
        whole = {t: sum(held[s][t] for s in groups) for t in kept}

        def share(c, kept=kept):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: share(held[s]) for s in groups}, share(whole)
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if held[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                items = items[:top] if part == "term" else items
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def awkward(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "été", "ÑANDÚ", "日本語", "x1y", "a_b", "don't", "\x1c", "ﬀ", "𐐀", "�", "z" * 300]
    rows = [
        (None, None, None), ("", "", ""), (" 12 _ \t", "en", "only digits"), ("alone here", "xx", "s"),
        ("Alpha " * 400, "en", None), (None, "en", "no text"), ("beta", "zz", None), ("beta", "zz", "b"),
    ]
    for _ in range(160):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c\n", "é", None])
        rows.append((" ".join(rng.choice(words) + rng.choice(["", "", "s"]) for _ in range(rng.randint(0, 40))), lang, source))
    rows += [rows[-1]] * 3
    rows.append((" ".join(rng.choice(words) for _ in range(60_000)), "en", "b"))
    return rows


@pytest.mark.parametrize("least", [1, 12, 10_000])
def test_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(divergence, "BLOCK", 40)
    monkeypatch.setattr(divergence, "BLOCKS", 40)
    rows = awkward()
    got = divergence.source_divergence(table(spark, rows), least, 7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 7)


def test_stripes_spill():
    """A task's stripes, spilt at every few entries, add up to the counts."""
    rows, total, docs, spills = awkward(), Counter(), Counter(), 0
    stripes = divergence.Stripes()
    for i, (text, lang, source) in enumerate(rows):
        stripes.add(lang or "", source or "", (text or "").encode())
        if stripes.entries < 30 and i < len(rows) - 1:
            continue
        spills += 1
        for row in stripes.spill().to_pylist():
            for e in row["sources"]:
                total[row["lang"], row["term"], e["source"]] += e["n"]
                docs[row["lang"], row["term"]] += e["docs"]
        assert not stripes.entries
    want, want_docs = Counter(), Counter()
    for text, lang, source in rows:
        found = Counter(TERM.findall(lower(text)))
        for t, n in [("", 1), *found.items()]:
            want[lang or "", t, source or ""] += n
            want_docs[lang or "", t] += 1
    assert spills > 3 and total == want and docs == want_docs


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(random.Random(2).choices(["Ab", "été", "c-d", "long" * 9], k=4000)).encode()
    want = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "PIECE", 50)
    assert divergence.term_counts(text) == want


def test_shares_are_exact():
    rng = random.Random(7)
    for _ in range(300):
        kept, total = rng.randint(1, 10**6), rng.randint(0, 8 * 10**15)
        n = rng.randint(0, total)
        got = divergence.shares(np.array([n]), np.array([total]), kept)[0]
        assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_tiles_of_many_sources(monkeypatch):
    rng = np.random.default_rng(1)
    absent = rng.integers(1, 50, 23)
    dense = np.tile(absent, (40, 1))
    term, source = np.unique(rng.integers(0, (40, 23), (300, 2)), axis=0).T
    share = rng.integers(1, 1000, len(term))
    dense[term, source] = share
    monkeypatch.setattr(divergence, "TILE", 5)
    got = {(int(a), int(b)): int(v) for x in divergence.pair_sums(term, source, share, 40, absent) for a, b, v in zip(*x)}
    assert got == {(a, b): int(np.abs(dense[:, a] - dense[:, b]).sum()) for a in range(23) for b in range(a + 1, 23)}


def test_empty(spark):
    assert divergence.source_divergence(table(spark, [])).count() == 0
