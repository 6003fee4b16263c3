"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORDS = ["alpha", "Beta", "gamma,", "delta", "eins", "zwei", "été", "ñandú", "x", "The", "of", "12", "日本語", "end."]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (str(rng.randint(0, 40)) if rng.random() < 0.5 else "") for _ in range(n))


def awkward(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """NULL and empty texts, blanks only, copies, near copies, ties, repeated rows, a NULL id, a very long text."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "One two")]
    base = prose(rng, 120)
    rows += [(10, base), (11, base), (12, base.replace("x", "y", 2)), (13, base + " tail"), (13, base + " tail")]
    rows += [(None, base), (None, "no id " + prose(rng, 30))]
    rows += [(100 + i, prose(rng, rng.randint(3, 90)).replace(" of", " of\n")) for i in range(40)]
    rows += [(200 + i, "shared line\n" + prose(rng, 20) + "\n  SHARED line \n\n" + prose(rng, 9)) for i in range(12)]
    rows.append((300, prose(rng, 30000)))
    return rows


def frame(spark, rows, schema: str = "doc_id long, text string"):
    """A table of the rows with more columns, named as operators might name their own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("key", "row", "sig", "tie", "range", "term", "block", "id", "e", "host", "salt", "n_chars", "label"):
        df = df.withColumn(name, F.lit(7).cast("long"))
    return df


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingle_set(text: str | None, size: int) -> frozenset:
    w = tokens(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else [])


def labels(n: int, links) -> list[int]:
    """The smallest position of each one's component."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
