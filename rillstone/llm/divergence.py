"""How far the vocabulary of each source departs from the others of its language, from in-mapper stripes.

Each task folds whole documents into one hash stripe per term: for every source its number of occurrences and of
documents, which add up to the term's document frequency. A task that holds SPILL entries spills its stripes and starts
anew, so its memory is bounded and a word that is everywhere still leaves a task as one row per spill. Spilled stripes
meet by term and are added up. The merged stripes of a language, cut into blocks of a bounded number of entries, then
directly emit what they add to each pair's divergence and their best terms; only those sums and bests move again.

Shares are whole numbers of billionths, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), computed exactly.

Defined results: NULL text, language or source is ''; a document is a row, so repeated rows count each; a (language,
source) group without terms still has its pairs, of value 0 if the language keeps no term; a source that is alone in its
language has no pairs; equal values are ranked by item; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import settle

SPILL = 1 << 18  # (term, source) entries that a task holds
BLOCK, BLOCKS = 1 << 16, 1 << 19  # entries of merged stripes that one call works on: as many as the language has pairs,
# so that fewer sums than entries come out, within these bounds
TILE = 256  # sources whose pairs are summed at once
PIECE = 1 << 20  # bytes of a text that are cut into terms at once
LANGUAGES = 10_000  # a table of one row per language is broadcast up to this many
SMOOTHING, SCALE_STEPS = 5, (1000, 1000, 1000)  # the scale of 10^9 as steps that keep products in 64 bits
ALL = b""  # the stripe under which each document counts once; no term is empty

#: Bytes of terms stay, A-Z lower-cased; all others become blanks.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
STRIPE = "lang string, term string, sources array<struct<source:string,n:bigint,docs:bigint>>"


def term_counts(text: bytes) -> Counter:
    """How often each term `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` stands in a text, A-Z lower-cased."""
    data, found, a = text.translate(_TERM_BYTES), Counter(), 0
    while a < len(data):
        b = data.find(b" ", a + PIECE) if len(data) - a > PIECE else -1
        found.update(data[a : b if b >= 0 else len(data)].split())
        a = b if b >= 0 else len(data)
    return found


class Stripes:
    """The stripes of one task since its last spill."""

    def __init__(self):
        self.held: dict[tuple[str, bytes], dict[str, list[int]]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        held = self.held
        for term, n in [(ALL, 1), *term_counts(text).items()]:
            stripe = held.get((lang, term))
            if stripe is None:
                stripe = held[lang, term] = {}
            entry = stripe.get(source)
            if entry is None:
                stripe[source] = [n, 1]
                self.entries += 1
            else:
                entry[0] += n
                entry[1] += 1

    def spill(self) -> pa.RecordBatch:
        keys, stripes = list(self.held), list(self.held.values())
        ends = np.concatenate([[0], np.cumsum([len(s) for s in stripes])]).astype(np.int32)
        entries = [e for s in stripes for e in s.values()]
        parts = [
            pa.array([source for s in stripes for source in s], pa.string()),
            pa.array([e[0] for e in entries], pa.int64()),
            pa.array([e[1] for e in entries], pa.int64()),
        ]
        sources = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, ["source", "n", "docs"]))
        langs, terms = pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary())
        self.__init__()
        return pa.RecordBatch.from_arrays([langs, terms.cast(pa.string()), sources], ["lang", "term", "sources"])


def _fold(batches):
    stripes = Stripes()
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in range(2))
        texts = batch.column(2).cast(pa.large_binary())
        for i, (lang, source) in enumerate(zip(langs, sources)):
            stripes.add(lang, source, texts[i].as_py())
            if stripes.entries >= SPILL:
                yield stripes.spill()
    if stripes.entries:
        yield stripes.spill()


def merged_stripes(
    df: DataFrame, least: int = 30, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """(lang, term, df, sources) of every term found in `least` documents of its language, `sources` being an array of
    (source, n); under the empty term the number of each source's documents. Written to the shared folder."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)])
    stripes = docs.toDF("lang", "source", "text").mapInArrow(_fold, STRIPE)
    # Dealt by term once: both sums below find their rows together.
    entries = stripes.repartition("lang", "term").select("lang", "term", F.inline("sources"))
    added = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    merged = added.groupBy("lang", "term").agg(
        F.sum("docs").alias("df"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return settle(merged.where((F.col("df") >= least) | (F.col("term") == "")), "stripes")


def shares(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), by long division: exact for totals below 9 * 10^15."""
    below = np.asarray(total, dtype=np.int64) + SMOOTHING * kept
    out, rest = np.divmod(np.asarray(count, dtype=np.int64) + SMOOTHING, below)
    for step in SCALE_STEPS:
        digit, rest = np.divmod(rest * step, below)
        out = out * step + digit
    return out + 1


def pair_sums(term: np.ndarray, source: np.ndarray, share: np.ndarray, terms: int, absent: np.ndarray):
    """(a, b, sum over terms of |share_a - share_b|) for all sources a < b, tile by tile. `term`, `source` and `share`
    are the entries, sorted by term; a source without an entry for a term has the share `absent`."""
    rows = max(1, (1 << 20) // TILE)
    bounds = np.searchsorted(term, np.arange(0, terms + rows, rows))
    for i in range(0, len(absent), TILE):
        for j in range(i, len(absent), TILE):
            total = np.zeros((len(absent[i : i + TILE]), len(absent[j : j + TILE])), dtype=np.int64)
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                left, right = (
                    _tile(term[a:b] - k * rows, source[a:b] - at, share[a:b], min(rows, terms - k * rows), absent[at : at + TILE])
                    for at in (i, j)
                )
                for n in range(len(total)):
                    total[n] += np.abs(right - left[:, n : n + 1]).sum(axis=0)
            a, b = np.indices(total.shape)
            upper = (a + i) < (b + j)
            yield a[upper] + i, b[upper] + j, total[upper]


def _tile(term: np.ndarray, source: np.ndarray, share: np.ndarray, terms: int, absent: np.ndarray) -> np.ndarray:
    out = np.tile(absent, (terms, 1))
    own = (source >= 0) & (source < len(absent))
    out[term[own], source[own]] = share[own]
    return out


def _emit(top: int):
    """What one block of a language's stripes adds to each pair of sources, and the block's best terms of each."""

    def run(key, groups: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        lang, out = key[0], []
        groups = groups.sort_values("source")
        names, total, kept = groups["source"].to_numpy(), groups["total"].to_numpy(), int(groups["kept"].iloc[0])
        entries = entries.sort_values("term")
        code, terms = pd.factorize(entries["term"])
        at = pd.Index(names).get_indexer(entries["source"])
        n = entries["n"].to_numpy()
        absent = shares(np.zeros(len(names), dtype=np.int64), total, kept) if kept else np.zeros(len(names), dtype=np.int64)
        share = shares(n, total[at], kept) if len(n) else np.zeros(0, dtype=np.int64)
        for a, b, value in pair_sums(code, at, share, len(terms), absent):
            out.append(pd.DataFrame({"lang": lang, "source": names[a], "part": "pair", "item": names[b], "value": value}))
        if len(n):
            whole = np.zeros(len(terms), dtype=np.int64)
            np.add.at(whole, code, n)
            gain = share - shares(whole, np.int64(total.sum()), kept)[code]
            rows = pd.DataFrame({"lang": lang, "source": names[at], "part": "term", "item": terms[code], "value": gain})
            rows = rows[gain > 0].sort_values(["value", "item"], ascending=[False, True])
            out.append(rows.groupby("source", sort=False).head(top))
        return pd.concat(out)

    return run


def source_divergence(
    df: DataFrame, least: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has the summed differences between the source's shares and
    those of each other source of the language; part `term` the `top` terms whose share most exceeds the language's."""
    stripes = merged_stripes(df, least, lang, source, text)
    entries = stripes.select("lang", "term", F.inline("sources"))
    found = (F.col("term") != "").cast("long")
    groups = entries.groupBy("lang", "source").agg(F.sum(found * F.col("n")).alias("total"))
    entries_of = F.sum(found * F.size("sources")).alias("entries")
    pairs = F.max(F.when(found == 0, F.size("sources").cast("long"))).alias("sources")  # of the stripe of all documents
    langs = stripes.groupBy("lang").agg(F.sum(found).alias("kept"), entries_of, pairs)
    of = F.greatest(F.lit(BLOCK), F.least(F.lit(BLOCKS), F.col("sources") * F.col("sources")))
    langs = langs.select("lang", "kept", F.greatest(F.lit(1), F.ceil(F.col("entries") / of)).cast("int").alias("blocks"))
    langs = settle(langs, "languages")
    langs = F.broadcast(langs) if langs.count() <= LANGUAGES else langs
    spread = groups.join(langs, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = entries.where("term != ''").join(langs.select("lang", "blocks"), "lang")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    blocks = blocks.select("lang", block, "term", "source", "n").toDF("lang", "block", "term", "source", "n")
    parts = (
        spread.select("lang", "block", "source", "total", "kept").groupBy("lang", "block")
        .cogroup(blocks.groupBy("lang", "block"))
        .applyInPandas(_emit(top), "lang string, source string, part string, item string, value long")
    )
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    there, back = F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    ways = F.when(F.col("part") == "pair", F.array(there, back)).otherwise(F.array(there))
    both = summed.select("lang", "part", "value", F.inline(ways))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = both.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
