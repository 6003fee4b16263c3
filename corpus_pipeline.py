"""From raw documents to packed sequences: five stages, each over everything the one before has kept.

Toxic documents go; lines that ten or more documents share go from all of them; of near duplicates (five words, a
similarity of 0.8) the one with the smallest id stays; personal data is replaced; what is left is packed. All stages but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import jaccard, lines, packing, pii, toxicity
from rillstone.llm.common import settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the labelled ones that are not held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.is_held_out(F.col("doc_id")))
    return toxicity.keep_clean(docs, model)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_common_lines(docs, least=10)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, size=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, public_tokenizers.PATTERN, added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_common_lines),
    ("n-gram jaccard join", keep_one_of_near_duplicates),
    ("personal data", replace_personal_data),
    ("best-fit packing", pack),
]

#: A trained classifier decides in the first stage, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`, each stage written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
