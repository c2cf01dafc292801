"""The corpus pipeline: five filters and packers, one after the other, over ``documents``.

Each stage reads all that its predecessor kept, and its decisions take effect.
All but the last return the columns of ``documents``. Defined results for nulls,
empty and very long texts, ties, repeated rows, empty tables and extra columns
are those of the operator that a stage calls:

* toxicity: rows scored 0.7 or more go.
* exact dedup: of equal texts the row with the largest doc_id stays.
* SimHash near-dedup: of documents that links of Jaccard similarity 0.8 or more over
  five-word shingles join, the one with the least doc_id stays.
* benchmark decontamination: documents with a window within a fifth of an
  item's words in edit distance go.
* best-fit packing: the places of all that is left in sequences of 2,048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexdrift.llm import decontamination, exact_dedup, packing, simhash, toxicity
from hexdrift.llm.common import cut


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by models of ``labels``."""
    return toxicity.ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, size=5, threshold=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

#: Models, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
