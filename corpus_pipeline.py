"""From raw documents to packed sequences: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateweave.llm import decontaminate as _decontaminate
from rateweave.llm import ngram_join, packing, pii, quality
from rateweave.llm.queries import table, tokenizer_file
from rateweave.session import cut_lineage

#: Near duplicates: Jaccard similarity of sets of five-word shingles, at least 80 in 100.
WORDS, NUM, DEN = 5, 80, 100


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (operator 5)."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 4)."""
    return ngram_join.drop_near_duplicates(docs, words=WORDS, num=NUM, den=DEN)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text (operator 7)."""
    return _decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the names of its kinds (operator 8)."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens (operator 2)."""
    return packing.pack(docs, tokenizer_file(), with_ids=False)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: SQL has no tokenizer, trained trees or components; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else cut_lineage(out)
    return docs
