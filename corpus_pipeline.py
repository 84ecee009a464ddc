"""From raw documents to packed sequences: language, copies, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import exact_dedup, language, ngram_join, packing, pii
from riskloom.llm.common import Scratch, table
from riskloom.llm.queries import vocabulary
from riskloom.session import ship


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null, empty and letterless texts go."""
    return language.accepted(docs, language.train(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs, Scratch(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle similarity connects."""
    return ngram_join.leaders(docs, Scratch(spark))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data of the texts replaced by marks."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json"), Scratch(spark))


STAGES = [
    ("language_id", in_a_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("pii", masked),
    ("best_fit_packing", packed),
]
#: Bytes of rows that go to a Python worker at a time. Spark counts rows (10,000) and up to 64 MB; with whole texts that is
#: tens of megabytes, held by the executor and by the worker, for every task of a stage.
BATCH = "4m"
#: No SQL: language scores and packing are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written and read again."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)  # stays: the last stage is read lazily
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.keep(docs)
    return docs
