"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, mixing to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.llm import mixing, queries
from filingspark.llm.common import clean as remove, cut, hash_mod, tables
from filingspark.llm.decontaminate import decontaminate
from filingspark.llm.exact_dedup import drop_copies
from filingspark.llm.language_id import reject, train
from filingspark.llm.near_copies import drop_near_copies

#: Documents whose language is found with a lower score are rejected, as are those without letters.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found, by a model that learned from two thirds of their ids."""
    return reject(docs, train(docs, hash_mod("doc_id", 3) != 1), LEAST_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest doc_id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens that each document gives to the mix, epoch by epoch."""
    rows = docs.select("doc_id", queries.domain(F.col("source")).alias("domain"), "lang", "source", "text")
    return mixing.mix(rows, queries.weights(spark), fraction=queries.FRACTION, max_epochs=queries.MAX_EPOCHS, seed=queries.SEED)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("mixing", mixed)]

#: Fingerprints and classifiers aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are a table in the shared folder, what it needed for them is removed."""
    docs, first = queries.table(spark, sf_dir, "documents"), tables()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        remove(first, -1)  # all but the table just written
    return STAGES[-1][1](spark, docs, sf_dir)
