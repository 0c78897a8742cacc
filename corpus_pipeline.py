"""From raw documents to encoded training text, stage by stage.

Each stage reads what the one before has written, keeps the columns of documents and decides over all their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.llm import mixing, ngram_join, quality_rules, sentence_pieces, toxicity
from clicklake.llm.common import fresh, table, words
from clicklake.sources.files import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy accepts."""
    return quality_rules.keep(docs, quality_rules.POLICIES["web-1"])


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a classifier fitted to the labels of those that came so far."""
    return toxicity.keep(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's target asks for, at most three, often none or one."""
    size = fresh(docs, "__size")
    sized = docs.withColumn(size, F.size(words(F.col("text"))).cast("long"))
    names = mixing.names_for(sized)
    return mixing.emitted(mixing.mix(sized, size, names=names), names).drop(size)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    ids, back = fresh(docs, "token_ids"), fresh(docs, "decoded")
    out = sentence_pieces.encode_and_decode(docs, to=ids, back=back)
    return out.withColumn(fresh(docs, "round_trip"), F.col(back).eqNullSafe(F.col("text"))).drop(back)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("toxicity", clean),
    ("ngram_join", distinct),
    ("mixing", mixed),
    ("sentence_pieces", encoded),
]

# Toxicity is learnt and pieces are encoded by a vocabulary file: neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs
