"""A corpus from raw documents: filter by quality, drop near duplicates, hide personal data, mix sources, pack sequences.

Every stage takes the documents that the one before kept, with the columns of ``documents``; the last returns packed pieces.

Defined cases, in all stages: an empty table gives no rows; columns beyond those of ``documents`` pass through, whatever their
names; texts of any length are worked on whole. What each stage does with nulls, empty texts and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kotonoha.llm import jaccard, mixing, packing, pii, quality_model
from kotonoha.llm.common import settle, table, tidy
from kotonoha.llm.queries import tokenizer_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is scored as an empty one (the model's bias) and stays or goes with it, still null; repeated rows stay or go
    together; a null id is no hindrance; with no usable labels everything stays.
    """
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; of equal ids any one.

    Rows with a null id, and texts that are null, empty or without words, belong to no group and stay as they are. A row that
    repeats an id and its text goes; further texts of an id stay, once each.
    """
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind, ``n_chars`` counted anew where a text changed.

    A null text stays null, an empty one empty; repeated rows and null ids stay.
    """
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the sources' budgets; at most one pass over a source, so that none is there twice.

    Null language or source counts as ``none``; a text without words (or null) costs nothing and comes with its place in the
    order; rows that repeat an id are units of their own, and as many of them are taken as their budget allows.
    """
    return mixing.mixed_documents(docs, mixing.MixParams(max_epochs=1))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of at most 2048; a null or empty text is its end id alone, repeated rows are packed each."""
    return packing.packed_documents(docs, *tokenizer_files())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("pack", pack)]

#: Trained models and tokenizers are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each one's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs)
            tidy(spark)
    return docs
