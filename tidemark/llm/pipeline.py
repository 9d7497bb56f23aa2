"""Stages that make a training set of documents: each takes documents and returns documents, the last one packed pieces.

Only the columns of documents go on; others, whatever their names, are left out. An empty table gives an empty one. A document
with a null, empty or white text passes the quality classifier, is near to all others without words (one of them stays), loses
nothing to substrings, where a null text becomes empty, is never taken by the mix, which counts words, and would be packed as its
end alone. Null ids, languages and sources are values like others. Rows that share an id are documents of their own in all
stages but the first, where the labels of an id hold for all its rows; of repeated rows the second stage keeps one. Long texts are
worked on whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import kneser, mixing, packing, simhash, substrings
from tidemark.llm.tokens import Vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps."""
    return kneser.keep(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return simhash.keep_one(docs.select(*COLUMNS))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings that occur more than once."""
    return substrings.remove(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words."""
    return mixing.resample(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"), "bytes")
    return packing.pack(docs.select(*COLUMNS), vocabulary, end=1)
