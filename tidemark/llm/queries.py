"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    centroids,
    extract,
    kneser,
    mixing,
    neighbours,
    oph,
    packing,
    resampling,
    rules,
    simhash,
    substrings,
    tokenfile,
    toxicity,
)
from tidemark.llm.frames import documents
from tidemark.llm.tokens import Vocabulary
from tidemark.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir))


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rules.judge(documents(spark, sf_dir), measures=measures)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph.edited_pairs(documents(spark, sf_dir))


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.severity(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(documents(spark, sf_dir))


def op8_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"), "words")
    path = fresh_dir(spark, "token-ids")
    tokenfile.write_tokens(documents(spark, sf_dir), vocabulary, end=1, path=path)
    return tokenfile.read_tokens(spark, path)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"), "bytes")
    return packing.pack(documents(spark, sf_dir), vocabulary, end=1)


def op10_kneser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_rules": op2_rules,
    "op3_simhash": op3_simhash,
    "op4_fingerprints": op4_fingerprints,
    "op5_extract": op5_extract,
    "op6_toxicity": op6_toxicity,
    "op7_substrings": op7_substrings,
    "op8_tokenfile": op8_tokenfile,
    "op9_packing": op9_packing,
    "op10_kneser": op10_kneser,
    "op11_centroids": op11_centroids,
    "op12_resampling": op12_resampling,
    "op13_neighbours": op13_neighbours,
}
