"""Cleaning a corpus: quality, near copies, benchmark passages, personal data, tokens. Each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import bpe, decontaminate, ngram_join, pii, quality
from streamlens.session import pin, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
PII_KEY = "replace-me"  # a secret of the user; fixed here so that runs agree


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies. Documents without words or id stay."""
    copies = pin(ngram_join.join(docs).where("class_id <> doc_id").select("doc_id"), "copies")
    return docs.join(ngram_join.bounded(copies), "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the new text."""
    out = pii.replace(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of ids and decoded text."""
    return bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None  # trained models, walks and merges are not SQL; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = pin(docs, f"stage-{k + 1}")
    return docs
