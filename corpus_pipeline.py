"""From documents to encoded training text: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from offerweave.llm import bpe, line_quality, mixing, near_dup, substring_dedup
from offerweave.llm.shared import new_path

BYTE_BPE = "byte_bpe_50k.json"
#: One epoch at most, since copies have just been taken out; a twentieth of the tokens may go for the weights' sake.
MIXTURE = mixing.Mixture(
    domains={"src0": "web", **{f"src{k}": "books" for k in range(1, 6)}, **{f"src{k}": "news" for k in range(6, 13)}},
    domain_weights={"web": 2, "books": 4, "news": 3, "other": 1},
    lang_weights={"en": 5, "de": 3, "fr": 2, "es": 2},
    share=(19, 20),
    max_epochs=1,
    seed=17,
)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines above a host's limit go from those that stay."""
    return line_quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return near_dup.one_of_each(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by windows that start more than once go; all documents stay."""
    return substring_dedup.without_repeats(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf's token prefix under the budgets of ``MIXTURE``."""
    return mixing.mixed_documents(docs, MIXTURE)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    return bpe.round_trips(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_duplicates", substring_duplicates),
    ("source_mixture", source_mixture),
    ("encoding", encoding),
]

#: Exact Jaccard components, window digests and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
