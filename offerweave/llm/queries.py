"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from offerweave.llm import bpe, collocations, graph_ann, html_text, importance, jaccard_join, line_quality, mixing, quality_model, substring_dedup, token_counts, token_records
from offerweave.llm.near_dup import near_duplicates

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
END_ID = 2
MIXTURE = mixing.Mixture(
    domains={"src0": "web", **{f"src{k}": "books" for k in range(1, 6)}, **{f"src{k}": "news" for k in range(6, 13)}},
    domain_weights={"web": 2, "books": 4, "news": 3, "other": 1},
    lang_weights={"en": 5, "de": 3, "fr": 2, "es": 2},
    source_weights={"src1": 3, "src7": 2},
    share=(9, 10),
    max_epochs=2,
    seed=17,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_records.read_report(spark, token_records.write_records(docs, public_tokenizers.path(WORD_BPE), END_ID))


def op2_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return graph_ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality_report(_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(_table(spark, sf_dir, "documents"), MIXTURE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(_table(spark, sf_dir, "documents"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_sample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_graph_ann": op2_graph_ann,
    "op3_line_quality": op3_line_quality,
    "op4_html_text": op4_html_text,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_model": op8_quality_model,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_importance": op11_importance,
    "op12_collocations": op12_collocations,
    "op13_jaccard_join": op13_jaccard_join,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {"op5_mixing": mixing.oracle(MIXTURE), "op11_importance": importance.oracle(), "op12_collocations": collocations.oracle()}
