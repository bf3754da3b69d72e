"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import oracles
from touchline.llm.alignment import alignment_report
from touchline.llm.bit_sliced import top_inner_products
from touchline.llm.common import table
from touchline.llm.exact_dedup import exact_groups
from touchline.llm.html_extract import extract
from touchline.llm.language_id import identify
from touchline.llm.mixing import mix_report
from touchline.llm.multi_index import nearest
from touchline.llm.ngram_join import near_duplicates
from touchline.llm.packing import pack
from touchline.llm.substring_dedup import window_report
from touchline.llm.suffix_dedup import removal_report
from touchline.llm.toxicity import score_documents
from touchline.llm.whitening import whiten


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file lies (the folder is a setting; files are never copied)."""
    folder = os.environ.get("TOUCHLINE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_nearest_neighbours, op3_language_id, op4_best_fit_packing, op5_suffix_dedup, op6_ngram_jaccard,
    op7_substring_dedup, op8_toxicity, op9_mix_sources, op10_top_k_search, op11_token_alignment,
    op12_embedding_whitening, op13_exact_dedup,
)}

ORACLE: dict[str, str] = {
    "op5_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op6_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op7_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op10_top_k_search": oracles.TOP_K_SEARCH,
    "op13_exact_dedup": oracles.EXACT_DEDUP,
}
