"""The queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acreframe.llm.centroids import CLUSTERS_SQL, cluster_vectors
from acreframe.llm.collocations import COLLOCATIONS_SQL, collocations
from acreframe.llm.common import documents, materialise
from acreframe.llm.decontaminate import CONTAMINATION_SQL, contamination
from acreframe.llm.line_crf import score_documents
from acreframe.llm.packing import pack_documents
from acreframe.llm.sanitise import find_private
from acreframe.llm.simhash import simhash_groups
from acreframe.llm.suffix_index import remove_repeats
from acreframe.llm.telephony import decode_media, store_media
from acreframe.llm.templates import line_report
from acreframe.llm.token_tree import count_tokens, derived_edits
from acreframe.llm.url_rules import PATTERNS, SITES, URL_SQL, judge_urls
from acreframe.llm.warc import ARCHIVED_SQL, archive_pages


def tokenizer(name: str) -> str:
    """Where a vocabulary file of the public tokenizers is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_media(materialise(store_media(documents(spark, sf_dir)), "media", compression="zstd"))


def op2_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(documents(spark, sf_dir))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), least_bytes=100)


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def op6_token_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), derived_edits(3), tokenizer("byte_bpe_50k.tiktoken"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), shingle=3, radius=2, seed=42).drop("key", "digest")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), width=4096, end_id=2)


def op9_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), length=100)


def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), SITES + PATTERNS).select("page_id", "host", "path", "rule", "verdict")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), longest=3, least=10, share=50, first=2000)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), clusters=40, rounds=5, dims=64, seed=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_telephony, op2_sanitise, op3_warc, op4_templates, op5_line_crf, op6_token_tree, op7_simhash, op8_packing, op9_suffix_index, op10_fm_index, op11_url_rules, op12_collocations, op13_clusters)
}
ORACLE: dict[str, str] = {"op3_warc": ARCHIVED_SQL, "op10_fm_index": CONTAMINATION_SQL, "op11_url_rules": URL_SQL, "op12_collocations": COLLOCATIONS_SQL, "op13_clusters": CLUSTERS_SQL}
