"""The corpus pipeline: quality, line templates, near copies, benchmark passages, packing.

Part of the training-data subpackage.  Each stage takes (spark, docs, sf_dir); what it gives is written and read again as the next
one's docs, and all but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreframe.llm.common import materialise
from acreframe.llm.decontaminate import decontaminate
from acreframe.llm.line_crf import keep_good
from acreframe.llm.near_copies import drop_similar
from acreframe.llm.packing import pack_documents
from acreframe.llm.queries import tokenizer
from acreframe.llm.templates import drop_boilerplate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text scores 0.7 at least.  Null and empty texts have a score like others; rows with equal texts fare alike."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines whose template recurs in unlike texts.  Every row loses lines of its own text; null stays null."""
    return drop_boilerplate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts of a five-word similarity of 0.8: that with the least doc_id; null and empty texts are alike.

    Covering hashing of fingerprints comes first; see near_copies.similar_links for what follows it, and why.
    """
    return drop_similar(docs, length=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without spans of words that lie in ten consecutive words of a test item; null stays null."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids; a null or empty text is its end alone, repeated rows are packed as they come.

    Workers hold few words, and let go of the tokenizer with their task, since other stages use them too.
    """
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), width=4096, end_id=2, cached=60_000, keep=False)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("packing", packing)]

#: SQL can't express the line field, the templates, XXH64 or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
