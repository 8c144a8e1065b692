"""The corpus pipeline: quality rules, language ID, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodgeline.llm import language, minhash, packing, quality
from lodgeline.llm.common import staged

#: The columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents within the fences of their language and source.

    Null and empty texts go; null ids, languages and sources are kept as they are; repeated rows are judged each. Only the
    columns of documents are read and returned; an empty table gives no rows.
    """
    return quality.filtered(docs.select(*COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is recognised, by a model of the labels in `docs`.

    Texts without a letter go; null ids and labels do not matter; repeated rows are judged each. Without any label all
    documents with a letter stay. Only the columns of documents are read and returned; an empty table gives no rows.
    """
    return language.of_known_language(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates, once; documents without id stay.

    Documents without words are like no other and stay. Of several rows with the kept id one stays. Only the columns of
    documents are read and returned; an empty table gives no rows.
    """
    return minhash.survivors(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences.

    A null or empty text is a piece of one token, the end; repeated rows and rows without id are packed each. Other
    columns are ignored; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Sketches, a trained classifier and the tokenizer's ids are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{k}")
    return docs
