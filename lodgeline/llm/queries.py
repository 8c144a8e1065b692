"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeline.llm import (
    bpe,
    embeddings,
    extraction,
    language,
    minhash,
    packing,
    personal,
    phrases,
    quality,
    resampling,
    scoring,
    sharding,
    tokens,
)
from lodgeline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        return run

    return add


@query("op1_suffix_tree")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.suffix_tree_scores(table(spark, folder, "documents"))


@query("op2_main_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.main_text(table(spark, folder, "pages"))


@query("op3_hilbert_shards")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, folder, "documents"), shards=40)


@query("op4_minhash_stars")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op5_piece_lengths")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.word_lengths(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query("op7_bpe_pair_index")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op8_itq_vectors")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query("op9_adaptive_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


ORACLES["op9_adaptive_quality"] = quality.SQL


@query("op10_best_fit")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op11_importance_resampling")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op11_importance_resampling"] = resampling.SQL


@query("op12_personal_data")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return personal.personal_data(table(spark, folder, "documents"))


@query("op13_phrases")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


ORACLES["op13_phrases"] = phrases.SQL
