"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodgeline.llm import (
    bpe,
    embeddings,
    extraction,
    language,
    minhash,
    packing,
    personal,
    quality,
    resampling,
    scoring,
    sharding,
    tokens,
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, shard int, n int, component_id string, kept int, key long"
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from all of us here "

ROWS = [
    (1, PROSE * 5, "en", "a", 10),
    (1, PROSE * 5, "en", "a", 10),
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (None, PROSE + "again", "en", "a", 5),
    (None, None, None, None, None),
    (4, "  \n\t ", "de", "b", 3),
    (5, PROSE * 5, "en", "b", 10),
    (10, "der schnelle braune fuchs springt über den faulen hund " * 4000, "de", "b", 9),
    (7, "###", "de", "b", None),
    (8, "word", "en", "c", 4),
    (9, "WORD", "en", "c", 4),
]

OPERATORS = {
    "scores": scoring.suffix_tree_scores,
    "shards": sharding.hilbert_shards,
    "duplicates": minhash.near_duplicates,
    "lengths": lambda d: tokens.word_lengths(d, public_tokenizers.path("byte_bpe_50k.json")),
    "language": language.identify,
    "bpe": lambda d: bpe.encode_decode(d, public_tokenizers.path("byte_bpe_50k.json")),
    "quality": quality.quality,
    "resampling": lambda d: resampling.resampled(d, d),
    "personal": personal.personal_data,
}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in ROWS], DOCUMENTS)


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_document(odd, name):
    rows = OPERATORS[name](odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](odd.limit(0)).collect() == []


def test_defined_results(odd):
    duplicates = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd).collect()}
    n = len(set(zip(*[(PROSE * 5).split()[k:] for k in range(5)])))
    assert {(1, n, 1, True), (5, n, 1, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (9, 1, 8, False)} <= duplicates
    assert (None, 0, None, True) in duplicates
    named = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd).collect() if r["doc_id"]}
    assert named[2] == named[3] == named[4] == named[7] == ("und", 0.0)
    assert named[1][0] == "en" and named[10][0] == "de"
    judged = {r["doc_id"]: r for r in quality.quality(odd).collect() if r["doc_id"]}
    assert judged[2]["base_failed"] and not judged[2]["kept"] and judged[2]["n_words"] == 0
    scores = {r["doc_id"]: r for r in scoring.suffix_tree_scores(odd).collect()}
    assert scores[2]["n_tokens"] == scores[3]["n_tokens"] == 1


def test_packing(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(odd, path, capacity=64).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in ROWS}
    assert sum(r["doc_id"] == 2 for r in rows) == 1
    assert sum(r["doc_id"] == 1 and r["piece"] == 0 for r in rows) == 2
    assert packing.pack(odd.limit(0), path).collect() == []


def test_pages(spark):
    kind = "page_id long, url string, html string, text string, n_chars int, stream long, bucket string"
    body = "<article><p>one &amp; two</p></article>"
    rows = [(1, "http://a/x", body), (1, "http://a/x", body), (2, None, None), (None, "", ""), (3, "x", "<div>" * 5000 + "deep")]
    pages = spark.createDataFrame([(*r, "t", 1, 2, "b") for r in rows], kind)
    found = extraction.main_text(pages).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in found) == [
        ("1", "one & two"), ("1", "one & two"), ("2", ""), ("3", "deep"), ("None", "")
    ]
    assert extraction.main_text(pages.limit(0)).collect() == []


def test_vectors(spark):
    kind = "vec_id long, embedding array<float>, label int, node long, n string, key int, links int"
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.01]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (12, [5.0]),
    ]
    table = spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], kind)
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(table).collect())
    links = {r[0]: r[1:] for r in found}
    assert len(found) == len(rows)
    assert links[1] == (3, 1, True) and links[2] == (3, 1, False) and links[3] == (3, 1, False)
    assert links[10] == (1, 10, True) and links[12] == (1, 10, False)
    assert all(links[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 11)) and links[0] == (0, None, True)
    assert embeddings.near_vectors(table.limit(0)).collect() == []


def test_stages_keep_columns_and_take_odd_rows(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, "").columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, odd, "").count() <= len(ROWS)
        assert stage(spark, odd.limit(0), "").collect() == []
    left = [r["doc_id"] for r in minhash.survivors(odd.select(*corpus_pipeline.COLUMNS)).collect()]
    assert sorted(x for x in left if x is not None) == [1, 2, 3, 4, 7, 8, 10] and left.count(None) == 2


def test_rows_that_tie_are_spread_over_ranges(spark):
    rows = spark.range(4000, numPartitions=4).selectExpr("CAST(NULL AS LONG) AS doc_id", "'' AS text", "'en' AS lang", "'a' AS source")
    found = sharding.hilbert_shards(rows, shards=7)
    counts = sorted(r["count"] for r in found.groupBy("shard").count().collect())
    assert sum(counts) == 4000 and counts[-1] - counts[0] <= 1
    base = rows.selectExpr("doc_id", "16L AS size", "0L AS text_crc32", "source", "lang")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = sharding.curve_order(base, ["source", "lang"], ["size", "doc_id"], ["text_crc32", "doc_id"], 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ordered.groupBy(F.input_file_name()).count().collect()]
    assert "_salt" not in ordered.columns and len(sizes) > 1 and max(sizes) < 3000


def test_extra_columns_do_not_reach_the_result(odd):
    assert sharding.hilbert_shards(odd.withColumn("place", F.lit(1))).columns[:3] == ["doc_id", "size", "text_crc32"]


GERMAN = "der schnelle braune fuchs springt über den faulen hund"


@pytest.mark.parametrize("each", ["own", "one"])
def test_language_of_rows_without_id_is_learnt(spark, each):
    text = {"own": f"concat('{GERMAN} ', id)", "one": f"'{GERMAN}'"}[each]
    without = spark.range(60).selectExpr("CAST(NULL AS LONG) AS doc_id", f"{text} AS text", "'de' AS lang")
    others = spark.range(60).selectExpr("id AS doc_id", f"concat('{PROSE}', id) AS text", "'en' AS lang")
    for rows in (without.union(others), without, others.withColumn("doc_id", F.lit(7).cast("long"))):
        model = language.train(rows, per_language=5)
        assert model is not None and model.languages == sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    named = language.identify(without.union(others), per_language=5).where("doc_id IS NULL")
    assert {r["lang_pred"] for r in named.collect()} == {"de"}


def test_sample_is_full_whatever_the_ids(spark):
    rows = spark.range(500).selectExpr("IF(id < 400, 1L, NULL) AS doc_id", f"concat('{PROSE}', id % 90) AS text", "'en' AS lang")
    assert len(language._sample(rows, 20)) == 20
    assert len(language._sample(rows, 600)) == 500
    assert len(language._sample(rows.limit(0), 20)) == 0


def test_documents_pass_if_no_language_can_be_learnt(spark):
    rows = [(1, PROSE, None, "a", 3), (2, "words", None, "a", 3), (3, "12 ?", None, "a", 3), (4, None, None, "a", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = language.of_known_language(table)
    assert left.columns == table.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2]
