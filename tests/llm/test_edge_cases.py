"""Every operator and stage on awkward tables: empty, all null, clashing column names, repeated rows."""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus  # noqa: E402

import corpus_pipeline  # noqa: E402
from starloom.llm import exact, fim, language, licenses, lm, mixing, nearcopies, packing, quality, search, shards, simhash, spelling  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def labels(docs):
    return docs.select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN 0 WHEN doc_id % 3 = 1 THEN 1 END").alias("quality"))


OPERATORS = {
    "mix": lambda d: mixing.mixture(d), "pack": lambda d: packing.pack(d, TOKENIZER), "language": lambda d: language.identify(d, language.fit(d, language.fold() != 1)),
    "licenses": lambda d: licenses.scan(d), "exact": lambda d: exact.resolve(d), "shards": lambda d: shards.byte_shards(d),
    "quality": lambda d: quality.classify(d, labels(d), F.col("source"), F.col("lang"), F.lit(True)), "near": lambda d: nearcopies.near_copies(d),
    "lm": lambda d: lm.score(d, language.fold(folds=10) != 0), "fim": lambda d: fim.fill_in_middle(d), "simhash": lambda d: simhash.near_copies(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document_with_clashing_columns(spark, name):
    data = corpus.rows()
    found = OPERATORS[name](corpus.documents(spark, extra=True)).collect()
    if name == "pack":
        found = [r for r in found if r["piece"] == 0]
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in data)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](corpus.documents(spark, data=[])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_all_columns_null(spark, name):
    found = OPERATORS[name](corpus.documents(spark, data=[(None,) * 5] * 7)).collect()
    assert len(found) == 7 and all(r["doc_id"] is None for r in found)


@pytest.mark.parametrize("name", OPERATORS)
def test_texts_of_several_megabytes(spark, name):
    """Beside null, empty and repeated rows."""
    long = "some words of a very long text, number 17. " * 80_000
    texts = [long, None, "", long, "short text", long + "x", "é" * 1_000_000]
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(0, long, "en", "s", 0)]
    found = OPERATORS[name](corpus.documents(spark, data=data)).collect()
    if name == "pack":
        found = [r for r in found if r["piece"] == 0]
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in data)


def test_words_of_very_long_texts(spark):
    long = "variant spelling " * 100_000 + "a" * 200_000
    found = spelling.document_variants(corpus.documents(spark, data=[(1, long, None, None, 0), (2, long, None, None, 0)])).collect()
    assert {len(r["word"]) for r in found} >= {7, 8} and max(len(r["word"]) for r in found) in (8, 199_999, 200_000)


def test_mix_and_pack_of_repeated_ids(spark):
    data = [(i % 5, f"text number {i} " * (i + 1), "en", f"s{i % 3}", 0) for i in range(40)]
    mixed = mixing.mix(corpus.documents(spark, data=data + data[:7]))
    copies = sorted(r["text"] for r in mixed.collect())
    packed = packing.pack(mixed, TOKENIZER).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(copies)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed)
    for (a, x, n), (b, y, _) in zip(places, places[1:]):
        assert y == x + n if a == b else y == 0


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_keep_columns_and_survive_empty_tables(spark, stage):
    name, function = stage
    docs = corpus.documents(spark, extra=True)
    out = function(spark, docs, "")
    if name != "pack":
        assert out.columns == docs.columns
    assert out.count() > 0
    assert function(spark, corpus.documents(spark, data=[]), "").count() == 0
    function(spark, corpus.documents(spark, data=[(None,) * 5] * 3), "").count()


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (50, [1.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [2.0, 2.0]), (0, [1.0, 2.0]), (6, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search.top_k(df, F.col("vec_id") % 50 == 0).collect())
    s = 256 * 256
    for_zero = [(0, 1, 5, 6 * s), (0, 2, 0, 5 * s), (0, 3, 50, s), (0, 4, 6, 0)]
    assert got == sorted(for_zero * 2 + [(50, 1, 5, 2 * s), (50, 2, 0, s), (50, 3, 0, s), (50, 4, 6, 0)])
    assert search.top_k(df.where("vec_id > 100"), F.lit(True)).collect() == []


def test_search_with_clashing_columns(spark):
    data = [(i, [float(i % 7), float(i % 3) - 1]) for i in range(120)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    plain = sorted(map(tuple, search.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    for name in ("tag", "id", "ids", "tags", "cells", "q_ids", "q_tags", "q_cells", "query_id", "rank", "score", "shard", "block", "beyond"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(map(tuple, search.top_k(df, F.col("vec_id") % 50 == 0).collect())) == plain
