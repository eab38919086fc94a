"""From documents to packed sequences: language, exact copies, near copies, mixture, packing.

Every stage works on all rows that the one before it kept, and its decisions take effect. All but the last return the
columns of documents. A stage's table may have more columns, of any name, and be empty; then its result is empty. Rows that repeat in full are
rows of their own until exact dedup, which keeps one of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import exact, language, mixing, nearcopies, packing
from starloom.operators.durable import durable, intermediates

TOKENIZER = "word_bpe_49k.json"
NEAR_WIDTH, NEAR_PERCENT = 5, 80  # the stage's own; the query op8_near_copies has 3 and 85


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and is near a centroid of some language; the model learns from rows with a language.

    A null or empty text goes. Null ids, languages and sources do not matter. Without any labelled text all texts with a letter stay.
    """
    return language.accepted(docs, language.fit(docs, language.fold() != 1))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays; one with an id before one without. A null text equals an empty one."""
    return exact.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, at a similarity of NEAR_PERCENT / 100 over shingles of NEAR_WIDTH words, the document with the smallest id stays.

    Documents without words and documents without an id all stay. Rows with one id and different texts are judged each by its text.
    """
    return nearcopies.without_near_copies(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for; a null source is a source, null and empty texts have size 0 and follow their source's rate."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences; a null or empty text is one piece of the end token. Repeats are packed each."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language id", language_id), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mix", mix), ("pack", pack)]

#: SQL cannot express the language model, the sketches or the packing; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each stage's result but the last is written to the shared folder and read again.

    What a stage wrote on the way is deleted when its result is stored.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with intermediates(spark):
            docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
