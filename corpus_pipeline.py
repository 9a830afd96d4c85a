"""From raw documents to packed sequences: five stages, each over all documents that the one before kept.

Every stage but the last returns the columns of documents; other columns, whatever their names, are left out. Null, empty and
blank texts have too few words and go in the first stage, very long texts pass whole, rows with one id and one text are copies
of each other, a null source or language is a value like others, and an empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from cartwheel.llm.shipping import ship
from cartwheel.llm.tables import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_SHINGLE = 5
# Bytes of a repeated passage: below those of fifty words (about 330 in European languages), above those of a sentence.
PASSAGE_BYTES = 256


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a text without words fails them."""
    return quality_rules.keep_good(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (of rows with one id, the first text)."""
    return simhash.keep_first(docs, NEAR_SHINGLE).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages of ``PASSAGE_BYTES`` and more; a text of which nothing is left goes."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES).filter("text <> ''").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as it is taken whole, and once more in part if the budget of its source ends in it. Rows
    without an id are ordered by their text; a document that is taken no word of is not there."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, each with its place in a sequence; rows alike are packed as often as they come."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("mixed", mixed), ("packed", packed)]

# Fingerprints, sketches and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
