"""Documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citylode.llm.common import stored, table
from citylode.llm.exact_dedup import drop_exact_duplicates
from citylode.llm.mixing import mix
from citylode.llm.near_dedup import drop_near_duplicates
from citylode.llm.packing import pack_documents
from citylode.llm.toxicity import drop_toxic

# Wanted shares of tokens by language.
LANGUAGE_WEIGHTS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    return drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_exact_duplicates(spark, docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(spark, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that languages have their shares; one with a rate below 1 may be dropped (see ``mixture``)."""
    return mix(spark, docs, table(spark, sf_dir, "labels"), LANGUAGE_WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of the permitted lengths."""
    return pack_documents(spark, docs)


STAGES = [
    ("toxicity", without_toxic), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
    ("mixing", mixed), ("packing", packed),
]
# Learned scores, MinHash and packing have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
