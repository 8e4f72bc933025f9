"""The corpus pipeline: five stages over ``documents``, each a Spark job whose Parquet output the next one reads.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents. Null ids and null texts pass like other rows; an empty table stays empty; extra columns are kept up to packing.
The stages exchange whole texts with Python, so they lower the session's rows per Arrow batch (``common.BATCH_ROWS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldgauge.llm.common import short_batches
from foldgauge.llm.decontaminate import clean_documents
from foldgauge.llm.near_dups import without_near_duplicates
from foldgauge.llm.packing import pack_documents
from foldgauge.llm.pii import mask_personal_data
from foldgauge.llm.quality import good_documents
from foldgauge.llm.registry import table
from foldgauge.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects (poor or toxic text)."""
    short_batches(spark)
    return good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    short_batches(spark)
    return without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which a twentieth or more is benchmark text."""
    short_batches(spark)
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows."""
    short_batches(spark)
    return mask_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens."""
    short_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_private),
    ("packing", pack),
]

#: Trained scorers, signatures and byte-pair encoding have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
