"""The labelled corpus as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.schema import CorpusSchema, require_corpus

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def read_corpus_csv(spark: SparkSession, path: str, schema: CorpusSchema = CorpusSchema()) -> DataFrame:
    """Labelled CSV with quoted multi-line texts.

    The header decides which column is which, so column order does not matter; everything is read as
    text and the labels are cast. Texts such as ``NA`` or ``null`` stay what they are. Quoted line breaks
    make a file unsplittable: give many files, or convert once to Parquet.
    """
    raw = spark.read.options(**CSV_OPTIONS, inferSchema=False, nullValue="\u0000", emptyValue="").csv(path)
    require_corpus(raw, schema)
    return raw.withColumns({label: F.col(label).cast("int") for label in schema.labels})


def read_corpus(spark: SparkSession, path: str, schema: CorpusSchema = CorpusSchema()) -> DataFrame:
    """Labelled Parquet: columns are pruned and filters pushed into the scan."""
    return require_corpus(spark.read.parquet(path), schema)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that keeps texts as they are, blanks at their ends included."""
    df.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_split_csv(df: DataFrame, path: str, split: str, split_column: str = "split") -> None:
    """One split of a dataset as CSV."""
    write_csv(df.where(F.col(split_column) == split).drop(split_column), path)


def head(df: DataFrame, n: int = 10) -> DataFrame:
    """A look at the first rows."""
    return df.limit(n)
