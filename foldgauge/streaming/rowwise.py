"""The batch operators applied to an unbounded table; the expressions are the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from foldgauge.operators.cleaning import clean_corpus
from foldgauge.operators.parsing import parse_replies
from foldgauge.operators.prompts import zero_shot_messages
from foldgauge.schema import CorpusSchema


def clean_stream(stream: DataFrame, schema: CorpusSchema, out: str = "cleaned") -> DataFrame:
    return clean_corpus(stream, schema.text, out)


def prompt_stream(stream: DataFrame, schema: CorpusSchema) -> DataFrame:
    return zero_shot_messages(stream, schema)


def parse_stream(stream: DataFrame, schema: CorpusSchema, raw: str = "raw_response") -> DataFrame:
    return parse_replies(stream, raw, schema.labels)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until the available input is used up; both paths belong in shared storage."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
