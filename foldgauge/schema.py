"""The labelled corpus: an id column, a text column and any number of 0/1 label columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldgauge.fixed_values import LABELS


@dataclass(frozen=True)
class CorpusSchema:
    """Names of the columns every operator works on."""

    labels: tuple[str, ...] = LABELS
    id: str = "id"
    text: str = "comment_text"

    @property
    def true_columns(self) -> list[str]:
        return [f"true_{label}" for label in self.labels]

    @property
    def pred_columns(self) -> list[str]:
        return [f"pred_{label}" for label in self.labels]

    @property
    def prob_columns(self) -> list[str]:
        return [f"prob_{label}" for label in self.labels]

    def struct_type(self) -> T.StructType:
        """Explicit read schema, so no file is scanned twice for inference."""
        fields = [T.StructField(self.id, T.StringType()), T.StructField(self.text, T.StringType())]
        return T.StructType(fields + [T.StructField(label, T.IntegerType()) for label in self.labels])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def require_corpus(df: DataFrame, schema: CorpusSchema) -> DataFrame:
    return require_columns(df, [schema.id, schema.text, *schema.labels])


def corpus_checks(df: DataFrame, schema: CorpusSchema) -> DataFrame:
    """One row of counts that must all be zero, except ``n_rows``.

    Ids are counted per id first, so the repeat count comes from one hash aggregate and not from a
    distinct set held in one task.
    """
    not_binary = sum(
        F.when(F.col(label).isin(0, 1), F.lit(0)).otherwise(F.lit(1)) for label in schema.labels
    )
    per_id = df.groupBy(schema.id).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(not_binary).alias("bad_labels"),
        F.sum(F.col(schema.text).isNull().cast("long")).alias("null_texts"),
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(schema.id).isNull(), F.col("n")).otherwise(F.lit(0))), F.lit(0)).alias("null_ids"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("long").alias("repeated_ids"),
        F.coalesce(F.sum("bad_labels"), F.lit(0)).alias("bad_labels"),
        F.coalesce(F.sum("null_texts"), F.lit(0)).alias("null_texts"),
    )


def unmatched_rows(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys appear on one side only: the shape check between truth and predictions."""
    joined = left.select(*keys, F.lit(True).alias("in_left")).join(
        right.select(*keys, F.lit(True).alias("in_right")), keys, "full_outer"
    )
    return joined.agg(
        F.count(F.when(F.col("in_left") & F.col("in_right"), 1)).alias("matched"),
        F.count(F.when(F.col("in_right").isNull(), 1)).alias("left_only"),
        F.count(F.when(F.col("in_left").isNull(), 1)).alias("right_only"),
    )
