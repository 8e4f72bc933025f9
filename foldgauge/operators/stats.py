"""Label statistics of a corpus and of its folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldgauge.fixed_values import POS_WEIGHT_CLIP
from foldgauge.schema import CorpusSchema


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round to the nearest even integer, scale back."""
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def positive_counts(labels: Sequence[str]) -> list[Column]:
    return [F.sum(F.col(label).cast("long")).alias(label) for label in labels]


def label_rows(wide: DataFrame, labels: Sequence[str], keep: Sequence[str], value: str = "positives") -> DataFrame:
    """One row per label from a row of per-label values: applied to aggregates, never to the corpus."""
    pairs = F.array(*[F.struct(F.lit(label).alias("label"), F.col(label).alias(value)) for label in labels])
    return wide.select(*keep, F.inline(pairs))


def label_frequency(df: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Positives per label and their share of all rows, in one pass for all labels."""
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *positive_counts(schema.labels))
    share = round_half_even(F.col("positives") / F.col("n_rows"), 6)
    return label_rows(wide, schema.labels, ["n_rows"]).select(
        "label", F.coalesce("positives", F.lit(0)).alias("count"), share.alias("proportion")
    )


def label_distribution_compare(full: DataFrame, sample: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Label frequencies of a corpus and of its sample side by side."""
    whole = label_frequency(full, schema).select(
        "label", F.col("count").alias("full_count"), F.col("proportion").alias("full_proportion")
    )
    part = label_frequency(sample, schema).select(
        "label", F.col("count").alias("sub_count"), F.col("proportion").alias("sub_proportion")
    )
    return whole.join(part, "label")


def fold_label_distribution(test_rows: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Test rows and positives per label in each fold."""
    return test_rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        *[F.sum(F.col(label).cast("long")).alias(f"{label}_pos") for label in schema.labels],
    )


def fold_role_sizes(roles: DataFrame) -> DataFrame:
    """Train, validation and test sizes per fold."""
    return roles.groupBy("fold").agg(
        *[F.count(F.when(F.col("role") == role, 1)).alias(f"n_{role}") for role in ("train", "val", "test")]
    )


def pos_weights(train_rows: DataFrame, schema: CorpusSchema, clip: float = POS_WEIGHT_CLIP) -> DataFrame:
    """Negatives per positive for each fold and label, capped; a label without positives counts one."""
    wide = train_rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_train"), *positive_counts(schema.labels))
    weight = F.least(
        (F.col("n_train") - F.col("positives")) / F.greatest(F.col("positives"), F.lit(1)), F.lit(float(clip))
    )
    return label_rows(wide, schema.labels, ["fold", "n_train"]).select(
        "fold", "label", "n_train", "positives", weight.alias("pos_weight")
    )
