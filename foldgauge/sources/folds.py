"""Fold definitions: a table of (fold, id, role), and import of the positional JSON form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldgauge.operators.ranking import running_positions
from foldgauge.schema import CorpusSchema
from foldgauge.session import rebalanced

ROLES = ("train", "val", "test")


def write_fold_roles(roles: DataFrame, path: str) -> None:
    """Partitioned by fold, so one fold is read without the others."""
    rebalanced(roles, ["fold"]).write.partitionBy("fold").parquet(path)


def read_fold_roles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("fold", F.col("fold").cast("int"))


def with_row_positions(df: DataFrame, out: str = "row_position") -> DataFrame:
    """0-based row positions of a file read in order, without a sort over all rows.

    The row number inside each read partition is offset by the rows of the partitions before it. The
    generated number holds the partition in its upper bits, which makes it the cell. For one file, or
    files whose order does not matter.
    """
    numbered = df.withColumn("generated", F.monotonically_increasing_id()).withColumn(
        "read_partition", F.shiftright("generated", 33)
    )
    placed = running_positions(numbered, [], "read_partition", ["generated"])
    return placed.select(*df.columns, (F.col("position") - 1).alias(out))


def write_positional_folds(roles: DataFrame, corpus: DataFrame, schema: CorpusSchema, path: str) -> None:
    """Folds as one JSON object of position lists: the exchange form, as long as all folds together. Keep folds as a table
    (``write_fold_roles``) otherwise."""
    placed = roles.join(with_row_positions(corpus.select(schema.id)), schema.id)
    lists = [F.array_sort(F.collect_list(F.when(F.col("role") == role, F.col("row_position")))).alias(f"{role}_idx") for role in ROLES]
    folds = placed.groupBy("fold").agg(*lists)
    entries = F.collect_list(F.struct(F.col("fold").cast("string"), F.struct(*(f"{role}_idx" for role in ROLES))))
    folds.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)


def read_positional_folds(spark: SparkSession, path: str) -> DataFrame:
    """``(fold, role, row_position)`` from a JSON object of folds with train, val and test position lists."""
    positions = T.ArrayType(T.LongType())
    parts = T.StructType([T.StructField(f"{role}_idx", positions) for role in ROLES])
    text = spark.read.text(path, wholetext=True)
    folds = text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), parts))).alias("fold", "parts"))
    roles = F.array(
        *[F.struct(F.lit(role).alias("role"), F.col(f"parts.{role}_idx").alias("rows")) for role in ROLES]
    )
    return folds.select(F.col("fold").cast("int").alias("fold"), F.inline(roles)).select(
        "fold", "role", F.explode("rows").alias("row_position")
    )


def positional_to_roles(positions: DataFrame, corpus: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Positions become ids, because Spark rows have no order of their own."""
    ids = with_row_positions(corpus.select(schema.id))
    return positions.join(ids, "row_position").select("fold", schema.id, "role")
