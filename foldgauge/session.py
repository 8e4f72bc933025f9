"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foldgauge")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="foldgauge-")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder, because there driver
    and executors are one machine. A cluster without the setting is an error, not a guess.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/foldgauge/{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, executor loss costs nothing."""
    spark = df.sparkSession
    target = path or scratch_dir(spark)
    rebalanced(df, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(target)
    return spark.read.schema(df.schema).parquet(target).select(*(f"`{name}`" for name in df.columns))


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` dealt out by the columns it is about to be partitioned by, large partitions split by Spark, so
    that a write leaves few files for each folder instead of one from every task."""
    return df.hint("rebalance", *(F.col(name) for name in columns)) if columns else df
