"""Streams that hold state: counts behind metrics, and the progress of runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foldgauge.fixed_values import PROGRESS_EVERY
from foldgauge.operators.metrics import RUN, metrics_of_counts, prediction_counts
from foldgauge.operators.parsing import exact_seconds
from foldgauge.operators.scoring import progress_rates
from foldgauge.schema import CorpusSchema


def _updates(stream: DataFrame, path: str, checkpoint: str, mode: str) -> StreamingQuery:
    """Writes what each batch brings to a folder of its own below ``path``. A batch that is run again after a failure
    replaces its folder, so every update counts once."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/update={number}")

    started = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", checkpoint)
    return started.trigger(availableNow=True).start()


def count_stream(
    predictions: DataFrame, schema: CorpusSchema, path: str, checkpoint: str, by: Sequence[str] = (*RUN, "fold")
) -> StreamingQuery:
    """Keeps the counts behind all metrics up to date as prediction files arrive.

    The state is one row of sums per run and fold; a batch writes the rows it changed and nothing else. Both paths belong in
    shared storage. A prediction that arrives twice counts twice.
    """
    return _updates(prediction_counts(predictions, schema, by), path, checkpoint, "update")


def streamed_metrics(spark: SparkSession, schema: CorpusSchema, path: str, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """``fold_metrics`` as of the latest update of every run and fold."""
    updates = spark.read.parquet(path)
    counts = [name for name in updates.columns if name not in (*by, "update")]
    latest = updates.groupBy(*by).agg(F.max_by(F.struct(*counts), "update").alias("latest"))
    return metrics_of_counts(latest.select(*by, "latest.*"), schema, by)


def progress_stream(
    calls: DataFrame, path: str, checkpoint: str, by: Sequence[str], order: Sequence[str], every: int = PROGRESS_EVERY
) -> StreamingQuery:
    """Progress of runs as their calls arrive: a row at every ``every``-th call and at the last one.

    ``calls`` has ``parse_failure``, ``latency_seconds`` and ``n``, the number of calls its run will make. The state of a run is three
    numbers: calls done, failures and seconds. Calls that arrive together are taken in the order of ``order``.
    """
    kinds = {f.name: f.dataType.simpleString() for f in calls.schema.fields}
    head = ", ".join(f"`{name}` {kinds[name]}" for name in by)

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, failures, seconds = state.get if state.exists else (0, 0, Decimal(0))
        arrived = pd.concat(list(parts)).sort_values(list(order), kind="stable")
        shown = []
        for failed, taken, n in zip(arrived["failed"], arrived["seconds"], arrived["n"], strict=True):
            done, failures, seconds = done + 1, failures + int(failed), seconds + taken
            if done % every == 0 or done == n:
                shown.append((*key, done, int(n), failures, seconds))
        state.update((done, failures, seconds))
        yield pd.DataFrame(shown, columns=[*by, "done", "n", "failures", "elapsed"])

    narrow = calls.select(
        *by, *order, F.col("parse_failure").cast("long").alias("failed"), exact_seconds("latency_seconds").alias("seconds"), F.col("n").cast("long").alias("n")
    )
    followed = narrow.groupBy(*by).applyInPandasWithState(
        follow,
        f"{head}, done long, n long, failures long, elapsed decimal(28,6)",
        "done long, failures long, seconds decimal(28,6)",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return _updates(progress_rates(followed, by), path, checkpoint, "append")
