"""Batch scoring of message lists through a function the user supplies, and run progress."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldgauge.fixed_values import PROGRESS_EVERY
from foldgauge.functions.labels import seeded_hash
from foldgauge.operators.parsing import exact_seconds, parse_replies
from foldgauge.operators.ranking import refined_cells, running_positions
from foldgauge.schema import CorpusSchema

Messages = Sequence[dict]
Scorer = Callable[[Messages], str]


def score_replies(
    df: DataFrame,
    scorer_factory: Callable[[], Scorer],
    messages: str = "messages",
    partitions: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Adds ``raw_response``, ``call_error`` and ``latency_seconds``, one call per row.

    ``scorer_factory`` runs once per task (open a client or load a model there) and returns a function from
    a message list to a reply. A call that raises keeps its row: the reply holds the error and the latency
    is 0. Calls are marked nondeterministic, so no plan rewrite repeats or moves them; write the result
    before using it twice. Give ``partitions`` when rows are few and calls slow, and ``concurrency`` to have that many calls of a
    task under way at a time, in which case the scorer must be safe to call from several threads; replies keep the order of their rows.
    """

    @F.pandas_udf("struct<raw_response string, call_error boolean, latency_seconds double>")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()

        def one(message_list) -> tuple[str, bool, float]:
            started = time.perf_counter()
            try:
                return scorer([dict(m) for m in message_list]), False, time.perf_counter() - started
            except Exception as problem:  # noqa: BLE001 - any failed call must keep its row
                return f"<<error: {problem!r}>>", True, 0.0

        with ThreadPool(max(1, concurrency)) as pool:
            for batch in batches:
                replies = pool.imap(one, batch) if concurrency > 1 else map(one, batch)
                yield pd.DataFrame(list(replies), columns=["raw_response", "call_error", "latency_seconds"])

    if partitions is not None:
        df = df.repartition(partitions)
    kept = [name for name in df.columns if name != messages]
    return df.withColumn("_scoring_reply", call.asNondeterministic()(F.col(messages))).select(*kept, "_scoring_reply.*")


def score_with_ledger(
    df: DataFrame,
    key: Sequence[str],
    scorer_factory: Callable[[], Scorer],
    ledger: str,
    rounds: int = 8,
    messages: str = "messages",
    partitions: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """The rows of ``df`` with their replies, each asked once however often the run is broken off and started again.

    Replies are kept in ``ledger``, a folder all executors share, under the columns of ``key``, which name a row. Rows are dealt by a hash
    of their key to ``rounds``; a round asks what the ledger does not hold yet and appends its replies in one commit. A run that dies
    loses the calls of its round only; the next one finds the others and asks what is missing. A reply that is an error
    (``call_error``) is a reply; to ask it again, leave it out of the ledger.
    """
    spark = df.sparkSession
    columns = [*key, "raw_response", "call_error", "latency_seconds"]
    fields = [df.schema[name].simpleString().replace(":", " ", 1) for name in key]
    schema = ", ".join([*(f"`{f.split()[0]}` {f.split(' ', 1)[1]}" for f in fields), "raw_response string, call_error boolean, latency_seconds double"])
    # An empty commit first, so that the folder exists and can be read.
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    number = F.pmod(seeded_hash("round", F.concat_ws("|", *(F.col(name).cast("string") for name in key))), F.lit(rounds))
    for turn in range(rounds):
        held = spark.read.schema(schema).parquet(ledger).select(*key)
        missing = df.where(number == turn).select(*key, messages).join(held, list(key), "left_anti")
        score_replies(missing, scorer_factory, messages, partitions, concurrency).select(columns).write.mode("append").parquet(ledger)
    return df.drop(messages).join(spark.read.schema(schema).parquet(ledger), list(key))


def chat_predictions(scored: DataFrame, schema: CorpusSchema, keep: Sequence[str]) -> DataFrame:
    """Prediction rows of a prompted run: id, raw reply, true and predicted labels, parse outcome.

    A failed call is zeros and a parse failure, whatever its error text contains.
    """
    parsed = parse_replies(scored, "raw_response", schema.labels)
    preds = [F.when(F.col("call_error"), 0).otherwise(F.col(name)).alias(name) for name in schema.pred_columns]
    return parsed.select(
        *keep,
        schema.id,
        "raw_response",
        *[F.col(label).cast("int").alias(f"true_{label}") for label in schema.labels],
        *preds,
        F.when(F.col("call_error"), "none").otherwise(F.col("parse_stage")).alias("parse_stage"),
        (F.col("parse_failure") | F.col("call_error")).alias("parse_failure"),
        "latency_seconds",
    )


def inference_progress(
    predictions: DataFrame, schema: CorpusSchema, by: Sequence[str], every: int = PROGRESS_EVERY
) -> DataFrame:
    """Calls done, failures so far, rate and remaining time at every ``every``-th call and the last.

    Calls are numbered in hash order of their ids. Running totals come from per-cell sums, so no run or
    fold is scanned by one task.
    """
    calls = predictions.select(
        *by,
        schema.id,
        seeded_hash("call", schema.id).alias("h"),
        F.col("parse_failure").cast("long").alias("failed"),
        exact_seconds("latency_seconds").alias("seconds"),
    )
    sums = {"failures": F.col("failed"), "elapsed": F.col("seconds")}
    calls, cells = refined_cells(calls, by, "h", sums)
    totals = running_positions(calls, by, "cell", ["h", schema.id], sums, cells=cells)
    shown = totals.where((F.col("position") % every == 0) | (F.col("position") == F.col("group_rows")))
    return progress_rates(shown.select(*by, F.col("position").alias("done"), F.col("group_rows").alias("n"), "failures", "elapsed"), by)


def progress_rates(shown: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rate and remaining seconds of (done, n, failures, elapsed) rows."""
    rate = F.col("done") / F.greatest(F.col("elapsed").cast("double"), F.lit(1e-6))
    return shown.withColumn("rate", rate).select(
        *by,
        "done",
        "n",
        "failures",
        F.col("elapsed").cast("double").alias("elapsed_seconds"),
        "rate",
        ((F.col("n") - F.col("done")) / F.greatest("rate", F.lit(1e-6))).alias("eta_seconds"),
    )
