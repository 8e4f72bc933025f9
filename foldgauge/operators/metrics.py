"""Per-label, macro and micro metrics per run and fold, and their spread over folds.

All labels of all runs and folds come out of one aggregation: three conditional sums per label, combined
on the map side. Everything after it works on one row per run and fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldgauge import fixed_values as V
from foldgauge.functions.scores import mean_pm_std, over_threshold, ratio
from foldgauge.schema import CorpusSchema

RUN = ("model", "mode", "think")


def threshold_predictions(scored: DataFrame, schema: CorpusSchema, threshold: float = V.DECISION_THRESHOLD) -> DataFrame:
    """Adds ``pred_<label>`` from ``prob_<label>``; one threshold for all labels."""
    return scored.withColumns(
        {pred: over_threshold(F.col(prob), threshold) for pred, prob in zip(schema.pred_columns, schema.prob_columns)}
    )


def join_predictions(truth: DataFrame, predictions: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Truth and predictions by (fold, id): an equi join, both sides shuffled on the same keys."""
    true = truth.select(
        "fold", schema.id, *[F.col(label).cast("int").alias(f"true_{label}") for label in schema.labels]
    )
    return predictions.join(true, ["fold", schema.id])


def prediction_counts(predictions: DataFrame, schema: CorpusSchema, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """Rows, hits, predicted and actual positives per run, fold and label: all that metrics need, in one aggregate that also
    runs on a stream."""
    sums = []
    for label in schema.labels:
        true, pred = F.col(f"true_{label}").cast("long"), F.col(f"pred_{label}").cast("long")
        sums += [
            F.sum(true * pred).alias(f"tp_{label}"),
            F.sum(pred).alias(f"pp_{label}"),
            F.sum(true).alias(f"ap_{label}"),
        ]
    return predictions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def fold_metrics(predictions: DataFrame, schema: CorpusSchema, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """One row per run and fold: ``per_label`` structs in label order, ``macro_f1``, ``micro_f1``, ``n_rows``."""
    return metrics_of_counts(prediction_counts(predictions, schema, by), schema, by)


def metrics_of_counts(counts: DataFrame, schema: CorpusSchema, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """``fold_metrics`` from ``prediction_counts``."""

    def f1(tp: Column, predicted: Column, actual: Column) -> Column:
        return ratio(2 * tp, predicted + actual)

    def of(kind: str, label: str) -> Column:
        return F.col(f"{kind}_{label}")

    per_label = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                ratio(of("tp", label), of("pp", label)).alias("precision"),
                ratio(of("tp", label), of("ap", label)).alias("recall"),
                f1(of("tp", label), of("pp", label), of("ap", label)).alias("f1"),
                of("ap", label).alias("support"),
            )
            for label in schema.labels
        ]
    )
    pooled = [reduce(add, [of(kind, label) for label in schema.labels]) for kind in ("tp", "pp", "ap")]
    macro = reduce(add, [F.col("per_label")[i]["f1"] for i in range(len(schema.labels))]) / len(schema.labels)
    return counts.select(*by, "n_rows", per_label.alias("per_label"), f1(*pooled).alias("micro_f1")).select(
        *by, "n_rows", "per_label", macro.alias("macro_f1"), "micro_f1"
    )


def per_label_metrics(metrics: DataFrame, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """Long form: one row per run, fold and label."""
    return metrics.select(*by, F.inline("per_label"))


def per_fold_results(metrics: DataFrame, by: Sequence[str] = (*RUN, "fold")) -> DataFrame:
    """The results table: label rows followed by a macro and a micro row, which have no P, R or support."""

    def overall(name: str, value: str) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            F.lit(None).cast("double").alias("precision"),
            F.lit(None).cast("double").alias("recall"),
            F.col(value).alias("f1"),
            F.lit(None).cast("long").alias("support"),
        )

    rows = F.concat("per_label", F.array(overall(V.MACRO_ROW, "macro_f1"), overall(V.MICRO_ROW, "micro_f1")))
    return metrics.select(*by, F.inline(rows)).select(
        *by, "label", *[F.bround(name, 4).alias(name) for name in ("precision", "recall", "f1")], "support"
    )


def aggregate_folds(metrics: DataFrame, schema: CorpusSchema, run: Sequence[str] = RUN) -> DataFrame:
    """One row per run: mean and population deviation of every metric, and the values in fold order."""

    def spread(value: Column, name: str) -> list[Column]:
        return [F.avg(value).alias(f"{name}_mean"), F.stddev_pop(value).alias(f"{name}_std")]

    def in_fold_order(name: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct("fold", F.col(name).alias("value"))))
        return F.transform(pairs, lambda pair: pair["value"]).alias(f"per_fold_{name}")

    columns = [F.count_distinct("fold").alias("n_folds")]
    for name in ("macro_f1", "micro_f1"):
        columns += [*spread(F.col(name), name), in_fold_order(name)]
    for i, label in enumerate(schema.labels):
        for metric in ("precision", "recall", "f1", "support"):
            columns += spread(F.col("per_label")[i][metric], f"{label}_{metric}")
    return metrics.groupBy(*run).agg(*columns)


def fold_mean_std(aggregated: DataFrame, schema: CorpusSchema, run: Sequence[str] = RUN) -> DataFrame:
    """Long form of ``aggregate_folds``: one row per run and label."""
    names = [f"{metric}_{stat}" for metric in ("precision", "recall", "f1", "support") for stat in ("mean", "std")]
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("label"), *[F.col(f"{label}_{name}").alias(name) for name in names])
            for label in schema.labels
        ]
    )
    return aggregated.select(*run, F.inline(rows))


def comparison_table(aggregated: DataFrame, schema: CorpusSchema, run: Sequence[str] = RUN) -> DataFrame:
    """One row per run: folds, macro, micro and every label's F1 as mean and deviation, 4 places."""
    names = ["macro_f1", "micro_f1", *[f"{label}_f1" for label in schema.labels]]
    return aggregated.select(
        *run,
        "n_folds",
        *[F.bround(f"{name}_{stat}", 4).alias(f"{name}_{stat}") for name in names for stat in ("mean", "std")],
    )


def comparison_display(table: DataFrame, schema: CorpusSchema, run: Sequence[str] = RUN) -> DataFrame:
    """The comparison table with ``mean ± std`` cells."""
    cells = [("macro_F1", "macro_f1"), ("micro_F1", "micro_f1"), *[(f"{label}_F1", f"{label}_f1") for label in schema.labels]]
    return table.select(*run, *[mean_pm_std(F.col(f"{name}_mean"), F.col(f"{name}_std")).alias(out) for out, name in cells])


def run_summary(aggregated: DataFrame, k: int, limited: bool = False) -> DataFrame:
    """Runs with all ``k`` folds of their split; a run with missing folds, or with a row limit, has no summary."""
    return aggregated.where((F.col("n_folds") == k) & F.lit(not limited))


def best_run_per_mode(table: DataFrame, metric: str, modes: Sequence[str] = V.MODES) -> DataFrame:
    """The top run of each mode as ``0.1234 (model)``; ``n/a`` for a mode without runs.

    Ties go to the smaller model name. The list of modes is a literal, so every mode yields a row even
    if the table lacks it.
    """
    ranked = F.struct((-F.col(metric)).alias("negated"), F.col("model").alias("model"))
    keep = [F.min(F.when(F.col("mode") == mode, ranked)).alias(mode) for mode in modes]
    best = table.agg(*keep)
    rows = F.array(*[F.struct(F.lit(mode).alias("mode"), F.col(mode).alias("top")) for mode in modes])
    return best.select(F.inline(rows)).select(
        "mode",
        F.lit(metric).alias("metric"),
        F.when(F.col("top").isNull(), "n/a")
        .otherwise(F.format_string("%.4f (%s)", -F.col("top.negated"), F.col("top.model")))
        .alias("best"),
    )


def label_lookup(table: DataFrame, schema: CorpusSchema, mode: str, labels: Sequence[str]) -> DataFrame:
    """Mean F1 of chosen labels for the runs of one mode."""
    return table.where(F.col("mode") == mode).select("model", "think", *[f"{label}_f1_mean" for label in labels])


def best_epoch(history: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """The epoch with the highest validation macro-F1; the earliest one on ties.

    One row per run and fold from a map-side combined maximum; ``-epoch`` makes earlier epochs win.
    """
    others = [name for name in history.columns if name not in (*by, "epoch", "val_macro_f1")]
    top = F.max(F.struct("val_macro_f1", (-F.col("epoch")).alias("neg_epoch"), *others)).alias("top")
    return history.groupBy(*by).agg(F.count(F.lit(1)).alias("epochs_run"), top).select(
        *by,
        "epochs_run",
        (-F.col("top.neg_epoch")).alias("best_epoch"),
        F.col("top.val_macro_f1").alias("best_val_macro_f1"),
        *[F.col(f"top.{name}") for name in others],
    )


def best_epoch_table(best: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """Best epochs for the report; a run without the optional facts shows defaults."""
    seconds = F.col("train_time_seconds") if "train_time_seconds" in best.columns else F.lit(0.0)
    length = F.col("max_len").cast("string") if "max_len" in best.columns else F.lit(None).cast("string")
    return best.select(
        *by,
        "best_epoch",
        F.bround(F.coalesce("best_val_macro_f1", F.lit(0.0)), 4).alias("best_val_macro_f1"),
        F.bround(F.coalesce(seconds, F.lit(0.0)), 1).alias("train_time_sec"),
        F.coalesce(length, F.lit("")).alias("max_len"),
    )


def epoch_loss(steps: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """Mean loss per epoch from a step log."""
    return steps.groupBy(*by, "epoch").agg(F.count(F.lit(1)).alias("n_steps"), F.avg("loss").alias("train_loss"))


def first_path(df: DataFrame, path: str, value: str, by: Sequence[str]) -> DataFrame:
    """The value of the lexicographically first path per group."""
    return df.groupBy(*by).agg(F.min_by(value, path).alias(value), F.min(path).alias(path))
