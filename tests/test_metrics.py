import random

import pytest
from pyspark.sql import functions as F

from foldgauge.operators import metrics as M


def predictions(spark, schema, rows):
    fields = ", ".join(f"true_{x} int, pred_{x} int" for x in schema.labels)
    return spark.createDataFrame(rows, f"model string, mode string, think string, fold int, {fields}")


def brute(rows, n_labels):
    """tp, predicted and actual positives of each label, counted row by row."""
    counts = [[0, 0, 0] for _ in range(n_labels)]
    for row in rows:
        for i in range(n_labels):
            true, pred = row[4 + 2 * i], row[5 + 2 * i]
            counts[i][0] += true & pred
            counts[i][1] += pred
            counts[i][2] += true
    quotient = lambda x, y: x / y if y else 0.0
    scores = [(quotient(tp, pp), quotient(tp, ap), quotient(2 * tp, pp + ap), ap) for tp, pp, ap in counts]
    pooled = [sum(c[j] for c in counts) for j in range(3)]
    return scores, sum(s[2] for s in scores) / n_labels, quotient(2 * pooled[0], pooled[1] + pooled[2])


def test_metrics_equal_brute_force(spark, schema):
    rng = random.Random(3)
    rows = [("m", "finetune", "nothink", f, *[rng.randint(0, 1) for _ in range(6)]) for f in range(3) for _ in range(50)]
    for r in M.fold_metrics(predictions(spark, schema, rows), schema).collect():
        scores, macro, micro = brute([x for x in rows if x[3] == r["fold"]], 3)
        assert [(x["precision"], x["recall"], x["f1"], x["support"]) for x in r["per_label"]] == scores
        assert [x["label"] for x in r["per_label"]] == list(schema.labels)
        assert r["macro_f1"] == macro and r["micro_f1"] == micro


def test_degenerate_labels(spark, schema):
    # a: no positives, no predictions; b: positives, no predictions; c: all correct
    rows = [("m", "x", "nothink", 0, 0, 0, 1, 0, 1, 1), ("m", "x", "nothink", 0, 0, 0, 0, 0, 0, 0)]
    row = M.fold_metrics(predictions(spark, schema, rows), schema).first()
    assert [tuple(x) for x in row["per_label"]] == [("a", 0.0, 0.0, 0.0, 0), ("b", 0.0, 0.0, 0.0, 1), ("c", 1.0, 1.0, 1.0, 1)]
    assert row["macro_f1"] == pytest.approx(1 / 3) and row["micro_f1"] == pytest.approx(2 / 3)


def test_mean_and_population_deviation(spark, schema):
    label = lambda name, f1: (name, f1, f1, f1, 3)
    rows = [
        ("m", "x", "nothink", fold, [label(n, f1) for n in schema.labels], f1, f1)
        for fold, f1 in ((10, 0.4), (2, 0.2))
    ]
    metrics = spark.createDataFrame(
        rows,
        "model string, mode string, think string, fold int, per_label array<struct<label:string,precision:double,recall:double,f1:double,support:bigint>>, macro_f1 double, micro_f1 double",
    )
    aggregated = M.aggregate_folds(metrics, schema)
    row = aggregated.first()
    assert row["macro_f1_mean"] == pytest.approx(0.3) and row["macro_f1_std"] == pytest.approx(0.1)
    assert row["per_fold_macro_f1"] == [0.2, 0.4]  # fold 2 before fold 10
    table = M.comparison_table(aggregated, schema)
    assert M.comparison_display(table, schema).first()["a_F1"] == "0.3000 ± 0.1000"
    assert M.run_summary(aggregated, k=5).count() == 0 and M.run_summary(aggregated, k=2).count() == 1
    assert M.run_summary(aggregated, k=2, limited=True).count() == 0
    long = {r["label"]: r["f1_std"] for r in M.fold_mean_std(aggregated, schema).collect()}
    assert long["c"] == pytest.approx(0.1)
    results = M.per_fold_results(metrics).where("fold = 2").collect()
    assert [r["label"] for r in results] == ["a", "b", "c", "MACRO_F1", "MICRO_F1"]
    assert results[3]["precision"] is None and results[3]["f1"] == 0.2


def test_best_run_ties_and_missing_modes(spark):
    table = spark.createDataFrame(
        [("m2", "finetune", 0.5), ("m1", "finetune", 0.5), ("m3", "zero_shot", 0.1)], "model string, mode string, s double"
    )
    best = {r["mode"]: r["best"] for r in M.best_run_per_mode(table, "s").collect()}
    assert best == {"finetune": "0.5000 (m1)", "zero_shot": "0.1000 (m3)", "few_shot": "n/a"}


def test_best_epoch_prefers_the_earliest(spark):
    rows = [("m", 0, e, s, float(e)) for e, s in ((1, 0.1), (2, 0.7), (3, 0.7), (4, 0.2))] + [("m", 1, 1, 0.0, 1.0)]
    history = spark.createDataFrame(rows, "model string, fold int, epoch int, val_macro_f1 double, train_loss double")
    best = {r["fold"]: (r["best_epoch"], r["best_val_macro_f1"], r["train_loss"], r["epochs_run"]) for r in M.best_epoch(history).collect()}
    assert best == {0: (2, 0.7, 2.0, 4), 1: (1, 0.0, 1.0, 1)}
    table = M.best_epoch_table(M.best_epoch(history).withColumns({"max_len": F.lit(256), "train_time_seconds": F.lit(1.25)}))
    assert {(r["max_len"], r["train_time_sec"]) for r in table.collect()} == {("256", 1.2)}


def test_threshold_is_inclusive(spark, schema):
    scored = spark.createDataFrame([(0.5, 0.49, 1.0)], "prob_a double, prob_b double, prob_c double")
    row = M.threshold_predictions(scored, schema).first()
    assert (row["pred_a"], row["pred_b"], row["pred_c"]) == (1, 0, 1)
