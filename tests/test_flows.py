from collections import Counter

from pyspark.sql import functions as F

from foldgauge.operators.classifier import TrainSettings
from foldgauge.operators.metrics import best_epoch
from foldgauge.operators.scoring import inference_progress
from foldgauge.plans import flows


def test_prepare_score_compare(spark, corpus, schema):
    prepared = flows.prepare(corpus, schema, n=200, k=4)
    assert prepared.sample.count() == 200
    compared = {r["label"]: (r["full_count"], r["sub_count"]) for r in prepared.label_distribution.collect()}
    assert compared["a"][0] == 86 and 26 <= compared["a"][1] <= 31
    assert sum(r["n_test"] for r in prepared.fold_distribution.collect()) == 200

    def factory():
        def score(messages):
            asked = messages[-1]["content"]
            if "number 77" in asked:
                raise ConnectionError
            return '{"a":1,"b":0,"c":0}' if "few" not in asked else "none"

        return score

    runs = [flows.score_by_prompt(prepared, schema, "llm_t", mode, factory) for mode in ("zero_shot", "few_shot")]
    predictions = runs[0].unionByName(runs[1])
    assert predictions.count() == 400
    facts = flows.chat_run_facts(predictions).collect()
    assert sum(r["n_test"] for r in facts) == 400
    comparison = flows.compare(predictions, schema)
    assert comparison.table.count() == 2 and comparison.display.count() == 2
    assert comparison.per_fold.count() == 2 * 4 * 5
    smoke = flows.score_by_prompt(prepared, schema, "llm_t", "zero_shot", factory, only_fold=1, limit=3)
    assert [r["fold"] for r in smoke.collect()] == [1, 1, 1]


def test_train_and_score(spark, schema):
    rows = []
    for i in range(240):
        a, b, c = i % 2, int(i % 3 == 0), int(i % 5 == 0)
        words = ["apple"] * a + ["berry"] * b + ["cherry"] * c + [f"w{i % 17}"]
        rows.append((f"r{i}", " ".join(words), a, b, c))
    corpus = spark.createDataFrame(rows, "id string, text string, a int, b int, c int")
    prepared = flows.prepare(corpus, schema, n=240, k=3)
    settings = TrainSettings(n_features=1 << 10, epochs=2, weighted=True)
    predictions, history = flows.train_and_score(prepared, schema, "bert_lr", settings, folds=(0, 1, 2))
    assert Counter(r["id"] for r in predictions.collect()) == Counter(r[0] for r in rows)
    table = flows.compare(predictions, schema).table.first()
    assert table["macro_f1_mean"] > 0.9 and table["n_folds"] == 3
    best = best_epoch(history.withColumn("max_len", F.lit(512))).collect()
    assert len(best) == 3 and all(r["epochs_run"] == 2 for r in best)


def test_progress_equals_brute_force(spark, schema):
    from test_prompts import key

    rows = [("m", "x", "nothink", i % 2, f"r{i}", i % 7 == 0, (i % 10) / 8) for i in range(230)]
    frame = spark.createDataFrame(rows, "model string, mode string, think string, fold int, id string, parse_failure boolean, latency_seconds double")
    got = {(r["fold"], r["done"]): (r["n"], r["failures"], r["elapsed_seconds"]) for r in inference_progress(frame, schema, ["model", "mode", "think", "fold"]).collect()}
    expected = {}
    for fold in (0, 1):
        mine = sorted((r for r in rows if r[3] == fold), key=lambda r: (key(r[4], "call"), r[4]))
        for done in (50, 100, 115):
            part = mine[:done]
            expected[fold, done] = (115, sum(r[5] for r in part), sum(r[6] for r in part))
    assert got == expected
