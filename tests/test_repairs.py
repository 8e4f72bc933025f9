"""Rows, texts and names that earlier versions lost."""

from pyspark.sql import functions as F

from foldgauge import CorpusSchema
from foldgauge.operators import metrics as M
from foldgauge.operators import prompts as P
from foldgauge.operators import splitting as S
from foldgauge.operators.parsing import parse_replies
from foldgauge.plans import flows
from foldgauge.sources import corpus as corpus_io
from foldgauge.sources import runs as runs_io


def test_csv_keeps_blanks_at_the_ends(spark, tmp_path):
    schema = CorpusSchema(labels=("a",), id="id", text="text")
    texts = ["  lead and trail  ", "x\ty \n", " ", "", '"q" ,', "two\nlines"]
    rows = spark.createDataFrame([(str(i), t, i % 2) for i, t in enumerate(texts)], "id string, text string, a int")
    corpus_io.write_csv(rows, str(tmp_path / "csv"))
    got = {r["id"]: r["text"] for r in corpus_io.read_corpus_csv(spark, str(tmp_path / "csv"), schema).collect()}
    assert got == {str(i): t for i, t in enumerate(texts)}


def test_ten_folds_all_get_exemplars(spark, corpus, schema):
    prepared = flows.prepare(corpus, schema, n=400, k=10)
    exemplars = P.few_shot_exemplars(prepared.sample, prepared.roles, schema)
    assert {r["fold"] for r in exemplars.collect()} == set(range(10))
    assert P.folds_without_exemplars(prepared.roles, exemplars).count() == 0
    asked = []
    replies = flows.score_by_prompt(prepared, schema, "m", "few_shot", lambda: lambda messages: f"{messages[-1]['content'].count('JSON:')}")
    asked = {(r["fold"], r["raw_response"]) for r in replies.select("fold", "raw_response").distinct().collect()}
    assert asked == {(fold, "6") for fold in range(10)}  # five exemplars and the question


def test_templates_without_exemplars(spark, corpus, schema):
    roles = S.fold_roles(corpus, schema, 3)
    none = P.few_shot_exemplars(corpus.limit(0), roles, schema)
    assert {r["fold"] for r in P.folds_without_exemplars(roles, none).collect()} == {0, 1, 2}
    got = P.prompt_templates(none, roles, schema).collect()
    assert sorted((r["mode"], r["fold"]) for r in got) == sorted((m, f) for m in ("zero_shot", "few_shot") for f in range(3))


def test_strict_prepare_refuses_repeated_ids(spark, corpus, schema):
    import pytest

    with pytest.raises(ValueError, match="repeated_ids"):
        flows.prepare(corpus.union(corpus.limit(1)), schema, n=10, strict=True)


def test_reply_parser_survives_deep_brackets_and_user_columns(spark):
    deep = '{"a":' + "[" * 200_000 + "}"
    rows = spark.createDataFrame([(0, deep, "mine"), (1, '{"a":1,"a":0}', "mine"), (2, '{"a":NaN}', "mine"), (3, '{"a":1}', "mine")], "i int, raw string, reply string")
    got = {r["i"]: (r["pred_a"], r["parse_failure"], r["reply"]) for r in parse_replies(rows, "raw", ["a"]).collect()}
    assert got == {0: (0, True, "mine"), 1: (0, False, "mine"), 2: (1, False, "mine"), 3: (1, False, "mine")}


def test_quotas_of_huge_counts(spark, schema):
    big = spark.range(4).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("text"), *[(F.col("id") % 2).cast("int").alias(x) for x in schema.labels])
    quotas = S.label_set_quotas(big, schema, 10**18)
    assert sum(r["quota"] for r in quotas.collect()) == 4


def test_model_names_and_row_counts_survive(spark, tmp_path, schema):
    run = {"model": F.lit("007"), "mode": F.lit("zero_shot"), "think": F.lit("nothink"), "fold": F.lit(3)}
    rows = spark.createDataFrame([(str(i), i % 2, 1) for i in range(8)], "id string, x int, y int")
    truth = {f"true_{label}": F.col("x") for label in schema.labels} | {f"pred_{label}": F.col("y") for label in schema.labels}
    predictions = rows.withColumns(truth).withColumns(run)
    runs_io.write_predictions(predictions, str(tmp_path / "p"))
    read = runs_io.read_predictions(spark, str(tmp_path / "p"))
    assert {(r["model"], r["fold"]) for r in read.select("model", "fold").distinct().collect()} == {("007", 3)}
    runs_io.write_fold_metrics(M.fold_metrics(read, schema), str(tmp_path / "m"), schema)
    row = runs_io.read_fold_metrics(spark, str(tmp_path / "m"), schema).first()
    assert (row["model"], row["n_test"]) == ("007", 8)


def test_scorer_is_told_model_and_budget(spark, corpus, schema):
    prepared = flows.prepare(corpus, schema, n=40, k=2)

    def factory(settings):
        return lambda messages: f"{settings.model} {settings.think} {settings.max_new_tokens}"

    replies = flows.score_by_prompt(prepared, schema, "my-qwq", "zero_shot", factory, think=True, requested_tokens=64)
    assert {r["raw_response"] for r in replies.collect()} == {"my-qwq True 2048"}
