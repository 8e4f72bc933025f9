import json

import pytest
from pyspark.sql import functions as F

from foldgauge import CorpusSchema
from foldgauge.operators import metrics as M
from foldgauge.operators import splitting as S
from foldgauge.operators.report import markdown_table
from foldgauge.schema import corpus_checks, require_corpus
from foldgauge.session import materialize, scratch_dir
from foldgauge.sources import corpus as corpus_io
from foldgauge.sources import folds as folds_io
from foldgauge.sources import runs as runs_io
from foldgauge.streaming import clean_stream, parse_stream, prompt_stream, write_stream
from foldgauge.operators.cleaning import clean_corpus
from foldgauge.operators.parsing import parse_replies


def test_csv_keeps_quotes_breaks_and_na(spark, schema, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('id,text,b,a,c,extra\n1,"say ""hi"", ok\nline 2",1,0,0,x\n2,NA,0,1,0,y\n3,null,0,0,1,\n4,,0,0,0,\n', encoding="utf-8")
    rows = {r["id"]: r for r in corpus_io.read_corpus_csv(spark, str(path), schema).collect()}
    assert rows["1"]["text"] == 'say "hi", ok\nline 2' and rows["1"]["b"] == 1
    assert rows["2"]["text"] == "NA" and rows["3"]["text"] == "null" and rows["4"]["text"] in (None, "")
    out = str(tmp_path / "out")
    corpus_io.write_csv(corpus_io.read_corpus_csv(spark, str(path), schema).select("id", "text", *schema.labels), out)
    assert {r["text"] for r in corpus_io.read_corpus_csv(spark, out, schema).collect()} == {r["text"] for r in rows.values()}


def test_missing_columns_are_refused(spark, schema):
    with pytest.raises(ValueError, match="missing columns"):
        require_corpus(spark.createDataFrame([("1", 0)], "id string, a int"), schema)


def test_corpus_checks_find_problems(spark, schema):
    rows = [("1", "x", 0, 0, 0), ("1", None, 0, 2, 0), (None, "y", 0, 0, None)]
    row = corpus_checks(spark.createDataFrame(rows, "id string, text string, a int, b int, c int"), schema).first()
    assert (row["n_rows"], row["null_ids"], row["repeated_ids"], row["bad_labels"], row["null_texts"]) == (3, 1, 1, 2, 1)


def test_positional_folds_become_roles(spark, schema, tmp_path):
    lines = ["id,text,a,b,c"] + [f"r{i},t,0,0,0" for i in range(20)]
    (tmp_path / "sample.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    folds = {str(f): {"train_idx": [i for i in range(20) if i % 4 != f and i % 5], "val_idx": [i for i in range(20) if i % 4 != f and not i % 5], "test_idx": [i for i in range(20) if i % 4 == f]} for f in range(4)}
    (tmp_path / "folds.json").write_text(json.dumps(folds, indent=2), encoding="utf-8")
    corpus = corpus_io.read_corpus_csv(spark, str(tmp_path / "sample.csv"), schema)
    positions = folds_io.read_positional_folds(spark, str(tmp_path / "folds.json"))
    roles = folds_io.positional_to_roles(positions, corpus, schema).collect()
    expected = {(int(f), f"r{i}", role[:-4]) for f, parts in folds.items() for role, rows in parts.items() for i in rows}
    assert {(r["fold"], r["id"], r["role"]) for r in roles} == expected and len(roles) == 80


def test_row_positions_span_read_partitions(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.col("id").alias("v"))
    assert all(r["v"] == r["row_position"] for r in folds_io.with_row_positions(rows).collect())


def _metrics(fold, f1):
    label = {"precision": f1, "recall": f1, "f1": f1, "support": 4}
    return {"fold": fold, "model": "name", "per_label": {x: label for x in "abc"}, "macro_f1": f1, "micro_f1": f1}


def test_import_run_tree(spark, schema, tmp_path):
    files = {
        "bert_one/fold_0/metrics.json": {**_metrics(0, 0.5), "best_epoch": 2, "history": [{"epoch": 1, "train_loss": 0.1, "val_macro_f1": 0.2, "val_micro_f1": 0.3}]},
        "bert_one/fold_10/metrics.json": _metrics(10, 0.7),
        "llm_two/zero_shot/fold_0/metrics.json": {**_metrics(0, 0.1), "mode": "zero", "parse_failures": 3},
        "llm_two/few_shot/think/fold_1/metrics.json": {**_metrics(1, 0.2), "mode": "few"},
        "llm_two/few_shot/nothink/fold_1/metrics.json": {**_metrics(1, 0.3), "mode": "few"},
        "other/fold_0/metrics.json": _metrics(0, 0.9),
        "bert_one/summary.json": {"macro_f1_mean": 0.6},
    }
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps(content, indent=2), encoding="utf-8")
    metrics = runs_io.import_run_tree(spark, str(tmp_path), schema)
    found = {(r["model"], r["mode"], r["think"]): r["n_folds"] for r in runs_io.discover_runs(metrics).collect()}
    assert found == {
        ("bert_one", "finetune", "nothink"): 2,
        ("llm_two", "zero_shot", "nothink"): 1,
        ("llm_two", "few_shot", "think"): 1,
        ("llm_two", "few_shot", "nothink"): 1,
    }
    table = {r["model"]: r for r in M.aggregate_folds(metrics, schema).where("mode = 'finetune'").collect()}
    assert table["bert_one"]["macro_f1_mean"] == pytest.approx(0.6)
    assert table["bert_one"]["per_fold_macro_f1"] == [0.5, 0.7]
    rows = M.per_fold_results(metrics).where("model = 'bert_one' and fold = 10").collect()
    assert [r["label"] for r in rows] == ["a", "b", "c", "MACRO_F1", "MICRO_F1"]


def test_metrics_document_shape(spark, schema, tmp_path):
    rows = [("bert_x", "finetune", "nothink", 0, 1, 1, 0, 1, 0, 0)]
    fields = ", ".join(f"true_{x} int, pred_{x} int" for x in schema.labels)
    metrics = M.fold_metrics(spark.createDataFrame(rows, f"model string, mode string, think string, fold int, {fields}"), schema)
    path = str(tmp_path / "metrics")
    runs_io.write_fold_metrics(metrics, path, schema)
    document = json.loads(spark.read.text(path).first()["value"])
    assert document["per_label"]["a"] == {"precision": 1.0, "recall": 1.0, "f1": 1.0, "support": 1}
    back = runs_io.read_fold_metrics(spark, path, schema)
    assert [tuple(x) for x in back.first()["per_label"]] == [tuple(x) for x in metrics.first()["per_label"]]
    summary = M.aggregate_folds(back, schema)
    runs_io.write_run_summary(summary, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).first()["per_fold_macro_f1"] == [pytest.approx(1 / 3)]


def test_markdown_lines(spark, tmp_path):
    table = spark.createDataFrame([("b", "x|y"), ("a", None)], "k string, v string")
    runs_io.write_markdown(markdown_table(table, "T", ["k"]), str(tmp_path / "md"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "md")).collect()]
    assert lines == ["# T", "", "| k | v |", "|:---|:---|", "| a |  |", "| b | x\\|y |"]


def test_missing_table_is_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert runs_io.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0
    spark.range(3).write.parquet(str(tmp_path / "some"))
    assert runs_io.read_or_empty(spark, str(tmp_path / "some"), schema).count() == 3


def test_templates_keep_line_breaks(spark, tmp_path):
    templates = spark.createDataFrame([("zero_shot", 0, "a\n\nb"), ("zero_shot", 1, "c")], "mode string, fold int, template string")
    runs_io.write_templates(templates, str(tmp_path / "t"))
    assert sorted(runs_io.read_templates(spark, str(tmp_path / "t")).collect()) == sorted(templates.collect())
    first = M.first_path(runs_io.read_templates(spark, str(tmp_path / "t")), "fold", "template", ["mode"]).first()
    assert first["template"] == "a\n\nb"


def test_one_fold_reads_one_folder(spark, corpus, schema, tmp_path):
    folds_io.write_fold_roles(S.fold_roles(corpus, schema), str(tmp_path / "roles"))
    one = folds_io.read_fold_roles(spark, str(tmp_path / "roles")).where("fold = 3")
    assert len(one.inputFiles()) > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan
    assert one.count() == 600


def test_split_csv(spark, tmp_path):
    rows = spark.createDataFrame([("train", "a"), ("test", "b")], "split string, text string")
    corpus_io.write_split_csv(rows, str(tmp_path / "train"), "train")
    assert [r["text"] for r in spark.read.option("header", True).csv(str(tmp_path / "train")).collect()] == ["a"]
    assert corpus_io.head(spark.range(50)).count() == 10


def test_streams_equal_batches(spark, tmp_path):
    schema = CorpusSchema(labels=("a", "b"), id="id", text="text")
    rows = spark.createDataFrame(
        [(str(i), f"t {i} &amp; … <b>", f'{{"a":{i % 2}}}' if i % 3 else "none") for i in range(40)], "id string, text string, raw_response string"
    )
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    both = parse_stream(clean_stream(stream, schema), schema)
    write_stream(both, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = parse_replies(clean_corpus(rows, "text"), "raw_response", schema.labels)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect())
    asked = prompt_stream(stream, schema)
    assert asked.isStreaming and "messages" in asked.columns


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert scratch_dir(spark).startswith(base)
    assert scratch_dir(spark) != scratch_dir(spark)
    assert materialize(spark.range(5)).count() == 5


class _Session:
    """Only what ``scratch_dir`` asks a session for."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder or default)})()


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_Session("yarn"))
    assert scratch_dir(_Session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/foldgauge/")
    assert scratch_dir(_Session("local[2]")).split("/foldgauge/")[0] == scratch_dir(_Session("local[2]")).split("/foldgauge/")[0]
