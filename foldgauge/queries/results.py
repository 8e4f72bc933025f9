"""Sources and sinks: what is written to the shared folder reads back as it was."""

from pyspark.sql import functions as F

from foldgauge.operators import metrics as M
from foldgauge.operators import splitting as S
from foldgauge.operators.prompts import few_shot_exemplars, prompt_templates
from foldgauge.operators.report import markdown_rows, markdown_table
from foldgauge.queries.base import CORPUS_SQL, DOCS, folds_sql, labelled_corpus, query, roles_sql, scores_sql, table, written_roles
from foldgauge.queries.metrics import (
    DOC_COMPARISON,
    DOC_METRICS,
    PER_LABEL,
    RUN_SQL,
    display_sql,
    doc_comparison,
    doc_metrics,
    encoder_predictions,
)
from foldgauge.queries.prompts import COMMENTS_SQL, EXEMPLARS_SQL, TEMPLATES_SQL, K
from foldgauge.session import scratch_dir
from foldgauge.sources import corpus as corpus_io
from foldgauge.sources import folds as folds_io
from foldgauge.sources import runs as runs_io

LINE_SQL = "SELECT '| ' || model || ' | ' || mode || ' | ' || macro_F1 || ' | ' || micro_F1 || ' |' AS line FROM shown"


def _display(spark, sf_dir):
    return M.comparison_display(doc_comparison(spark, sf_dir), DOCS).select("model", "mode", "macro_F1", "micro_F1")


@query("markdown_rows", f"{DOC_COMPARISON}, shown AS ({display_sql(DOCS)}) {LINE_SQL}")
def lines(spark, sf_dir):
    return markdown_rows(_display(spark, sf_dir)).select("line")


@query(
    "markdown_table",
    f"""{DOC_COMPARISON}, shown AS ({display_sql(DOCS)}) {LINE_SQL} UNION ALL
SELECT unnest(['# Comparison Table', '', '| model | mode | macro_F1 | micro_F1 |', '|:---|:---|:---|:---|'])""",
)
def markdown(spark, sf_dir):
    path = scratch_dir(spark)
    runs_io.write_markdown(markdown_table(_display(spark, sf_dir), "Comparison Table", ["model", "mode"]), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("corpus_csv", f"WITH {CORPUS_SQL} SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, quality, toxic FROM corpus")
def corpus_csv(spark, sf_dir):
    """The labelled corpus through CSV: quotes and line breaks inside texts survive."""
    path = scratch_dir(spark)
    corpus_io.write_csv(labelled_corpus(spark, sf_dir).select("doc_id", "text", *DOCS.labels), path)
    return corpus_io.read_corpus_csv(spark, path, DOCS)


@query(
    "split_csv",
    f"WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')} SELECT CAST(fold AS VARCHAR) AS fold, CAST(doc_id AS VARCHAR) AS doc_id FROM roles WHERE role = 'train'",
)
def split_csv(spark, sf_dir):
    path = scratch_dir(spark)
    corpus_io.write_split_csv(S.fold_roles(labelled_corpus(spark, sf_dir), DOCS), path, "train", split_column="role")
    return spark.read.option("header", True).csv(path)


@query("fold_roles_table", f"WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')} SELECT fold, doc_id, role FROM roles")
def fold_roles_table(spark, sf_dir):
    path = scratch_dir(spark)
    folds_io.write_fold_roles(S.fold_roles(labelled_corpus(spark, sf_dir), DOCS), path)
    return folds_io.read_fold_roles(spark, path)


@query(
    "predictions_table",
    f"""WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')}, {scores_sql(DOCS, 'corpus')}
SELECT *, CAST(prob_quality >= 0.5 AS INTEGER) AS pred_quality, CAST(prob_toxic >= 0.5 AS INTEGER) AS pred_toxic
FROM scores WHERE model = 'bert_base'""",
)
def predictions_table(spark, sf_dir):
    """Predictions of one run out of a table holding several: the run is a partition filter."""
    path = scratch_dir(spark)
    runs_io.write_predictions(encoder_predictions(labelled_corpus(spark, sf_dir), DOCS), path)
    return runs_io.read_predictions(spark, path).where(F.col("model") == "bert_base")


def _written_metrics(spark, sf_dir):
    path = scratch_dir(spark)
    runs_io.write_fold_metrics(doc_metrics(spark, sf_dir), path, DOCS)
    return runs_io.read_fold_metrics(spark, path, DOCS)


@query("fold_metrics_documents", f"{DOC_METRICS} {PER_LABEL}")
def metrics_documents(spark, sf_dir):
    return M.per_label_metrics(_written_metrics(spark, sf_dir))


@query("discover_runs", f"{DOC_METRICS} SELECT {RUN_SQL}, count(DISTINCT fold) AS n_folds FROM fold_scores GROUP BY {RUN_SQL}")
def discover(spark, sf_dir):
    return runs_io.discover_runs(_written_metrics(spark, sf_dir))


@query(
    "exemplar_table",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, {roles_sql(DOCS, 'corpus')}, {EXEMPLARS_SQL}
SELECT fold, slot, doc_id, text, quality, toxic FROM exemplars""",
)
def exemplar_table(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir)
    path = scratch_dir(spark)
    runs_io.write_exemplars(few_shot_exemplars(corpus, written_roles(spark, sf_dir), DOCS, K, texts=table(spark, sf_dir, "documents")), path)
    return runs_io.read_exemplars(spark, path)


@query(
    "first_template",
    f"{TEMPLATES_SQL} SELECT mode, fold, template FROM templates WHERE fold = 0",
)
def first_template(spark, sf_dir):
    """Templates written per mode and fold; the first one of each mode is what a report shows."""
    path, roles = scratch_dir(spark), written_roles(spark, sf_dir)
    exemplars = few_shot_exemplars(labelled_corpus(spark, sf_dir), roles, DOCS, K, texts=table(spark, sf_dir, "documents"))
    runs_io.write_templates(prompt_templates(exemplars, roles, DOCS), path)
    return M.first_path(runs_io.read_templates(spark, path), "fold", "template", ["mode"]).select("mode", "fold", "template")
