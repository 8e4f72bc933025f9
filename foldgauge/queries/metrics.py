"""Thresholds, metrics per run and fold, spread over folds, comparison tables."""

from pyspark.sql import functions as F

from foldgauge.operators import metrics as M
from foldgauge.operators import splitting as S
from foldgauge.queries.base import (
    CORPUS_SQL,
    DOCS,
    ORDERS,
    ORDERS_SQL,
    digit,
    digit_sql,
    encoder_scores,
    folds_sql,
    labelled_corpus,
    labelled_orders,
    metrics_sql,
    query,
    raw_replies,
    replies_sql,
    parsed_sql,
    roles_sql,
    scores_sql,
)
from foldgauge.operators.scoring import chat_predictions
from foldgauge.schema import unmatched_rows

RUN_SQL = "model, mode, think"


def encoder_predictions(corpus, schema):
    """Predictions of the fine-tuned runs on every fold's test rows."""
    labels = corpus.select(schema.id, *schema.labels)
    test = S.stratified_folds(corpus, schema).select("fold", schema.id).join(labels, schema.id)
    return M.threshold_predictions(encoder_scores(test, schema), schema)


def prompted_predictions(corpus, schema):
    """Predictions of the prompted runs, parsed from their replies."""
    labels = corpus.select(schema.id, *schema.labels)
    test = S.stratified_folds(corpus, schema).select("fold", schema.id).join(labels, schema.id)
    return chat_predictions(raw_replies(test, schema), schema, [*M.RUN, "fold"])


def all_predictions(corpus, schema):
    columns = [*M.RUN, "fold", schema.id, *schema.true_columns, *schema.pred_columns]
    return encoder_predictions(corpus, schema).select(columns).unionByName(
        prompted_predictions(corpus, schema).select(columns)
    )


def predictions_sql(schema, source_sql: str, source: str) -> str:
    """CTE ``predictions`` holding the fine-tuned and the prompted runs."""
    true = ", ".join(f"true_{label}" for label in schema.labels)
    prob = ", ".join(f"CAST(prob_{label} >= 0.5 AS INTEGER) AS pred_{label}" for label in schema.labels)
    renamed = ", ".join(f"{label} AS true_{label}" for label in schema.labels)
    pred = ", ".join(f"CASE WHEN call_error THEN 0 ELSE pred_{label} END AS pred_{label}" for label in schema.labels)
    return f"""{source_sql}, {folds_sql(schema, source)}, {scores_sql(schema, source)}, {replies_sql(schema, source)},
{parsed_sql(schema)}, predictions AS (
  SELECT {RUN_SQL}, fold, {schema.id}, {true}, {prob} FROM scores
  UNION ALL SELECT {RUN_SQL}, fold, {schema.id}, {renamed}, {pred} FROM parsed
)"""


DOC_METRICS = f"WITH {predictions_sql(DOCS, CORPUS_SQL, 'corpus')}, {metrics_sql(DOCS, 'predictions')}"
ORDER_METRICS = f"WITH {predictions_sql(ORDERS, ORDERS_SQL, 'orders_labelled')}, {metrics_sql(ORDERS, 'predictions')}"


def doc_metrics(spark, sf_dir):
    return M.fold_metrics(all_predictions(labelled_corpus(spark, sf_dir), DOCS), DOCS)


def order_metrics(spark, sf_dir):
    return M.fold_metrics(all_predictions(labelled_orders(spark, sf_dir), ORDERS), ORDERS)


@query(
    "threshold_predictions",
    f"""WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')}, {scores_sql(DOCS, 'corpus')}
SELECT *, CAST(prob_quality >= 0.5 AS INTEGER) AS pred_quality, CAST(prob_toxic >= 0.5 AS INTEGER) AS pred_toxic FROM scores""",
)
def thresholds(spark, sf_dir):
    return encoder_predictions(labelled_corpus(spark, sf_dir), DOCS)


@query(
    "predictions_joined",
    f"""WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')}, {scores_sql(DOCS, 'corpus')}
SELECT model, mode, think, s.fold, s.doc_id, s.prob_quality, s.prob_toxic, c.quality AS true_quality, c.toxic AS true_toxic
FROM scores s JOIN corpus c ON s.doc_id = c.doc_id""",
)
def joined(spark, sf_dir):
    """Scores that carry no labels, joined back to the truth by fold and id."""
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    folds = S.stratified_folds(corpus, DOCS).select("fold", "doc_id")
    truth = folds.join(corpus, "doc_id")
    return M.join_predictions(truth, encoder_scores(truth, DOCS).drop(*DOCS.true_columns), DOCS)


@query(
    "prediction_match_check",
    f"WITH {CORPUS_SQL} SELECT 2 * count(*) AS matched, CAST(0 AS BIGINT) AS left_only, CAST(0 AS BIGINT) AS right_only FROM corpus",
)
def match_check(spark, sf_dir):
    """Every test row has exactly one prediction per model, and no prediction lacks its row."""
    corpus = labelled_corpus(spark, sf_dir)
    predictions = encoder_predictions(corpus, DOCS)
    expected = corpus.select("doc_id", F.explode(F.array(F.lit("bert_base"), F.lit("bert_mini"))).alias("model"))
    return unmatched_rows(expected, predictions, ["model", "doc_id"])


PER_LABEL = f'SELECT {RUN_SQL}, fold, label, "precision", recall, f1, support FROM label_scores'


@query("per_label_metrics", f"{DOC_METRICS} {PER_LABEL}")
def per_label(spark, sf_dir):
    return M.per_label_metrics(doc_metrics(spark, sf_dir))


@query("per_label_metrics_orders", f"{ORDER_METRICS} {PER_LABEL}")
def per_label_orders(spark, sf_dir):
    return M.per_label_metrics(order_metrics(spark, sf_dir))


MACRO_MICRO = f"SELECT {RUN_SQL}, fold, round(macro_f1, 9) AS macro_f1, micro_f1 FROM fold_scores"


def _macro_micro(metrics):
    return metrics.select(*M.RUN, "fold", F.round("macro_f1", 9).alias("macro_f1"), "micro_f1")


@query("macro_micro_f1", f"{DOC_METRICS} {MACRO_MICRO}")
def macro_micro(spark, sf_dir):
    return _macro_micro(doc_metrics(spark, sf_dir))


@query("macro_micro_f1_orders", f"{ORDER_METRICS} {MACRO_MICRO}")
def macro_micro_orders(spark, sf_dir):
    return _macro_micro(order_metrics(spark, sf_dir))


PER_FOLD_RESULTS = f"""SELECT {RUN_SQL}, fold, label, round_even("precision", 4) AS "precision", round_even(recall, 4) AS recall,
  round_even(f1, 4) AS f1, support FROM label_scores
UNION ALL SELECT {RUN_SQL}, fold, 'MACRO_F1', NULL, NULL, round_even(macro_f1, 4), NULL FROM fold_scores
UNION ALL SELECT {RUN_SQL}, fold, 'MICRO_F1', NULL, NULL, round_even(micro_f1, 4), NULL FROM fold_scores"""


@query("per_fold_results", f"{DOC_METRICS} {PER_FOLD_RESULTS}")
def per_fold(spark, sf_dir):
    return M.per_fold_results(doc_metrics(spark, sf_dir))


def mean_std_sql(digits: int) -> str:
    parts = []
    for metric in ("precision", "recall", "f1", "support"):
        parts.append(f'round(avg("{metric}"), {digits}) AS {metric}_mean')
        parts.append(f'round(stddev_pop("{metric}"), {digits}) AS {metric}_std')
    return f"SELECT {RUN_SQL}, label, {', '.join(parts)} FROM label_scores GROUP BY {RUN_SQL}, label"


def _mean_std(metrics, schema):
    long = M.fold_mean_std(M.aggregate_folds(metrics, schema), schema)
    return long.select(*M.RUN, "label", *[F.round(name, 6).alias(name) for name in long.columns[4:]])


@query("fold_mean_std", f"{DOC_METRICS} {mean_std_sql(6)}")
def mean_std(spark, sf_dir):
    return _mean_std(doc_metrics(spark, sf_dir), DOCS)


@query("fold_mean_std_orders", f"{ORDER_METRICS} {mean_std_sql(6)}")
def mean_std_orders(spark, sf_dir):
    return _mean_std(order_metrics(spark, sf_dir), ORDERS)


@query(
    "per_fold_arrays",
    f"""{DOC_METRICS} SELECT {RUN_SQL}, count(*) AS n_folds,
  string_agg(printf('%.6f', macro_f1), ',' ORDER BY fold) AS macro_by_fold,
  string_agg(printf('%.6f', micro_f1), ',' ORDER BY fold) AS micro_by_fold FROM fold_scores GROUP BY {RUN_SQL}""",
)
def per_fold_arrays(spark, sf_dir):
    aggregated = M.aggregate_folds(doc_metrics(spark, sf_dir), DOCS)

    def text(name):
        return F.array_join(F.transform(name, lambda v: F.format_string("%.6f", v)), ",")

    return aggregated.select(
        *M.RUN,
        "n_folds",
        text("per_fold_macro_f1").alias("macro_by_fold"),
        text("per_fold_micro_f1").alias("micro_by_fold"),
    )


def comparison_sql(schema, digits: int = 4, rounding: str = "round_even") -> str:
    """CTE ``comparison``."""
    labels = []
    for label in schema.labels:
        labels.append(f"{rounding}(avg(l.f1) FILTER (l.label = '{label}'), {digits}) AS {label}_f1_mean")
        labels.append(f"{rounding}(stddev_pop(l.f1) FILTER (l.label = '{label}'), {digits}) AS {label}_f1_std")
    return f"""overall AS (
  SELECT {RUN_SQL}, count(DISTINCT fold) AS n_folds, {rounding}(avg(macro_f1), {digits}) AS macro_f1_mean,
    {rounding}(stddev_pop(macro_f1), {digits}) AS macro_f1_std, {rounding}(avg(micro_f1), {digits}) AS micro_f1_mean,
    {rounding}(stddev_pop(micro_f1), {digits}) AS micro_f1_std FROM fold_scores GROUP BY {RUN_SQL}
), by_label AS (
  SELECT {RUN_SQL}, {", ".join(labels)} FROM label_scores l GROUP BY {RUN_SQL}
), comparison AS (SELECT * FROM overall JOIN by_label USING ({RUN_SQL}))"""


DOC_COMPARISON = f"{DOC_METRICS}, {comparison_sql(DOCS)}"
ORDER_COMPARISON = f"{ORDER_METRICS}, {comparison_sql(ORDERS)}"


def doc_comparison(spark, sf_dir):
    return M.comparison_table(M.aggregate_folds(doc_metrics(spark, sf_dir), DOCS), DOCS)


def order_comparison(spark, sf_dir):
    return M.comparison_table(M.aggregate_folds(order_metrics(spark, sf_dir), ORDERS), ORDERS)


@query("comparison_table", f"{DOC_COMPARISON} SELECT * FROM comparison")
def comparison(spark, sf_dir):
    return doc_comparison(spark, sf_dir)


@query("comparison_table_orders", f"{ORDER_COMPARISON} SELECT * FROM comparison")
def comparison_orders(spark, sf_dir):
    return order_comparison(spark, sf_dir)


def display_sql(schema) -> str:
    names = ["macro", "micro", *schema.labels]
    cells = ", ".join(f"printf('%.4f ± %.4f', {name}_f1_mean, {name}_f1_std) AS {name}_F1" for name in names)
    return f"SELECT {RUN_SQL}, {cells} FROM comparison"


@query("comparison_display", f"{DOC_COMPARISON} {display_sql(DOCS)}")
def display(spark, sf_dir):
    return M.comparison_display(doc_comparison(spark, sf_dir), DOCS)


@query(
    "run_summary",
    f"{DOC_COMPARISON} SELECT {RUN_SQL}, n_folds, macro_f1_mean, macro_f1_std, micro_f1_mean, micro_f1_std FROM comparison WHERE n_folds = 5",
)
def summary(spark, sf_dir):
    table = doc_comparison(spark, sf_dir)
    return M.run_summary(table, k=5).select(
        *M.RUN, "n_folds", "macro_f1_mean", "macro_f1_std", "micro_f1_mean", "micro_f1_std"
    )


def best_sql(metric: str) -> str:
    return f"""SELECT m.mode, '{metric}' AS metric, CASE WHEN b.model IS NULL THEN 'n/a'
  ELSE printf('%.4f (%s)', b.v, b.model) END AS best
FROM (VALUES ('finetune'), ('zero_shot'), ('few_shot'), ('distilled')) AS m(mode) LEFT JOIN (
  SELECT mode, model, {metric} AS v, row_number() OVER (PARTITION BY mode ORDER BY {metric} DESC, model) AS r FROM comparison
) b ON b.mode = m.mode AND b.r = 1"""


@query(
    "best_run_per_mode",
    f"{DOC_COMPARISON} {best_sql('macro_f1_mean')} UNION ALL {best_sql('micro_f1_mean')}",
)
def best_runs(spark, sf_dir):
    """Also asks for a mode no run has, which must show as n/a."""
    table = doc_comparison(spark, sf_dir)
    modes = ("finetune", "zero_shot", "few_shot", "distilled")
    return M.best_run_per_mode(table, "macro_f1_mean", modes).unionByName(
        M.best_run_per_mode(table, "micro_f1_mean", modes)
    )


@query(
    "model_mode_label_lookup",
    f"{ORDER_COMPARISON} SELECT model, think, is_f_f1_mean, is_early_f1_mean FROM comparison WHERE mode = 'finetune'",
)
def lookup(spark, sf_dir):
    return M.label_lookup(order_comparison(spark, sf_dir), ORDERS, "finetune", ["is_f", "is_early"])


# --- training history: validation metrics per epoch ---------------------------------------------
EPOCHS = 4


def epoch_predictions(corpus, schema):
    """Validation predictions after each epoch of each model; later epochs carry less noise."""
    labels = corpus.select(schema.id, *schema.labels)
    val = S.fold_rows(labels, S.fold_roles(corpus, schema), schema, "val")
    model = F.explode(F.array(F.lit("bert_base"), F.lit("bert_mini")))
    every = val.select("fold", schema.id, *schema.labels, model.alias("model")).withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))
    )
    columns = []
    for label in schema.labels:
        flip = digit("epoch", F.col("model"), F.col("epoch"), label, F.col(schema.id)) < 5 - F.col("epoch")
        columns.append(F.col(label).alias(f"true_{label}"))
        columns.append(F.when(flip, 1 - F.col(label)).otherwise(F.col(label)).alias(f"pred_{label}"))
    return every.select("model", "fold", "epoch", *columns)


def history_sql(schema, source: str) -> str:
    """CTEs up to ``history`` from ``roles``."""
    columns = []
    for label in schema.labels:
        flip = f"{digit_sql(repr('epoch'), 'm.model', 'e.epoch', repr(label), f'r.{schema.id}')} < 5 - e.epoch"
        columns.append(f"c.{label} AS true_{label}, CASE WHEN {flip} THEN 1 - c.{label} ELSE c.{label} END AS pred_{label}")
    return f"""epoch_predictions AS (
  SELECT m.model, r.fold, CAST(e.epoch AS INTEGER) AS epoch, {", ".join(columns)}
  FROM roles r JOIN {source} c ON r.{schema.id} = c.{schema.id} CROSS JOIN (VALUES ('bert_base'), ('bert_mini')) AS m(model)
  CROSS JOIN range(1, {EPOCHS + 1}) AS e(epoch) WHERE r.role = 'val'
), {metrics_sql(schema, 'epoch_predictions', 'model, fold, epoch')}, history AS (
  SELECT model, fold, epoch, round(macro_f1, 9) AS val_macro_f1, micro_f1 AS val_micro_f1 FROM fold_scores
)"""


def training_history(spark, sf_dir):
    metrics = M.fold_metrics(epoch_predictions(labelled_corpus(spark, sf_dir), DOCS), DOCS, ["model", "fold", "epoch"])
    return metrics.select(
        "model", "fold", "epoch", F.round("macro_f1", 9).alias("val_macro_f1"), F.col("micro_f1").alias("val_micro_f1")
    )


HISTORY = f"WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}, {history_sql(DOCS, 'corpus')}"


@query("training_history", f"{HISTORY} SELECT * FROM history")
def history(spark, sf_dir):
    return training_history(spark, sf_dir)


@query(
    "best_epoch",
    f"""{HISTORY} SELECT model, fold, epochs_run, best_epoch, best_val_macro_f1, val_micro_f1 FROM (
  SELECT model, fold, epoch AS best_epoch, val_macro_f1 AS best_val_macro_f1, val_micro_f1,
    count(*) OVER (PARTITION BY model, fold) AS epochs_run,
    row_number() OVER (PARTITION BY model, fold ORDER BY val_macro_f1 DESC, epoch) AS r FROM history) WHERE r = 1""",
)
def best(spark, sf_dir):
    return M.best_epoch(training_history(spark, sf_dir))


@query(
    "best_epoch_table",
    f"""{HISTORY} SELECT model, fold, best_epoch, round_even(v, 4) AS best_val_macro_f1, CAST(0 AS DOUBLE) AS train_time_sec,
  '' AS max_len FROM (SELECT model, fold, epoch AS best_epoch, val_macro_f1 AS v,
    row_number() OVER (PARTITION BY model, fold ORDER BY val_macro_f1 DESC, epoch) AS r FROM history) WHERE r = 1""",
)
def best_table(spark, sf_dir):
    return M.best_epoch_table(M.best_epoch(training_history(spark, sf_dir)))


@query(
    "epoch_loss",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}, steps AS (
  SELECT 'bert_base' AS model, r.fold, CAST(e.epoch AS INTEGER) AS epoch,
    ({digit_sql(repr('loss'), 'e.epoch', 'r.doc_id')} + 1) / 64.0::DOUBLE AS loss
  FROM roles r CROSS JOIN range(1, 5) AS e(epoch) WHERE r.role = 'train'
) SELECT model, fold, epoch, count(*) AS n_steps, round(avg(loss), 9) AS train_loss FROM steps GROUP BY model, fold, epoch""",
)
def losses(spark, sf_dir):
    """Mean loss per epoch of a step log with one step per train row."""
    train = S.fold_roles(labelled_corpus(spark, sf_dir), DOCS).where(F.col("role") == "train")
    steps = train.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).select(
        F.lit("bert_base").alias("model"),
        "fold",
        "epoch",
        ((digit("loss", F.col("epoch"), F.col("doc_id")) + 1) / F.lit(64.0)).alias("loss"),
    )
    return M.epoch_loss(steps).withColumn("train_loss", F.round("train_loss", 9))
