"""Training and scoring: iterative, so checked by rows and by properties that SQL can state."""

from functools import reduce

from pyspark.sql import functions as F

from foldgauge.operators.classifier import TrainSettings, train_score_folds as train
from foldgauge.operators.metrics import best_epoch
from foldgauge.queries.base import CORPUS_SQL, DOCS, labelled_corpus, query, roles_sql, written_roles

SETTINGS = TrainSettings(weighted=True)
FOLDS = (0, 1, 2, 3, 4)


def _train(spark, sf_dir):
    return train(labelled_corpus(spark, sf_dir), written_roles(spark, sf_dir), DOCS, SETTINGS, FOLDS)


@query("train_score_folds")
def train_score_folds(spark, sf_dir):
    return _train(spark, sf_dir)[0]


@query("train_history")
def train_history(spark, sf_dir):
    return best_epoch(_train(spark, sf_dir)[1], by=["fold"])


def _f1(true, pred):
    """F1 of two 0/1 columns over the whole table."""
    return 2 * F.sum(true * pred) / F.greatest(F.sum(true) + F.sum(pred), F.lit(1))


@query(
    "train_properties",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}
SELECT fold, count(*) FILTER (role = 'test') AS n_test, CAST(0 AS BIGINT) AS not_scored, CAST(0 AS BIGINT) AS beyond_one,
  CAST(0 AS BIGINT) AS wrongly_decided, CAST(0 AS BIGINT) AS wrong_truth, CAST(4 AS BIGINT) AS n_epochs, TRUE AS loss_falls,
  TRUE AS beats_constant FROM roles GROUP BY fold""",
)
def train_properties(spark, sf_dir):
    """What must hold of a training: each test row scored once by its own fold, probabilities and decisions that fit each
    other, a falling loss, and over all folds a better F1 than always saying yes."""
    roles, corpus = written_roles(spark, sf_dir), labelled_corpus(spark, sf_dir)
    scored, history = train(corpus, roles, DOCS, SETTINGS, FOLDS)
    test = roles.where("role = 'test'").select("fold", "doc_id").join(corpus.select("doc_id", *DOCS.labels), "doc_id")
    both = test.join(scored, ["fold", "doc_id"], "full")
    off = [~F.col(p).between(0, 1) for p in DOCS.prob_columns]
    undecided = [F.col(pred) != (F.col(prob) >= SETTINGS.threshold).cast("int") for pred, prob in zip(DOCS.pred_columns, DOCS.prob_columns)]
    untrue = [F.col(label) != F.col(true) for label, true in zip(DOCS.labels, DOCS.true_columns)]

    def rows_with(conditions):
        return F.sum(F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(True)).cast("long"))

    per_fold = both.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum((F.col(DOCS.prob_columns[0]).isNull() | F.col(DOCS.labels[0]).isNull()).cast("long")).alias("not_scored"),
        rows_with(off).alias("beyond_one"),
        rows_with(undecided).alias("wrongly_decided"),
        rows_with(untrue).alias("wrong_truth"),
    )
    by_epoch = history.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_epochs"), (F.max_by("train_loss", "epoch") < F.min_by("train_loss", "epoch")).alias("loss_falls")
    )
    better = [_f1(F.col(true), F.col(pred)) - _f1(F.col(true), F.lit(1)) for true, pred in zip(DOCS.true_columns, DOCS.pred_columns)]
    overall = scored.agg((reduce(lambda a, b: a + b, better) > 0).alias("beats_constant"))
    one = F.lit(1).alias("one")
    return per_fold.join(by_epoch, "fold").select("*", one).join(F.broadcast(overall.select("*", one)), "one").drop("one")
