"""Each flow strings operators together; folds, models and modes are columns, not loops."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from inspect import signature

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldgauge import fixed_values as V
from foldgauge.functions.scores import token_budget
from foldgauge.operators import metrics as M
from foldgauge.operators import splitting as S
from foldgauge.operators import stats
from foldgauge.operators.classifier import TrainSettings, train_score_folds
from foldgauge.operators.parsing import latency_stats, parse_failure_stats
from foldgauge.operators.prompts import few_shot_exemplars, few_shot_messages, zero_shot_messages
from foldgauge.operators.scoring import Scorer, chat_predictions, score_replies
from foldgauge.schema import CorpusSchema, corpus_checks, require_corpus
from foldgauge.session import materialize


@dataclass(frozen=True)
class ScorerSettings:
    """What a prompted run asks of its scorer."""

    model: str
    think: bool
    max_new_tokens: int


@dataclass(frozen=True)
class Prepared:
    sample: DataFrame
    roles: DataFrame
    label_distribution: DataFrame
    fold_distribution: DataFrame
    k: int = V.N_FOLDS


def prepare(
    corpus: DataFrame,
    schema: CorpusSchema,
    n: int = V.SAMPLE_SIZE,
    k: int = V.N_FOLDS,
    val_ratio: float = V.VAL_RATIO,
    seed: int = V.SEED,
    strict: bool = False,
) -> Prepared:
    """Sample, folds and the two tables that show how even they are.

    Sample and roles are written once to the shared folder, since everything after reads them repeatedly. ``strict``
    first counts what ``corpus_checks`` finds and raises on null or repeated ids and on labels that are not 0 or 1.
    """
    require_corpus(corpus, schema)
    if strict:
        found = corpus_checks(corpus, schema).first()
        wrong = {name: found[name] for name in ("null_ids", "repeated_ids", "bad_labels") if found[name]}
        if wrong:
            raise ValueError(f"the corpus fails its checks: {wrong}")
    sample = materialize(S.stratified_subsample(corpus, schema, n, seed))
    roles = materialize(S.fold_roles(sample, schema, k, val_ratio, seed), partition_by=["fold", "role"])
    labels = sample.select(schema.id, *schema.labels)
    test = S.fold_rows(labels, roles, schema, "test")
    return Prepared(
        sample,
        roles,
        stats.label_distribution_compare(corpus, sample, schema),
        stats.fold_label_distribution(test, schema),
        k,
    )


def score_by_prompt(
    prepared: Prepared,
    schema: CorpusSchema,
    model: str,
    mode: str,
    scorer_factory: Callable[[ScorerSettings], Scorer] | Callable[[], Scorer],
    think: bool = False,
    only_fold: int | None = None,
    limit: int | None = None,
    partitions: int | None = None,
    requested_tokens: int = V.NUM_PREDICT,
) -> DataFrame:
    """Prediction rows of one prompted run over the test rows of all folds, or of one.

    The scored table is written before use, so no call is ever repeated by a later stage. A factory that takes an
    argument is handed the run's ``ScorerSettings``: model, thinking and the token budget that follows from them.
    """
    if signature(scorer_factory).parameters:
        budget = token_budget(F.lit(model), F.lit(think), F.lit(requested_tokens))
        # One row: the budget of this run.
        tokens = prepared.roles.sparkSession.range(1).select(budget.alias("budget")).first()["budget"]
        scorer_factory = partial(scorer_factory, ScorerSettings(model, think, int(tokens)))
    test_ids = prepared.roles.where(F.col("role") == "test")
    if only_fold is not None:
        test_ids = test_ids.where(F.col("fold") == only_fold)
    if limit is not None:
        test_ids = S.limit_per_fold(test_ids, schema, limit)
    test = S.fold_rows(prepared.sample, test_ids, schema).drop("role")
    if mode == "few_shot":
        asked = few_shot_messages(test, few_shot_exemplars(prepared.sample, prepared.roles, schema, prepared.k), schema)
    else:
        asked = zero_shot_messages(test, schema)
    run = {"model": F.lit(model), "mode": F.lit(mode), "think": F.lit("think" if think else "nothink")}
    scored = materialize(score_replies(asked.withColumns(run), scorer_factory, partitions=partitions))
    return chat_predictions(scored, schema, [*M.RUN, "fold"])


def train_and_score(
    prepared: Prepared,
    schema: CorpusSchema,
    model: str,
    settings: TrainSettings = TrainSettings(),
    folds: Sequence[int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Prediction rows and training history of one trained run, over all folds unless some are named."""
    folds = range(prepared.k) if folds is None else folds
    scored, history = train_score_folds(prepared.sample, prepared.roles, schema, settings, folds)
    run = {"model": F.lit(model), "mode": F.lit("finetune"), "think": F.lit("nothink")}
    return scored.withColumns(run), history.withColumn("model", F.lit(model))


def chat_run_facts(predictions: DataFrame) -> DataFrame:
    """Parse failures and latencies per run and fold."""
    by = [*M.RUN, "fold"]
    return parse_failure_stats(predictions, by).join(latency_stats(predictions, by).drop("n_calls"), by)


def with_run_facts(metrics: DataFrame, facts: DataFrame) -> DataFrame:
    """Metrics of every run and fold with the facts that some runs have, ready for ``write_fold_metrics``."""
    by = [*M.RUN, "fold"]
    return metrics.join(facts.drop("n_test"), by, "left")


@dataclass(frozen=True)
class Comparison:
    per_fold: DataFrame
    aggregated: DataFrame
    table: DataFrame
    display: DataFrame


def compare(predictions: DataFrame, schema: CorpusSchema) -> Comparison:
    """All result tables from the predictions of any number of runs: one aggregation feeds them."""
    return compare_metrics(M.fold_metrics(predictions, schema), schema)


def compare_metrics(fold_metrics: DataFrame, schema: CorpusSchema) -> Comparison:
    """The same from metrics already computed, such as imported runs."""
    aggregated = M.aggregate_folds(fold_metrics, schema)
    table = M.comparison_table(aggregated, schema)
    return Comparison(M.per_fold_results(fold_metrics), aggregated, table, M.comparison_display(table, schema))
