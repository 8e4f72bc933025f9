"""Scoring surface, reply parsing, failure and latency statistics, progress."""

from pyspark.sql import functions as F

from foldgauge import fixed_values as V
from foldgauge.functions.scores import sigmoid, token_budget
from foldgauge.operators import splitting as S
from foldgauge.operators.metrics import RUN
from foldgauge.operators.parsing import latency_stats, parse_failure_stats, parse_replies, parse_stage_counts, unfenced
from foldgauge.operators.prompts import zero_shot_messages
from foldgauge.operators.scoring import chat_predictions, inference_progress, score_replies
from foldgauge.queries.base import (
    CORPUS_SQL,
    DOCS,
    ORDERS,
    ORDERS_SQL,
    digit,
    digit_sql,
    folds_sql,
    hash_sql,
    labelled_corpus,
    labelled_orders,
    parsed_sql,
    query,
    raw_replies,
    replies_sql,
    table,
)
from foldgauge.queries.metrics import RUN_SQL, prompted_predictions
from foldgauge.queries.prompts import COMMENTS_SQL
from foldgauge.session import materialize

PARSED = f"WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')}, {replies_sql(DOCS, 'corpus')}, {parsed_sql(DOCS)}"
PARSED_ORDERS = f"WITH {ORDERS_SQL}, {folds_sql(ORDERS, 'orders_labelled')}, {replies_sql(ORDERS, 'orders_labelled')}, {parsed_sql(ORDERS)}"
OUTCOME = "CASE WHEN call_error THEN 'none' ELSE parse_stage END AS parse_stage, parse_failure OR call_error AS parse_failure"


def _replies(corpus, schema):
    labels = corpus.select(schema.id, *schema.labels)
    test = S.stratified_folds(corpus, schema).select("fold", schema.id).join(labels, schema.id)
    return raw_replies(test, schema)


@query(
    "parse_responses",
    f"""{PARSED} SELECT {RUN_SQL}, fold, doc_id, raw_response, pred_quality, pred_toxic, parse_stage, parse_failure FROM parsed""",
)
def responses(spark, sf_dir):
    parsed = parse_replies(_replies(labelled_corpus(spark, sf_dir), DOCS), "raw_response", DOCS.labels)
    return parsed.select(*RUN, "fold", "doc_id", "raw_response", *DOCS.pred_columns, "parse_stage", "parse_failure")


@query(
    "parse_responses_orders",
    f"""{PARSED_ORDERS} SELECT {RUN_SQL}, fold, o_orderkey, {", ".join(ORDERS.pred_columns)}, parse_stage, parse_failure FROM parsed""",
)
def responses_orders(spark, sf_dir):
    parsed = parse_replies(_replies(labelled_orders(spark, sf_dir), ORDERS), "raw_response", ORDERS.labels)
    return parsed.select(*RUN, "fold", "o_orderkey", *ORDERS.pred_columns, "parse_stage", "parse_failure")


@query(
    "unfenced_replies",
    f"""{PARSED} SELECT {RUN_SQL}, fold, doc_id, CASE WHEN starts_with(raw_response, '```')
  THEN raw_response[9:length(raw_response) - 4] ELSE raw_response END AS reply FROM parsed""",
)
def unfenced_replies(spark, sf_dir):
    return _replies(labelled_corpus(spark, sf_dir), DOCS).select(
        *RUN, "fold", "doc_id", unfenced(F.col("raw_response")).alias("reply")
    )


@query(
    "chat_prediction_rows",
    f"""{PARSED} SELECT {RUN_SQL}, fold, doc_id, raw_response, quality AS true_quality, toxic AS true_toxic,
  CASE WHEN call_error THEN 0 ELSE pred_quality END AS pred_quality, CASE WHEN call_error THEN 0 ELSE pred_toxic END AS pred_toxic,
  {OUTCOME}, latency_seconds FROM parsed""",
)
def chat_rows(spark, sf_dir):
    return chat_predictions(_replies(labelled_corpus(spark, sf_dir), DOCS), DOCS, [*RUN, "fold"])


@query(
    "parse_stage_counts",
    f"{PARSED} SELECT {RUN_SQL}, parse_stage, count(*) AS n_replies FROM parsed GROUP BY {RUN_SQL}, parse_stage",
)
def stage_counts(spark, sf_dir):
    parsed = parse_replies(_replies(labelled_corpus(spark, sf_dir), DOCS), "raw_response", DOCS.labels)
    return parse_stage_counts(parsed, RUN)


FAILURES = f"""SELECT {RUN_SQL}, fold, count(*) AS n_test, count(*) FILTER (parse_failure OR call_error) AS parse_failures,
  count(*) FILTER (parse_failure OR call_error)::DOUBLE / count(*) AS parse_failure_rate FROM parsed GROUP BY {RUN_SQL}, fold"""


@query("parse_failure_stats", f"{PARSED} {FAILURES}")
def failure_stats(spark, sf_dir):
    return parse_failure_stats(prompted_predictions(labelled_corpus(spark, sf_dir), DOCS), [*RUN, "fold"])


@query("parse_failure_stats_orders", f"{PARSED_ORDERS} {FAILURES}")
def failure_stats_orders(spark, sf_dir):
    return parse_failure_stats(prompted_predictions(labelled_orders(spark, sf_dir), ORDERS), [*RUN, "fold"])


LATENCY = f"""SELECT {RUN_SQL}, fold, count(*) AS n_calls, sum(latency_seconds) / count(*) AS mean_latency_seconds,
  sum(latency_seconds) AS total_inference_seconds FROM parsed GROUP BY {RUN_SQL}, fold"""


@query("latency_stats", f"{PARSED} {LATENCY}")
def latencies(spark, sf_dir):
    return latency_stats(prompted_predictions(labelled_corpus(spark, sf_dir), DOCS), [*RUN, "fold"])


def progress_sql(schema, parsed: str) -> str:
    return f"""{parsed}, calls AS (
  SELECT {RUN_SQL}, fold, {schema.id}, CAST(parse_failure OR call_error AS BIGINT) AS failed, latency_seconds,
    {hash_sql("'call'", schema.id)} AS h FROM parsed
), totals AS (
  SELECT {RUN_SQL}, fold, row_number() OVER w AS done, count(*) OVER (PARTITION BY {RUN_SQL}, fold) AS n,
    CAST(sum(failed) OVER w AS BIGINT) AS failures, sum(latency_seconds) OVER w AS elapsed_seconds FROM calls
  WINDOW w AS (PARTITION BY {RUN_SQL}, fold ORDER BY h, {schema.id} ROWS UNBOUNDED PRECEDING)
) SELECT {RUN_SQL}, fold, done, n, failures, elapsed_seconds, done / greatest(elapsed_seconds, 1e-6) AS rate,
  (n - done) / greatest(done / greatest(elapsed_seconds, 1e-6), 1e-6) AS eta_seconds
FROM totals WHERE done % 50 = 0 OR done = n"""


def _progress(corpus, schema):
    """Progress of calls already answered: the scored table is written once, as the scoring flow does."""
    columns = [*RUN, "fold", schema.id, "parse_failure", "latency_seconds"]
    calls = materialize(prompted_predictions(corpus, schema).select(columns))
    return inference_progress(calls, schema, [*RUN, "fold"])


@query("inference_progress", progress_sql(DOCS, PARSED))
def progress(spark, sf_dir):
    return _progress(labelled_corpus(spark, sf_dir), DOCS)


@query("inference_progress_orders", progress_sql(ORDERS, PARSED_ORDERS))
def progress_orders(spark, sf_dir):
    return _progress(labelled_orders(spark, sf_dir), ORDERS)


@query(
    "json_props_extract",
    """SELECT event_id, props, CAST(CASE WHEN coalesce(CAST(json_extract(props, '$.k') AS VARCHAR), 'null')
  IN ('null', 'false', '0', '""', '[]') THEN 0 ELSE 1 END AS INTEGER) AS has_k,
  CASE WHEN json_exists(props, '$.k') THEN 'json' ELSE 'none' END AS parse_stage,
  NOT json_exists(props, '$.k') AS parse_failure FROM events""",
)
def props(spark, sf_dir):
    """The reply parser on another JSON column: is key ``k`` there and not empty or zero?"""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_replies(events, "props", ["k"], prefix="has_")


def length_scorer():
    """A stand-in for a model: labels from the length of the question, failing on every seventh length."""

    def score(messages) -> str:
        length = len(messages[-1]["content"])
        if length % 7 == 0:
            raise TimeoutError
        return f'{{"quality":{length % 2},"toxic":{int(length % 3 == 0)}}}'

    return score


@query(
    "score_replies",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, asked AS (
  SELECT doc_id, quality, toxic, length(comment) + {len(V.ZERO_SHOT_PREFIX) + len(V.PROMPT_SUFFIX)} AS n FROM comments
) SELECT doc_id, CASE WHEN n % 7 = 0 THEN '<<error: TimeoutError()>>'
    ELSE '{{"quality":' || n % 2 || ',"toxic":' || CAST(n % 3 = 0 AS INTEGER) || '}}' END AS raw_response,
  quality AS true_quality, toxic AS true_toxic,
  CAST(CASE WHEN n % 7 = 0 THEN 0 ELSE n % 2 END AS INTEGER) AS pred_quality,
  CAST(CASE WHEN n % 7 = 0 THEN 0 ELSE CAST(n % 3 = 0 AS INTEGER) END AS INTEGER) AS pred_toxic,
  CASE WHEN n % 7 = 0 THEN 'none' ELSE 'json' END AS parse_stage, n % 7 = 0 AS parse_failure FROM asked""",
)
def scored(spark, sf_dir):
    asked = zero_shot_messages(labelled_corpus(spark, sf_dir), DOCS)
    return chat_predictions(score_replies(asked, length_scorer), DOCS, []).drop("latency_seconds")


@query(
    "sigmoid_scores",
    f"""WITH {CORPUS_SQL} SELECT doc_id, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(({digit_sql(repr('logit'), 'doc_id')} - 8) / 2.0::DOUBLE))), 9) AS prob,
  CAST({digit_sql(repr('logit'), 'doc_id')} >= 8 AS INTEGER) AS pred FROM corpus""",
)
def sigmoids(spark, sf_dir):
    prob = sigmoid((digit("logit", F.col("doc_id")) - 8) / F.lit(2.0))
    return labelled_corpus(spark, sf_dir).select(
        "doc_id", F.round(prob, 9).alias("prob"), (prob >= V.DECISION_THRESHOLD).cast("int").alias("pred")
    )


MODELS = [(name, think) for name in V.CHAT_NAMES.values() for think in (False, True)]


@query(
    "token_budget",
    f"""WITH {CORPUS_SQL}, models(model, think) AS (VALUES {", ".join(f"('{m}', {t})" for m, t in MODELS)}), asked AS (
  SELECT model, think, CASE WHEN quality = 1 THEN 64 ELSE 1024 END AS requested FROM corpus CROSS JOIN models
) SELECT model, think, requested, CASE WHEN model NOT LIKE 'gpt-oss%' THEN requested
  WHEN think THEN greatest(requested, 2048) ELSE greatest(requested, 512) END AS budget, count(*) AS n_calls
FROM asked GROUP BY model, think, requested""",
)
def budgets(spark, sf_dir):
    """Token budgets of the calls a run over the corpus would make with each model and thinking switch."""
    calls = labelled_corpus(spark, sf_dir).select(
        F.when(F.col("quality") == 1, V.NUM_PREDICT).otherwise(1024).alias("requested"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("think")) for m, t in MODELS])).alias("m"),
    )
    return (
        calls.select("m.*", "requested", token_budget(F.col("m.model"), F.col("m.think"), F.col("requested")).alias("budget"))
        .groupBy("model", "think", "requested", "budget")
        .agg(F.count(F.lit(1)).alias("n_calls"))
    )
