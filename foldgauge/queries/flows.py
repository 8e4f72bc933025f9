"""Runs that are broken off, streams that hold state, and documents with all their facts."""

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldgauge.functions.labels import seeded_hash
from foldgauge.operators import metrics as M
from foldgauge.operators import splitting as S
from foldgauge.operators.prompts import clean_negatives, zero_shot_messages
from foldgauge.operators.scoring import score_with_ledger
from foldgauge.plans import flows
from foldgauge.queries.base import CORPUS_SQL, DOCS, ORDERS, ORDERS_SQL, folds_sql, hash_sql, labelled_corpus, labelled_orders, query, roles_sql, table
from foldgauge.queries.metrics import DOC_COMPARISON, DOC_METRICS, RUN_SQL, all_predictions, doc_comparison, doc_metrics, prompted_predictions
from foldgauge.queries.replies import PARSED, progress_sql
from foldgauge.session import materialize, scratch_dir
from foldgauge.sources import corpus as corpus_io
from foldgauge.sources import folds as folds_io
from foldgauge.sources import runs as runs_io
from foldgauge.streaming.stateful import count_stream, progress_stream, streamed_metrics

K = 5


# --- scoring that goes on where it broke off ----------------------------------------------------
ROUNDS = 4


def answering(name: str):
    """A scorer that signs its replies. A call without messages takes the whole process with it, as a lost client would."""

    def factory():
        def score(messages) -> str:
            if not messages:
                raise SystemExit("the client is gone")
            return name

        return score

    return factory


@query(
    "score_resumed",
    f"""WITH {CORPUS_SQL} SELECT doc_id,
  CASE WHEN CAST('0x' || {hash_sql("'round'", 'doc_id')} AS BIGINT) % {ROUNDS} < 2 THEN 'first' ELSE 'second' END AS raw_response, false AS call_error FROM corpus""",
)
def score_resumed(spark, sf_dir):
    """A run that dies in its third round, and one that asks the rest: each id is answered, and answered once."""
    asked = zero_shot_messages(labelled_corpus(spark, sf_dir), DOCS).select("doc_id", "messages")
    asked, ledger = materialize(asked), scratch_dir(spark)
    number = F.pmod(seeded_hash("round", "doc_id"), F.lit(ROUNDS))
    dying = asked.withColumn("messages", F.when(number < 2, F.col("messages")).otherwise(F.slice("messages", 1, 0)))
    try:
        score_with_ledger(dying, ["doc_id"], answering("first"), ledger, ROUNDS)
    except PySparkException as lost:
        if "the client is gone" not in str(lost):
            raise
    scored = score_with_ledger(asked, ["doc_id"], answering("second"), ledger, ROUNDS, concurrency=4)
    return scored.select("doc_id", "raw_response", "call_error")


# --- streams that hold state --------------------------------------------------------------------
ARRIVALS = 3


def _arrivals(df, number):
    """``df`` as files that arrive one after another, by the third of the hash range their rows lie in."""
    return [df.where(number == i) for i in range(ARRIVALS)]


@query("streamed_comparison", f"{DOC_COMPARISON} SELECT * FROM comparison")
def streamed_comparison(spark, sf_dir):
    """The comparison table from counts kept up to date while prediction files arrive."""
    predictions = materialize(all_predictions(labelled_corpus(spark, sf_dir), DOCS))
    files, updates, checkpoint = (scratch_dir(spark) for _ in range(3))
    for part in _arrivals(predictions, F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))):
        part.write.mode("append").parquet(files)
        stream = spark.readStream.schema(predictions.schema).parquet(files)
        count_stream(stream, DOCS, updates, checkpoint).awaitTermination()
    return flows.compare_metrics(streamed_metrics(spark, DOCS, updates), DOCS).table


@query("streamed_progress", progress_sql(DOCS, PARSED))
def streamed_progress(spark, sf_dir):
    """Progress rows from calls that arrive in the order they were made."""
    by = [*M.RUN, "fold"]
    calls = prompted_predictions(labelled_corpus(spark, sf_dir), DOCS).select(*by, "doc_id", "parse_failure", "latency_seconds")
    calls = materialize(calls.withColumn("h", seeded_hash("call", "doc_id")))
    calls = materialize(calls.join(calls.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), by))
    files, updates, checkpoint = (scratch_dir(spark) for _ in range(3))
    for part in _arrivals(calls, F.floor(F.col("h") / F.lit((1 << 60) // ARRIVALS + 1))):
        part.write.mode("append").parquet(files)
        stream = spark.readStream.schema(calls.schema).parquet(files)
        progress_stream(stream, updates, checkpoint, by, ["h", "doc_id"]).awaitTermination()
    return spark.read.parquet(updates).drop("update")


# --- documents, summaries, imports --------------------------------------------------------------
@query(
    "fold_documents_with_facts",
    f"""{DOC_METRICS}, facts AS (
  SELECT {RUN_SQL}, fold, count(*) AS n_test, CASE WHEN mode <> 'finetune' THEN count(*) FILTER (failed) END AS parse_failures,
    CASE WHEN mode <> 'finetune' THEN count(*) FILTER (failed)::DOUBLE / count(*) END AS parse_failure_rate,
    CASE WHEN mode <> 'finetune' THEN sum(seconds) / count(*) END AS mean_latency_seconds, CASE WHEN mode <> 'finetune' THEN sum(seconds) END AS total_inference_seconds
  FROM (SELECT {RUN_SQL}, fold, parse_failure OR call_error AS failed, latency_seconds AS seconds FROM parsed
    UNION ALL SELECT {RUN_SQL}, fold, NULL, NULL FROM scores) GROUP BY {RUN_SQL}, fold
) SELECT * FROM facts""",
)
def documents_with_facts(spark, sf_dir):
    """Metrics documents that also hold parse failures and latencies, written and read back."""
    corpus, path = labelled_corpus(spark, sf_dir), scratch_dir(spark)
    facts = flows.chat_run_facts(prompted_predictions(corpus, DOCS))
    runs_io.write_fold_metrics(flows.with_run_facts(doc_metrics(spark, sf_dir), facts), path, DOCS)
    names = ["n_test", "parse_failures", "parse_failure_rate", "mean_latency_seconds", "total_inference_seconds"]
    return runs_io.read_fold_metrics(spark, path, DOCS).select(*M.RUN, "fold", *names)


@query(
    "run_summary_sink",
    f"{DOC_COMPARISON} SELECT {RUN_SQL}, CAST(n_folds AS BIGINT) AS n_folds, macro_f1_mean, micro_f1_mean FROM comparison WHERE n_folds = 5",
)
def summary_sink(spark, sf_dir):
    """Summaries of whole runs as documents; a run with a row limit writes none."""
    path = scratch_dir(spark)
    whole = doc_comparison(spark, sf_dir)
    runs_io.write_run_summary(M.run_summary(whole, K), f"{path}/whole")
    runs_io.write_run_summary(M.run_summary(whole, K, limited=True), f"{path}/limited")
    schema = "n_folds long, macro_f1_mean double, micro_f1_mean double, model string, mode string, think string"
    both = [runs_io.read_or_empty(spark, f"{path}/{name}", schema, "json") for name in ("whole", "limited")]
    return both[0].unionByName(both[1])


@query(
    "import_run_tree",
    f"{DOC_METRICS} SELECT {RUN_SQL}, fold, macro_f1, micro_f1 FROM fold_scores",
)
def run_tree(spark, sf_dir):
    """A tree of run folders, one document for each run and fold, exported and imported again."""
    path = scratch_dir(spark)
    runs_io.export_run_tree(doc_metrics(spark, sf_dir), path, DOCS)
    return runs_io.import_run_tree(spark, path, DOCS).select(*M.RUN, "fold", "macro_f1", "micro_f1")


@query("positional_folds", f"WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')} SELECT fold, doc_id, role FROM roles")
def positional_folds(spark, sf_dir):
    """Folds given as row positions of a corpus file become roles of ids."""
    path = scratch_dir(spark)
    corpus = materialize(labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels))
    folds_io.write_positional_folds(S.fold_roles(corpus, DOCS), corpus, DOCS, path)
    return folds_io.positional_to_roles(folds_io.read_positional_folds(spark, path), corpus, DOCS)


@query("sample_table", f"WITH {CORPUS_SQL} SELECT doc_id, text, quality, toxic FROM corpus WHERE quality = 0")
def sample_table(spark, sf_dir):
    """The stored sample, read with its filter and columns pushed into the scan."""
    path = scratch_dir(spark)
    labelled_corpus(spark, sf_dir).select("doc_id", "text", *DOCS.labels).write.parquet(path)
    return corpus_io.read_corpus(spark, path, DOCS).where("quality = 0")


@query("first_ten_labels", "SELECT count(*) AS n_rows, true AS from_the_table FROM (SELECT * FROM labels LIMIT 10)")
def first_ten(spark, sf_dir):
    """A look at ten rows: which ten is not defined, that they are rows of the table is."""
    labels = table(spark, sf_dir, "labels")
    seen = corpus_io.head(labels)
    known = seen.join(labels.withColumn("known", F.lit(1)), ["doc_id", "quality", "toxic"], "left")
    return known.agg(F.count(F.lit(1)).alias("n_rows"), (F.count("known") == F.count(F.lit(1))).alias("from_the_table"))


@query("missing_table", f"{DOC_METRICS} SELECT {RUN_SQL}, fold, CAST(NULL AS DOUBLE) AS seconds FROM fold_scores")
def missing_table(spark, sf_dir):
    """A table that was never written reads as empty, and what joins it shows blanks."""
    times = runs_io.read_or_empty(spark, scratch_dir(spark), "model string, mode string, think string, fold int, seconds double")
    return doc_metrics(spark, sf_dir).select(*M.RUN, "fold").join(times, [*M.RUN, "fold"], "left")


@query(
    "limit_per_fold_orders",
    f"""WITH {ORDERS_SQL}, {folds_sql(ORDERS, 'orders_labelled')} SELECT fold, o_orderkey FROM (
  SELECT fold, o_orderkey, row_number() OVER (PARTITION BY fold ORDER BY o_orderkey) AS r FROM folds) WHERE r <= 1500""",
)
def limited_orders(spark, sf_dir):
    """A larger smoke run: the first 1,500 test rows of each fold."""
    return S.limit_per_fold(S.stratified_folds(labelled_orders(spark, sf_dir), ORDERS).select("fold", "o_orderkey"), ORDERS, 1500)


@query(
    "clean_negatives_unused",
    f"""WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')}
SELECT doc_id FROM corpus WHERE quality = 0 AND toxic = 0 AND doc_id NOT IN (SELECT doc_id FROM folds WHERE fold = 0)""",
)
def unused_negatives(spark, sf_dir):
    """Rows without a label whose ids no earlier choice has used."""
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    return clean_negatives(corpus, DOCS, S.stratified_folds(corpus, DOCS).where("fold = 0")).select("doc_id")
