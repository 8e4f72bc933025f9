"""The registry and the inputs the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.operators.splitting import fold_roles
from foldgauge.schema import CorpusSchema
from foldgauge.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the labelled corpus: documents with labels -------------------------------------------------
DOCS = CorpusSchema(labels=("quality", "toxic"), id="doc_id", text="text")
CORPUS_SQL = """corpus AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def labelled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id")


def written_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold roles as the prepare flow leaves them: a table in the shared folder, split by fold and role."""
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    return materialize(fold_roles(corpus, DOCS), partition_by=["fold", "role"])


# --- the six-label scale table: orders with labels derived from their columns -------------------
ORDERS = CorpusSchema(
    labels=("is_f", "is_p", "is_urgent", "is_high", "is_big", "is_early"), id="o_orderkey", text="o_orderpriority"
)
ORDERS_SQL = """orders_labelled AS (
  SELECT o_orderkey,
    CAST(o_orderstatus = 'F' AS INTEGER) AS is_f,
    CAST(o_orderstatus = 'P' AS INTEGER) AS is_p,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent,
    CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS is_high,
    CAST(o_totalprice > 450000 AS INTEGER) AS is_big,
    CAST(o_orderdate < TIMESTAMP '1995-01-01' AS INTEGER) AS is_early
  FROM orders
)"""


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (status == "F").cast("int").alias("is_f"),
        (status == "P").cast("int").alias("is_p"),
        (priority == "1-URGENT").cast("int").alias("is_urgent"),
        (priority == "2-HIGH").cast("int").alias("is_high"),
        (F.col("o_totalprice") > 450000).cast("int").alias("is_big"),
        (F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")).cast("int").alias("is_early"),
    )


# --- SQL for splits -----------------------------------------------------------------------------
def label_set_sql(schema: CorpusSchema) -> str:
    return " || ".join(f"CAST({label} AS VARCHAR)" for label in schema.labels)


def hash_sql(seed: str, row_id: str) -> str:
    return f"substr(md5({seed} || '|' || CAST({row_id} AS VARCHAR)), 1, 15)"


def folds_sql(schema: CorpusSchema, source: str, k: int = 5, seed: int = 42) -> str:
    """CTE ``folds`` by one global window, the plain definition of what the operator computes in cells."""
    return f"""keyed AS (
  SELECT {schema.id}, {label_set_sql(schema)} AS label_set, {hash_sql(f"'{seed}'", schema.id)} AS h FROM {source}
), folds AS (
  SELECT {schema.id}, label_set,
    CAST((row_number() OVER (ORDER BY label_set, h, {schema.id}) - 1) % {k} AS INTEGER) AS fold FROM keyed
)"""


def roles_sql(schema: CorpusSchema, source: str, k: int = 5, seed: int = 42, inner: int = 10) -> str:
    return f"""{folds_sql(schema, source, k, seed)}, every_fold AS (
  SELECT CAST(g.fold AS INTEGER) AS fold, f.fold = g.fold AS is_test, f.label_set, f.{schema.id},
    {hash_sql(f"CAST({seed} + g.fold AS VARCHAR)", f"f.{schema.id}")} AS h
  FROM folds f CROSS JOIN range({k}) AS g(fold)
), roles AS (
  SELECT fold, {schema.id},
    CASE WHEN is_test THEN 'test'
      WHEN (row_number() OVER (PARTITION BY fold, is_test ORDER BY label_set, h, {schema.id}) - 1) % {inner} = 0
      THEN 'val' ELSE 'train' END AS role
  FROM every_fold
)"""


# --- predictions: noisy copies of the labels, the noise drawn from hashes of ids ----------------
# They exercise the algebra of scoring, parsing and metrics; they say nothing about model quality.
HEX = "0123456789abcdef"
ENCODERS = ("bert_base", "bert_mini")
CHAT_RUNS = (
    ("llm_large", "zero_shot", "nothink"),
    ("llm_large", "few_shot", "nothink"),
    ("llm_small", "zero_shot", "nothink"),
    ("llm_small", "few_shot", "think"),
)


def digit(*parts: Column | str) -> Column:
    """A number from 0 to 15 drawn from the parts."""
    columns = [part if isinstance(part, Column) else F.lit(part) for part in parts]
    text = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.instr(F.lit(HEX), F.substring(F.md5(text.cast("binary")), 1, 1)) - 1


def digit_sql(*parts: str) -> str:
    text = " || '|' || ".join(f"CAST({part} AS VARCHAR)" for part in parts)
    return f"(instr('{HEX}', substr(md5({text}), 1, 1)) - 1)"


def encoder_scores(rows: DataFrame, schema: CorpusSchema, models: tuple[str, ...] = ENCODERS) -> DataFrame:
    """``prob_<label>`` per model for (fold, id, labels) rows."""
    every_model = rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    probs = []
    for label in schema.labels:
        noise = digit("prob", F.col("model"), label, F.col(schema.id)) / F.lit(20.0)
        probs.append(F.when(F.col(label) == 1, F.lit(1.0) - noise).otherwise(noise).alias(f"prob_{label}"))
    return every_model.select(
        "model",
        F.lit("finetune").alias("mode"),
        F.lit("nothink").alias("think"),
        "fold",
        schema.id,
        *[F.col(label).cast("int").alias(f"true_{label}") for label in schema.labels],
        *probs,
    )


def scores_sql(schema: CorpusSchema, source: str, models: tuple[str, ...] = ENCODERS) -> str:
    """CTE ``scores`` from ``folds`` and the labelled source."""
    columns = []
    for label in schema.labels:
        noise = f"{digit_sql(repr('prob'), 'm.model', repr(label), f'f.{schema.id}')} / 20.0"
        noise = f"CAST({noise} AS DOUBLE)"
        columns.append(f"c.{label} AS true_{label}")
        columns.append(f"CASE WHEN c.{label} = 1 THEN CAST(1.0 AS DOUBLE) - {noise} ELSE {noise} END AS prob_{label}")
    names = ", ".join(f"('{m}')" for m in models)
    return f"""scores AS (
  SELECT m.model, 'finetune' AS mode, 'nothink' AS think, f.fold, f.{schema.id}, {", ".join(columns)}
  FROM folds f JOIN {source} c ON f.{schema.id} = c.{schema.id} CROSS JOIN (VALUES {names}) AS m(model)
)"""


def raw_replies(rows: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Replies of the prompted runs in every shape a model produces, with errors and latencies."""
    run = F.explode(
        F.array(*[F.struct(F.lit(a).alias("model"), F.lit(b).alias("mode"), F.lit(c).alias("think")) for a, b, c in CHAT_RUNS])
    )
    every_run = rows.withColumn("run", run).select("run.*", *rows.columns)
    key = [F.col("model"), F.col("mode"), F.col(schema.id)]
    guess = {}
    for label in schema.labels:
        flip = digit("flip", *key[:2], label, key[2]) < 3
        guess[f"g_{label}"] = F.when(flip, 1 - F.col(label)).otherwise(F.col(label)).cast("string")
    shape = digit("shape", *key)

    def whole(render) -> Column:
        fields = []
        for label in schema.labels:
            fields += [F.lit(f'"{label}":'), render(F.col(f"g_{label}")), F.lit(",")]
        return F.concat(F.lit("{"), *fields[:-1], F.lit("}"))

    plain = whole(lambda g: g)
    first = schema.labels[0]
    reply = (
        F.when(shape <= 6, plain)
        .when(shape == 7, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(shape == 8, F.concat(F.lit('Sure: {"note":1} then '), plain, F.lit(" done")))
        .when(shape == 9, whole(lambda g: F.when(g == "1", "true").otherwise("false")))
        .when(shape == 10, whole(lambda g: F.when(g == "1", '"0"').otherwise('""')))
        .when(shape == 11, F.concat(F.lit(f'{{"{first}":'), F.col(f"g_{first}"), F.lit(', "')))
        .when(shape == 12, F.upper(plain))
        .when(shape == 13, F.lit(""))
        .when(shape == 14, F.lit("I cannot say."))
        .otherwise(F.lit("<<error: TimeoutError()>>"))
    )
    seconds = (digit("latency", *key) + 1) * F.lit(0.125)
    return (
        every_run.withColumns(guess)
        .withColumns({"raw_response": reply, "call_error": shape == 15})
        .withColumn("latency_seconds", F.when(F.col("call_error"), 0.0).otherwise(seconds))
        .drop(*guess)
    )


def replies_sql(schema: CorpusSchema, source: str) -> str:
    """CTE ``replies`` from ``folds`` and the labelled source."""
    runs = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in CHAT_RUNS)
    key = ["r.model", "r.mode", f"f.{schema.id}"]
    guesses = ", ".join(
        f"CAST(CASE WHEN {digit_sql(repr('flip'), *key[:2], repr(label), key[2])} < 3 THEN 1 - c.{label} ELSE c.{label} END AS VARCHAR) AS g_{label}"
        for label in schema.labels
    )

    def whole(render) -> str:
        body = " || ',' || ".join(f"'\"{label}\":' || {render(f'g_{label}')}" for label in schema.labels)
        return f"'{{' || {body} || '}}'"

    plain = whole(lambda g: g)
    first = schema.labels[0]
    yes_no = whole(lambda g: f"CASE WHEN {g} = '1' THEN 'true' ELSE 'false' END")
    quoted = whole(lambda g: f"CASE WHEN {g} = '1' THEN '\"0\"' ELSE '\"\"' END")
    return f"""asked AS (
  SELECT r.model, r.mode, r.think, f.fold, f.{schema.id}, {", ".join(f"c.{label}" for label in schema.labels)}, {guesses},
    {digit_sql(repr('shape'), *key)} AS shape,
    ({digit_sql(repr('latency'), *key)} + 1) * CAST(0.125 AS DOUBLE) AS seconds
  FROM folds f JOIN {source} c ON f.{schema.id} = c.{schema.id} CROSS JOIN (VALUES {runs}) AS r(model, mode, think)
), replies AS (
  SELECT model, mode, think, fold, {schema.id}, {", ".join(schema.labels)},
    CASE WHEN shape <= 6 THEN {plain}
      WHEN shape = 7 THEN '```json' || chr(10) || {plain} || chr(10) || '```'
      WHEN shape = 8 THEN 'Sure: {{"note":1}} then ' || {plain} || ' done'
      WHEN shape = 9 THEN {yes_no}
      WHEN shape = 10 THEN {quoted}
      WHEN shape = 11 THEN '{{"{first}":' || g_{first} || ', "'
      WHEN shape = 12 THEN upper({plain})
      WHEN shape = 13 THEN ''
      WHEN shape = 14 THEN 'I cannot say.'
      ELSE '<<error: TimeoutError()>>' END AS raw_response,
    shape = 15 AS call_error,
    CASE WHEN shape = 15 THEN CAST(0 AS DOUBLE) ELSE seconds END AS latency_seconds
  FROM asked
)"""


def parsed_sql(schema: CorpusSchema) -> str:
    """CTE ``parsed`` from ``replies``: labels, stage and failure of each reply."""
    has_key = " OR ".join(f"json_exists(o, '$.{label}')" for label in schema.labels)
    falsy = "('null', 'false', '0', '\"\"', '[]')"
    bits, found = [], []
    for label in schema.labels:
        hit = f"regexp_extract(raw_response, '(?i)\"\\s*{label}\\s*\"\\s*:\\s*([01])', 1)"
        bits.append(
            f"""CAST(CASE WHEN obj IS NOT NULL THEN
        CASE WHEN coalesce(CAST(json_extract(obj, '$.{label}') AS VARCHAR), 'null') IN {falsy} THEN 0 ELSE 1 END
      WHEN {hit} = '1' THEN 1 ELSE 0 END AS INTEGER) AS pred_{label}"""
        )
        found.append(f"{hit} <> ''")
    return f"""objects AS (
  SELECT *, list_filter(
    list_filter(regexp_extract_all(raw_response, '\\{{[^{{}}]*\\}}'), lambda o: json_valid(o)), lambda o: {has_key})[1] AS obj
  FROM replies
), parsed AS (
  SELECT model, mode, think, fold, {schema.id}, {", ".join(schema.labels)}, raw_response, call_error, latency_seconds,
    {", ".join(bits)},
    CASE WHEN obj IS NOT NULL THEN 'json' WHEN {" OR ".join(found)} THEN 'pattern' ELSE 'none' END AS parse_stage,
    obj IS NULL AS parse_failure
  FROM objects
)"""


def metrics_sql(schema: CorpusSchema, source: str, by: str = "model, mode, think, fold") -> str:
    """CTEs ``counts`` (long), ``label_scores`` and ``fold_scores`` from prediction rows in ``source``."""
    long = " UNION ALL ".join(
        f"SELECT {by}, {i} AS label_index, '{label}' AS label, CAST(true_{label} AS BIGINT) AS t, CAST(pred_{label} AS BIGINT) AS p FROM {source}"
        for i, label in enumerate(schema.labels)
    )
    return f"""long AS ({long}), counts AS (
  SELECT {by}, label_index, label, CAST(sum(t * p) AS BIGINT) AS tp, CAST(sum((1 - t) * p) AS BIGINT) AS fp,
    CAST(sum(t * (1 - p)) AS BIGINT) AS fn
  FROM long GROUP BY {by}, label_index, label
), label_scores AS (
  SELECT {by}, label_index, label,
    CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END AS "precision",
    CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0::DOUBLE ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END AS f1,
    tp + fn AS support
  FROM counts
), fold_scores AS (
  SELECT s.*, m.micro_f1 FROM (
    SELECT {by}, list_sum(list(f1 ORDER BY label_index)) / {len(schema.labels)} AS macro_f1 FROM label_scores GROUP BY {by}
  ) s JOIN (
    SELECT {by}, CASE WHEN sum(2 * tp + fp + fn) = 0 THEN 0.0::DOUBLE
      ELSE (2 * sum(tp))::DOUBLE / sum(2 * tp + fp + fn)::DOUBLE END AS micro_f1 FROM counts GROUP BY {by}
  ) m USING ({by})
)"""
