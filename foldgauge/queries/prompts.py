"""Prompt construction over the corpus."""

from pyspark.sql import functions as F

from foldgauge import fixed_values as V
from foldgauge.functions.labels import labels_json as label_json
from foldgauge.functions.text import render_messages
from foldgauge.operators import prompts as P
from foldgauge.operators import splitting as S
from foldgauge.queries.base import (
    CORPUS_SQL,
    DOCS,
    ORDERS,
    ORDERS_SQL,
    hash_sql,
    labelled_corpus,
    labelled_orders,
    query,
    roles_sql,
    table,
    written_roles,
)
from foldgauge.queries.cleaning import steps_sql
from foldgauge.schema import CorpusSchema

K = 5


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


COMMENTS_SQL = f"""{steps_sql('corpus', 'doc_id, quality, toxic', 'text')}, comments AS (
  SELECT doc_id, quality, toxic, CASE WHEN length(trim(t_blank_run)) > 800
    THEN substr(trim(t_blank_run), 1, 800) || ' ...' ELSE trim(t_blank_run) END AS comment FROM s_blank_run
)"""
EXEMPLARS_SQL = f"""candidates AS (
  SELECT r.fold, c.doc_id, c.quality, c.toxic, c.quality + c.toxic AS card, {hash_sql("'0'", 'c.doc_id')} AS h
  FROM roles r JOIN corpus c ON r.doc_id = c.doc_id WHERE r.role = 'train'
), slots AS (
  SELECT 0 AS slot, *, row_number() OVER (PARTITION BY fold ORDER BY card <> 1, h, doc_id) AS r, 1 AS n FROM candidates WHERE quality = 1
  UNION ALL SELECT 1, *, row_number() OVER (PARTITION BY fold ORDER BY card <> 1, h, doc_id), 1 FROM candidates WHERE toxic = 1
  UNION ALL SELECT 2, *, row_number() OVER (PARTITION BY fold ORDER BY h, doc_id), 2 FROM candidates WHERE card = 0
), exemplars AS (
  SELECT s.fold, CAST(s.slot + s.r - 1 AS INTEGER) AS slot, s.doc_id, c.comment AS text, s.quality, s.toxic
  FROM slots s JOIN comments c ON s.doc_id = c.doc_id WHERE s.r <= s.n
)"""
JSON_SQL = """'{"quality":' || quality || ',"toxic":' || toxic || '}'"""
PREFIXES_SQL = f"""prefixes AS (
  SELECT fold, {quoted(V.FEW_SHOT_HEADER)} || string_agg({quoted(V.FEW_SHOT_TEXT_PREFIX)} || text || {quoted(V.FEW_SHOT_JSON_PREFIX)}
    || {JSON_SQL} || {quoted(V.FEW_SHOT_EXEMPLAR_END)}, '' ORDER BY slot) AS prefix FROM exemplars GROUP BY fold
)"""


def _messages(df, *keep):
    return df.select(
        *keep,
        F.get("messages", F.lit(0))["content"].alias("system_content"),
        F.get("messages", F.lit(1))["content"].alias("user_content"),
        render_messages(F.col("messages")).alias("rendered"),
    )


def messages_sql(keep: str, user: str, source: str) -> str:
    system = quoted(V.SYSTEM_PROMPT)
    return f"""SELECT {keep}, {system} AS system_content, {user} AS user_content,
  '[SYSTEM]' || chr(10) || {system} || chr(10) || chr(10) || '[USER]' || chr(10) || {user} AS rendered FROM {source}"""


@query("truncate_text", f"WITH {CORPUS_SQL}, {COMMENTS_SQL} SELECT doc_id, comment FROM comments")
def truncate_text(spark, sf_dir):
    return P.truncated_comments(labelled_corpus(spark, sf_dir), DOCS).select("doc_id", "comment")


@query("labels_json", f"WITH {CORPUS_SQL} SELECT doc_id, {JSON_SQL} AS json FROM corpus")
def labels_json(spark, sf_dir):
    return labelled_corpus(spark, sf_dir).select("doc_id", label_json(DOCS.labels).alias("json"))


@query(
    "labels_json_orders",
    f"""WITH {ORDERS_SQL} SELECT o_orderkey, '{{' || {" || ',' || ".join(f"'\"{label}\":' || {label}" for label in ORDERS.labels)} || '}}' AS json
FROM orders_labelled""",
)
def labels_json_orders(spark, sf_dir):
    return labelled_orders(spark, sf_dir).select("o_orderkey", label_json(ORDERS.labels).alias("json"))


@query(
    "zero_shot_messages",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}
{messages_sql('doc_id', f"{quoted(V.ZERO_SHOT_PREFIX)} || comment || {quoted(V.PROMPT_SUFFIX)}", 'comments')}""",
)
def zero_shot(spark, sf_dir):
    return _messages(P.zero_shot_messages(labelled_corpus(spark, sf_dir), DOCS), "doc_id")


@query(
    "few_shot_exemplars",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, {roles_sql(DOCS, 'corpus')}, {EXEMPLARS_SQL}
SELECT fold, slot, doc_id, text, quality, toxic FROM exemplars""",
)
def exemplars(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir)
    return P.few_shot_exemplars(corpus, written_roles(spark, sf_dir), DOCS, K, texts=table(spark, sf_dir, "documents"))


@query(
    "few_shot_messages",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, {roles_sql(DOCS, 'corpus')}, {EXEMPLARS_SQL}, {PREFIXES_SQL}, asked AS (
  SELECT r.fold, c.doc_id, c.comment, p.prefix FROM roles r JOIN comments c ON r.doc_id = c.doc_id JOIN prefixes p ON r.fold = p.fold
  WHERE r.role = 'test'
) {messages_sql('fold, doc_id', f"prefix || {quoted(V.FEW_SHOT_QUERY_PREFIX)} || comment || {quoted(V.PROMPT_SUFFIX)}", 'asked')}""",
)
def few_shot(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir)
    roles = written_roles(spark, sf_dir)
    test = S.fold_rows(corpus.select("doc_id", "text"), roles, DOCS, "test")
    chosen = P.few_shot_exemplars(corpus, roles, DOCS, K, texts=table(spark, sf_dir, "documents"))
    return _messages(P.few_shot_messages(test, chosen, DOCS), "fold", "doc_id")


TEMPLATES_SQL = f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, {roles_sql(DOCS, 'corpus')}, {EXEMPLARS_SQL}, {PREFIXES_SQL}, holes AS (
  SELECT 'zero_shot' AS mode, fold, {quoted(V.ZERO_SHOT_PREFIX)} AS lead FROM (SELECT DISTINCT fold FROM roles)
  UNION ALL SELECT 'few_shot', fold, prefix || {quoted(V.FEW_SHOT_QUERY_PREFIX)} FROM prefixes
), templates AS (
  SELECT mode, fold, '[SYSTEM]' || chr(10) || {quoted(V.SYSTEM_PROMPT)} || chr(10) || chr(10) || '[USER]' || chr(10)
    || lead || {quoted(V.TEMPLATE_PLACEHOLDER)} || {quoted(V.PROMPT_SUFFIX)} AS template FROM holes
)"""


@query("prompt_templates", f"{TEMPLATES_SQL} SELECT mode, fold, template FROM templates")
def templates(spark, sf_dir):
    corpus, roles = labelled_corpus(spark, sf_dir), written_roles(spark, sf_dir)
    return P.prompt_templates(P.few_shot_exemplars(corpus, roles, DOCS, K, texts=table(spark, sf_dir, "documents")), roles, DOCS)


# --- six labels: one that no row holds alone, and one that no row holds -------------------------
SIX = CorpusSchema(labels=("is_f", "is_big_f", "is_never", "is_urgent", "is_p", "is_early"), id="o_orderkey", text="note")
SIX_SQL = """six AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || ' ' || o_orderpriority AS note, CAST(o_orderstatus = 'F' AS INTEGER) AS is_f,
    CAST(o_orderstatus = 'F' AND o_totalprice > 300000 AS INTEGER) AS is_big_f, CAST(o_totalprice < 0 AS INTEGER) AS is_never,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent, CAST(o_orderstatus = 'P' AS INTEGER) AS is_p,
    CAST(o_orderdate < TIMESTAMP '1995-01-01' AS INTEGER) AS is_early FROM orders
)"""


def six_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    flags = {
        "is_f": F.col("o_orderstatus") == "F",
        "is_big_f": (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000),
        "is_never": F.col("o_totalprice") < 0,
        "is_urgent": F.col("o_orderpriority") == "1-URGENT",
        "is_p": F.col("o_orderstatus") == "P",
        "is_early": F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp"),
    }
    note = F.concat_ws(" ", F.col("o_custkey").cast("string"), "o_orderpriority")
    return orders.select("o_orderkey", note.alias("note"), *[value.cast("int").alias(name) for name, value in flags.items()])


def six_exemplars_sql(k: int) -> str:
    labels = ", ".join(SIX.labels)
    order = f"ORDER BY card > 1, h, {SIX.id}"
    slots = [f"SELECT {i} AS slot, *, row_number() OVER (PARTITION BY fold {order}) AS r, 1 AS n FROM candidates WHERE {label} = 1" for i, label in enumerate(SIX.labels)]
    slots.append(f"SELECT {len(SIX.labels)}, *, row_number() OVER (PARTITION BY fold {order}), 2 FROM candidates WHERE card = 0")
    return f"""WITH {SIX_SQL}, {roles_sql(SIX, 'six', k)}, candidates AS (
  SELECT r.fold, c.*, {' + '.join(SIX.labels)} AS card, {hash_sql("'0'", f'c.{SIX.id}')} AS h
  FROM roles r JOIN six c ON r.{SIX.id} = c.{SIX.id} WHERE r.role = 'train'
), slots AS ({' UNION ALL '.join(slots)})
SELECT fold, CAST(slot + r - 1 AS INTEGER) AS slot, {SIX.id}, note AS text, {labels} FROM slots WHERE r <= n"""


@query("few_shot_exemplars_six", six_exemplars_sql(K))
def exemplars_six(spark, sf_dir):
    """Slot 1 has no row with its label alone and takes one with others beside it; slot 2 has no row and stays empty."""
    corpus = six_labels(spark, sf_dir)
    return P.few_shot_exemplars(corpus, S.fold_roles(corpus, SIX), SIX, K)


@query("few_shot_ten_folds", six_exemplars_sql(10))
def exemplars_ten_folds(spark, sf_dir):
    corpus = six_labels(spark, sf_dir)
    return P.few_shot_exemplars(corpus, S.fold_roles(corpus, SIX, 10), SIX)


@query(
    "clean_then_prompt",
    f"""WITH {CORPUS_SQL}, {COMMENTS_SQL}, {roles_sql(DOCS, 'corpus')}, {EXEMPLARS_SQL}, {PREFIXES_SQL}
SELECT r.fold, c.doc_id, 'mine ' || c.doc_id AS comment, lang AS prefix, source AS cleaned_comment, 7 AS block,
  prefixes.prefix || {quoted(V.FEW_SHOT_QUERY_PREFIX)} || comments.comment || {quoted(V.PROMPT_SUFFIX)} AS few,
  {quoted(V.ZERO_SHOT_PREFIX)} || comments.comment || {quoted(V.PROMPT_SUFFIX)} AS zero
FROM roles r JOIN corpus c ON r.doc_id = c.doc_id JOIN comments ON comments.doc_id = c.doc_id JOIN prefixes ON prefixes.fold = r.fold
WHERE r.role = 'test'""",
)
def clean_then_prompt(spark, sf_dir):
    """Columns of the user that are named like the operators' own come through prompts as they were."""
    corpus, roles = labelled_corpus(spark, sf_dir), written_roles(spark, sf_dir)
    mine = corpus.select(
        "doc_id", "text", F.concat(F.lit("mine "), F.col("doc_id").cast("string")).alias("comment"), F.col("lang").alias("prefix"), F.col("source").alias("cleaned_comment"), F.lit(7).alias("block")
    )
    chosen = P.few_shot_exemplars(corpus, roles, DOCS, K, texts=table(spark, sf_dir, "documents"))
    asked = P.few_shot_messages(S.fold_rows(mine, roles, DOCS, "test"), chosen, DOCS)
    asked = P.zero_shot_messages(asked.withColumn("few", F.get("messages", F.lit(1))["content"]), DOCS)
    return asked.select("fold", "doc_id", "comment", "prefix", "cleaned_comment", "block", "few", F.get("messages", F.lit(1))["content"].alias("zero"))


TRANSCRIPT_CHARS = 2000


@query(
    "render_transcripts",
    f"""WITH blocks AS (
  SELECT conv_id, turn, '[' || upper(coalesce(role, '')) || ']' || chr(10) || coalesce(text, '') AS block FROM conversations
), placed AS (
  SELECT *, coalesce(sum(length(block) + 2) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM blocks
) SELECT conv_id, CAST(ahead // {TRANSCRIPT_CHARS} AS BIGINT) AS part, count(*) AS n_turns,
  string_agg(block, chr(10) || chr(10) ORDER BY ahead) AS text FROM placed GROUP BY conv_id, ahead // {TRANSCRIPT_CHARS}""",
)
def transcripts(spark, sf_dir):
    """Whole conversations in turn order, in parts that stay bounded however long a conversation is."""
    return P.render_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", TRANSCRIPT_CHARS)


@query(
    "render_conversations",
    "SELECT conv_id, turn, '[' || upper(role) || ']' || chr(10) || text AS block FROM conversations",
)
def conversations(spark, sf_dir):
    return P.render_turns(table(spark, sf_dir, "conversations"), "role", "text").select("conv_id", "turn", "block")
