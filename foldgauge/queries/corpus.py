"""Corpus scans, checks and label statistics."""

from pyspark.sql import functions as F

from foldgauge.functions.labels import cardinality, label_set
from foldgauge.operators import splitting as S
from foldgauge.operators import stats
from foldgauge.operators.prompts import clean_negatives as without_labels
from foldgauge.queries.base import (
    CORPUS_SQL,
    DOCS,
    ORDERS,
    ORDERS_SQL,
    folds_sql,
    hash_sql,
    label_set_sql,
    labelled_corpus,
    labelled_orders,
    query,
    roles_sql,
)
from foldgauge.schema import corpus_checks, require_corpus

SAMPLE_N = 100


def sample_sql(schema, source: str, n: int, seed: int = 42) -> str:
    """CTE ``chosen``: the ids of an exactly-n stratified sample."""
    return f"""keyed AS (
  SELECT {schema.id}, {label_set_sql(schema)} AS label_set, {hash_sql(f"'{seed}'", schema.id)} AS h FROM {source}
), sets AS (
  SELECT label_set, count(*) AS n_set, (SELECT count(*) FROM keyed) AS n_all FROM keyed GROUP BY label_set
), shares AS (
  SELECT *, (n_set * {n}) // n_all AS base, (n_set * {n}) % n_all AS remainder FROM sets
), quotas AS (
  SELECT label_set, CASE WHEN n_all <= {n} THEN n_set ELSE base + CASE WHEN
    row_number() OVER (ORDER BY remainder DESC, label_set) <= {n} - (SELECT sum(base) FROM shares) THEN 1 ELSE 0 END
    END AS quota
  FROM shares
), chosen AS (
  SELECT {schema.id} FROM (
    SELECT k.*, q.quota, row_number() OVER (PARTITION BY k.label_set ORDER BY h, {schema.id}) AS r
    FROM keyed k JOIN quotas q USING (label_set)
  ) WHERE r <= quota
)"""


def frequency_sql(schema, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS label, CAST(sum({label}) AS BIGINT) AS "count",
        round_even(sum({label}) * 1000000.0::DOUBLE / count(*), 0) / 1000000.0::DOUBLE AS proportion FROM {source}"""
        for label in schema.labels
    )


@query("labelled_corpus", f"WITH {CORPUS_SQL} SELECT doc_id, text, lang, source, quality, toxic FROM corpus")
def corpus_rows(spark, sf_dir):
    return require_corpus(labelled_corpus(spark, sf_dir), DOCS)


@query(
    "corpus_checks",
    f"""WITH {CORPUS_SQL}, per_id AS (
  SELECT doc_id, count(*) AS n, sum(CASE WHEN quality IN (0, 1) THEN 0 ELSE 1 END + CASE WHEN toxic IN (0, 1) THEN 0 ELSE 1 END) AS bad,
    count(*) FILTER (text IS NULL) AS null_texts FROM corpus GROUP BY doc_id
) SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (doc_id IS NULL), 0) AS BIGINT) AS null_ids,
  count(*) FILTER (n > 1) AS repeated_ids, CAST(sum(bad) AS BIGINT) AS bad_labels, CAST(sum(null_texts) AS BIGINT) AS null_texts
FROM per_id""",
)
def checks(spark, sf_dir):
    return corpus_checks(labelled_corpus(spark, sf_dir), DOCS)


@query("label_frequency", f"WITH {CORPUS_SQL} {frequency_sql(DOCS, 'corpus')}")
def frequency(spark, sf_dir):
    return stats.label_frequency(labelled_corpus(spark, sf_dir), DOCS)


@query("label_frequency_orders", f"WITH {ORDERS_SQL} {frequency_sql(ORDERS, 'orders_labelled')}")
def frequency_orders(spark, sf_dir):
    return stats.label_frequency(labelled_orders(spark, sf_dir), ORDERS)


@query(
    "label_cardinality",
    f"""WITH {CORPUS_SQL} SELECT doc_id, CAST(quality + toxic AS INTEGER) AS n_labels,
  CAST(quality AS VARCHAR) || CAST(toxic AS VARCHAR) AS label_set FROM corpus""",
)
def label_cardinality(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir)
    return corpus.select(
        "doc_id", cardinality(DOCS.labels).alias("n_labels"), label_set(DOCS.labels).alias("label_set")
    )


@query("clean_negatives", f"WITH {CORPUS_SQL} SELECT doc_id, text FROM corpus WHERE quality + toxic = 0")
def negatives(spark, sf_dir):
    return without_labels(labelled_corpus(spark, sf_dir), DOCS).select("doc_id", "text")


@query(
    "single_label_positives",
    f"""WITH {CORPUS_SQL} SELECT label, doc_id, is_single FROM (
  SELECT 'quality' AS label, doc_id, quality + toxic = 1 AS is_single FROM corpus WHERE quality = 1
  UNION ALL SELECT 'toxic', doc_id, quality + toxic = 1 FROM corpus WHERE toxic = 1)""",
)
def positives(spark, sf_dir):
    """Every positive with whether it holds that label alone: the candidates of an exemplar slot."""
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    held = F.filter(
        F.array(*[F.struct(F.lit(label).alias("label"), F.col(label).alias("value")) for label in DOCS.labels]),
        lambda pair: pair["value"] == 1,
    )
    return corpus.select(
        "doc_id", (cardinality(DOCS.labels) == 1).alias("is_single"), F.explode(held).alias("pair")
    ).select(F.col("pair.label").alias("label"), "doc_id", "is_single")


@query(
    "label_distribution_compare",
    f"""WITH {CORPUS_SQL}, {sample_sql(DOCS, 'corpus', SAMPLE_N)},
sample AS (SELECT * FROM corpus WHERE doc_id IN (SELECT doc_id FROM chosen)),
whole AS ({frequency_sql(DOCS, 'corpus')}), part AS ({frequency_sql(DOCS, 'sample')})
SELECT w.label, w."count" AS full_count, w.proportion AS full_proportion, p."count" AS sub_count,
  p.proportion AS sub_proportion FROM whole w JOIN part p USING (label)""",
)
def distribution_compare(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    return stats.label_distribution_compare(corpus, S.stratified_subsample(corpus, DOCS, SAMPLE_N), DOCS)


def fold_distribution_sql(schema, source_sql: str, source: str) -> str:
    sums = ", ".join(f"CAST(sum(c.{label}) AS BIGINT) AS {label}_pos" for label in schema.labels)
    return f"""WITH {source_sql}, {folds_sql(schema, source)}
SELECT f.fold, count(*) AS n_test, {sums} FROM folds f JOIN {source} c ON f.{schema.id} = c.{schema.id} GROUP BY f.fold"""


def _fold_distribution(corpus, schema):
    labels = corpus.select(schema.id, *schema.labels)
    return stats.fold_label_distribution(labels.join(S.stratified_folds(corpus, schema), schema.id), schema)


@query("fold_label_distribution", fold_distribution_sql(DOCS, CORPUS_SQL, "corpus"))
def fold_distribution(spark, sf_dir):
    return _fold_distribution(labelled_corpus(spark, sf_dir), DOCS)


@query("fold_label_distribution_orders", fold_distribution_sql(ORDERS, ORDERS_SQL, "orders_labelled"))
def fold_distribution_orders(spark, sf_dir):
    return _fold_distribution(labelled_orders(spark, sf_dir), ORDERS)


@query(
    "pos_weights",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}, train AS (
  SELECT r.fold, c.* FROM roles r JOIN corpus c ON r.doc_id = c.doc_id WHERE r.role = 'train'
), long AS (SELECT fold, 'quality' AS label, quality AS v FROM train UNION ALL SELECT fold, 'toxic', toxic FROM train)
SELECT fold, label, count(*) AS n_train, CAST(sum(v) AS BIGINT) AS positives,
  least((count(*) - sum(v))::DOUBLE / greatest(sum(v), 1)::DOUBLE, 50.0::DOUBLE) AS pos_weight FROM long GROUP BY fold, label""",
)
def positive_weights(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)
    return stats.pos_weights(S.fold_rows(corpus, S.fold_roles(corpus, DOCS), DOCS, "train"), DOCS)
