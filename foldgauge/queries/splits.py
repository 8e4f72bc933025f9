"""Folds, samples, roles and leak checks."""

from pyspark.sql import functions as F

from foldgauge.operators import splitting as S
from foldgauge.operators import stats
from foldgauge.operators.prompts import few_shot_exemplars
from foldgauge.queries.base import (
    CORPUS_SQL,
    DOCS,
    ORDERS,
    ORDERS_SQL,
    folds_sql,
    labelled_corpus,
    labelled_orders,
    query,
    roles_sql,
    table,
    written_roles,
)
from foldgauge.queries.corpus import SAMPLE_N, sample_sql
from foldgauge.schema import CorpusSchema, unmatched_rows

K = 5


def _labels(spark, sf_dir):
    return labelled_corpus(spark, sf_dir).select("doc_id", *DOCS.labels)


@query("stratified_folds", f"WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')} SELECT doc_id, label_set, fold FROM folds")
def folds(spark, sf_dir):
    return S.stratified_folds(_labels(spark, sf_dir), DOCS)


@query(
    "stratified_folds_orders",
    f"WITH {ORDERS_SQL}, {folds_sql(ORDERS, 'orders_labelled')} SELECT o_orderkey, label_set, fold FROM folds",
)
def folds_orders(spark, sf_dir):
    return S.stratified_folds(labelled_orders(spark, sf_dir), ORDERS)


@query("nested_fold_roles", f"WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')} SELECT fold, doc_id, role FROM roles")
def roles(spark, sf_dir):
    return S.fold_roles(_labels(spark, sf_dir), DOCS)


@query(
    "nested_fold_roles_orders",
    f"WITH {ORDERS_SQL}, {roles_sql(ORDERS, 'orders_labelled')} SELECT fold, o_orderkey, role FROM roles",
)
def roles_orders(spark, sf_dir):
    return S.fold_roles(labelled_orders(spark, sf_dir), ORDERS)


@query(
    "fold_role_sizes",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')} SELECT fold, count(*) FILTER (role = 'train') AS n_train,
  count(*) FILTER (role = 'val') AS n_val, count(*) FILTER (role = 'test') AS n_test FROM roles GROUP BY fold""",
)
def role_sizes(spark, sf_dir):
    return stats.fold_role_sizes(S.fold_roles(_labels(spark, sf_dir), DOCS))


@query(
    "fold_rows",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}
SELECT r.fold, r.role, c.doc_id, c.lang, c.source, c.quality, c.toxic FROM roles r JOIN corpus c ON r.doc_id = c.doc_id""",
)
def rows_of_folds(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir).drop("text")
    return S.fold_rows(corpus, S.fold_roles(corpus, DOCS), DOCS)


@query(
    "only_fold",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}
SELECT r.role, count(*) AS n_rows FROM roles r JOIN corpus c ON r.doc_id = c.doc_id WHERE r.fold = 2 GROUP BY r.role""",
)
def only_fold(spark, sf_dir):
    """One fold of the cross-validation: a filter on the fold column."""
    corpus = _labels(spark, sf_dir)
    rows = S.fold_rows(corpus, S.fold_roles(corpus, DOCS), DOCS)
    return rows.where(F.col("fold") == 2).groupBy("role").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "limit_per_fold",
    f"""WITH {CORPUS_SQL}, {folds_sql(DOCS, 'corpus')} SELECT fold, doc_id FROM (
  SELECT fold, doc_id, row_number() OVER (PARTITION BY fold ORDER BY doc_id) AS r FROM folds) WHERE r <= 10""",
)
def limited(spark, sf_dir):
    """A smoke run's rows: the first ten test rows of each fold, chosen from all of them."""
    return S.limit_per_fold(S.stratified_folds(_labels(spark, sf_dir), DOCS).select("fold", "doc_id"), DOCS, 10)


@query(
    "stratified_subsample",
    f"""WITH {CORPUS_SQL}, {sample_sql(DOCS, 'corpus', SAMPLE_N)}
SELECT doc_id, text, quality, toxic FROM corpus WHERE doc_id IN (SELECT doc_id FROM chosen)""",
)
def subsample(spark, sf_dir):
    corpus = labelled_corpus(spark, sf_dir).select("doc_id", "text", *DOCS.labels)
    return S.stratified_subsample(corpus, DOCS, SAMPLE_N)


@query(
    "stratified_subsample_orders",
    f"""WITH {ORDERS_SQL}, {sample_sql(ORDERS, 'orders_labelled', 8000)}
SELECT * FROM orders_labelled WHERE o_orderkey IN (SELECT o_orderkey FROM chosen)""",
)
def subsample_orders(spark, sf_dir):
    return S.stratified_subsample(labelled_orders(spark, sf_dir), ORDERS)


@query(
    "sample_remainder",
    f"""WITH {CORPUS_SQL}, {sample_sql(DOCS, 'corpus', SAMPLE_N)}
SELECT doc_id, quality, toxic FROM corpus WHERE doc_id NOT IN (SELECT doc_id FROM chosen)""",
)
def remainder(spark, sf_dir):
    return S.sample_remainder(_labels(spark, sf_dir), DOCS, SAMPLE_N)


@query(
    "sample_union_complete",
    f"""WITH {CORPUS_SQL} SELECT count(*) AS matched, CAST(0 AS BIGINT) AS left_only, CAST(0 AS BIGINT) AS right_only FROM corpus""",
)
def union_complete(spark, sf_dir):
    """Sample and remainder put together are the corpus: nothing lost, nothing twice."""
    corpus = _labels(spark, sf_dir)
    together = S.stratified_subsample(corpus, DOCS, SAMPLE_N).unionByName(S.sample_remainder(corpus, DOCS, SAMPLE_N))
    return unmatched_rows(corpus, together, ["doc_id"])


@query(
    "leakage_check",
    f"""WITH {CORPUS_SQL}, {roles_sql(DOCS, 'corpus')}
SELECT fold, count(*) AS n_ids, CAST(0 AS BIGINT) AS multi_role, CAST(0 AS BIGINT) AS exemplars_outside_train
FROM roles GROUP BY fold""",
)
def leaks(spark, sf_dir):
    roles = written_roles(spark, sf_dir)
    return S.leakage_check(roles, few_shot_exemplars(
        labelled_corpus(spark, sf_dir), roles, DOCS, K, texts=table(spark, sf_dir, "documents")
    ), DOCS)


# --- very many label combinations: 17 labels from the bits of two keys, over 100,000 combinations at sf0.1 -------
MANY = CorpusSchema(labels=tuple(f"bit_{i}" for i in range(17)), id="line_id", text="l_comment")
_BITS = [("l_partkey", i) for i in range(9)] + [("l_orderkey", i) for i in range(8)]
MANY_SQL = f"""lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS line_id,
    {', '.join(f'CAST(({key} >> {i}) & 1 AS INTEGER) AS {label}' for label, (key, i) in zip(MANY.labels, _BITS))}
  FROM lineitem
)"""


def many_label_sets(spark, sf_dir):
    line_id = F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")))
    bits = [F.shiftright(key, i).bitwiseAND(F.lit(1)).cast("int").alias(label) for label, (key, i) in zip(MANY.labels, _BITS)]
    return table(spark, sf_dir, "lineitem").select(line_id.alias("line_id"), *bits)


@query("stratified_folds_many", f"WITH {MANY_SQL}, {folds_sql(MANY, 'lines')} SELECT line_id, label_set, fold FROM folds")
def folds_many(spark, sf_dir):
    return S.stratified_folds(many_label_sets(spark, sf_dir), MANY)


@query(
    "fold_bounds_many",
    f"""WITH {MANY_SQL}, {folds_sql(MANY, 'lines')}, cells AS (
  SELECT label_set, {', '.join(f'count(*) FILTER (fold = {f}) AS n{f}' for f in range(K))} FROM folds GROUP BY label_set
) SELECT count(*) AS n_label_sets, CAST(sum({' + '.join(f'n{f}' for f in range(K))}) AS BIGINT) AS n_rows,
  greatest({', '.join(f'sum(n{f})' for f in range(K))}) - least({', '.join(f'sum(n{f})' for f in range(K))}) <= 1 AS even_folds,
  max(greatest({', '.join(f'n{f}' for f in range(K))}) - least({', '.join(f'n{f}' for f in range(K))})) <= 1 AS even_label_sets FROM cells""",
)
def bounds_many(spark, sf_dir):
    """Fold sizes, and the share of every label combination, differ by at most one row between folds."""
    dealt = S.stratified_folds(many_label_sets(spark, sf_dir), MANY)
    per_fold = [F.sum((F.col("fold") == f).cast("long")).alias(f"n{f}") for f in range(K)]
    names = [f"n{f}" for f in range(K)]
    sums = [F.sum(n) for n in names]
    return dealt.groupBy("label_set").agg(*per_fold).agg(
        F.count(F.lit(1)).alias("n_label_sets"),
        F.sum(sum((F.col(n) for n in names[1:]), F.col(names[0]))).alias("n_rows"),
        (F.greatest(*sums) - F.least(*sums) <= 1).alias("even_folds"),
        (F.max(F.greatest(*names) - F.least(*names)) <= 1).alias("even_label_sets"),
    )


@query(
    "sampled_ids_many",
    f"""WITH {MANY_SQL}, {sample_sql(MANY, 'lines', 8000)} SELECT line_id FROM chosen""",
)
def sampled_many(spark, sf_dir):
    return S.sampled_ids(many_label_sets(spark, sf_dir), MANY, 8000)
