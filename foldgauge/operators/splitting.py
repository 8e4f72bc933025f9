"""Stratified folds, nested validation parts, exact-size samples and leak checks.

Rows are ordered inside each joint label combination by a seeded hash of their id and dealt round robin,
so fold sizes and the share of every label combination differ by at most one row between folds. The order
depends on ids only: any cluster size, partitioning or retry gives the same split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldgauge.fixed_values import N_FOLDS, SAMPLE_SIZE, SEED, VAL_RATIO
from foldgauge.functions.labels import label_set, seeded_hash
from foldgauge.operators.ranking import BROADCAST_ROWS, CELL_ROWS, first_n_pruned, first_rows, refined_cells, running_positions, totals_before
from foldgauge.schema import CorpusSchema
from foldgauge.session import materialize



def most_label_sets(schema: CorpusSchema) -> int:
    """There are no more label combinations than this."""
    return 1 << len(schema.labels)


def keyed_rows(df: DataFrame, schema: CorpusSchema, seed: int = SEED) -> DataFrame:
    """Id, label combination and hash. Text never enters a split shuffle."""
    return df.select(schema.id, label_set(schema.labels).alias("label_set"), seeded_hash(seed, schema.id).alias("h"))


def deal_round_robin(
    keyed: DataFrame, schema: CorpusSchema, parts: Column | int, by: Sequence[str] = (), most_groups: int | None = None, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Adds ``part``: rows of each ``by`` group, laid out by label combination, dealt over ``parts``.

    The place of a row is the start of its label combination, plus the rows in earlier cells, plus its
    place in its cell, which one task sorts. The first two are known per cell, so rows meet them in one join on the window's own
    keys: nothing is ever shuffled by label combination alone, one of which may hold most of the corpus. Results do not depend on
    cells, since they are prefixes of the hash that rows are ordered by.
    """
    group = [*by, "label_set"]
    rows, cells = refined_cells(keyed, group, "h", cell_rows=cell_rows)
    placed = running_positions(rows, group, "cell", ["h", schema.id], start_groups=by, most_groups=most_groups, cells=cells)
    parts = parts if isinstance(parts, Column) else F.lit(parts)
    return placed.select(
        *keyed.columns, F.pmod(F.col("group_start") + F.col("position") - 1, parts).cast("int").alias("part")
    )


def stratified_folds(
    df: DataFrame, schema: CorpusSchema, k: int = N_FOLDS, seed: int = SEED, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``(id, label_set, fold)``: each row is in the test part of exactly one fold."""
    dealt = deal_round_robin(keyed_rows(df, schema, seed), schema, k, most_groups=most_label_sets(schema), cell_rows=cell_rows)
    return dealt.select(schema.id, "label_set", F.col("part").alias("fold"))


def fold_roles(
    df: DataFrame,
    schema: CorpusSchema,
    k: int = N_FOLDS,
    val_ratio: float = VAL_RATIO,
    seed: int = SEED,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(fold, id, role)`` for all folds at once; role is train, val or test.

    The rows outside a fold's test part are dealt again with seed ``seed + fold``; the first of
    ``round(1 / val_ratio)`` parts validates. Test rows ride along as a group of their own, so all folds
    and roles come out of one shuffle of k rows per corpus row, which is the size of the result.
    """
    inner_parts = max(2, round(1.0 / val_ratio))
    most = most_label_sets(schema)
    outer = deal_round_robin(keyed_rows(df, schema, seed), schema, k, most_groups=most, cell_rows=cell_rows)
    every_fold = outer.select(
        F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"), F.col("part"), schema.id, "label_set"
    ).select(
        "fold",
        (F.col("part") == F.col("fold")).alias("is_test"),
        "label_set",
        schema.id,
        seeded_hash(F.col("fold") + F.lit(seed), schema.id).alias("h"),
    )
    dealt = deal_round_robin(every_fold, schema, inner_parts, ["fold", "is_test"], 2 * k * most, cell_rows)
    role = F.when(F.col("is_test"), "test").when(F.col("part") == 0, "val").otherwise("train")
    return dealt.select("fold", schema.id, role.alias("role"))


def label_set_quotas(df: DataFrame, schema: CorpusSchema, n: int) -> DataFrame:
    """Rows to take per label combination: largest remainders, summing to exactly ``min(n, rows)``.

    Integer arithmetic throughout, over one row per label combination: their counts are written once, two totals of them come
    to the driver, and a combination's rank by remainder is a running count over ranges of the order.
    """
    counts = materialize(df.groupBy(label_set(schema.labels).alias("label_set")).agg(F.count(F.lit(1)).alias("n_set")))
    n_all = counts.agg(F.coalesce(F.sum("n_set"), F.lit(0))).first()[0]
    if n_all <= n:
        return counts.select("label_set", F.col("n_set").alias("quota"))
    # as decimals: rows times rows leaves the range of a bigint on large corpora
    share = f"(cast(n_set as decimal(19,0)) * cast({n} as decimal(19,0)))"
    shares = counts.select("label_set", F.expr(f"{share} div {n_all}").alias("base"), F.expr(f"{share} % {n_all}").alias("remainder"))
    left_over = n - shares.agg(F.sum("base")).first()[0]
    ranked = totals_before(shares, [], [F.desc("remainder"), F.asc("label_set")], F.lit(1), "ahead", most_label_sets(schema))
    quota = F.col("base") + F.when(F.col("ahead") < F.lit(left_over), 1).otherwise(0)
    return ranked.select("label_set", quota.cast("long").alias("quota"))


def sampled_ids(
    df: DataFrame, schema: CorpusSchema, n: int = SAMPLE_SIZE, seed: int = SEED, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``(id)`` of exactly ``min(n, rows)`` rows that keep the joint label distribution.

    Only hash cells that start inside the quota can hold chosen rows. Those cells are found from counts
    first, so about ``n`` rows reach the ranking shuffle however large the corpus is.
    """
    rows, cells = refined_cells(keyed_rows(df, schema, seed), ["label_set"], "h", cell_rows=cell_rows)
    quotas = label_set_quotas(df, schema, n)
    return first_rows(rows, ["label_set"], "cell", ["h", schema.id], F.col("quota"), n, quotas, cells).select(schema.id)


def _id_filter(ids: DataFrame, n: int) -> DataFrame:
    """At most ``n`` ids: a small sample is broadcast so the corpus and its texts are not shuffled."""
    return F.broadcast(ids) if n <= BROADCAST_ROWS else ids


def stratified_subsample(df: DataFrame, schema: CorpusSchema, n: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """The sampled rows with all their columns."""
    return df.join(_id_filter(sampled_ids(df, schema, n, seed), n), schema.id, "left_semi")


def sample_remainder(df: DataFrame, schema: CorpusSchema, n: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """The rows the sample left out."""
    return df.join(_id_filter(sampled_ids(df, schema, n, seed), n), schema.id, "left_anti")


def fold_rows(df: DataFrame, roles: DataFrame, schema: CorpusSchema, role: str | None = None) -> DataFrame:
    """Corpus rows of every fold, ``fold`` and ``role`` being columns. One fold is a filter on the result."""
    if role is not None:
        roles = roles.where(F.col("role") == role)
    return roles.join(df, schema.id)


def limit_per_fold(rows: DataFrame, schema: CorpusSchema, n: int, by: Sequence[str] = ("fold",)) -> DataFrame:
    """The first ``n`` rows of each fold by id: the smoke-run switch."""
    return first_n_pruned(rows, by, [schema.id], n, spread=schema.id).drop("position")


def leakage_check(roles: DataFrame, exemplars: DataFrame, schema: CorpusSchema) -> DataFrame:
    """Per fold, counts that must be zero.

    ``multi_role``: ids holding more than one role in the fold; ``exemplars_outside_train``: exemplars that
    are not train rows of their fold. Exemplars join the roles by (fold, id), so nothing is paired up.
    """
    per_id = roles.groupBy("fold", schema.id).agg(F.count(F.lit(1)).alias("n"))
    multi = per_id.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_ids"), F.sum((F.col("n") > 1).cast("long")).alias("multi_role")
    )
    shown = exemplars.select("fold", schema.id).distinct()
    train = roles.where(F.col("role") == "train").select("fold", schema.id)
    outside = shown.join(train, ["fold", schema.id], "left_anti").groupBy("fold").agg(
        F.count(F.lit(1)).alias("exemplars_outside_train")
    )
    return multi.join(outside, "fold", "left").select(
        "fold", "n_ids", "multi_role", F.coalesce("exemplars_outside_train", F.lit(0).cast("long")).alias("exemplars_outside_train")
    )
