"""Exact positions and top-n per group without ever putting a whole group into one task.

A plain ``row_number() over (partition by g order by h)`` sends all rows of ``g`` to one task. Where one
label combination holds most of the corpus that task is the job. Both operators here first split each
group into cells that follow the same order, so the result equals the plain window and the largest
sort is one cell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldgauge.functions.labels import HASH_BITS
from foldgauge.session import materialize

# A side is broadcast only if its rows (keys and counts, about 50 bytes each) are provably at most this many.
BROADCAST_ROWS = 300_000
# A coarse cell is one of 2**COARSE_BITS of its group; one with more than CELL_ROWS rows is cut further.
COARSE_BITS = 12
CELL_ROWS = 1_000_000
# Running sums over groups go through one window if there can be no more groups than this.
WINDOW_GROUPS = 1 << 16
PRUNE_ROWS = 1 << 15


def refined_cells(
    df: DataFrame,
    by: Sequence[str],
    h: str,
    sums: dict[str, Column] | None = None,
    cell_rows: int = CELL_ROWS,
    hash_bits: int = HASH_BITS,
) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``cell``, and the rows and sums of every cell (``cell_totals``).

    A cell is the hash ``h`` with its lower bits cleared, which never decreases along the hash; as many bits are kept as leave it
    about ``cell_rows`` rows. Rows are counted in coarse cells, one map-side combined aggregate. Only cells above the bound,
    at most rows / ``cell_rows`` of them, are listed, broadcast and cut by as many further bits as their count asks for, and
    only their rows are counted again; hashes are uniform, so a bit more than that is room enough. Rows of one
    hash, such as repeated ids, stay together whatever their number.
    """
    low = hash_bits - COARSE_BITS
    coarse = F.shiftright(F.col(h), low)
    counted = cell_totals(df.withColumn("_coarse", coarse), by, "_coarse", sums)
    extra = F.least(F.ceil(F.log2(F.col("cell_rows") / cell_rows)) + 1, F.lit(low)).cast("int")
    crowded = F.broadcast(counted.where(F.col("cell_rows") > cell_rows).select(*by, "_coarse", extra.alias("_extra")))

    def cut(rows: DataFrame) -> DataFrame:
        lower = F.lit(low) - F.coalesce("_extra", F.lit(0))
        return rows.select(*df.columns, F.call_function("shiftleft", F.call_function("shiftright", F.col(h), lower), lower).alias("cell"))

    marked = df.withColumn("_coarse", coarse)
    on = [*by, "_coarse"]
    plain = counted.where(F.col("cell_rows") <= cell_rows).withColumn("cell", F.shiftleft("_coarse", low)).drop("_coarse")
    fine = cell_totals(cut(marked.join(crowded, on)), by, "cell", sums)
    return cut(marked.join(crowded, on, "left")), plain.unionByName(fine)


def totals_before(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], value: Column, name: str, most: int | None = None
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one in its ``by`` group (0 for the first).

    With ``most``, a proven bound on the rows that stays within WINDOW_GROUPS, one window does it. Otherwise rows are written in ranges of the
    order; each range is summed where it lies and begins at the sum of the ranges before it, so no task sees more than
    one range and one row for each range.
    """
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if most is not None and most <= WINDOW_GROUPS:
        return df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    ranged = df.repartitionByRange(*[F.asc(c) for c in by], *order)
    placed = materialize(ranged.withColumns({"_range": F.spark_partition_id(), "_value": value}))
    sums = placed.groupBy("_range", *by).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("_range", *(F.col(c).alias(f"_by_{c}") for c in by), F.sum("_sum").over(earlier).alias("_begin"))
    # A group that begins in an earlier range is the first of its range: at most one row for each range.
    begins = F.broadcast(begins.where(F.col("_begin").isNotNull()).withColumnRenamed("_range", "_of"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col("_range") == F.col("_of"))
    local = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    so_far = placed.withColumn("_so_far", F.coalesce(F.sum("_value").over(local), F.lit(0)))
    total = F.coalesce("_begin", F.lit(0)) + F.col("_so_far")
    return so_far.join(begins, same, "left").select(*df.columns, total.alias(name))


def cell_totals(df: DataFrame, by: Sequence[str], cell: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Rows and sums of each cell. The aggregate combines on the map side, so only one row per (task, group, cell) is shuffled."""
    return df.groupBy(*by, cell).agg(
        F.count(F.lit(1)).alias("cell_rows"), *[F.sum(value).alias(f"cell_{name}") for name, value in (sums or {}).items()]
    )


def cell_counts(cells: DataFrame, by: Sequence[str], cell: str, sums: Sequence[str] = ()) -> DataFrame:
    """Rows and sums ahead of each cell of a group, and the group totals; the window runs over cells, never over rows."""
    group = Window.partitionBy(*by)
    ahead = group.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        *by,
        cell,
        F.coalesce(F.sum("cell_rows").over(ahead), F.lit(0)).alias("rows_ahead"),
        F.sum("cell_rows").over(group).alias("group_rows"),
        *[F.sum(f"cell_{name}").over(ahead).alias(f"ahead_{name}") for name in sums],
    )


def running_positions(
    df: DataFrame,
    by: Sequence[str],
    cell: str,
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    start_groups: Sequence[str] | None = None,
    most_groups: int | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Adds ``position`` (1-based), ``group_rows`` and a running total per entry of ``sums``.

    ``cell`` must be non-decreasing along ``order`` (for example a prefix of the first order column); ``cells`` are its totals if
    they are known. The join uses the window's own keys, so the row side is shuffled once. With ``start_groups``, a prefix
    of ``by``, also adds ``group_start``: the rows of the groups before this one inside its start group; ``most_groups`` is
    the caller's bound on the groups.
    """
    sums = sums or {}
    cells = cell_totals(df, by, cell, sums) if cells is None else cells
    inside = Window.partitionBy(*by, cell).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select(
        "*",
        F.row_number().over(inside).alias("cell_position"),
        *[F.sum(value).over(so_far).alias(f"local_{name}") for name, value in sums.items()],
    )
    ahead = cell_counts(cells, by, cell, list(sums))
    extra = []
    if start_groups is not None:
        ahead = ahead.join(group_starts(cells, by, start_groups, most_groups), list(by))
        extra = ["group_start"]
    return local.join(ahead, [*by, cell]).select(
        *df.columns,
        (F.col("rows_ahead") + F.col("cell_position")).alias("position"),
        "group_rows",
        *extra,
        *[
            (F.coalesce(F.col(f"ahead_{name}"), F.lit(0)) + F.coalesce(F.col(f"local_{name}"), F.lit(0))).alias(name)
            for name in sums
        ],
    )


def group_starts(cells: DataFrame, by: Sequence[str], start_groups: Sequence[str], most_groups: int | None = None) -> DataFrame:
    """Rows in the groups before each group, the groups of one start group ordered by the rest of ``by``; from cell totals."""
    totals = cells.groupBy(*by).agg(F.sum("cell_rows").alias("rows"))
    rest = [F.asc(name) for name in by if name not in start_groups]
    return totals_before(totals, start_groups, rest, F.col("rows"), "group_start", most_groups).drop("rows")


def first_rows(
    df: DataFrame,
    by: Sequence[str],
    cell: str,
    order: Sequence[str],
    quota: Column,
    most: int,
    quotas: DataFrame | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """The first ``quota`` rows of each group, adding ``position``.

    Cells are counted first (``cells``, if known). Only cells that start inside the quota can hold chosen rows, so the rows
    are filtered by cell before anything is shuffled or sorted; what reaches the window is about the
    result. ``quotas`` optionally holds the column ``quota`` refers to, one row per group. ``most`` is the sum of all quotas, which
    bounds the chosen cells, as each holds a row; above the limit the same join runs as a shuffle join.
    """
    cells = cell_counts(cell_totals(df, by, cell) if cells is None else cells, by, cell)
    if quotas is not None:
        cells = cells.join(quotas, list(by))
    chosen = cells.withColumn("cell_quota", quota).where(F.col("rows_ahead") < F.col("cell_quota"))
    chosen = chosen.select(*by, cell, "rows_ahead", "cell_quota")
    if most <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    inside = Window.partitionBy(*by, cell).orderBy(*order)
    return (
        df.join(chosen, [*by, cell])
        .withColumn("position", F.col("rows_ahead") + F.row_number().over(inside))
        .where(F.col("position") <= F.col("cell_quota"))
        .select(*df.columns, "position")
    )


def first_n_pruned(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, spread: str, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group in a plain ascending order, adding ``position``.

    Each task keeps the first ``n`` rows of every group it meets and lets go of all others before anything is shuffled, so at
    most tasks x groups x ``n`` rows move; a row outside them cannot be among the group's first ``n``. Those left are ranked inside
    ``salts`` slices of each group, and the last ranking sees at most ``n * salts`` rows per group.
    """
    keys = [*by, *order]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        held = 0
        for batch in batches:
            new = pa.Table.from_batches([batch])
            kept = new if kept is None else pa.concat_tables([kept, new])
            if kept.num_rows > 2 * held + PRUNE_ROWS:
                kept = first_of_each(kept, by, keys, n)
                held = kept.num_rows
        if kept is not None:
            yield from first_of_each(kept, by, keys, n).to_batches(max_chunksize=PRUNE_ROWS)

    pruned = df.mapInArrow(prune, df.schema).withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    in_slice = Window.partitionBy(*by, "_salt").orderBy(*order)
    in_group = Window.partitionBy(*by).orderBy(*order)
    return (
        pruned.withColumn("position", F.row_number().over(in_slice))
        .where(F.col("position") <= n)
        .withColumn("position", F.row_number().over(in_group))
        .where(F.col("position") <= n)
        .drop("_salt")
    )


def first_of_each(rows: pa.Table, by: Sequence[str], keys: Sequence[str], n: int) -> pa.Table:
    """The first ``n`` rows of each group of an Arrow table, nulls first as Spark sorts them."""
    ranked = rows.take(pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))
    new = np.zeros(ranked.num_rows, dtype=bool)
    new[:1] = True
    for name in by:
        codes = ranked.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    begins = np.flatnonzero(new)
    place = np.arange(ranked.num_rows) - np.repeat(begins, np.diff(np.append(begins, ranked.num_rows)))
    return ranked.filter(pa.array(place < n))
