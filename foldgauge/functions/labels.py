"""Expressions over the 0/1 label columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def cardinality(labels: Sequence[str]) -> Column:
    """How many labels are set."""
    return reduce(add, [F.col(label) for label in labels]).cast("int")


def label_set(labels: Sequence[str]) -> Column:
    """The joint label combination as a string of bits, one character per label."""
    return F.concat(*[F.when(F.col(label) == 1, "1").otherwise("0") for label in labels])


def labels_json(labels: Sequence[str]) -> Column:
    """Compact JSON in label order. ``to_json`` drops null fields, hence the coalesce."""
    fields = [F.coalesce(F.col(label).cast("int"), F.lit(0)).alias(label) for label in labels]
    return F.to_json(F.struct(*fields))


HASH_BITS = 60


def seeded_hash(seed: Column | int | str, row_id: Column | str) -> Column:
    """The first 60 bits of md5 over ``seed|id`` as a bigint: the same order on any partitioning.

    A fixed-width number keeps shuffles small and lets sorts compare prefixes. The coalesce marks it
    non-null; otherwise every join on it adds a null filter that computes the hash a second time.
    """
    seed_text = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    digest = F.md5(F.concat(seed_text, F.lit("|"), row_id.cast("string")).cast("binary"))
    return F.coalesce(F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def hash_cell(h: Column | str, bits: int) -> Column:
    """The leading bits of ``seeded_hash``: a cell number that never decreases along the hash."""
    h = F.col(h) if isinstance(h, str) else h
    return F.shiftright(h, HASH_BITS - bits).cast("int")
