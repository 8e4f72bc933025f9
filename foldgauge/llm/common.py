"""Helpers the operators share: words and hashes of whole Arrow batches, checked broadcasts, scratch tables.

Texts are handled as the bytes of an Arrow batch, so a batch costs a few numpy passes and no Python object
per word. Work memory is bounded by BLOCK_BYTES, whatever the length of a batch or of a text.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 21
BROADCAST_ROWS = 1_000_000

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_LONG_SPAN = 64
_KEY = b"spans of bytes"


def class_table(pattern: str) -> np.ndarray:
    """Which of the 256 byte values belong to words. ``ascii_alnum``: letters, digits and all bytes of
    characters beyond ASCII; ``not_blank``: all but blank and the controls 9 to 13."""
    table = np.zeros(256, dtype=bool)
    if pattern == "ascii_alnum":
        for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
            table[low:high] = True
    elif pattern == "not_blank":
        table[:] = True
        table[0x20] = False
        table[0x09:0x0E] = False
    else:
        raise ValueError(f"unknown word class {pattern!r}")
    return table


ALNUM = class_table("ascii_alnum")
NOT_BLANK = class_table("not_blank")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def worker_memo() -> dict:
    """What a worker process keeps between tasks. The package travels to workers by value, so its own globals
    are new in every task."""
    return sys.modules.setdefault("_foldgauge_memo", ModuleType("_foldgauge_memo")).__dict__.setdefault("memo", {})


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_string()).fill_null("")
    if not len(wide):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the index of its first word (n + 1 entries)."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(bounds), dtype=np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def _eights(block: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on as one number; ``block`` ends in 8 bytes of padding."""
    return np.ndarray((len(block) - 7,), dtype="<u8", buffer=block, strides=(1,))


_UPTO = np.array([(1 << 8 * n) - 1 for n in range(8)] + [_MASK], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of the bytes of each ordered, disjoint span, after ``fold`` maps each byte.

    Up to 7 bytes and their number are one 64-bit value, which is only mixed: such spans never collide with each other. Longer
    ones are chained through the finaliser 8 bytes at a time, those over _LONG_SPAN bytes are hashed by keyed BLAKE2b, so no
    algebraic structure of a text can make two of them agree.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
        base = starts[at]
        block = np.zeros(ends[upto - 1] - base + 8, dtype=np.uint8)
        block[:-8] = fold[data[base : ends[upto - 1]]]
        eights = _eights(block)
        s, size = starts[at:upto] - base, ends[at:upto] - starts[at:upto]
        wide = size.astype(np.uint64)
        found = mix((eights[s] & _UPTO[np.minimum(size, 8)]) | (wide << np.uint64(56)))
        longer = np.flatnonzero(size > 7)
        if len(longer):
            chain = mix(wide[longer] * np.uint64(_ODD))
            for k in range(_LONG_SPAN // 8):
                on = np.flatnonzero(size[longer] > 8 * k)
                mine = longer[on]
                chain[on] = mix(chain[on] ^ (eights[s[mine] + 8 * k] & _UPTO[np.minimum(size[mine] - 8 * k, 8)]))
            found[longer] = chain
            for k in longer[size[longer] > _LONG_SPAN].tolist():
                digest = hashlib.blake2b(block[s[k] : s[k] + size[k]], digest_size=8, key=_KEY).digest()
                found[k] = np.uint64(int.from_bytes(digest, "little"))
        out[at:upto] = found
        at = upto
    return out


def spans_differ(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which spans differ, byte by byte, from the spans of the same size that begin at ``others``."""
    block = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = _eights(block)
    size = ends - starts
    differ = np.zeros(len(starts), dtype=bool)
    on = np.flatnonzero((size <= _LONG_SPAN) & (size > 0) & (starts != others))
    for k in range(_LONG_SPAN // 8):
        on = on[size[on] > 8 * k]
        apart = (eights[starts[on] + 8 * k] ^ eights[others[on] + 8 * k]) & _UPTO[np.minimum(size[on] - 8 * k, 8)]
        differ[on] |= apart != 0
    for k in np.flatnonzero((size > _LONG_SPAN) & (starts != others)).tolist():
        differ[k] = not np.array_equal(data[starts[k] : ends[k]], data[others[k] : others[k] + size[k]])
    return differ


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` consecutive words (not heeding rows)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += words[k : k + n] * np.uint64(pow(_ODD, 2 * k + 3, 1 << 64))
    return mix(total)


def row_blocks(bounds: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of at most ``limit`` bytes, or of one row."""
    at, rows = 0, len(bounds) - 1
    while at < rows:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield at, min(upto, rows)
        at = min(upto, rows)


def as_signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    bounds = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, type=kind))


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, cells: Column | None = None) -> DataFrame:
    """``df`` (a written table of narrow rows) with a broadcast hint if its counted rows, and the ``cells`` of their lists all
    together, stay within the bound; beyond it Spark joins by shuffle, with the same result."""
    n, most = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.lit(0) if cells is None else cells), F.lit(0))).first()
    return F.broadcast(df) if max(n, most) <= rows else df


def free_memory() -> None:
    """Gives memory that numpy and Arrow have let go of back to the system: a worker lives on between tasks, and what one kind of
    task once needed would otherwise stay with it beside the needs of the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def let_go(keep: str = "") -> None:
    """Drops what tasks of other kinds keep in this worker (all of ``worker_memo`` whose key does not begin with ``keep``) and
    frees the memory: a vocabulary with its cache is as large as all that another task needs."""
    memo = worker_memo()
    foreign = [key for key in memo if key[0] != keep]
    for key in foreign:
        del memo[key]
    if foreign:
        gc.collect()
    free_memory()


def trimmed(
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = ""
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function`` of mapInArrow, with its memory freed behind each batch, and before what an earlier task of the worker left,
    except for what it keeps under ``keep`` itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keep)
        for batch in function(batches):
            yield batch
            free_memory()
        free_memory()

    return run


BATCH_ROWS = 500
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """At most ``rows`` rows an Arrow batch from here on in this session. For jobs that own their session: both sides of the
    exchange with Python hold whole batches, and rows are whole texts."""
    before = int(spark.conf.get(_ROWS_KEY))
    spark.conf.set(_ROWS_KEY, str(min(before, rows) if before > 0 else rows))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Smaller Arrow batches for the jobs run inside, where rows are long; the session's setting comes back."""
    before = spark.conf.get(_ROWS_KEY)
    short_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS_KEY, before)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of ours can meet one of theirs."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("whole")


def with_row(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``_row``, a number that marks a row of a stored table through one flow."""
    return df.select(F.monotonically_increasing_id().alias("_row"), *columns)
