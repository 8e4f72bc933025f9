"""Benchmark decontamination with training suffix arrays (operator 8).

The documents of an Arrow batch are taken in shards of about SHARD_WORDS words, or BLOCK_TEXT bytes. A shard's suffix array orders all
its word positions by the words that follow, as deep as the widest window; the start of every test suffix (each
place of a benchmark item; items that share a window are searched once) is looked up by binary search, all suffixes at once. The equal range of a suffix gives
every occurrence of its window, with its location; chained hits give the longest verbatim match. The
benchmark is the query set: its words, 8 bytes each, go to the tasks in blocks of at most BENCHMARK_WORDS words, each
block in a pass of its own, so what is broadcast is bounded however large the benchmark is. A document never
leaves its task, so nothing is shuffled, except the union of hits if there are several blocks.

Words: A-Z lower-cased, runs of ASCII letters, digits and characters beyond ASCII. A window is ``window`` consecutive words of an
item, or the whole item if it has fewer. Words are compared by 64-bit hashes. A null or empty text has no words and is clean; a null
or wordless item is no item; a null item id counts as one item and has no part in the list's digest; repeated items and items sharing a window all count (ids are counted once); repeated rows
each give a row; null document ids stay null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import ALNUM, mix, row_blocks, span_hashes, text_bytes, trimmed, whole_row, with_row, word_spans
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

WINDOW = 13
SHARD_WORDS = 1 << 19
BLOCK_TEXT = 1 << 22
MEMO = 4096
NO_ITEMS = hashlib.sha256(b"").hexdigest()
BENCHMARK_WORDS = 2_000_000
_CODE_BITS = 21


@dataclass
class TestWindows:
    """The distinct windows of one block of the benchmark: start in ``words`` and width; those of window w stand in the items
    ``item[first[w] : first[w + 1]]``, at ``place``."""

    words: np.ndarray
    start: np.ndarray
    width: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    ids: list[str | None]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, and each row's first word (n + 1 entries)."""
    data, bounds = text_bytes(texts)
    starts, ends, first = word_spans(data, bounds, ALNUM)
    return span_hashes(data, starts, ends), first


def test_windows(ids: list[str | None], words: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> TestWindows:
    """Windows of the items whose word hashes are ``words``, item k from ``bounds[k]`` to ``bounds[k + 1]``."""
    sizes = np.diff(bounds)
    count = np.where(sizes == 0, 0, np.maximum(1, sizes - window + 1))
    item = np.repeat(np.arange(len(ids)), count)
    place = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    start, width = bounds[:-1][item] + place, np.minimum(window, sizes[item])
    key = mix(width.astype(np.uint64))
    for k in range(int(width.max(initial=0))):
        more = np.flatnonzero(k < width)
        key[more] = mix(key[more] ^ words[start[more] + k])
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(one) + 1))
    return TestWindows(words, start[one], width[one], first, item[order], place[order], ids)


class SuffixArray:
    """All word positions of a shard in the order of the ``depth`` words that begin there.

    The shard is one string of words with an end mark (code 0) behind each row, so no match crosses a row. Words
    are ordered by the top bits of their hashes, three to a sort key; positions that tie are sorted again by
    their next three words.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int):
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.at = np.arange(len(words)) + row  # where each word stands in the string
        self.hashes = np.zeros(len(words) + len(first) - 1 + depth + 3, dtype=np.uint64)
        self.hashes[self.at] = words
        self.codes = np.zeros(len(self.hashes), dtype=np.int64)
        self.codes[self.at] = _codes(words)
        self.row = row
        key = self._key(slice(0, -2), 0)[self.at]
        order = np.argsort(key)
        key = key[order]
        order = self.at[order]
        same = key[1:] == key[:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        group = group[tied]
        for level in range(3, depth, 3):
            if not len(tied):
                break
            sub = order[tied]
            key = self._key(sub, level)
            by = np.lexsort((key, group))
            order[tied] = sub[by]
            key, group = key[by], group[by]
            same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
            group = np.concatenate([[0], np.cumsum(~same)])
            left = np.flatnonzero(np.append(same, False) | np.append(False, same))
            tied, group = tied[left], group[left]
        self.order = order

    def _key(self, at: np.ndarray | slice, level: int) -> np.ndarray:
        """Three codes from ``level`` words after each place, as one number."""
        if isinstance(at, slice):
            return (self.codes[:-2] << (2 * _CODE_BITS)) | (self.codes[1:-1] << _CODE_BITS) | self.codes[2:]
        at = at + level
        return (self.codes[at] << (2 * _CODE_BITS)) | (self.codes[at + 1] << _CODE_BITS) | self.codes[at + 2]

    def ranges(self, words: np.ndarray, start: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (``width`` words from ``start`` of ``words``) the range of the array that begins
        with it, found by binary search of all queries at once."""
        codes = _codes(words)
        bounds = []
        for upper in (False, True):
            low = np.zeros(len(start), dtype=np.int64)
            high = np.full(len(start), len(self.order), dtype=np.int64)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                sign = self._compare(self.order[middle], codes, start[open_], width[open_])
                right = sign <= 0 if upper else sign < 0
                low[open_[right]] = middle[right] + 1
                high[open_[~right]] = middle[~right]
            bounds.append(low)
        return bounds[0], bounds[1]

    def _compare(self, at: np.ndarray, codes: np.ndarray, start: np.ndarray, width: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: the suffix at ``at`` against the query, looking at the query's words only."""
        sign = np.zeros(len(at), dtype=np.int8)
        live = np.arange(len(at))
        for k in range(int(width.max(initial=0))):
            live = live[(sign[live] == 0) & (k < width[live])]
            if not len(live):
                break
            sign[live] = np.sign(self.codes[at[live] + k] - codes[start[live] + k])
        return sign


def _codes(words: np.ndarray) -> np.ndarray:
    """Short codes from 1 up; 0 is the end mark, so the topmost two numbers share a code."""
    return np.minimum((words >> np.uint64(64 - _CODE_BITS)).astype(np.int64) + 1, (1 << _CODE_BITS) - 1)


def shard_hits(words: np.ndarray, first: np.ndarray, tests: TestWindows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word in the shard, test window) of every occurrence of a test window in the shard whose rows begin
    at ``first``."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words) or not len(tests.start):
        return none, none, none
    depth = int(tests.width.max())
    array = SuffixArray(words, first, depth)
    low, high = array.ranges(tests.words, tests.start, tests.width)
    count = high - low
    test = np.repeat(np.arange(len(count)), count)
    rank = np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(test))
    at = array.order[rank]
    for k in range(depth):  # the codes are short: the whole hashes decide
        more = k < tests.width[test]
        equal = ~more
        equal[more] = array.hashes[at[more] + k] == tests.words[tests.start[test[more]] + k]
        at, test = at[equal], test[equal]
    word = np.searchsorted(array.at, at)
    return array.row[word], word, test


def _shards(first: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    at, rows = 0, len(first) - 1
    while at < rows:
        upto = max(at + 1, int(np.searchsorted(first, first[at] + limit, side="right")) - 1)
        yield at, min(upto, rows)
        at = min(upto, rows)


def _covered(at: np.ndarray, width: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie inside one of the spans."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


class _Findings:
    """What the hits of a row say about items. Rows with the same hits, such as copies of a line that many items share, are
    looked up in a memo, so that an item is gone through once for each different sequence of windows."""

    def __init__(self, tests: TestWindows):
        self.tests = tests
        self.items_of: dict[bytes, tuple[list[str | None], str]] = {}
        self.longest_of: dict[bytes, tuple[int, int, str | None]] = {}

    def items(self, test: np.ndarray) -> tuple[list[str | None], str]:
        """The ids of all items with these windows, nulls last, and the digest of those that are not null."""
        distinct = np.unique(test)
        found = self.items_of.get(distinct.tobytes())
        if found is None:
            first = self.tests.first
            numbers = np.unique(np.concatenate([self.tests.item[first[t] : first[t + 1]] for t in distinct.tolist()]))
            ids = {self.tests.ids[k] for k in numbers.tolist()}
            named = sorted(i for i in ids if i is not None)
            found = ([*named, *([None] if None in ids else [])], hashlib.sha256(",".join(named).encode()).hexdigest())
            if len(self.items_of) >= MEMO:
                self.items_of.clear()
            self.items_of[distinct.tobytes()] = found
        return found

    def longest(self, at: np.ndarray, test: np.ndarray) -> tuple[int, int, str | None]:
        """(length, position, item) of the longest verbatim match of a row, hits in order: windows at successive words that are
        successive in an item are one match. Ties: the first position, then the least item id."""
        cuts = np.flatnonzero(np.diff(at) > 1) + 1
        best = (0, 0, None)
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            length, offset, item = self._of_run(at[low:high] - at[low], test[low:high])
            if length > best[0]:
                best = (length, int(at[low]) + offset, item)
        return best

    def _of_run(self, at: np.ndarray, test: np.ndarray) -> tuple[int, int, str | None]:
        mark = at.tobytes() + test.tobytes()
        found = self.longest_of.get(mark)
        if found is None:
            tests = self.tests
            many = tests.first[test + 1] - tests.first[test]
            hit = np.repeat(np.arange(len(test)), many)
            member = np.repeat(tests.first[test] - np.cumsum(many) + many, many) + np.arange(len(hit))
            item, line, spot, width = tests.item[member], at[hit] - tests.place[member], at[hit], tests.width[test][hit]
            by = np.lexsort((spot, line, item))
            item, line, spot, width = item[by], line[by], spot[by], width[by]
            new = np.ones(len(by), dtype=bool)
            new[1:] = (item[1:] != item[:-1]) | (line[1:] != line[:-1]) | (spot[1:] != spot[:-1] + 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(by)) - 1
            length = spot[end] + width[end] - spot[begin]
            k = np.lexsort((item[begin], spot[begin], -length))[0]
            found = (int(length[k]), int(spot[begin[k]]), tests.ids[int(item[begin[k]])])
            if len(self.longest_of) >= MEMO:
                self.longest_of.clear()
            self.longest_of[mark] = found
        return found


def batch_matches(texts: pa.Array, tests: TestWindows, shard_words: int = SHARD_WORDS, list_items: bool = True) -> list[pa.Array]:
    """n_words, hit spans (start, end, merged), items, n_items, items_sha256, longest match: one entry for each row."""
    rows, findings = len(texts), _Findings(tests)
    n_words = np.zeros(rows, dtype=np.int64)
    spans: list[list[int]] = [[] for _ in range(rows)]
    items: list[list[str | None]] = [[] for _ in range(rows)]
    longest: list[dict | None] = [None] * rows
    n_items, digests = np.zeros(rows, dtype=np.int64), [NO_ITEMS] * rows
    _, bounds = text_bytes(texts)
    for begin, stop in row_blocks(bounds, BLOCK_TEXT):
        words, first = hashed_words(texts.slice(begin, stop - begin))
        n_words[begin:stop] = np.diff(first)
        for low, high in _shards(first, shard_words):
            base = first[low]
            own = first[low : high + 1] - base
            row, at, test = shard_hits(words[base : first[high]], own, tests)
            order = np.lexsort((tests.width[test], at, row))
            row, at, test = row[order], at[order], test[order]
            edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1)).tolist()
            for a, b in pairwise(edges):
                r = begin + low + int(row[a])
                here, mine = at[a:b] - own[row[a]], test[a:b]
                length, position, item = findings.longest(here, mine)
                longest[r] = {"words": length, "word": position, "item": item}
                found, digests[r] = findings.items(mine)
                n_items[r] = len(found)
                if list_items:
                    items[r] = found
                hit = np.concatenate([[False], _covered(here, tests.width[mine], int(own[row[a] + 1] - own[row[a]])), [False]])
                spans[r] = np.flatnonzero(hit[1:] != hit[:-1]).tolist()
    place = pa.struct([("words", pa.int64()), ("word", pa.int64()), ("item", pa.string())])
    return [
        pa.array(n_words),
        pa.array(spans, type=pa.list_(pa.int64())),
        pa.array(items, type=pa.list_(pa.string())),
        pa.array(n_items),
        pa.array(digests),
        pa.array(longest, type=place),
    ]


_NAMES = ["_row", "id", "n_words", "spans", "items", "n_items", "items_sha256", "longest"]
_FOUND = "n_words long, spans array<long>, items array<string>, n_items long, items_sha256 string, longest struct<words:long,word:long,item:string>"


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, window: int, limit: int) -> Iterator[TestWindows]:
    """The benchmark in blocks of at most ``limit`` words (a longer item is a block of its own). Its texts are hashed in tasks;
    only 8 bytes a word come to the driver, one block at a time."""
    items = benchmark.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("body"))

    def hash_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first = hashed_words(batch.column(1))
            each = [words[a:b].tobytes() for a, b in pairwise(first.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each, type=pa.binary())], names=["id", "words"])

    hashed = items.where(F.col("body").isNotNull()).mapInArrow(hash_items, "id string, words binary")
    ids: list[str | None] = []
    words: list[np.ndarray] = []
    size = 0

    def block() -> TestWindows:
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or ""))
        flat = np.concatenate([*(words[k] for k in order), np.zeros(0, dtype=np.uint64)])
        return test_windows([ids[k] for k in order], flat, np.cumsum([0, *(len(words[k]) for k in order)]), window)

    for item in hashed.toLocalIterator():
        own = np.frombuffer(item.words, dtype=np.uint64)
        if ids and size + len(own) > limit:
            yield block()
            ids, words, size = [], [], 0
        ids.append(item.id)
        words.append(own)
        size += len(own)
    yield block()


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    block_words: int = BENCHMARK_WORDS,
    shard_words: int = SHARD_WORDS,
    list_items: bool = True,
) -> DataFrame:
    """(_row, id, n_words, spans, items, n_items, items_sha256, longest) of every document; spans lists word starts and ends in turn.

    Without ``list_items`` the lists stay empty where one block holds the benchmark; number and digest are there in any case.
    """
    narrow = with_row(docs, F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = narrow.schema["id"].dataType.simpleString()
    spark = docs.sparkSession
    blocks = benchmark_blocks(benchmark, item_column, item_text_column, window, block_words)
    tests, further = next(blocks), next(blocks, None)
    if further is not None:
        narrow = materialize(narrow)  # several passes: the row numbers must agree

    def found_in(tests: TestWindows, lists: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(vars(tests))  # plain arrays: classes travel with the task

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = TestWindows(**shared.value)
            for batch in batches:
                found = batch_matches(batch.column(2), tests, shard_words, lists)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=_NAMES)

        return narrow.mapInArrow(trimmed(match), f"_row long, id {kind}, {_FOUND}")

    if further is None:
        return found_in(tests, list_items)
    union = reduce(DataFrame.unionByName, [found_in(t, True) for t in chain([tests, further], blocks)])
    items = F.array_distinct(F.flatten(F.collect_list("items")))  # one list for each block of the benchmark
    merged = union.groupBy("_row").agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(items).alias("items"),
        F.min_by("longest", F.when(F.col("longest").isNotNull(), F.struct(-F.col("longest.words"), "longest.word", "longest.item"))).alias("longest"),
    )
    merged = merged.withColumn("n_items", F.size("items").cast("long")).withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged(s) for s in batch.column(3).to_pylist()]
            columns = [*batch.columns[:3], pa.array(spans, type=pa.list_(pa.int64())), *batch.columns[4:]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return merged.select(*_NAMES).mapInArrow(join_spans, f"_row long, id {kind}, {_FOUND}")


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The matches with n_hit, n_items, items_sha256 and the decision: a twentieth or more of the words hit."""
    ends = F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)")
    found = find_matches(docs, benchmark, id_column, **options).withColumn("n_hit", ends)
    return found.select(
        "_row",
        F.col("id").alias(id_column),
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.coalesce(F.col("longest.words"), F.lit(0).cast("long")).alias("longest_words"),
        F.col("longest.word").alias("longest_at"),
        F.col("longest.item").alias("longest_item"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` without its contaminated rows, all columns as they are, in the same pass if one block suffices."""
    window = options.get("window", WINDOW)
    blocks = benchmark_blocks(benchmark, "item_id", "text", window, options.get("block_words", BENCHMARK_WORDS))
    tests, further = next(blocks), next(blocks, None)
    if further is not None:
        whole = materialize(docs.select(F.monotonically_increasing_id().alias("number"), whole_row(docs)))
        narrow = whole.select("number", F.col("whole")[text_column].alias("text"))
        bad = contamination(narrow, benchmark, "number", list_items=False, **options).where("contaminated")
        return whole.join(bad.select("number"), "number", "left_anti").select("whole.*")
    shared = docs.sparkSession.sparkContext.broadcast(vars(tests))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestWindows(**shared.value)
        for batch in batches:
            n_words, spans, *_ = batch_matches(batch.column(0).field(text_column), tests, list_items=False)
            hit = np.array([sum(s[1::2]) - sum(s[::2]) for s in spans.to_pylist()], dtype=np.int64)
            yield batch.filter(pa.array(~((hit > 0) & (20 * hit >= n_words.to_numpy()))))

    whole = docs.select(whole_row(docs))
    return whole.mapInArrow(trimmed(keep), whole.schema).select("whole.*")


OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS g
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win), grams AS (
  SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, sizes WHERE len(w) >= n)
), hits AS (SELECT r, k, n, item FROM grams JOIN win USING (n, g)),
spot AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
seen AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN spot USING (r) LEFT JOIN seen USING (r)
"""


@query("op8_decontaminate", OP8_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), list_items=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


__all__ = ["SuffixArray", "clean_documents", "contamination", "find_matches", "shard_hits"]
