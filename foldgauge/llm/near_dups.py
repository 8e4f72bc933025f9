"""Near duplicates by DartMinHash (operator 1).

Every element of a weighted set throws darts at fixed places of its own (weight, rank) strip, the places drawn
from hashes of the element. A dart counts if it lies below the element's weight; each dart names a coordinate, and a
coordinate keeps the dart of least rank. Two sets agree on a coordinate with a probability equal to their weighted
Jaccard similarity, and a signature of ``bands * rows`` coordinates costs about as many darts as it has coordinates times
their logarithm, instead of one hash for each element and coordinate. Elements are shingles of five words;
``weighting`` is ``"set"`` (every distinct shingle weighs 1: plain Jaccard) or ``"count"`` (its number in the text).

Flow: texts with the same elements and weights become one representative, so copies are never paired. The
signature is cut into bands; representatives that share a band bucket are candidates. In each bucket all members are first
compared with one leader, the member that meets most others over all buckets (the original of a family of
copies), which is linear. Buckets whose members are not connected by that go on: every member outside the leader's
component is compared with all members of other components, in blocks of bounded size. There a pair is verified on its
whole shingle sets unless its signatures agree too little (MARGIN below the threshold is over four deviations) or the
triangle inequality of the Jaccard distances to the leader rules it out; a block returns one link for each member and
component. So no bucket or group has a cap, no group is expanded to all its pairs, and the classes are the connected components of
all verified links.

A pair at similarity 0.8 shares one of 40 bands of 6 coordinates with probability 0.999995.

Words: A-Z lower-cased, runs of ASCII letters, digits and characters beyond ASCII; fewer than five words are one shingle. Texts
without words (null, empty) are alike and form one class. Null ids are allowed; repeated rows are copies of each other;
other columns are ignored. ``keep`` marks one row of each class: the one with the least id (nulls last), then the first row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import (
    ALNUM,
    arrow_rows,
    as_signed,
    gram_hashes,
    list_array,
    mix,
    row_blocks,
    small_enough,
    span_hashes,
    text_bytes,
    trimmed,
    whole_row,
    word_spans,
)
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 40
BAND_ROWS = 6
MARGIN = 0.12
BLOCK_ELEMENTS = 1 << 17
_LEVELS = 64
_CELLS = 1 << 18


def row_elements(texts: pa.Array, words: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct shingle hashes in order, their counts) of each text that has words."""
    data, bounds = text_bytes(texts)
    starts, ends, first = word_spans(data, bounds, ALNUM)
    hashes = span_hashes(data, starts, ends)
    grams = gram_hashes(hashes, words)
    for row, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if high - low >= words:
            yield (row, *np.unique(grams[low : high - words + 1], return_counts=True))
        elif high > low:
            short = mix(np.array([np.add.reduce(mix(hashes[low:high] + np.arange(1, high - low + 1, dtype=np.uint64)))]))
            yield row, short, np.ones(1, dtype=np.int64)


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


_POISSON = np.cumsum(np.exp(-1.0) / np.array([1.0, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800, 39916800]))


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray, first: np.ndarray, coordinates: int, seed: int = 1
) -> np.ndarray:
    """(rows, coordinates) uint64: the earliest dart of each coordinate, its rank in the upper half.

    ``elements`` and ``weights`` list the sets one after another, row r from ``first[r]`` to ``first[r + 1]``. A strip
    is cut into cells of area 1, each with a Poisson(1) number of darts: level 0 spans weights 0 to 1, level a
    weights 2**(a-1) to 2**a, and a cell of a level of width L spans 1 / L of ranks. Only darts up to the rank where about
    ``coordinates * (log(coordinates) + 2)`` of them are expected in a set are thrown; the rank is doubled
    for sets that still miss a coordinate.
    """
    rows = len(first) - 1
    out = np.full(rows * coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(rows), sizes)
    total = np.bincount(owner, weights=weights, minlength=rows)
    reach = coordinates * (np.log(max(2, coordinates)) + 2) / np.maximum(total, 1e-300)
    todo = np.flatnonzero(sizes > 0)
    top = np.maximum(0, np.ceil(np.log2(np.maximum(weights, 1e-300)))).astype(np.int64) + (weights > 1)
    while len(todo):
        chosen = np.isin(owner, todo)
        item, row, weight, levels = elements[chosen], owner[chosen], weights[chosen], top[chosen]
        for level in range(int(levels.max(initial=0)) + 1):
            floor = 0.0 if level == 0 else 2.0 ** (level - 1)
            width = 1.0 if level == 0 else floor
            on = np.flatnonzero(weight > floor)
            if not len(on):
                continue
            cells = np.ceil(reach[row[on]] * width).astype(np.int64)
            ends = np.cumsum(cells)
            low = 0
            while low < len(on):  # about _CELLS cells at a time, so small sets with many cells take no more memory
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _CELLS, side="right")))
                part, count = on[low:high], cells[low:high]
                low = high
                which = np.repeat(part, count)
                cell = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                start = mix(item[which] + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64)))
                start = mix(start ^ (cell.astype(np.uint64) * np.uint64(_LEVELS) + np.uint64(level + 1)))
                darts = np.searchsorted(_POISSON, _uniform(start), side="right")
                source = np.repeat(np.arange(len(which)), darts)
                number = np.arange(len(source)) - np.repeat(np.cumsum(darts) - darts, darts)
                dart = mix(start[source] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                rank = (cell[source] + _uniform(dart)) / width
                second = mix(dart + np.uint64(0x5851F42D4C957F2D))
                height = floor + width * (second >> np.uint64(40)).astype(np.float64) * 2.0**-24
                mine = which[source]
                good = (rank <= reach[row[mine]]) & (height < weight[mine])
                spot = (second[good] & np.uint64(0xFFFFFF)) * np.uint64(coordinates) >> np.uint64(24)
                key = row[mine[good]] * coordinates + spot.astype(np.int64)
                value = rank[good].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
                np.minimum.at(out, key, value | (dart[good] & np.uint64(0xFFFFFFFF)))
        empty = (out.reshape(rows, coordinates) == np.iinfo(np.uint64).max).any(axis=1)
        todo = todo[empty[todo]]
        reach[todo] *= 2
    return out.reshape(rows, coordinates)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """(rows, bands) uint64: one hash for each band, its number mixed in."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        key = mix(key + mix(parts[:, :, k]))
    return key


_SIGNED = "_row long, id {kind}, size long, key_a long, key_b long, bands array<long>, signature binary"


def signed_documents(
    docs: DataFrame, id_column: str, text_column: str, words: int, bands: int, rows: int, weighting: str
) -> DataFrame:
    """One row for each text: the hash of its whole weighted set, its band keys and a byte of each coordinate."""
    narrow = docs.select("_row", F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = narrow.schema["id"].dataType.simpleString()
    counted = weighting == "count"
    if weighting not in ("set", "count"):
        raise ValueError(f"unknown weighting {weighting!r}")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column(2)
            _, bounds = text_bytes(body)
            for low, high in row_blocks(bounds):
                part = batch.slice(low, high - low)
                n = high - low
                sizes = np.zeros(n, dtype=np.int64)
                key_a, key_b = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
                sets, weights = [], []
                for row, elements, counts in row_elements(part.column(2), words):
                    weigh = counts if counted else np.ones(len(counts), dtype=np.int64)
                    sets.append(elements)
                    weights.append(weigh.astype(np.float64))
                    sizes[row] = len(elements)
                    own = mix(elements + weigh.astype(np.uint64))
                    key_a[row], key_b[row] = np.add.reduce(own), np.bitwise_xor.reduce(mix(own + np.uint64(77)))
                first = np.concatenate([[0], np.cumsum(sizes)])
                flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                weight = np.concatenate(weights) if weights else np.zeros(0)
                signature = dart_signatures(flat, weight, first, bands * rows)
                keys = as_signed(band_keys(signature, bands))
                lengths = np.where(sizes > 0, bands, 0)
                raw = (mix(signature) & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(sizes),
                        pa.array(as_signed(key_a)),
                        pa.array(as_signed(key_b)),
                        list_array(keys[sizes > 0].reshape(-1), lengths),
                        pa.array([r.tobytes() if size else b"" for r, size in zip(raw, sizes, strict=True)], type=pa.binary()),
                    ],
                    names=["_row", "id", "size", "key_a", "key_b", "bands", "signature"],
                )

    return narrow.mapInArrow(trimmed(sign), _SIGNED.format(kind=kind))


def _sets(docs: DataFrame, rows: DataFrame, text_column: str, words: int, weighting: str) -> DataFrame:
    """(_row, elements): the whole weighted sets of the rows named in ``rows`` (a written table), written once."""
    texts = docs.select("_row", F.col(text_column).alias("body")).join(small_enough(rows), "_row", "left_semi")
    counted = weighting == "count"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes] = [b""] * batch.num_rows
            for row, elements, counts in row_elements(batch.column(1), words):
                packed[row] = elements.tobytes() + (counts.astype(np.uint64).tobytes() if counted else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, type=pa.binary())], names=["_row", "elements"])

    return materialize(texts.mapInArrow(trimmed(gather), "_row long, elements binary"))


def verified_pairs(pairs: DataFrame, docs: DataFrame, text_column: str, words: int, weighting: str) -> DataFrame:
    """(a, b, similarity) of the given row pairs, from the whole weighted sets of both texts."""
    named = materialize(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "_row"))
    sets = _sets(docs, named, text_column, words, weighting)
    sides = pairs.join(sets.select(F.col("_row").alias("b"), F.col("elements").alias("right")), "b").join(
        sets.select(F.col("_row").alias("a"), F.col("elements").alias("left")), "a"
    )
    counted = weighting == "count"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = np.zeros(batch.num_rows)
            for k in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=np.uint64) for c in (2, 3))
                similar[k] = _jaccard(left, right, counted)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similar)], names=["a", "b", "similarity"])

    return sides.select("a", "b", "left", "right").mapInArrow(trimmed(compare), "a long, b long, similarity double")


def _jaccard(left: np.ndarray, right: np.ndarray, counted: bool) -> float:
    if not counted:
        both = np.concatenate([left, right])
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        return shared / (len(left) + len(right) - shared)
    (x, n), (y, m) = np.split(left, 2), np.split(right, 2)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    return shared / int(n.sum() + m.sum() - shared)


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(_row, component) for every node: the least node it is linked with, over any number of links.

    Each round takes the least label among a node and its neighbours and then the label of that label, so the rounds
    grow with the logarithm of the longest chain. Every round is a table in the shared folder.
    """
    edges = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("least"))
        lower = labels.join(near, "a").select("a", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("further"))
        step = materialize(lower.join(jump, "label").select("a", "old", F.least("label", "further").alias("label")))
        labels = step.select("a", "label")
        if step.where("old <> label").isEmpty():
            break
    named = nodes.select("_row").join(labels.withColumnRenamed("a", "_row"), "_row", "left")
    return named.select("_row", F.coalesce("label", "_row").alias("component"))


def _dealt(entries: DataFrame, fields: list[str]) -> DataFrame:
    """Askers and members of every open bucket, dealt to blocks (bucket, q, m): each asker meets each member once."""

    def block_of(count: str) -> Column:
        return F.pmod(F.xxhash64("_row"), F.col(count)).cast("long")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    held = entries.select(*fields, F.lit(False).alias("asks"), every("n_ask").alias("q"), block_of("n_held").alias("m"))
    asking = entries.where("open").select(*fields, F.lit(True).alias("asks"), block_of("n_ask").alias("q"), every("n_held").alias("m"))
    return held.unionByName(asking)


def _possible(part: pa.Table, threshold: float, margin: float, counted: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(asker, members it may be similar to, the likeliest first) of a block. A pair that meets in the bucket of an earlier
    band is left to that bucket; this is told by the bucket keys, as the signature bytes of a band may agree without it."""
    asks = part.column("asks").to_numpy(zero_copy_only=False)
    component, size, near, band = (part.column(c).to_numpy() for c in ("component", "size", "near", "band"))
    raw = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype=np.uint8).reshape(len(asks), -1)
    keys = part.column("bands").combine_chunks().flatten().to_numpy().reshape(len(asks), -1)
    m = np.flatnonzero(~asks)
    for k in np.flatnonzero(asks).tolist():
        fit = m[component[m] != component[k]]
        if not counted:  # a set much smaller or larger cannot be similar enough
            fit = fit[(size[fit] >= threshold * size[k]) & (threshold * size[fit] <= size[k])]
        fit = fit[np.abs(near[fit] - near[k]) <= 1 - threshold + 1e-9]
        sure = (raw[fit] == raw[k]).mean(axis=1)
        good = np.flatnonzero(sure >= threshold - margin)
        good = good[~(keys[fit[good], : band[k]] == keys[k, : band[k]]).any(axis=1)]
        if len(good):
            yield k, fit[good[np.argsort(-sure[good], kind="stable")]]


def _block_rows(entries: DataFrame, threshold: float, margin: float, counted: bool) -> DataFrame:
    """(bucket, _row): the rows of open buckets that have a possible partner there; only their sets are needed."""

    def compare(part: pa.Table) -> pa.Table:
        row, found = part.column("_row").to_numpy(), [np.zeros(0, dtype=np.int64)]
        for k, fit in _possible(part, threshold, margin, counted):
            found += [fit, np.array([k])]
        rows = np.unique(row[np.concatenate(found)])
        return pa.table({"bucket": pa.array(np.full(len(rows), part.column("bucket")[0].as_py())), "_row": pa.array(rows)})

    fields = ["bucket", "band", "_row", "component", "near", "size", "bands", "signature"]
    return _dealt(entries, fields).groupBy("bucket", "q", "m").applyInArrow(compare, "bucket long, _row long").distinct()


def _block_links(entries: DataFrame, threshold: float, margin: float, counted: bool) -> DataFrame:
    """(a, b): verified links between components inside the open buckets, one for each asker and component in a block."""

    def compare(part: pa.Table) -> pa.Table:
        row, component = part.column("_row").to_numpy(), part.column("component").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in part.column("elements").to_pylist()]
        links = set()
        for k, fit in _possible(part, threshold, margin, counted):
            linked = set()
            for other in fit.tolist():
                if component[other] not in linked and _jaccard(sets[k], sets[other], counted) >= threshold:
                    linked.add(component[other])
                    links.add((min(row[k], row[other]), max(row[k], row[other])))
        pairs = np.array(sorted(links), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    fields = ["bucket", "band", "_row", "component", "near", "size", "bands", "signature", "elements"]
    return _dealt(entries, fields).groupBy("bucket", "q", "m").applyInArrow(compare, "a long, b long").distinct()


def _with_blocks(entries: DataFrame, block_elements: int) -> DataFrame:
    """``entries`` with the numbers of blocks (n_ask, n_held) their bucket's askers and members are dealt to."""

    def blocks(size: Column) -> Column:
        return F.greatest(F.ceil(F.sum(size) / block_elements), F.lit(1)).cast("long")

    asking = F.when(F.col("open"), F.col("size")).otherwise(0)
    counts = entries.groupBy("bucket").agg(blocks(asking).alias("n_ask"), blocks(F.col("size")).alias("n_held"))
    return entries.join(counts, "bucket")


def near_duplicate_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = SHINGLE_WORDS,
    threshold: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    weighting: str = "set",
    margin: float = MARGIN,
    block_elements: int = BLOCK_ELEMENTS,
) -> DataFrame:
    """(_row, id, class_id, class_rows, n_texts, keep): the class of every row.

    ``docs`` is a stored table with a unique ``_row`` (``numbered``); it is read twice, for the signatures and for the
    texts that pairs name. ``class_id`` is the least id of the class, ``n_texts`` its number of different shingle sets.
    """
    with arrow_rows(docs.sparkSession):
        return _classes(docs, id_column, text_column, words, threshold, bands, rows, weighting, margin, block_elements)


def _classes(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    words: int,
    threshold: float,
    bands: int,
    rows: int,
    weighting: str,
    margin: float,
    block_elements: int,
) -> DataFrame:
    signed = materialize(signed_documents(docs, id_column, text_column, words, bands, rows, weighting))
    same = ["size", "key_a", "key_b"]
    groups = materialize(
        signed.groupBy(*same).agg(
            F.min("_row").alias("rep"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
        )
    )
    entries = groups.select(F.col("rep").alias("_row"), F.posexplode("bands").alias("band", "bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = materialize(entries.join(sizes, "bucket"))
    support = entries.groupBy("_row").agg(F.sum("n").alias("support"))
    ranked = entries.join(support, "_row")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("support", (-F.col("_row")).alias("minus"))).alias("best"))
    leaders = leaders.select("bucket", (-F.col("best.minus")).alias("leader"))
    led = materialize(entries.join(leaders, "bucket"))
    pair = [F.least("_row", "leader").alias("a"), F.greatest("_row", "leader").alias("b")]
    pairs = materialize(led.where("_row <> leader").select(*pair).distinct())
    checked = materialize(verified_pairs(pairs, docs, text_column, words, weighting))
    links = checked.where(F.col("similarity") >= threshold)
    nodes = groups.select(F.col("rep").alias("_row"))
    component = materialize(connected(nodes, links))

    # buckets that still hold several components: the rest of each is compared with all of it
    named = led.join(component, "_row")
    spread = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = spread.where("low <> high").select("bucket")
    heads = component.select(F.col("_row").alias("leader"), F.col("component").alias("head"))
    named = named.join(open_, "bucket", "left_semi").join(heads, "leader")
    named = named.select("bucket", "band", "_row", "component", "leader", (F.col("component") != F.col("head")).alias("open"))
    near = checked.select("a", "b", "similarity")
    named = named.withColumn("a", F.least("_row", "leader")).withColumn("b", F.greatest("_row", "leader"))
    named = named.join(near, ["a", "b"], "left")
    parts = groups.select(F.col("rep").alias("_row"), "size", "bands", "signature")
    named = materialize(named.join(parts, "_row").drop("a", "b", "leader"))
    if not named.isEmpty():
        options = (threshold, margin, weighting == "count")
        ready = _with_blocks(named.withColumn("near", F.coalesce("similarity", F.lit(1.0))), block_elements)
        needed = materialize(_block_rows(ready, *options))
        sets = _sets(docs, materialize(needed.select("_row").distinct()), text_column, words, weighting)
        ready = _with_blocks(ready.drop("n_ask", "n_held").join(needed, ["bucket", "_row"], "left_semi"), block_elements)
        more = materialize(_block_links(ready.join(sets, "_row"), *options))
        component = materialize(connected(nodes, links.select("a", "b").union(more)))

    in_class = groups.select(*same, F.col("rep").alias("_row")).join(component, "_row").drop("_row")
    rows_ = materialize(signed.select("_row", "id", *same).join(in_class, same))
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "_row")
    facts = rows_.groupBy("component").agg(F.min(first).alias("first"), F.count("*").alias("class_rows"))
    texts = in_class.groupBy("component").agg(F.count("*").alias("n_texts"))
    facts = facts.join(texts, "component")
    return rows_.join(facts, "component").select(
        "_row",
        F.col("id").alias(id_column),
        F.col("first.id").alias("class_id"),
        "class_rows",
        "n_texts",
        (F.col("_row") == F.col("first._row")).alias("keep"),
    )


def numbered(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns with a ``_row`` number, written once: numbers of two scans need not agree."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("_row"), *columns))


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, all columns as they are (columns named like ours do no harm)."""
    whole = numbered(docs, whole_row(docs))
    narrow = whole.select("_row", F.col("whole")[id_column].alias("id"), F.col("whole")[text_column].alias("text"))
    classes = near_duplicate_classes(narrow, "id", "text", **options)
    dropped = materialize(classes.where("NOT keep").select("_row"))
    return whole.join(small_enough(dropped), "_row", "left_anti").select("whole.*")


@query("op1_near_duplicates")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents"), "doc_id", "text")
    return near_duplicate_classes(docs).drop("_row")


__all__ = ["band_keys", "connected", "dart_signatures", "near_duplicate_classes", "numbered", "without_near_duplicates"]
