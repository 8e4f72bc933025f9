"""Packing into fixed-length sequences (operator 6): first-fit decreasing with a tournament tree.

Each document's ids (with the end id) are cut into blocks of the full length; what is left is cut once at half
the length if it is longer than that, so every loose piece takes at most half a sequence and first-fit decreasing
leaves almost no padding. The pieces are dealt by a hash to random groups of about ``group_pieces`` pieces
(a huge document is spread over many groups), and each group is packed on its own: pieces by falling
length, each into the first sequence with room, which a tournament tree over the free room of all sequences finds in
logarithmic time. Ids never leave the task that made them: later steps carry lengths and checksums only.

A null or empty text is one piece holding the end id. Repeated rows are packed one by one, null ids stay null,
other columns are ignored; an empty table gives no rows. Ties in length go by row and start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import let_go, trimmed, with_row
from foldgauge.llm.registry import query, table
from foldgauge.llm.token_counts import RANKS, VOCABULARY, batch_ids, encoder, vocabulary_path
from foldgauge.session import materialize

SEQUENCE_TOKENS = 2048
END_ID = 1
GROUP_PIECES = 8192
_SPREAD = 256  # pieces of one document that stay in one group


class TournamentTree:
    """Free room of ``bins`` equal bins; finds the first bin with enough room."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def take(self, need: int) -> int:
        room, at = self.room, 1
        if room[1] < need:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if room[at] < need:
                at += 1
        found = at - self.leaves
        room[at] -= need
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it for each length (in given order; ties keep that order)."""
    order = np.argsort(-lengths, kind="stable")
    tree = TournamentTree(len(lengths), capacity)
    bins = np.zeros(len(lengths), dtype=np.int64)
    places = np.zeros(len(lengths), dtype=np.int64)
    filled: dict[int, int] = {}
    for at in order.tolist():
        need = int(lengths[at])
        found = tree.take(need)
        bins[at] = found
        places[at] = filled.get(found, 0)
        filled[found] = filled.get(found, 0) + need
    return bins, places


class _Cutter:
    """Cuts the ids of one document, which may come in several arrays, into pieces."""

    def __init__(self, length: int):
        self.length = length
        self.rest = np.zeros(0, dtype=np.uint32)
        self.pieces: list[tuple[int, int, int]] = []
        self.start = 0

    def _piece(self, ids: np.ndarray) -> None:
        self.pieces.append((self.start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        self.start += len(ids)

    def add(self, ids: np.ndarray) -> None:
        ids = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        full = len(ids) // self.length * self.length
        for at in range(0, full, self.length):
            self._piece(ids[at : at + self.length])
        self.rest = ids[full:]

    def finish(self, end_id: int) -> list[tuple[int, int, int]]:
        self.add(np.array([end_id], dtype=np.uint32))
        half = self.length // 2
        if len(self.rest) > half:
            self._piece(self.rest[:half])
            self.rest = self.rest[half:]
        if len(self.rest):
            self._piece(self.rest)
        return self.pieces


def cut_documents(
    docs: DataFrame, id_column: str, text_column: str, length: int, end_id: int, vocabulary: str, ranks: str | None
) -> DataFrame:
    """(_row, id, piece, start, length, ids_crc32, doc_tokens) of all pieces, in one pass over the texts."""
    narrow = with_row(docs, F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = narrow.schema["id"].dataType.simpleString()
    names = ["_row", "id", "piece", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path(vocabulary), vocabulary_path(ranks) if ranks else None)
        for batch in batches:
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            at, cutter = 0, _Cutter(length)
            for row, ids in batch_ids(batch.column(2), encode):
                while at < row:
                    found[at] = cutter.finish(end_id)
                    at, cutter = at + 1, _Cutter(length)
                cutter.add(ids)
            while at < batch.num_rows:
                found[at] = cutter.finish(end_id)
                at, cutter = at + 1, _Cutter(length)
            each = np.array([len(pieces) for pieces in found], dtype=np.int64)
            rows = np.repeat(np.arange(batch.num_rows), each)
            flat = np.array([piece for pieces in found for piece in pieces], dtype=np.int64).reshape(-1, 3)
            tokens = np.array([sum(p[1] for p in pieces) for pieces in found], dtype=np.int64)
            number = np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each)
            kept = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]
            values = [number, flat[:, 0], flat[:, 1], flat[:, 2], tokens[rows]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v) for v in values)], names=names)

    return narrow.mapInArrow(trimmed(cut, "encoder"), f"_row long, id {kind}, piece long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    ranks: str | None = RANKS,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    The pieces are written to the shared folder once, so a lost executor never encodes a text again.
    """
    pieces = materialize(cut_documents(docs, id_column, text_column, length, end_id, vocabulary, ranks))
    groups = max(1, -(-pieces.count() // group_pieces))
    place = F.pmod(F.xxhash64("_row", F.floor(F.col("piece") / _SPREAD)), F.lit(groups))
    kind = pieces.schema["id"].dataType.simpleString()

    def pack(part: pa.Table) -> pa.Table:
        let_go()  # the encoder's work is done
        part = part.sort_by([("_row", "ascending"), ("start", "ascending")])
        bins, places = first_fit_decreasing(part.column("length").to_numpy(), length)
        group = part.column("place")[0].as_py()
        part = part.select(["id", "start", "length", "ids_crc32", "doc_tokens"])
        return part.append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(places))

    packed = (
        pieces.select("_row", "id", "start", "length", "ids_crc32", "doc_tokens", place.cast("long").alias("place"))
        .groupBy("place")
        .applyInArrow(pack, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
    return packed.withColumnRenamed("id", id_column)


@query("op6_pack_documents")
def op6_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
