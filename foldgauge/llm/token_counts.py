"""Token counts by overlap resynchronisation (operator 4).

A text longer than ``chunk`` bytes is cut into chunks that overlap. Each chunk is encoded with the byte offsets
of its tokens; two neighbours are spliced at a *stable boundary* that both encodings have inside the overlap.
A place is stable if a blank (space, tab, line ends) follows a character that is no white space: no
pre-token of the byte-level pattern holds such a place inside it, no special token holds a blank, and nothing to the
left of it changes how the text to the right is split. If the overlap holds no such common place, it is
doubled, at last to the whole rest, so that the result always equals the encoding of the whole text.

By the same fact a text is a row of segments (white space, then the rest up to the next stable place) that encode
independently, so a worker encodes each distinct segment once and keeps up to ``CACHE_SEGMENTS`` of them.
Segments are told apart by a 64-bit hash.

Nulls are empty texts with 0 tokens. Repeated rows each give a row, null ids stay null, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import SAME, row_blocks, span_hashes, spans_differ, text_bytes, trimmed, worker_memo
from foldgauge.llm.registry import query, table

VOCABULARY = "byte_bpe_50k.json"
CHUNK_BYTES = 1 << 15
OVERLAP_BYTES = 1 << 9
LIMIT_TOKENS = 1024
CACHE_SEGMENTS = 1_000_000
CACHE_BYTES = 1 << 25
_JOINED = 64
RANKS = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _blank_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x09:0x0E] = True
    table[0x20] = True
    return table


_BLANK = _blank_table()


def stable_places(data: np.ndarray) -> np.ndarray:
    """Positions p with a blank at p and, before it, a byte that surely ends no white-space character.

    White space beyond ASCII is one of U+0085 and U+00A0 (two bytes from C2) or a three-byte character from
    E1 9A, E2 80, E2 81 or E3 80; all characters that begin so count as white space here, which is safe.
    """
    blank = _BLANK[data]
    place = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    high = data[place - 1] >= 0x80
    if high.any():
        at = place[high]
        two = np.where(at >= 2, data[at - 2], 0)
        three = np.where(at >= 3, data[at - 3], 0)
        doubtful = (two == 0xC2) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81)))
        doubtful |= (three == 0xE3) & (two == 0x80)
        keep = np.ones(len(place), dtype=bool)
        keep[np.flatnonzero(high)[doubtful]] = False
        place = place[keep]
    return place


def _rank_encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as source:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, source)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class SegmentEncoder:
    """Encodes rows of bytes by their distinct segments; holds the segments met so far."""

    def __init__(self, path: str, ranks: str | None = None):
        """``ranks``: the same vocabulary as a rank file; segments without special strings then go to the
        faster library for such files, which gives the same ids."""
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)  # one character of a token stands for one byte
        with open(path, encoding="utf-8") as source:
            added = json.load(source)["added_tokens"]
        for token in added:
            self.width[token["id"]] = len(token["content"].encode())
        self.special = [token["content"].encode() for token in added]
        self.ranked = _rank_encoding(ranks) if ranks else None
        self.joined = 32 * _JOINED if ranks else _JOINED
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.first = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _library_ids(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in order, and how many each has. Segments that start with a blank and end in
        none go to the library many at a time; the byte widths of tokens tell where each one ends."""
        texts: list[bytes] = []
        begin = 0
        for at, segment in enumerate(segments):
            if len(segment) < 2 or not _BLANK[segment[0]] or not 0x20 < segment[-1] < 0x80:
                if begin < at:
                    texts.append(b"".join(segments[begin:at]))
                texts.append(segment)
                begin = at + 1
            elif at - begin == self.joined:
                texts.append(b"".join(segments[begin:at]))
                begin = at
        if begin < len(segments):
            texts.append(b"".join(segments[begin:]))
        ids = np.concatenate(self._encoded(texts))
        ends = np.cumsum(self.width[ids])
        want = np.cumsum([len(s) for s in segments])
        at = np.searchsorted(ends, want)
        if not np.array_equal(ends[at], want):
            raise ValueError("a token crosses a boundary that was held to be stable")
        return ids, np.diff(at, prepend=-1)

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.ranked is None:
            encoded = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, dtype=np.uint32) for e in encoded]
        out = []
        for text in texts:
            if any(special in text for special in self.special):
                ids = self.library.encode(text.decode(), add_special_tokens=False).ids
            else:
                ids = self.ranked.encode_ordinary(text.decode())
            out.append(np.array(ids, dtype=np.uint32))
        return out

    def _learn(self, segments: list[bytes]) -> None:
        ids, counts = self._library_ids(segments)
        n = len(self.known)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(segments) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.count[n : n + len(segments)] = counts
        self.first[n : n + len(segments)] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        self.held += sum(map(len, segments))
        self.known.update(zip(segments, range(n, n + len(segments)), strict=True))

    def _segments(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the kept entry of every segment of these rows, and each row's first segment."""
        first = np.zeros(len(data), dtype=bool)
        first[stable_places(data)] = True
        first[bounds[bounds < len(data)]] = True
        cuts = np.flatnonzero(first)
        starts, ends = cuts, np.append(cuts[1:], len(data))
        hashes = span_hashes(data, starts, ends, SAME)
        _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        same_size = (ends - starts) == (ends - starts)[index][inverse]
        unlike = np.flatnonzero(~same_size)
        unlike = np.union1d(unlike, np.flatnonzero(same_size)[spans_differ(data, starts[same_size], ends[same_size], starts[index][inverse][same_size])])
        if len(unlike):  # equal hashes of different segments: each stands for itself
            inverse = inverse.copy()
            inverse[unlike] = len(index) + np.arange(len(unlike))
            index = np.concatenate([index, unlike])
        raw = data.tobytes()
        listed = [raw[s:e] for s, e in zip(starts[index].tolist(), ends[index].tolist(), strict=True)]
        if len(self.known) + len(index) > CACHE_SEGMENTS or self.held > CACHE_BYTES:
            self._clear()
        new = list(dict.fromkeys(segment for segment in listed if segment not in self.known))
        if new:
            self._learn(new)
        entry = np.fromiter(map(self.known.__getitem__, listed), dtype=np.int64, count=len(listed))
        return entry[inverse], np.searchsorted(starts, bounds)

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each row."""
        if not len(data):
            return np.zeros(len(bounds) - 1, dtype=np.int64)
        entry, first = self._segments(data, bounds)
        total = np.concatenate([[0], np.cumsum(self.count[entry])])
        return np.diff(total[first])

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a row, and the n + 1 places where rows begin."""
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(bounds), dtype=np.int64)
        entry, first = self._segments(data, bounds)
        count = self.count[entry]
        total = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(self.first[entry] - total[:-1], count) + np.arange(total[-1])
        return self.flat[take], total[first]


def encoder(path: str, ranks: str | None = None) -> SegmentEncoder:
    """One encoder for each worker process."""
    memo = worker_memo()
    if ("encoder", path, ranks) not in memo:
        memo["encoder", path, ranks] = SegmentEncoder(path, ranks)
    return memo["encoder", path, ranks]


def spliced_ids(
    data: np.ndarray, encode: SegmentEncoder, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES
) -> Iterator[np.ndarray]:
    """Ids of one text in pieces: overlapping chunks, each cut at the places where it was spliced."""
    size, begin = len(data), 0
    places = stable_places(data)

    def whole(at: int) -> int:
        while at < size and data[at] & 0xC0 == 0x80:  # not inside a character
            at += 1
        return min(at, size)

    while begin < size:
        end, tail = whole(begin + chunk), overlap
        while end < size:
            # the next chunk would begin at end - tail; look for a place both encodings can share
            low = max(begin + 1, end - tail)
            own = places[np.searchsorted(places, low) : np.searchsorted(places, end)]
            if len(own):
                ids = encode.ids(data[begin:end], np.array([0, end - begin]))[0]
                offsets = begin + np.cumsum(encode.width[ids])
                follow = encode.ids(data[own[0] : end], np.array([0, end - own[0]]))[0]
                after = own[0] + np.concatenate([[0], np.cumsum(encode.width[follow])])
                common = own[np.isin(own, offsets) & np.isin(own, after)]
                if len(common):
                    yield ids[: int(np.searchsorted(offsets, common[-1])) + 1]
                    begin = int(common[-1])
                    break
            end, tail = whole(end + tail), tail * 2
        else:
            yield encode.ids(data[begin:size], np.array([0, size - begin]))[0]
            begin = size


def batch_ids(
    texts: pa.Array, encode: SegmentEncoder, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES
) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text in order; a huge text comes in several pieces, never as a whole."""
    data, bounds = text_bytes(texts)
    for low, high in row_blocks(bounds):
        block, own = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        huge = np.diff(own) > chunk
        at = 0
        while at < high - low:
            if huge[at]:
                for piece in spliced_ids(block[own[at] : own[at + 1]], encode, chunk, overlap):
                    yield low + at, piece
                at += 1
                continue
            upto = at + int(np.argmax(huge[at:])) if huge[at:].any() else high - low
            ids, first = encode.ids(block[own[at] : own[upto]], own[at : upto + 1] - own[at])
            for k in range(upto - at):
                yield low + at + k, ids[first[k] : first[k + 1]]
            at = upto


def batch_counts(texts: pa.Array, encode: SegmentEncoder, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    data, bounds = text_bytes(texts)
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), dtype=np.int64)
    for low, high in row_blocks(bounds):
        rows = np.arange(low, high)
        for row in rows[sizes[rows] > chunk]:
            out[row] = sum(len(piece) for piece in spliced_ids(data[bounds[row] : bounds[row + 1]], encode, chunk, overlap))
        plain = rows[sizes[rows] <= chunk]
        if len(plain) == len(rows):
            out[plain] = encode.counts(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        elif len(plain):
            ends = np.concatenate([[0], np.cumsum(sizes[plain])])
            joined = np.concatenate([data[bounds[r] : bounds[r + 1]] for r in plain])
            out[plain] = encode.counts(joined, ends)
    return sizes, out


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    limit: int = LIMIT_TOKENS,
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text. One pass without a shuffle."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = narrow.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            sizes, tokens = batch_counts(batch.column(1), encode, chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens)], names=["id", "n_bytes", "n_tokens"])

    counted = narrow.mapInArrow(trimmed(count, "encoder"), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit")
    )


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


__all__ = ["SegmentEncoder", "batch_ids", "count_tokens", "encoder", "spliced_ids", "stable_places"]
