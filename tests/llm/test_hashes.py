"""Texts made to defeat polynomial hashes: Thue-Morse sequences of two letters, equal under every power series modulo 2**64."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from test_text_operators import brute_contamination, library  # noqa: F401

from foldgauge.llm import common, decontaminate, lm_scores, near_dups, packing, token_counts


def thue_morse(n, letters):
    one = [0]
    while len(one) < n:
        one += [1 - x for x in one]
    return "".join(letters[x] for x in one), "".join(letters[1 - x] for x in one)


PAIRS = [thue_morse(1 << k, letters) for k in (10, 11, 12, 16) for letters in ("ea", "xy", "tT")]
TEXTS = [text for pair in PAIRS for text in pair]


@pytest.fixture(scope="module")
def docs(spark):
    """Each text alone and, split by blanks into words of 1,024 letters, among others."""
    rows = list(enumerate(TEXTS)) + [(100 + k, f"one {t} two three four") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


def test_spans_of_all_sizes():
    draw = np.random.default_rng(0)
    for low, high in ((1, 9), (6, 20), (60, 200)):
        texts = ["".join(draw.choice(list("ab"), draw.integers(low, high))) for _ in range(3000)]
        data, bounds = common.text_bytes(pa.array(texts))
        hashes = common.span_hashes(data, bounds[:-1], bounds[1:])
        assert len(set(hashes.tolist())) == len(set(texts))
        where = {}
        for text, value in zip(texts, hashes.tolist(), strict=True):
            assert where.setdefault(text, value) == value
        other = np.roll(np.arange(3000), 1)
        equal = np.flatnonzero(np.diff(bounds) == np.diff(bounds)[other])
        differ = common.spans_differ(data, bounds[:-1][equal], bounds[1:][equal], bounds[:-1][other[equal]])
        assert differ.tolist() == [texts[k] != texts[other[k]] for k in equal]


def test_colliding_segments_are_told_apart(monkeypatch, library):  # noqa: F811
    """Even with a hash that tells nothing apart the ids are right."""
    monkeypatch.setattr(token_counts, "span_hashes", lambda data, starts, ends, fold: np.zeros(len(starts), dtype=np.uint64))
    encode = token_counts.SegmentEncoder(token_counts.vocabulary_path())
    texts = ["some words here", "some words there", "", "x" * 500 + " " + "y" * 500]
    data, bounds = common.text_bytes(pa.array(texts))
    assert encode.counts(data, bounds).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_and_packing(docs, library):  # noqa: F811
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()} == {n: len(x) for n, x in ids.items()}
    for r in packing.pack_documents(docs).collect():
        own = np.array([*ids[r.doc_id], 1], dtype="<u4")
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_near_duplicates(docs):
    classes = near_dups.near_duplicate_classes(near_dups.numbered(docs, "doc_id", "text")).collect()
    want = {}
    for r in docs.collect():
        want.setdefault(r.text.lower(), set()).add(r.doc_id)
    got = {}
    for r in classes:
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_decontamination(spark, docs):
    items = [(k, TEXTS[2 * k]) for k in range(len(PAIRS))] + [(50, f"one {TEXTS[1]} two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = Counter(tuple(r) for r in decontaminate.contamination(docs, benchmark).select(columns).collect())
    assert got == brute_contamination([tuple(r) for r in docs.collect()], items)


def test_language_model_counts(docs):
    rows = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    held = {n: zlib.crc32(str(n).encode()) % 10 == 0 for n in rows}
    known = {w for n, words in rows.items() if not held[n] for w in words}
    scored = lm_scores.language_scores(docs, head=50, shortlist=20, hash_classes=8, dimensions=8).collect()
    assert {r.doc_id: r.n_known for r in scored} == {n: 1 + sum(w in known for w in words) for n, words in rows.items()}
