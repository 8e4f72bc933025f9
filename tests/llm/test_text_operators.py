"""Token counts, packing, decontamination and language scores against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foldgauge.llm import decontaminate, lm_scores, packing, token_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.vocabulary_path())


@pytest.fixture(scope="module")
def both(tricky, documents):
    return documents.select("doc_id", "text").unionByName(tricky.select("doc_id", "text"))


def test_token_counts(both, library):
    texts = Counter((r.doc_id, r.text) for r in both.collect())
    want = Counter()
    for (number, text), times in texts.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[number, len((text or "").encode()), n, n > 1024] += times
    for options in ({}, {"chunk": 700, "overlap": 16}):
        got = Counter(tuple(r) for r in token_counts.count_tokens(both, **options).collect())
        assert got == want


def test_ranks_give_the_same_ids(both, library):
    import pyarrow as pa

    encode = token_counts.SegmentEncoder(token_counts.vocabulary_path(), token_counts.vocabulary_path(token_counts.RANKS))
    texts = [r.text for r in both.collect()]
    found = {}
    for row, ids in token_counts.batch_ids(pa.array(texts), encode, 900, 32):
        found.setdefault(row, []).append(ids)
    for row, text in enumerate(texts):
        ids = np.concatenate(found.get(row, [np.zeros(0)])).tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids


def test_tournament_tree_is_first_fit():
    lengths = np.random.default_rng(1).integers(1, 400, 500)
    bins, places = packing.first_fit_decreasing(lengths, 1000)
    room, want = [], np.zeros(len(lengths), dtype=int)
    for k in np.argsort(-lengths, kind="stable"):
        for b, free in enumerate(room):
            if free >= lengths[k]:
                break
        else:
            b = len(room)
            room.append(1000)
        room[b] -= lengths[k]
        want[k] = b
    assert bins.tolist() == want.tolist()
    for b in set(bins.tolist()):
        spans = sorted((places[k], places[k] + lengths[k]) for k in np.flatnonzero(bins == b))
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_packing(both, library):
    rows = packing.pack_documents(both, group_pieces=64).collect()
    ids = {}
    for r in both.collect():
        own = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        ids.setdefault((r.doc_id, len(own)), []).append(own)
    tokens = Counter()
    for r in rows:
        assert any(zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for own in ids[r.doc_id, r.doc_tokens])
        tokens[r.doc_id, r.doc_tokens] += r.length
    assert tokens == {key: key[1] * len(owns) for key, owns in ids.items()}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 2048
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False))


def brute_contamination(texts, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        n = min(13, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(str(item))
    out = Counter()
    for number, text in texts:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[number, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)] += 1
    return out


def test_contamination(spark, both, benchmark):
    first = benchmark.first()
    planted = spark.createDataFrame(
        [(10**6, first.text), (10**6 + 1, "before " * 20 + first.text + " after" * 3000), (10**6 + 2, " ".join(first.text.split()[:12]))], both.schema
    )
    docs = both.unionByName(planted)
    extra = spark.createDataFrame([(901, "the lazy dog"), (902, "the lazy dog"), (903, None), (904, " ... "), (905, "word word word")], "item_id long, text string")
    items = benchmark.select("item_id", "text").unionByName(extra)
    want = brute_contamination([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for options in ({"shard_words": 500}, {"block_words": 100}):
        got = Counter(tuple(r) for r in decontaminate.contamination(docs, items, **options).select(columns).collect())
        assert got == want
    found = {r.doc_id: r for r in decontaminate.contamination(planted, items).collect()}
    assert found[10**6].longest_words == found[10**6].n_words and found[10**6 + 1].longest_at == 20


def test_null_items_and_repeated_documents(spark, both):
    words = " ".join(f"w{k}" for k in range(30))
    items = spark.createDataFrame([(None, words), (7, words), (None, "w3 w4"), (8, "w3 w4")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {words} y"), (1, f"x {words} y"), (2, "w3 w4"), (None, None)], "doc_id long, text string")
    for options in ({}, {"block_words": 20}):
        rows = sorted(decontaminate.contamination(docs, items, **options).collect(), key=lambda r: (r.n_words, r.n_items))
        assert [(r.n_hit, r.n_items) for r in rows] == [(0, 0), (2, 2), (30, 3), (30, 3)]
        assert rows[1].items_sha256 == hashlib.sha256(b"8").hexdigest() and rows[2].items_sha256 == hashlib.sha256(b"7,8").hexdigest()


def test_many_items_that_share_a_window(spark):
    """100,000 items begin with the same 20 words, which 300 documents hold: each is gone through once, not once a document."""
    import time

    shared = " ".join(f"s{k}" for k in range(20))
    items = spark.range(100_000).selectExpr("id AS item_id", f"concat('{shared} tail', id) AS text")
    docs = spark.range(300).selectExpr("id AS doc_id", f"concat('d', id, ' {shared} and more words ', id) AS text")
    begun = time.perf_counter()
    rows = decontaminate.contamination(docs, items, list_items=False).collect()
    assert time.perf_counter() - begun < 60
    digest = hashlib.sha256(",".join(sorted(map(str, range(100_000)))).encode()).hexdigest()
    assert {(r.n_hit, r.n_items, r.items_sha256, r.longest_words, r.longest_at, r.longest_item) for r in rows} == {(20, 100_000, digest, 20, 1, "0")}


def test_clean_documents_keeps_columns(tricky, nothing, benchmark):
    for options in ({}, {"block_words": 100}):
        kept = decontaminate.clean_documents(tricky, benchmark, **options)
        assert kept.columns == tricky.columns and kept.count() == tricky.count()
    assert decontaminate.clean_documents(nothing, benchmark).count() == 0


def test_language_scores(both):
    rows = both.collect()
    words = [[w for w in re.findall("[^\x20\x09-\x0d]+", lowered(r.text))] + [None] for r in rows]
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 == 0 for r in rows]
    count = Counter(w for own, out in zip(words, held, strict=True) if not out for w in own)
    total = sum(count.values())
    normal = math.log10(total + 0.1 * (len(count) + 1))
    want = sorted(
        (-1 if r.doc_id is None else r.doc_id, out, len(own), sum(count[w] > 0 for w in own), total, round(sum(math.log10(count[w] + 0.1) for w in own) - len(own) * normal, 4))
        for r, own, out in zip(rows, words, held, strict=True)
    )
    scored = lm_scores.language_scores(both, head=50, shortlist=20, hash_classes=8, dimensions=8).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in scored)
    assert got == want
    assert all(r.score < 0 for r in scored)


def test_language_model_is_normalised_and_learns():
    noise = np.array([0.4, 0.3, 0.2, 0.1])
    model = lm_scores.LogBilinear(4, 8, noise)
    before = np.array([[a, b] for a in range(4) for b in range(4)])
    for target in ([np.exp(model.log_probabilities(before, np.full(16, k))) for k in range(4)],):
        assert np.allclose(np.sum(target, axis=0), 1, atol=1e-5)
    draw = np.random.default_rng(0)
    chain = np.cumsum(draw.integers(0, 2, 20000)) % 4  # the next class is this one or the one after
    pairs = lm_scores.contexts(chain, np.array([0, len(chain)]), 0)
    squares = {name: np.ones_like(getattr(model, name)) for name in model.SHAPES}
    for at in range(0, len(chain), 200):
        model.learn(pairs[at : at + 200], chain[at : at + 200], draw, squares, 16, 0.3)
    assert model.log_probabilities(pairs, chain).mean() > np.log(0.42)


def test_empty_tables(nothing, benchmark):
    assert token_counts.count_tokens(nothing).count() == 0
    assert packing.pack_documents(nothing).count() == 0
    assert decontaminate.contamination(nothing, benchmark).count() == 0
    assert decontaminate.contamination(nothing, benchmark.limit(0)).count() == 0
    assert lm_scores.language_scores(nothing).count() == 0
