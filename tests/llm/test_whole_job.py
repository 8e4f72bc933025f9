"""Cases in which an operator once did less than the whole job."""

import numpy as np
import pyarrow as pa

from foldgauge.llm import near_dups, neighbours


def test_pairs_whose_bytes_agree_in_an_earlier_band_are_compared():
    raw = np.random.default_rng(1).integers(0, 256, 240, dtype=np.uint8).tobytes()
    bands = [[10, 20, 30], [11, 20, 30], [10, 21, 30]]  # the bytes of band 0 agree, its keys do not
    part = pa.table(
        {
            "asks": [True, False, False], "component": [1, 2, 3], "size": [9, 9, 9], "near": [0.75] * 3, "band": [1] * 3,
            "signature": pa.array([raw] * 3, type=pa.binary()), "bands": pa.chunked_array([bands[:2], bands[2:]], type=pa.list_(pa.int64())),
        }
    )
    found = [(k, fit.tolist()) for k, fit in near_dups._possible(part, 0.8, 0.12, False)]
    assert found == [(0, [1])]  # row 2 met row 0 in band 0


def test_no_pair_just_above_the_threshold_is_left_by_all_its_buckets():
    """2,000 pairs at similarity 0.82: in the first bucket that a pair shares, it is compared."""
    draw = np.random.default_rng(7)
    sets = []
    for _ in range(2000):
        words = draw.integers(0, 1 << 63, 158).astype(np.uint64)
        sets += [np.unique(words[:144]), np.unique(np.concatenate([words[:130], words[144:]]))]
    flat, first = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    signatures = near_dups.dart_signatures(flat, np.ones(len(flat)), first, 240)
    keys = near_dups.band_keys(signatures, 40)
    raw = (near_dups.mix(signatures) & np.uint64(0xFF)).astype(np.uint8)
    lost = 0
    for k in range(0, len(sets), 2):
        shared = np.flatnonzero(keys[k] == keys[k + 1])
        if len(shared) and (raw[k] == raw[k + 1]).mean() >= 0.68:
            part = pa.table(
                {
                    "asks": [True, False], "component": [1, 2], "size": [144, 144], "near": [0.75] * 2, "band": [int(shared[0])] * 2,
                    "signature": pa.array([r.tobytes() for r in raw[k : k + 2]], type=pa.binary()),
                    "bands": pa.array(near_dups.as_signed(keys[k : k + 2]).tolist(), type=pa.list_(pa.int64())),
                }
            )
            lost += not list(near_dups._possible(part, 0.8, 0.12, False))
    assert lost == 0


def test_vectors_of_a_reused_id_and_of_other_widths_take_part(spark):
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(size=8).tolist()) for k in range(20, 80)]
    near = {q: (np.array(v) + 0.01 * draw.normal(size=8)).tolist() for q, v in rows if q % 20 == 0}
    rows += [(1, v) for v in near.values()]  # one id, a vector beside each query
    rows += [(100 + k, near[40]) for k in range(3)]
    rows += [(200 + k, draw.normal(size=4).tolist()) for k in range(9)]
    rows += [(300, [0.0] * 8), (300, draw.normal(size=8).tolist())]  # its zero vector takes no part, the other asks
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(vectors, every=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = {}
    firsts = {q: min(np.array(v).tobytes() for n, v in rows if n == q and any(v)) for q, _ in rows if q % 20 == 0}
    for q, own in firsts.items():
        a, best = np.frombuffer(own), {}
        for n, v in rows:
            if n != q and len(v) == len(a) and any(v):
                b = np.array(v)
                best[n] = max(best.get(n, -2), a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
        want[q] = [n for n, _ in ranked]
    assert {q: [n for _, n, _ in sorted(x)] for q, x in got.items()} == want
    assert all(want[q][0] == 1 for q in (20, 40, 60)) and set(want) == {20, 40, 60, 100, 200, 300}
