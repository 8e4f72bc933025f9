"""Joint training against one problem at a time, and a ledger that is never asked twice."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldgauge import CorpusSchema
from foldgauge.operators import classifier as C
from foldgauge.operators import scoring
from foldgauge.session import scratch_dir
from foldgauge.sources.runs import read_or_empty


def test_lockstep_search_finds_each_minimum():
    """Quadratics of very different scales, one for each column."""
    draw = np.random.default_rng(0)
    n, columns = 30, 5
    centre = draw.normal(size=(n, columns))
    curve = draw.uniform(0.5, 2, size=(n, columns)) * 10.0 ** np.arange(-2, 3)
    search = C.LockstepLBFGS((n, columns), 6, np.full(columns, 1.0))
    for _ in range(60):
        apart = search.trial - centre
        search.tell((0.5 * curve * apart**2).sum(axis=0), (curve * apart).astype(np.float32))
    assert np.allclose(search.place, centre, atol=1e-2)


def test_joint_sums_equal_plain_ones(spark):
    """Gradient sums of a pass over several tasks and chunks against numpy on the whole table."""
    schema = CorpusSchema(labels=("a", "b"), id="id", text="text")
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(i % 9)), i % 2, int(i % 3 == 0)) for i in range(200)]
    corpus = spark.createDataFrame(rows, "id int, text string, a int, b int").repartition(5)
    roles = spark.createDataFrame([(f, i, ["train", "val", "test"][(i + f) % 3]) for i in range(200) for f in range(2)], "fold int, id int, role string")
    settings = C.TrainSettings(n_features=64)
    stored = C.token_features(corpus, schema, settings).join(C.roles_by_id(roles, schema, (0, 1)), "id").select("labels", "roles", "tokens")

    add_by_column = C._add_by_column

    def add(part, matrix, numbers):
        train = (part.roles == 0).astype(float)
        add_by_column(matrix, part.column, train[part.row] * part.value[:, None])
        numbers += train.sum(axis=0)

    matrix, numbers = C.summed(stored, 64, 2, 2, add)
    want = np.zeros((64, 2))
    for r in stored.collect():
        tokens, counts = np.unique(r.tokens or [], return_counts=True)
        for f in range(2):
            if r.roles[f] == 0 and len(tokens):
                want[tokens.astype(int), f] += 1 + np.log(counts)
    assert np.allclose(matrix, want) and numbers.tolist() == [sum((i + f) % 3 == 0 for i in range(200)) for f in range(2)]


def test_partial_sums_do_not_grow_with_the_partitions(spark):
    """Each task passes on a whole matrix, so there may be no more tasks than cores, and every row is still counted."""
    rows = [([1], [0], [i % 8, i % 3]) for i in range(400)]
    stored = spark.createDataFrame(rows, "labels array<int>, roles array<int>, tokens array<int>").repartition(40)

    def add(part, matrix, numbers):
        numbers[0] += len(part.labels)
        numbers[1] = 1  # this task has a matrix
        matrix[:, 0] += np.bincount(part.column, minlength=8)

    matrix, (n, tasks) = C.summed(stored, 8, 1, 2, add)
    assert n == 400 and matrix.sum() == sum(len({i % 8, i % 3}) for i in range(400))
    assert tasks <= spark.sparkContext.defaultParallelism


def test_margins_and_sums_of_a_pass_equal_dense_products():
    draw = np.random.default_rng(1)
    n, n_features, folds, labels = 40, 16, 3, 2
    counts = draw.poisson(0.4, size=(n, n_features))
    counts[5] = 0
    row, column = np.nonzero(counts)
    rows = C.Rows(draw.integers(0, 2, (n, labels)).astype(float), np.zeros((n, folds), dtype=int), row, column, 1 + np.log(counts[row, column]))
    idf, weights = draw.uniform(size=(folds, n_features)), draw.normal(size=(folds * labels, n_features + 1))
    values, plain = C._scaled(rows, idf), np.where(counts, 1 + np.log(np.maximum(counts, 1)), 0)
    margins = C._margins(rows, values, weights)
    for f in range(folds):
        dense = plain * idf[f]
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
        mine = weights[f * labels : (f + 1) * labels]
        assert np.allclose(margins[:, f], dense @ mine[:, :-1].T + mine[:, -1])
        total = np.ones((n_features, 1))
        C._add_by_column(total, column, values[f][:, None])
        assert np.allclose(total[:, 0], 1 + dense.sum(axis=0))


def test_stored_features_give_the_sums_of_plain_tf_idf(spark, monkeypatch):
    """What passes work out from stored distinct features, over several pieces and slabs, against tf-idf values of the tokens; passes read no tokens."""
    monkeypatch.setattr(C, "SLAB_ENTRIES", 16)
    monkeypatch.setattr(C, "CHUNK_ENTRIES", 200)
    draw = np.random.default_rng(2)
    n_features, folds, labels = 64, 3, 2
    data = [(i, [i % 2, i // 2 % 2], [int(x) for x in draw.integers(0, 3, folds)], [int(x) for x in draw.poisson(6, draw.integers(0, 40))]) for i in range(50)]
    stored = spark.createDataFrame(data, "id int, labels array<int>, roles array<int>, tokens array<int>").coalesce(1)
    rank, idf = draw.permutation(n_features).astype(np.int32), draw.uniform(1, 2, size=(folds, n_features)).astype(np.float32)
    featured = C.with_features(stored, "id", n_features, rank, idf)
    assert not any(kind == "array<int>" for name, kind in featured.dtypes if name not in ("labels", "roles"))
    trial = draw.normal(size=(n_features + 1, folds * labels)).astype(np.float32)
    plain = {r.id: r for r in stored.collect()}
    batch = featured.toArrow().combine_chunks().to_batches()[0]
    at, total, want = 0, np.zeros((folds * labels, n_features)).T, np.zeros((n_features, folds * labels))
    for rows in C.feature_rows(batch):
        n = len(rows.labels)
        margins = C._joint_margins(rows, np.ascontiguousarray(C._weighed(trial, idf, labels)), trial[-1])
        apart = draw.normal(size=margins.shape)
        C._add_slopes(rows, apart, total)
        for i in range(n):
            tokens, counts = np.unique(np.array(plain[batch.column(0)[at + i].as_py()].tokens, dtype=int), return_counts=True)
            for f in range(folds):
                value = (1 + np.log(counts)) * idf[f][rank[tokens]]
                value /= max(np.linalg.norm(value), 1e-12)
                for label in range(labels):
                    k = f * labels + label
                    assert np.isclose(margins[i, f, label], value @ trial[rank[tokens], k] + trial[-1, k])
                    want[rank[tokens], k] += value * apart[i, f, label]
        at += n
    assert at == 50 and np.allclose(total * np.repeat(idf, labels, axis=0).T, want)


def test_rows_without_tokens_and_roles_are_scored_or_left_out(spark):
    schema = CorpusSchema(labels=("a",), id="id", text="text")
    corpus = spark.createDataFrame([(i, None if i == 7 else ("yes " if i % 2 else "no ") * 3, i % 2) for i in range(60)], "id int, text string, a int")
    roles = spark.createDataFrame([(0, i, "test" if i < 20 else "val" if i < 30 else "train") for i in range(50)], "fold int, id int, role string")
    scored, history = C.train_score_folds(corpus, roles, schema, C.TrainSettings(n_features=32, epochs=2), [0])
    rows = {r.id: r for r in scored.collect()}
    assert set(rows) == set(range(20)) and all(r.pred_a == r.true_a for i, r in rows.items() if i != 7)
    assert 0 < rows[7].prob_a < 1 and history.count() == 2


@pytest.mark.parametrize("concurrency", [1, 4])
def test_ledger_is_asked_once(spark, concurrency):
    """Every call leaves a trace in its reply; the second run over more rows asks only the new ones."""
    messages = F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("content")))
    ask = spark.range(60).select("id", (F.col("id") % 2).alias("part"), messages.alias("messages"))
    ledger = scratch_dir(spark)

    def factory(name):
        def make():
            def score(messages):
                if messages[-1]["content"] == "n13":
                    raise TimeoutError
                return f"{name} {messages[-1]['content']}"

            return score

        return make

    first = scoring.score_with_ledger(ask.where("id < 30"), ["id", "part"], factory("one"), ledger, rounds=3, concurrency=concurrency)
    assert first.count() == 30
    both = scoring.score_with_ledger(ask, ["id", "part"], factory("two"), ledger, rounds=3, concurrency=concurrency).collect()
    assert sorted(r.id for r in both) == list(range(60))
    for r in both:
        assert r.call_error == (r.id == 13)
        assert r.id == 13 or r.raw_response == f"{'one' if r.id < 30 else 'two'} n{r.id}"
    assert read_or_empty(spark, ledger, "id long, part long, raw_response string").count() == 60
