"""Quality classifier from weak labels (operator 9).

Overlapping heuristic labellers vote bad, good or nothing on every document, for two questions: is it poor text, is it toxic. Known
labels are one more labeller where they exist. Expectation-maximisation estimates each labeller's accuracy from the
counts of vote patterns over all documents (at most 3 to the number of labellers of them, whatever the corpus size) and gives
each pattern a posterior. Posterior labels of a bounded sample, drawn by a hash of the row (``train_rows``), then fit a hashed linear scorer (words,
binned text statistics for form, words, beginnings of words and those that come twice or four times for content, follow-the-regularised-leader with an L1 term, so that chance words
weigh nothing), and the scorer judges every document in one pass over whole texts. For the fit a row counts if its votes changed the odds of its
class by ``sure`` or more either way: a row that only abstaining or weak labellers saw teaches nothing, however rare its class is.

A document is rejected if either score is 0.5 or more. Null and empty texts have no words and are scored by their statistics; repeated rows each give a
row; null ids have no known labels and stay null; repeated label rows count as bad if any says so; an empty table gives no rows; other columns
are ignored or, in ``good_documents``, kept.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import ALNUM, list_array, mix, row_blocks, span_hashes, text_bytes, trimmed, whole_row, word_spans
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

BUCKET_BITS = 20
TRAIN_ROWS = 60_000
SURE = 50.0
PREFIX_BYTES = (4, 6)
OFTEN = (2, 4)
TRUST = 0.9999
ROUNDS = 50
EPOCHS = 3
QUESTIONS = ("poor", "toxic")
#: Questions that the statistics alone decide.
FORM = ("poor",)
NEVER = -30.0
STATISTICS = 6
#: Common insults, a heuristic labeller.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "trash", "clown", "dumb", "worthless", "pathetic", "disgusting", "imbecile", "bastard", "retard", "jerk")
LABELLERS = {"poor": ("capitals", "symbols", "repeats", "variety", "stutter", "known"), "toxic": ("insult", "shouting", "known")}

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#$%&*|!<>{}[]\\^~_=+@"]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[0x41:0x5B] = True
_SMALL = np.zeros(256, dtype=bool)
_SMALL[0x61:0x7B] = True


def _per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marks)])[bounds])


def _insult_hashes() -> np.ndarray:
    data, bounds = text_bytes(pa.array([" ".join(INSULTS)]))
    starts, ends, _ = word_spans(data, bounds, ALNUM)
    return span_hashes(data, starts, ends)


def _three_way(value: np.ndarray, good: float, bad: float, on: np.ndarray) -> np.ndarray:
    """1 (bad) from ``bad`` on, -1 (good) up to ``good``, else 0; rows not ``on`` abstain."""
    return np.where(on, np.where(value >= bad, 1, np.where(value <= good, -1, 0)), 0)


def _distinct(values: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the first of each row's equal values, in order, and how many there are; ``salt`` tells rows apart."""
    _, at, count = np.unique(values ^ salt, return_index=True, return_counts=True)
    often = np.zeros(len(values), dtype=np.int64)
    often[at] = count
    places = np.flatnonzero(often)
    return places, often[places]


def block_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heuristic votes (rows, labellers without the known label), the features of all rows as bucket numbers, one row after
    another and each ending in its statistics, and how many each row has."""
    starts, ends, first = word_spans(data, bounds, ALNUM)
    words = span_hashes(data, starts, ends)
    rows = len(bounds) - 1
    count = np.diff(first)
    owner = np.repeat(np.arange(rows), count)
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    capitals, small, symbols = (_per_row(t[data], bounds) for t in (_CAPITAL, _SMALL, _SYMBOLS))
    letters = np.maximum(1, capitals + small)
    size = np.maximum(1, np.diff(bounds))
    insult = _per_row(np.isin(words, _insult_hashes()), first)
    long_enough = count >= 10

    def share(at: np.ndarray, of: np.ndarray, where: np.ndarray, otherwise: float) -> np.ndarray:
        return np.where(where, np.bincount(owner[at], minlength=rows) / np.maximum(of, 1), otherwise)

    inside = np.flatnonzero(owner[1:] == owner[:-1])
    stutter = share(inside[words[inside] == words[inside + 1]], count - 1, count > 1, 0.0)
    gram = np.flatnonzero(owner[2:] == owner[:-2])
    grams = words[gram] + words[gram + 1] * np.uint64(3) + words[gram + 2] * np.uint64(5)
    repeated = 1 - share(gram[_distinct(grams, salt[gram])[0]], count - 2, long_enough, 1.0)
    distinct, _ = _distinct(words, salt)
    variety = share(distinct, count, long_enough, 1.0)
    found, values = [owner[distinct]], [words[distinct]]
    for width in PREFIX_BYTES:
        longer = np.flatnonzero(ends - starts > width)  # their first bytes are shared by compounds and inflected forms
        begun = mix(span_hashes(data, starts[longer], starts[longer] + width) + np.uint64(width))
        at, often = _distinct(begun, salt[longer])
        for n in (1, *OFTEN):
            few = at[often >= n]
            found.append(owner[longer[few]])
            values.append(mix(begun[few] + np.uint64(n)))
    cap_share, symbol_share = capitals / letters, symbols / size
    votes = np.stack(
        [
            _three_way(cap_share, 0.15, 0.4, letters >= 20),
            _three_way(symbol_share, 0.005, 0.03, count > 0),
            _three_way(repeated, 0.1, 0.35, long_enough),
            _three_way(-variety, -0.5, -0.25, long_enough),
            _three_way(stutter, 0.05, 0.25, count >= 4),
            _three_way(insult.astype(float), 0, 1, count > 0),
            np.where(cap_share >= 0.4, 1, 0),
        ],
        axis=1,
    ).astype(np.int8)
    unknown = np.where(long_enough, 0, 20)  # too few words to tell: a bin of its own
    bins = np.stack(
        [
            np.minimum(19, cap_share * 20),
            np.minimum(19, symbol_share * 200),
            np.maximum(unknown, np.minimum(19, repeated * 20)),
            np.maximum(unknown, np.minimum(19, variety * 20)),
            np.where(count >= 4, np.minimum(19, stutter * 20), 20),
            np.minimum(19, np.log2(count + 1)),
        ],
        axis=1,
    ).astype(np.uint64)
    names = np.arange(1, STATISTICS + 1, dtype=np.uint64) * np.uint64(1_000_003)
    found.append(np.repeat(np.arange(rows), STATISTICS))
    values.append(mix(bins + names).reshape(-1))
    of = np.concatenate(found).astype(np.uint16 if rows < 1 << 16 else np.int64)
    flat = mix(np.concatenate(values)[np.argsort(of, kind="stable")]) >> np.uint64(64 - BUCKET_BITS)
    return votes, flat.astype(np.int32), np.bincount(of, minlength=rows)


_HEURISTICS = ("capitals", "symbols", "repeats", "variety", "stutter", "insult", "shouting")


def cast_votes(docs: DataFrame, id_column: str, text_column: str, share: int) -> DataFrame:
    """(_row, id, votes, features): features only for rows drawn into the sample (``share`` of a million)."""
    body = F.col(text_column)
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000)) < share
    narrow = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), body.alias("body"), drawn.alias("drawn"))
    kind = narrow.schema["id"].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            for low, high in row_blocks(bounds):
                part = batch.slice(low, high - low)
                votes, flat, lengths = block_features(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                chosen = part.column(3).to_numpy(zero_copy_only=False)
                kept = [f if on else f[:0] for f, on in zip(np.split(flat, np.cumsum(lengths)[:-1]), chosen, strict=True)]
                lists = [
                    list_array(votes.reshape(-1), np.full(len(votes), votes.shape[1])),
                    pa.array([f.tobytes() for f in kept], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists, part.column(3)], names=["_row", "id", "votes", "features", "drawn"])

    return narrow.mapInArrow(trimmed(vote), f"_row long, id {kind}, votes array<tinyint>, features binary, drawn boolean")


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, trust: float = TRUST) -> tuple[float, np.ndarray, np.ndarray]:
    """(prior of bad, accuracies (labellers, 2 classes, 3 votes), posterior of bad for each pattern).

    Votes are -1, 0, 1. The first posterior is the share of bad among the votes cast, the last labeller (known labels)
    counting more than all others together. Of the last labeller's votes at least ``trust`` are held to be right, else heuristics
    that agree with each other could outvote it.
    """
    weight = np.ones(patterns.shape[1])
    weight[-1] = 4 * patterns.shape[1]
    bad, good = ((patterns == 1) * weight).sum(axis=1), ((patterns == -1) * weight).sum(axis=1)
    posterior = (bad + 0.1) / (bad + good + 1.0)
    prior, tables = 0.1, np.zeros((patterns.shape[1], 2, 3))
    wrong = (2, 0)  # the column of a false vote, by class
    for _ in range(rounds):
        prior = float(np.clip((posterior * counts).sum() / max(1.0, counts.sum()), 0.001, 0.999))
        for k in range(patterns.shape[1]):
            for vote in (-1, 0, 1):
                on = patterns[:, k] == vote
                tables[k, 0, vote + 1] = ((1 - posterior) * counts)[on].sum() + 0.5
                tables[k, 1, vote + 1] = (posterior * counts)[on].sum() + 0.5
        for side in (0, 1):
            cast = tables[-1, side, 0] + tables[-1, side, 2]
            tables[-1, side, wrong[side]] = min(tables[-1, side, wrong[side]], (1 - trust) * cast)
        cast = tables[:, :, (0, 2)].sum(axis=2, keepdims=True)
        given = np.log(tables / cast)
        given[:, :, 1] = 0  # that a labeller abstains says nothing: short texts make several do so at once
        tables /= tables.sum(axis=2, keepdims=True)
        sides = [np.log(1 - prior) + np.zeros(len(patterns)), np.log(prior) + np.zeros(len(patterns))]
        for k in range(patterns.shape[1]):
            for side in (0, 1):
                sides[side] = sides[side] + given[k, side, patterns[:, k] + 1]
        new = 1 / (1 + np.exp(np.clip(sides[0] - sides[1], -500, 500)))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            posterior = new
            break
        posterior = new
    return prior, tables, posterior


class StoredRows(Sequence):
    """Rows of features in a file, each read when its turn comes: a worker holds their places, not the rows."""

    def __init__(self, file: BinaryIO, starts: np.ndarray, sizes: np.ndarray):
        self.file, self.starts, self.sizes = file, starts, sizes

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, k: int) -> np.ndarray:
        return np.frombuffer(os.pread(self.file.fileno(), int(self.sizes[k]), int(self.starts[k])), dtype=np.int32)


class LinearScorer:
    """Hashed logistic regression, follow-the-regularised-leader per coordinate with L1 and L2."""

    def __init__(self, alpha: float = 0.2, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BUCKET_BITS) + 1)
        self.n = np.zeros((1 << BUCKET_BITS) + 1)

    def _weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def fit(self, rows: Sequence[np.ndarray], targets: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> np.ndarray:
        """Learns and returns the weights, the bias last."""
        bias = np.array([len(self.z) - 1])
        for epoch in range(epochs):
            for k in np.random.default_rng(seed + epoch).permutation(len(rows)).tolist():
                at = np.concatenate([rows[k], bias])
                weight = self._weights(at)
                p = 1 / (1 + np.exp(-np.clip(weight.sum(), -30, 30)))
                g = p - targets[k]
                sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
                self.z[at] += g - sigma * weight
                self.n[at] += g * g
        learnt = np.zeros(len(self.z))
        some = np.append(np.flatnonzero(np.abs(self.z[:-1]) > self.l1), bias)
        learnt[some] = self._weights(some)
        return learnt


def known_labels(labels: DataFrame, id_column: str, poor: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(id, known_poor, known_toxic) as votes; conflicting rows count as bad."""
    quality = F.when(F.min(poor) == 0, 1).when(F.min(poor) == 1, -1).otherwise(0)
    harm = F.when(F.max(toxic) == 1, 1).when(F.max(toxic) == 0, -1).otherwise(0)
    named = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    return named.agg(quality.cast("tinyint").alias("known_poor"), harm.cast("tinyint").alias("known_toxic"))


def fit_scorers(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    train_rows: int = TRAIN_ROWS,
    sure: float = SURE,
) -> tuple[dict[str, np.ndarray], dict[str, dict]]:
    """Weights of both scorers, and what EM found: prior and accuracy of each labeller."""
    share = int(min(1.0, train_rows / max(1, docs.count())) * 1_000_000)
    voted = cast_votes(docs, id_column, text_column, share)
    rows = materialize(voted.join(known_labels(labels, id_column), "id", "left"))
    columns = [F.col("votes")[k].alias(name) for k, name in enumerate(_HEURISTICS)]
    known = [F.coalesce(F.col(f"known_{q}"), F.lit(0).cast("tinyint")).alias(f"known_{q}") for q in QUESTIONS]
    flat = rows.select("_row", *columns, *known, "features", "drawn")
    spark, lessons, facts = docs.sparkSession, [], {}
    for question in QUESTIONS:
        names = [n if n != "known" else f"known_{question}" for n in LABELLERS[question]]
        seen = flat.groupBy(*names).count().collect()  # at most 3 ** labellers rows
        patterns = np.array([[r[n] for n in names] for r in seen], dtype=np.int64).reshape(-1, len(names))
        counts = np.array([r["count"] for r in seen], dtype=np.float64)
        prior, tables, posterior = estimate(patterns, counts)
        facts[question] = {"prior": prior, "accuracy": {n: tables[k].tolist() for k, n in enumerate(names)}}
        odds = posterior / np.maximum(1 - posterior, 1e-12) * (1 - prior) / prior
        taught = [(*map(int, p), float(x)) for p, x, o in zip(patterns, posterior, odds, strict=True) if o >= sure or o <= 1 / sure]
        belief = spark.createDataFrame(taught, ", ".join([*(f"{n} tinyint" for n in names), "target double"]))
        mine = flat.where("drawn").join(F.broadcast(belief), names)  # as few rows as there are patterns
        shown = F.expr(f"substring(features, -{4 * STATISTICS}, {4 * STATISTICS})") if question in FORM else F.col("features")
        lessons.append(mine.select(F.lit(question).alias("question"), "_row", "target", shown.alias("features")))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One scorer for each question from the sample, whose size is bounded by ``train_rows``; rows in the order of their
        numbers. Their features wait in a file of the task's own, which is gone with the task."""
        with tempfile.TemporaryFile() as file:
            places: dict[str, list[tuple[int, float, int, int]]] = {}
            end = 0
            for batch in batches:
                columns = [batch.column(name).to_pylist() for name in ("question", "_row", "target")]
                for question, row, target, features in zip(*columns, batch.column("features"), strict=True):
                    size = file.write(features.as_buffer())
                    places.setdefault(question, []).append((row, target, end, size))
                    end += size
            file.flush()
            for question, lessons in places.items():
                _, targets, starts, sizes = map(np.array, zip(*sorted(lessons), strict=True))
                w = LinearScorer().fit(StoredRows(file, starts, sizes), targets)
                at = np.flatnonzero(w)
                yield pa.RecordBatch.from_pydict({"question": [question] * len(at), "at": at, "weight": w[at]})

    together = reduce(DataFrame.unionByName, lessons).repartition(len(QUESTIONS), "question")
    learnt = together.mapInArrow(trimmed(fit), "question string, at long, weight double")
    weights = {question: np.zeros((1 << BUCKET_BITS) + 1) for question in QUESTIONS}
    for question in QUESTIONS:
        weights[question][-1] = NEVER  # what no sure row teaches is not rejected
    rows_ = learnt.collect()  # the weights that are not zero
    for question in {row.question for row in rows_}:
        weights[question][-1] = 0.0
    for row in rows_:
        weights[row.question][row.at] = row.weight
    return weights, facts


def _sparse(weights: dict[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    out = {}
    for question, w in weights.items():
        at = np.flatnonzero(w[:-1])
        out[question] = (at, w[at], float(w[-1]))
    return out


def _dense(scorers: dict[str, tuple[np.ndarray, np.ndarray, float]]) -> dict[str, tuple[np.ndarray, float]]:
    """The weights as a table over all buckets; one for a task."""
    dense = {}
    for question, (at, w, bias) in scorers.items():
        dense[question] = (np.zeros(1 << BUCKET_BITS, dtype=np.float32), bias)
        dense[question][0][at] = w
    return dense


def _batch_scores(texts: pa.Array, dense: dict[str, tuple[np.ndarray, float]]) -> dict[str, np.ndarray]:
    data, bounds = text_bytes(texts)
    scores = {question: np.zeros(len(bounds) - 1) for question in dense}
    for low, high in row_blocks(bounds):
        _, flat, lengths = block_features(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        for question, (w, bias) in dense.items():
            if question in FORM:
                total = w[flat[(ends[1:, None] - np.arange(1, STATISTICS + 1))]].sum(axis=1) + bias
            else:
                total = np.diff(np.concatenate([[0.0], np.cumsum(w[flat], dtype=np.float64)])[ends]) + bias
            scores[question][low:high] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    return scores


def judge_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """(id, p_poor, p_toxic, rejected) of every document."""
    weights, _ = fit_scorers(docs, labels, id_column, text_column, **options)
    shared = docs.sparkSession.sparkContext.broadcast(_sparse(weights))
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = narrow.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(shared.value)
        for batch in batches:
            scores = _batch_scores(batch.column(1), dense)
            bad = (scores["poor"] >= 0.5) | (scores["toxic"] >= 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores["poor"]), pa.array(scores["toxic"]), pa.array(bad)], names=["id", "p_poor", "p_toxic", "rejected"])

    return narrow.mapInArrow(trimmed(score), f"id {kind}, p_poor double, p_toxic double, rejected boolean").withColumnRenamed("id", id_column)


def good_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they are, in one pass."""
    weights, _ = fit_scorers(docs, labels, id_column, text_column, **options)
    shared = docs.sparkSession.sparkContext.broadcast(_sparse(weights))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(shared.value)
        for batch in batches:
            scores = _batch_scores(batch.column(0).field(text_column), dense)
            yield batch.filter(pa.array((scores["poor"] < 0.5) & (scores["toxic"] < 0.5)))

    whole = docs.select(whole_row(docs))
    return whole.mapInArrow(trimmed(keep), whole.schema).select("whole.*")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
