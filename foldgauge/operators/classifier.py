"""A multi-label classifier for all folds at once: logistic regressions trained in joint passes over one table.

It stands where an encoder would be fine-tuned: fresh per fold, trained on the train part, the best of
several epochs chosen on validation macro-F1, then the test part scored. Every fold and label is a column of one coefficient matrix. A pass
reads each stored row once and, for all columns together, sums loss and gradient over the folds that train on the row and
confusion counts over those that validate on it; sums are added up inside tasks, as many as there are cores, and then block by
block over the cluster. What is the same in every pass is worked out once and stored with the rows: the distinct features of a row, frequent
ones under low numbers, and its length in each fold. The idf goes to the weights and to the summed gradient instead of to every entry.
The driver takes one L-BFGS step per pass for every column, each with its own step length and history, and goes on from
there in the next epoch. So a run costs ``epochs * steps_per_epoch + 1`` passes, whatever the number of folds and labels.

What is broadcast and collected has ``n_features * folds * labels`` numbers, a bound set by parameters, not by the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldgauge import fixed_values as V
from foldgauge.functions.text import token_window
from foldgauge.operators.cleaning import clean_corpus
from foldgauge.operators.metrics import threshold_predictions
from foldgauge.schema import CorpusSchema
from foldgauge.session import materialize


@dataclass(frozen=True)
class TrainSettings:
    max_tokens: int = V.MAX_TOKENS
    n_features: int = 1 << 18
    epochs: int = V.EPOCHS
    steps_per_epoch: int = 3
    reg_param: float = 1e-4
    threshold: float = V.DECISION_THRESHOLD
    weighted: bool = False
    pos_weight_clip: float = V.POS_WEIGHT_CLIP
    clean: bool = True
    memory: int = 4


ROLE_CODES = {"train": 0, "val": 1, "test": 2}
BLOCK = 4096
CHUNK_ENTRIES = 1 << 18
SLAB_ENTRIES = 1 << 15


def token_features(corpus: DataFrame, schema: CorpusSchema, settings: TrainSettings) -> DataFrame:
    """Id, labels and the hashed tokens of each row; texts are cleaned and cut once, not per epoch."""
    cleaned = clean_corpus(corpus, schema.text, "cleaned_text", enabled=settings.clean)
    words = token_window(F.lower("cleaned_text"), settings.max_tokens)
    hashed = F.transform(words, lambda word: F.pmod(F.xxhash64(word), F.lit(settings.n_features)).cast("int"))
    labels = F.array(*[F.coalesce(F.col(label).cast("int"), F.lit(0)) for label in schema.labels])
    return cleaned.select(schema.id, labels.alias("labels"), hashed.alias("tokens"))


def roles_by_id(roles: DataFrame, schema: CorpusSchema, folds: Sequence[int]) -> DataFrame:
    """One row per id with a small code per fold (-1: no role), so texts and features need not be copied per fold."""
    code = F.coalesce(*[F.when(F.col("role") == role, F.lit(value)) for role, value in ROLE_CODES.items()])
    wide = roles.groupBy(schema.id).agg(*[F.max(F.when(F.col("fold") == f, code)).alias(f"role_{f}") for f in folds])
    packed = F.array(*[F.coalesce(f"role_{f}", F.lit(-1)).cast("int") for f in folds])
    return wide.select(schema.id, packed.alias("roles"))


@dataclass
class Rows:
    """Rows of a batch as numpy arrays: labels (n, L), roles (n, folds), their distinct tokens with log counts in row order and,
    once it is known, the length (n, folds) of each row's tf-idf values."""

    labels: np.ndarray
    roles: np.ndarray
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    length: np.ndarray | None = None

    @cached_property
    def starts(self) -> np.ndarray:
        """Where the entries of a row begin, for each row that has any."""
        return np.flatnonzero(np.concatenate([[True], self.row[1:] != self.row[:-1]])) if len(self.row) else np.zeros(0, dtype=np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over the entries of each row."""
        out = np.zeros(len(self.labels))
        if len(self.row):
            out[self.row[self.starts]] = np.add.reduceat(values, self.starts)
        return out


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """First row and end of pieces of about CHUNK_ENTRIES entries (or one row), so that memory does not follow the batch."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + CHUNK_ENTRIES, side="right")))
        yield at, upto
        at = upto


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of one size as the rows of a matrix."""
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _packed(numbers: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``sizes`` numbers a row as bytes: Spark copies a row's bytes at once, but the items of an array one by one."""
    offsets = np.concatenate([[0], np.cumsum(sizes * numbers.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))])


def _unpacked(packed: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows and how many each row has."""
    _, offsets, data = packed.buffers()
    offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(packed.type) else np.int32)
    offsets = offsets[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
    numbers = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return numbers.view(dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _distinct(batch: pa.RecordBatch, n_features: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """In pieces of a batch that holds tokens as they stand in the text: first row, end, and row, feature and count of each entry."""
    tokens = batch.column("tokens")
    sizes = np.array(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    for at, upto in _pieces(sizes):
        mine = tokens.slice(at, upto - at).flatten().to_numpy()
        keys, counts = np.unique(np.repeat(np.arange(upto - at), sizes[at:upto]) * n_features + mine, return_counts=True)
        yield at, upto, keys // n_features, keys % n_features, counts


def batch_rows(batch: pa.RecordBatch, n_features: int) -> Iterator[Rows]:
    """Rows of a batch that holds tokens, in pieces."""
    y, r = _matrix(batch.column("labels")).astype(np.float64), _matrix(batch.column("roles"))
    for at, upto, row, column, counts in _distinct(batch, n_features):
        yield Rows(y[at:upto], r[at:upto], row, column, 1 + np.log(counts))


def feature_rows(batch: pa.RecordBatch) -> Iterator[Rows]:
    """Rows of a batch that ``with_features`` made, in pieces."""
    y, r = _matrix(batch.column("labels")).astype(np.float64), _matrix(batch.column("roles"))
    length = _unpacked(batch.column("length"), np.float64)[0].reshape(len(y), -1)
    (columns, sizes), counts = _unpacked(batch.column("features"), np.int32), _unpacked(batch.column("counts"), np.int32)[0]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for at, upto in _pieces(sizes):
        mine, row = slice(ends[at], ends[upto]), np.repeat(np.arange(upto - at), sizes[at:upto])
        yield Rows(y[at:upto], r[at:upto], row, columns[mine].astype(np.intp), 1 + np.log(counts[mine]), length[at:upto])


def with_features(stored: DataFrame, row_id: str, n_features: int, rank: np.ndarray, idf: np.ndarray) -> DataFrame:
    """Id, labels and roles with what every pass needs of a row: its distinct features, numbered by ``rank``, their counts, and the
    length of its tf-idf values in each fold. ``idf`` is numbered by rank."""
    shared = stored.sparkSession.sparkContext.broadcast((rank, idf))
    names, kind = [row_id, "labels", "roles", "features", "counts", "length"], stored.schema[row_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, idf = shared.value
        for batch in batches:
            for at, upto, row, column, counts in _distinct(batch, n_features):
                n, column = upto - at, rank[column]
                sizes = np.bincount(row, minlength=n)
                length = _lengths(Rows(np.empty((n, 0)), np.empty((n, 0)), row, column, 1 + np.log(counts)), idf)
                kept = [batch.column(name).slice(at, n) for name in names[:3]]
                entries = [_packed(column.astype(np.int32), sizes), _packed(counts.astype(np.int32), sizes)]
                yield pa.RecordBatch.from_arrays([*kept, *entries, _packed(length, np.full(n, len(idf)))], names=names)

    fields = f"`{row_id}` {kind}, labels array<int>, roles array<int>, features binary, counts binary, length binary"
    return stored.select(row_id, "labels", "roles", "tokens").mapInArrow(work, fields)


def _add_by_column(total: np.ndarray, column: np.ndarray, values: np.ndarray) -> None:
    """Adds the rows of ``values`` to the rows of ``total`` that ``column`` names, one number of them after the other."""
    for k in range(values.shape[1]):
        sums = np.bincount(column, weights=values[:, k])
        total[: len(sums), k] += sums


def summed(
    stored: DataFrame,
    n_features: int,
    width: int,
    extra: int,
    add: Callable[[Rows, np.ndarray, np.ndarray], None],
    read: Callable[[pa.RecordBatch], Iterator[Rows]] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Totals over all rows: an (n_features, width) matrix and ``extra`` numbers, both filled by ``add``.

    ``read`` takes the rows out of a batch; without it the table holds tokens. Each task adds up its own matrix, and there are no more tasks than cores, so what is passed on does not grow with the rows.
    Blocks of BLOCK features that hold anything are then added up in parallel, one after the other as they arrive, so the
    cluster reduces the matrix and the driver only puts the finished blocks in place.
    """

    read = read or partial(batch_rows, n_features=n_features)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, numbers = np.zeros((width, n_features)).T, np.zeros(extra)  # a column's numbers side by side
        for batch in batches:
            for rows in read(batch):
                add(rows, matrix, numbers)
        for low in range(0, n_features, BLOCK):
            part = matrix[low : low + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([part.tobytes()])], names=["low", "part"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([numbers.tobytes()])], names=["low", "part"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for low, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total = totals.setdefault(low, np.zeros(len(part.as_buffer()) // 8))
                total += np.frombuffer(part.as_buffer())
        for low, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([total.tobytes()])], names=["low", "part"])

    schema = "low long, part binary"
    matrix, numbers = np.zeros((n_features, width)), np.zeros(extra)
    cores = max(2, stored.sparkSession.sparkContext.defaultParallelism)
    parts = stored.coalesce(cores).mapInArrow(local, schema).repartition(cores, "low")
    # at most n_features / BLOCK rows of BLOCK * width numbers
    for low, part in parts.mapInArrow(reduce, schema).collect():
        if low < 0:
            numbers = np.frombuffer(part)
        else:
            matrix[low : low + BLOCK] = np.frombuffer(part).reshape(-1, width)
    return matrix, numbers


def _lengths(rows: Rows, idf: np.ndarray) -> np.ndarray:
    """(rows, folds): the length of each row's tf-idf values with the idf of each fold (row of ``idf``)."""
    return np.stack([np.maximum(np.sqrt(rows.sums((rows.value * one[rows.column]) ** 2)), 1e-12) for one in idf], axis=1)


def _scaled(rows: Rows, idf: np.ndarray) -> list[np.ndarray]:
    """For each fold (row of ``idf``) the tf-idf value of each entry, rows of length one: what passes use without writing it out."""
    lengths = _lengths(rows, idf)
    return [rows.value * one[rows.column] / length[rows.row] for one, length in zip(idf, lengths.T, strict=True)]


def _row_dots(rows: Rows, values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums over each row's entries of its value times the numbers that ``table`` has for its feature side by side, in slabs of
    entries that stay in the processor's cache."""
    out, at = np.zeros((len(rows.labels), table.shape[1])), 0
    while at < len(rows.starts):
        upto = max(at + 1, int(np.searchsorted(rows.starts, rows.starts[at] + SLAB_ENTRIES)))
        starts = rows.starts[at:upto]
        mine = slice(starts[0], rows.starts[upto] if upto < len(rows.starts) else len(values))
        found = table.take(rows.column[mine], axis=0) * values[mine, None]
        out[rows.row[starts]] = np.add.reduceat(found, starts - starts[0], axis=0)
        at = upto
    return out


def _margins(rows: Rows, values: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """(rows, folds, labels): the linear scores; ``weights`` has a row for each fold and label, the intercept last in it."""
    n_labels = rows.labels.shape[1]
    by_fold = weights.reshape(len(values), n_labels, -1)
    return np.stack([_row_dots(rows, value, mine[:, :-1].T) + mine[:, -1] for value, mine in zip(values, by_fold, strict=True)], axis=1)


def _weighed(trial: np.ndarray, idf: np.ndarray, n_labels: int) -> np.ndarray:
    """Coefficients of each fold and label times the fold's idf, so that log counts can stand for tf-idf values."""
    return trial[:-1].astype(np.float64) * np.repeat(idf, n_labels, axis=0).T


def _joint_margins(rows: Rows, weighed: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """``_margins`` of the tf-idf values, from log counts and ``_weighed`` coefficients."""
    n, n_folds = rows.length.shape
    return _row_dots(rows, rows.value, weighed).reshape(n, n_folds, -1) / rows.length[:, :, None] + intercepts.reshape(n_folds, -1)


def _add_slopes(rows: Rows, apart: np.ndarray, matrix: np.ndarray) -> None:
    """Adds each row's features times its (fold, label) numbers ``apart`` to ``matrix``, which still lacks the idf."""
    shares = np.ascontiguousarray((apart / rows.length[:, :, None]).reshape(len(apart), -1).T)
    by_entry = np.empty(len(rows.row))
    for k, share in enumerate(shares):
        share.take(rows.row, out=by_entry, mode="clip")
        by_entry *= rows.value
        _add_by_column(matrix[:, k : k + 1], rows.column, by_entry[:, None])


def _probabilities(margins: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * margins))


class LockstepLBFGS:
    """Independent L-BFGS minimisations, one for each column of the coefficient matrix, all taking their steps together.

    A column whose trial step does not lower its objective enough keeps its place and tries a quarter of the step next.
    """

    def __init__(self, shape: tuple[int, int], memory: int, first_step: np.ndarray):
        self.trial = np.zeros(shape, dtype=np.float32)
        self.place, self.gradient, self.direction = (np.zeros(shape, dtype=np.float32) for _ in range(3))
        self.value = np.full(shape[1], np.inf)
        self.slope, self.step, self.first_step = np.zeros(shape[1]), np.ones(shape[1]), first_step
        self.memory, self.past = memory, []

    def tell(self, value: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """Takes objective and gradient at ``trial``, chooses the next one; returns which columns moved."""
        begun = np.isfinite(self.value)
        moved = ~begun | (value <= self.value + 1e-4 * self.step * self.slope)
        moved_by = (self.trial - self.place) * moved
        bent_by = (gradient - self.gradient) * moved
        bend = np.einsum("ij,ij->j", moved_by, bent_by, dtype=np.float64)
        if begun.any():
            usable = moved & (bend > 1e-12)
            self.past = [*self.past, (moved_by * usable, bent_by * usable, np.where(usable, 1 / np.where(usable, bend, 1), 0))][-self.memory :]
        self.place = np.where(moved, self.trial, self.place)
        self.gradient = np.where(moved, gradient, self.gradient).astype(np.float32)
        self.value = np.where(moved, value, self.value)
        fresh = self._direction()
        self.direction = np.where(moved, fresh, self.direction)
        self.slope = np.einsum("ij,ij->j", self.direction, self.gradient, dtype=np.float64)
        self.step = np.where(moved, np.where(begun, 1.0, self.first_step), self.step / 4)
        self.trial = (self.place + self.step * self.direction).astype(np.float32)
        return moved

    def _direction(self) -> np.ndarray:
        q, used = self.gradient.astype(np.float32).copy(), []
        for s, y, rho in reversed(self.past):
            a = rho * np.einsum("ij,ij->j", s, q, dtype=np.float64)
            q -= a.astype(np.float32) * y
            used.append(a)
        scale = np.ones(q.shape[1])
        for s, y, rho in self.past:  # the latest usable pair sets the scale
            size = np.einsum("ij,ij->j", y, y, dtype=np.float64)
            scale = np.where(rho > 0, 1 / np.maximum(rho * size, 1e-300), scale)
        q *= scale.astype(np.float32)
        for (s, y, rho), a in zip(self.past, reversed(used), strict=True):
            b = rho * np.einsum("ij,ij->j", y, q, dtype=np.float64)
            q += (a - b).astype(np.float32) * s
        return -q


def _f1(counts: np.ndarray) -> np.ndarray:
    """F1 from (3, ...) sums of hits, false alarms and misses; 0 where it is undefined."""
    hits, alarms, misses = counts
    return np.where(hits > 0, 2 * hits / np.maximum(2 * hits + alarms + misses, 1), 0.0)


def train_score_folds(
    corpus: DataFrame, roles: DataFrame, schema: CorpusSchema, settings: TrainSettings, folds: Sequence[int]
) -> tuple[DataFrame, DataFrame]:
    """``(predictions, history)`` for the given folds, trained together.

    ``history`` has one row per fold and epoch: mean objective over labels, validation macro and micro F1.
    """
    spark = corpus.sparkSession
    n_folds, n_labels, n_features = len(folds), len(schema.labels), settings.n_features
    columns = n_folds * n_labels
    stored = materialize(token_features(corpus, schema, settings).join(roles_by_id(roles, schema, folds), schema.id))
    def seen(rows: Rows, matrix: np.ndarray, numbers: np.ndarray) -> None:
        """Rows of each fold's train part that hold a feature, and how many there are, with and without each label."""
        train = (rows.roles == ROLE_CODES["train"]).astype(np.float64)
        _add_by_column(matrix, rows.column, train[rows.row])
        numbers[:n_folds] += train.sum(axis=0)
        numbers[n_folds:] += (train[:, :, None] * rows.labels[:, None, :]).sum(axis=0).ravel()

    holding, counts = summed(stored.select("labels", "roles", "tokens"), n_features, n_folds, n_folds + columns, seen)
    n_train, positives = counts[:n_folds], counts[n_folds:].reshape(n_folds, n_labels)
    by_rank = np.argsort(-holding.sum(axis=1), kind="stable")  # frequent features side by side, whatever their hashes
    rank = np.empty(n_features, dtype=np.int32)
    rank[by_rank] = np.arange(n_features)
    idf = np.ascontiguousarray(np.log((n_train + 1) / (holding[by_rank] + 1)).astype(np.float32).T)
    featured = materialize(with_features(stored, schema.id, n_features, rank, idf))
    narrow = featured.select("labels", "roles", "features", "counts", "length")
    weights = np.ones((n_folds, n_labels))
    if settings.weighted:
        weights = np.minimum((n_train[:, None] - positives) / np.maximum(positives, 1), settings.pos_weight_clip)
    mass = np.maximum(n_train[:, None] - positives + weights * positives, 1e-12).ravel()
    threshold = settings.threshold
    search = LockstepLBFGS((n_features + 1, columns), settings.memory, 1 / np.maximum(weights.ravel(), 1.0))
    confusion = np.zeros((3, n_folds, n_labels))
    best, best_macro, history = np.zeros((n_features + 1, columns), dtype=np.float32), np.full(n_folds, -1.0), []

    for step in range(settings.epochs * settings.steps_per_epoch + 1):
        shared = spark.sparkContext.broadcast((np.ascontiguousarray(_weighed(search.trial, idf, n_labels)), search.trial[-1].copy()))

        def slopes(rows: Rows, matrix: np.ndarray, numbers: np.ndarray, shared=shared) -> None:
            margins = _joint_margins(rows, *shared.value)
            truth = rows.labels[:, None, :]
            train = (rows.roles == ROLE_CODES["train"])[:, :, None] * np.where(truth > 0, weights, 1.0)
            loss = np.logaddexp(0, margins) - truth * margins
            apart = train * (_probabilities(margins) - truth)
            _add_slopes(rows, apart, matrix)
            checked = (rows.roles == ROLE_CODES["val"])[:, :, None]
            said = (_probabilities(margins) >= threshold) & checked
            hits, alarms, misses = said & (truth > 0), said & (truth <= 0), checked & ~said & (truth > 0)
            numbers += np.concatenate([part.sum(axis=0).ravel() for part in (train * loss, apart, hits, alarms, misses)])

        matrix, numbers = summed(narrow, n_features, columns, 5 * columns, slopes, feature_rows)
        shared.destroy()
        matrix *= np.repeat(idf, n_labels, axis=0).T
        loss, slope, *found = numbers.reshape(5, columns)
        pull = search.trial.copy()
        pull[-1] = 0  # intercepts are free
        value = loss / mass + 0.5 * settings.reg_param * np.einsum("ij,ij->j", pull, pull, dtype=np.float64)
        gradient = (np.concatenate([matrix, slope[None]]) / mass + settings.reg_param * pull).astype(np.float32)
        moved = search.tell(value, gradient).reshape(n_folds, n_labels)
        confusion = np.where(moved, np.array(found).reshape(3, n_folds, n_labels), confusion)
        if step and step % settings.steps_per_epoch == 0:
            macro, micro = _f1(confusion).mean(axis=1), _f1(confusion.sum(axis=2))
            losses = search.value.reshape(n_folds, n_labels).mean(axis=1)
            better = macro > best_macro
            best_macro = np.where(better, macro, best_macro)
            best = np.where(np.repeat(better, n_labels), search.place, best)
            epoch = step // settings.steps_per_epoch
            history += [(int(f), epoch, float(losses[i]), float(macro[i]), float(micro[i])) for i, f in enumerate(folds)]

    shared = spark.sparkContext.broadcast((np.ascontiguousarray(_weighed(best, idf, n_labels)), best[-1].copy()))
    kind = stored.schema[schema.id].dataType.simpleString()
    names = ["fold", schema.id, *schema.true_columns, *schema.prob_columns]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for rows in feature_rows(batch):
                n = len(rows.labels)
                said = _probabilities(_joint_margins(rows, *shared.value))
                row, fold = np.nonzero(rows.roles == ROLE_CODES["test"])
                truth = [pa.array(rows.labels[row, k].astype(np.int32)) for k in range(n_labels)]
                chances = [pa.array(said[row, fold, k]) for k in range(n_labels)]
                ids = batch.column(0).slice(at, n).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(folds, dtype=np.int32)[fold]), ids, *truth, *chances], names=names)
                at += n

    fields = [*(f"`{name}` int" for name in schema.true_columns), *(f"`{name}` double" for name in schema.prob_columns)]
    scored = featured.mapInArrow(score, f"fold int, `{schema.id}` {kind}, {', '.join(fields)}")
    ordered = [name for label in schema.labels for name in (f"true_{label}", f"prob_{label}", f"pred_{label}")]
    predictions = materialize(threshold_predictions(scored, schema, threshold).select("fold", schema.id, *ordered))
    shared.destroy()
    table = spark.createDataFrame(history, "fold int, epoch int, train_loss double, val_macro_f1 double, val_micro_f1 double")
    return predictions, table
