"""Scores of a log-bilinear language model trained with noise-contrastive estimation (operator 7).

Tokens: A-Z lower-cased, runs of anything but blank and the controls 9 to 13, then one end for each text. The counts of all tokens of the
training texts are gathered by Spark. The model works on word classes: each of the ``shortlist`` most frequent
tokens (and the end) is a class of its own, the others fall into ``hash_classes`` classes by hash and keep their share of the class by
count, an unknown token the share of a count of 0.1. So the probability of a token is P(class | two classes before) * P(token | class) and sums to 1.

P(class | context) is log-bilinear: the vectors of the two classes before are mapped by one matrix for each place, added, and multiplied with the
vector of the class, plus its bias. It is trained by NCE against the class frequencies, with noise shared by a
minibatch, in numpy, on every training text once: each of ``ROUNDS_`` rounds takes a third of them, every task trains from the same
parameters on its own rows, and the results are averaged by token counts, in a tree of bounded groups. Parameters have a fixed size
(classes * dimensions), so they may travel through the driver. Scoring normalises over all classes: batched matrix products over the
distinct contexts of a block of texts.

Counts of the ``head`` most frequent tokens (a bounded table) go to the tasks; rarer tokens are joined with the counts by shuffle. They
are rare by definition, so no key of that join is hot. Tokens are told apart by 64-bit hashes.

A null or empty text is one end token. Training texts are those whose crc32 of the id as text has a last decimal digit other than 0; a null id
counts as an empty text (held out). Repeated rows each count and each give a row; an empty table gives no rows; without training texts every count is 0. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import NOT_BLANK, as_signed, list_array, row_blocks, span_hashes, text_bytes, word_spans
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

SHORTLIST = 383
HASH_CLASSES = 128
HEAD = 65_536
DIMENSIONS = 32
NOISE = 64
BATCH = 1024
RATE = 0.1
ROUNDS_ = 3
SEED = 17
END = np.uint64(1)  # stands for the end token among word hashes
_FLUSH = 2_000_000
_BLOCK = 1 << 23
_FAN = 32


def token_rows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row closed by the end token, and where rows begin (n + 1 entries)."""
    starts, ends, first = word_spans(data, bounds, NOT_BLANK)
    words = span_hashes(data, starts, ends)
    rows = len(bounds) - 1
    out = np.full(len(words) + rows, END, dtype=np.uint64)
    row = np.repeat(np.arange(rows), np.diff(first))
    out[np.arange(len(words)) + row] = words
    return out, first + np.arange(rows + 1)


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def token_counts(training: DataFrame) -> DataFrame:
    """(word, c) over all texts of the one column, combined inside each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_words, held_counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            for low, high in row_blocks(bounds, _BLOCK):
                words, _ = token_rows(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                new, number = np.unique(words, return_counts=True)
                held_words, inverse = np.unique(np.concatenate([held_words, new]), return_inverse=True)
                held_counts = np.bincount(inverse, weights=np.concatenate([held_counts, number]), minlength=len(held_words)).astype(np.int64)
                if len(held_words) > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(as_signed(held_words)), pa.array(held_counts)], names=["word", "c"])
                    held_words, held_counts = held_words[:0], held_counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(as_signed(held_words)), pa.array(held_counts)], names=["word", "c"])

    return training.mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks need of the counts; all arrays have a bounded size."""

    head: np.ndarray  # word hashes in order
    head_counts: np.ndarray
    short: np.ndarray  # word hashes in order: class k is short[k]
    class_total: np.ndarray  # N of each class
    class_words: np.ndarray  # V of each class
    tokens: int
    words: int
    hash_classes: int

    @property
    def classes(self) -> int:
        return len(self.short) + self.hash_classes

    def classes_of(self, tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.short, tokens), len(self.short) - 1)
        return np.where(self.short[at] == tokens, at, len(self.short) + (tokens % np.uint64(self.hash_classes)).astype(np.int64))

    def noise(self) -> np.ndarray:
        p = self.class_total + 1.0
        return p / p.sum()


def vocabulary(counts: DataFrame, shortlist: int, hash_classes: int, head: int) -> Vocabulary:
    tokens, words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(head).toArrow()
    hashes = top.column("word").to_numpy().view(np.uint64)
    number = top.column("c").to_numpy()
    short = np.unique(np.concatenate([hashes[:shortlist], [END]])).astype(np.uint64)
    order = np.argsort(hashes)
    hashes, number = hashes[order], number[order]
    size = len(short) + hash_classes
    total, distinct = np.zeros(size), np.zeros(size)
    at = np.searchsorted(hashes, short)
    for k, spot in enumerate(at.tolist()):
        if spot < len(hashes) and hashes[spot] == short[k]:
            total[k], distinct[k] = number[spot], 1
    # unsigned remainder of a signed long: correct by 2**64 modulo the number of classes
    word = F.col("word")
    shift = (1 << 64) % hash_classes
    bucket = F.pmod(word, F.lit(hash_classes)) + F.when(word < 0, shift).otherwise(0)
    bucket = F.pmod(bucket, F.lit(hash_classes))
    rest = counts.where(~word.isin([int(x) for x in as_signed(short)])).groupBy(bucket.alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    for row in rest.collect():  # at most hash_classes rows
        total[len(short) + row["k"]], distinct[len(short) + row["k"]] = row["n"], row["v"]
    return Vocabulary(hashes, number, short, total, distinct, int(tokens), int(words), hash_classes)


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to ``total[at]``; repeated places are summed first."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    total[at[begin]] += np.add.reduceat(rows[order], begin, axis=0)


class LogBilinear:
    """Vectors of context classes, a matrix for each of two places, vectors and biases of predicted classes."""

    SHAPES = ("context", "place", "target", "bias")

    def __init__(self, classes: int, dimensions: int, noise: np.ndarray, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.context = draw.normal(0, 0.3, (classes, dimensions)).astype(np.float32)
        self.place = np.stack([np.eye(dimensions), 0.5 * np.eye(dimensions)]).astype(np.float32)
        self.target = draw.normal(0, 0.05, (classes, dimensions)).astype(np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.noise = noise
        self.log_noise = np.log(noise).astype(np.float32)
        self.drawn = np.cumsum(noise)
        self.drawn[-1] = 1.0

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).reshape(-1) for name in self.SHAPES])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for name in self.SHAPES:
            own = getattr(self, name)
            setattr(self, name, flat[at : at + own.size].reshape(own.shape).astype(np.float32).copy())
            at += own.size
        return self

    def expected(self, before: np.ndarray) -> np.ndarray:
        """The predicted vector of each context (rows of two classes, the nearest first)."""
        return self.context[before[:, 0]] @ self.place[0] + self.context[before[:, 1]] @ self.place[1]

    def learn(self, before: np.ndarray, target: np.ndarray, draw: np.random.Generator, squares: dict, noise: int, rate: float) -> None:
        """One NCE step on a minibatch; the noise classes are shared by its tokens."""
        sample = np.searchsorted(self.drawn, draw.random(noise))
        shift = self.log_noise + np.float32(np.log(noise))
        hidden, right = self.expected(before), self.target[target]
        own = np.einsum("ij,ij->i", hidden, right) + self.bias[target] - shift[target]
        other = hidden @ self.target[sample].T + (self.bias[sample] - shift[sample])
        g_own = (1 / (1 + np.exp(-np.clip(own, -30, 30))) - 1).astype(np.float32)
        g_other = (1 / (1 + np.exp(-np.clip(other, -30, 30)))).astype(np.float32)
        g_hidden = g_own[:, None] * right + g_other @ self.target[sample]
        steps = {name: np.zeros_like(getattr(self, name)) for name in self.SHAPES}
        _add_rows(steps["target"], target, g_own[:, None] * hidden)
        _add_rows(steps["target"], sample, g_other.T @ hidden)
        steps["bias"] += np.bincount(target, weights=g_own, minlength=len(self.bias)).astype(np.float32)
        steps["bias"] += np.bincount(sample, weights=g_other.sum(axis=0), minlength=len(self.bias)).astype(np.float32)
        for k in (0, 1):
            steps["place"][k] = self.context[before[:, k]].T @ g_hidden
            _add_rows(steps["context"], before[:, k], g_hidden @ self.place[k].T)
        for name, step in steps.items():
            own_squares = squares[name]
            own_squares += step * step
            step *= np.float32(rate)
            step /= np.sqrt(own_squares)
            getattr(self, name)[...] -= step

    def log_totals(self, before: np.ndarray, block: int = 512) -> np.ndarray:
        """Natural log of the normaliser of each context."""
        out = np.zeros(len(before), dtype=np.float64)
        for low in range(0, len(before), block):
            scores = self.expected(before[low : low + block]) @ self.target.T
            scores += self.bias
            top = scores.max(axis=1, keepdims=True)
            scores -= top
            np.exp(scores, out=scores)
            out[low : low + block] = top[:, 0] + np.log(scores.sum(axis=1))
        return out

    def log_probabilities(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log P(class | context), normalised over all classes; equal contexts are worked out once."""
        classes = len(self.bias)
        key, inverse = np.unique(before[:, 0] * classes + before[:, 1], return_inverse=True)
        distinct = np.stack([key // classes, key % classes], axis=1)
        hidden, total = self.expected(distinct), self.log_totals(distinct)
        out = np.zeros(len(target))
        for low in range(0, len(target), 1 << 16):
            part = slice(low, low + (1 << 16))
            own = (hidden[inverse[part]] * self.target[target[part]]).sum(axis=1) + self.bias[target[part]]
            out[part] = own - total[inverse[part]]
        return out


def contexts(classes: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """The two classes before each token; before a row's first token stands the end."""
    out = np.full((len(classes), 2), end, dtype=np.int64)
    out[1:, 0], out[2:, 1] = classes[:-1], classes[:-2]
    begin = first[:-1]
    out[begin] = end
    second = begin + 1
    out[second[second < first[1:]], 1] = end
    return out


def train(training: DataFrame, remainder: Column, known: Vocabulary, dimensions: int, rounds: int, noise: int, rate: float) -> LogBilinear:
    """``training``: one text column and the remainders 1 to 9 that deal it to rounds."""
    spark = training.sparkSession
    model = LogBilinear(known.classes, dimensions, known.noise())
    end = int(known.classes_of(np.array([END]))[0])
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((vars(known), model.flat()))

        def fit(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            words, flat = Vocabulary(**shared.value[0]), shared.value[1]
            own = LogBilinear(words.classes, dimensions, words.noise()).load(flat)
            squares = {name: np.ones_like(getattr(own, name)) for name in own.SHAPES}
            draw, seen = np.random.default_rng(SEED + turn), 0
            for batch in batches:
                data, bounds = text_bytes(batch.column(0))
                for low, high in row_blocks(bounds):
                    tokens, first = token_rows(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                    classes = words.classes_of(tokens)
                    before = contexts(classes, first, end)
                    order = draw.permutation(len(classes))
                    for at in range(0, len(order), BATCH):
                        part = order[at : at + BATCH]
                        own.learn(before[part], classes[part], draw, squares, noise, rate)
                    seen += len(classes)
            if seen:
                body = (own.flat().astype(np.float64) * seen).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([draw.integers(1 << 30)]), pa.array([seen]), pa.array([body], type=pa.binary())], names=["part", "seen", "body"])

        def add(part: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(b.as_buffer(), dtype=np.float64) for b in part.column("body")], axis=0)
            seen = int(np.sum(part.column("seen").to_numpy()))
            return pa.table({"part": pa.array([part.column("part")[0].as_py()]), "seen": pa.array([seen]), "body": pa.array([total.tobytes()], type=pa.binary())})

        own_turn = training.where(F.pmod(remainder, F.lit(rounds)) == turn).select("body")
        results = materialize(own_turn.mapInArrow(fit, "part long, seen long, body binary"))
        while (left := results.count()) > 1:
            groups = -(-left // _FAN)
            dealt = results.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
            results = materialize(dealt.groupBy("part").applyInArrow(add, "part long, seen long, body binary"))
        for row in results.collect():  # one row of the parameters' size, or none
            model.load(np.frombuffer(bytes(row["body"]), dtype=np.float64) / row["seen"])
    return model


def _scored(docs: DataFrame, known: Vocabulary, model: LogBilinear) -> DataFrame:
    """What one pass can say of every text: the sums over head tokens, and its rarer tokens with their numbers."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((vars(known), model.flat(), model.context.shape[1]))
    names = ["_row", "id", "held_out", "n_tokens", "head_known", "head_log", "class_log", "tail", "tail_n"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(**shared.value[0])
        lm = LogBilinear(words.classes, shared.value[2], words.noise()).load(shared.value[1])
        end = int(words.classes_of(np.array([END]))[0])
        short = len(words.short)
        head_log = np.log10(words.head_counts + 0.1)
        share = np.log10(words.class_total + 0.1 * (words.class_words + 1))
        for batch in batches:
            data, bounds = text_bytes(batch.column(3))
            for low, high in row_blocks(bounds, _BLOCK):
                tokens, first = token_rows(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                classes = words.classes_of(tokens)
                logs = lm.log_probabilities(contexts(classes, first, end), classes) / np.log(10)
                at = np.minimum(np.searchsorted(words.head, tokens), max(0, len(words.head) - 1))
                in_head = words.head[at] == tokens if len(words.head) else np.zeros(len(tokens), dtype=bool)
                own = np.where(in_head, head_log[at] if len(words.head) else 0.0, 0.0)
                hashed = classes >= short
                logs += np.where(hashed, own - share[classes], 0.0)
                rows = high - low
                row = np.repeat(np.arange(rows), np.diff(first))
                pairs = np.flatnonzero(~in_head)
                by = np.lexsort((tokens[pairs], row[pairs]))
                t, r = tokens[pairs][by], row[pairs][by]
                new = np.ones(len(t), dtype=bool)
                new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
                begin = np.flatnonzero(new)
                number = np.diff(np.append(begin, len(t)))
                each = np.bincount(r[begin], minlength=rows)
                part = batch.slice(low, rows)
                arrays = [np.diff(first), np.add.reduceat(in_head.astype(np.int64), first[:-1]), np.add.reduceat(own, first[:-1]), np.add.reduceat(logs, first[:-1])]
                lists = [list_array(as_signed(t[begin]), each), list_array(number.astype(np.int64), each)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array(a) for a in arrays), *lists], names=names)

    schema = f"_row long, id {kind}, held_out boolean, n_tokens long, head_known long, head_log double, class_log double, tail array<long>, tail_n array<long>"
    return docs.select("_row", "id", "held_out", "body").mapInArrow(score, schema)


def language_scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shortlist: int = SHORTLIST,
    hash_classes: int = HASH_CLASSES,
    head: int = HEAD,
    dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS_,
    noise: int = NOISE,
    rate: float = RATE,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    raw = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).alias("body"))
    remainder = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 10
    training = raw.where(~F.col("held_out"))
    counts = materialize(token_counts(training.select("body")))
    known = vocabulary(counts, shortlist, hash_classes, head)
    model = train(training, remainder, known, dimensions, rounds, noise, rate)
    scored = materialize(_scored(raw, known, model))
    rare = scored.select("_row", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select("_row", F.col("x.tail").alias("word"), F.col("x.tail_n").alias("n"))
    c = F.coalesce("c", F.lit(0))
    summed = rare.join(counts, "word", "left").groupBy("_row").agg(
        F.sum(F.col("n") * F.log10(c + 0.1)).alias("tail_log"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known")
    )
    both = scored.drop("tail", "tail_n").join(summed, "_row", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    normal = F.lit(float(np.log10(known.tokens + 0.1 * (known.words + 1))))
    return both.select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * normal).alias("base_score"),
        (F.col("class_log") + tail_log).alias("score"),
    )


@query("op7_language_scores")
def op7_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
