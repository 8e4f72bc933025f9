"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 10).

Index: every distinct vector becomes a node. A few random-projection trees cut the nodes into leaves of bounded size
(larger ones are cut again by a hash), whose inner neighbours start the graph. NN-descent then runs rounds of Spark joins until few edges change: a node's
neighbours and a sample of those that name it, drawn anew each round, meet (the neighbours of neighbours), every pair of them is compared, and a pair counts
only if it beats the worst neighbour that one of the two has; each node keeps its best ``degree``. For this the vectors travel as bytes
(8 bits a component); only the graph is approximate, never a returned score.

Search: queries are rows of the table, so they enter the graph at their own node and expand, round by round, every node of their beam
(the ``beam`` best so far) that is not expanded yet, along edges in both directions, until no beam changes. New nodes are scored in double precision
on the original vectors: vectors lie in blocks of bounded size, and the questions to a block travel as one row per query and block.

Equal vectors share a node; a node answers with its least ids, enough for ``top`` results, so ties and copies come out exactly. Takes no part: a
null vector, an empty or all-zero one, one with a null or non-finite component, and a row with a null id. Vectors of each width have an index of
their own. A repeated row counts once; an id with several vectors answers with its nearest and asks with its first by bytes that takes part. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

TOP = 5
EVERY = 50
DEGREE = 24
TREES = 4
LEAF = 512
SETTLED = 0.05
BEAM = 224
BLOCK = 512


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)


def nodes_of(vectors: DataFrame, id_column: str, vector_column: str, top: int) -> tuple[DataFrame, DataFrame]:
    """(node, vec, code) of every distinct vector that takes part, and (node, vec_id) of its least ``top + 1`` ids.

    node: a stored number of the vector's own, as one id may have several vectors; vec: doubles as bytes; code: the components of the unit vector in 8 bits.
    """
    numbers = F.col(vector_column).cast("array<double>")
    usable = F.size(numbers) > 0
    usable &= ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(numbers, lambda x: x != 0)
    named = vectors.select(F.col(id_column).cast("long").alias("vec_id"), numbers.alias("v")).where(F.col("vec_id").isNotNull() & usable)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, code = [], []
            for values in batch.column(1).to_pylist():
                v = np.array(values, dtype=np.float64) + 0.0
                raw.append(v.tobytes())
                code.append(np.rint(v * (127.0 / np.abs(v).max())).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, type=pa.binary()), pa.array(code, type=pa.binary())], names=["vec_id", "vec", "code"])

    coded = materialize(named.mapInArrow(encode, "vec_id long, vec binary, code binary"))
    distinct = coded.groupBy("vec").agg(F.first("code").alias("code")).sortWithinPartitions("vec")
    nodes = materialize(distinct.select("vec", F.monotonically_increasing_id().alias("node"), "code"))
    first = Window.partitionBy("vec").orderBy("vec_id")
    listed = coded.select("vec", "vec_id").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= top + 1)
    return nodes, materialize(listed.join(nodes.select("vec", "node"), "vec").select("node", "vec_id"))


def _best(pairs: DataFrame, degree: int) -> DataFrame:
    """The best ``degree`` distinct neighbours of every node."""
    ranked = pairs.groupBy("node", "near").agg(F.max("score").alias("score"))
    order = Window.partitionBy("node").orderBy(F.desc("score"), "near")
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= degree).drop("place")


def _unit(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float32)
    return codes / np.maximum(np.linalg.norm(codes, axis=1, keepdims=True), 1e-9)


def first_graph(nodes: DataFrame, degree: int, trees: int, leaf: int, seed: int = 11) -> DataFrame:
    """(node, near, score) from the leaves of random-projection trees."""
    count, size = nodes.agg(F.count("*"), F.first(F.length("code"))).first()
    if not count:
        return nodes.select("node", F.col("node").alias("near"), F.lit(0.0).cast("float").alias("score"))
    bits = max(0, int(np.ceil(np.log2(count / leaf)))) if count > leaf else 0
    planes = np.random.default_rng(seed).standard_normal((trees, size, bits)).astype(np.float32)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), np.int8))
            for tree in range(trees):
                key = ((unit @ planes[tree]) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(unit), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.full(len(unit), tree, dtype=np.int64)), pa.array(key.astype(np.int64))],
                    names=["node", "code", "tree", "key"],
                )

    keyed = nodes.select("node", "code").mapInArrow(assign, "node long, code binary, tree long, key long")
    sizes = keyed.groupBy("tree", "key").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts"))
    keyed = keyed.join(sizes, ["tree", "key"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))

    def inner(part: pa.Table) -> pa.Table:
        node, unit = part.column("node").to_numpy(), _unit(_matrix(part.column("code"), np.int8))
        keep = min(degree, len(node) - 1)
        if keep < 1:
            none = np.zeros(0, dtype=np.int64)
            return pa.table({"node": pa.array(none), "near": pa.array(none), "score": pa.array(none.astype(np.float32))})
        score = unit @ unit.T
        np.fill_diagonal(score, -9)
        best = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        return pa.table({"node": np.repeat(node, keep), "near": node[best].reshape(-1), "score": np.take_along_axis(score, best, 1).reshape(-1)})

    return _best(keyed.groupBy("tree", "key", "part").applyInArrow(inner, "node long, near long, score float"), degree)


def descend(graph: DataFrame, nodes: DataFrame, degree: int, turn: int = 0) -> DataFrame:
    """One round: the pairs among each node's neighbours that improve one of the two, merged into the graph."""
    named = graph.select(F.col("near").alias("centre"), F.col("node").alias("member"))
    sample = Window.partitionBy("centre").orderBy(F.xxhash64("centre", "member", F.lit(turn)))
    named = named.withColumn("place", F.row_number().over(sample)).where(F.col("place") <= degree).drop("place")
    meets = graph.select(F.col("node").alias("centre"), F.col("near").alias("member")).union(named).distinct()
    worst = graph.groupBy("node").agg(F.min("score").alias("worst"), F.count("*").alias("held"))
    worst = worst.select("node", F.when(F.col("held") >= degree, F.col("worst")).otherwise(-2.0).cast("float").alias("worst"))
    facts = nodes.select("node", "code").join(worst, "node").withColumnRenamed("node", "member")
    rooms = meets.join(facts, "member").groupBy("centre").agg(F.collect_list(F.struct("member", "worst", "code")).alias("room"))  # 2 * degree at most

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rooms_, flat = batch.column(0), batch.column(0).flatten()
            member, worst_ = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            unit = _unit(_matrix(flat.field(2), np.int8)) if len(flat) else np.zeros((0, 1), dtype=np.float32)
            ends = np.concatenate([[0], np.cumsum(rooms_.value_lengths().to_numpy())])
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                score = unit[low:high] @ unit[low:high].T
                np.fill_diagonal(score, -9)
                a, b = np.nonzero(score > worst_[low:high, None])
                found.append((member[low + a], member[low + b], score[a, b]))
            a, b, score = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(score.astype(np.float32))], names=["node", "near", "score"])

    better = rooms.select("room").mapInArrow(compare, "node long, near long, score float")
    return _best(graph.unionByName(better), degree)


def build_graph(nodes: DataFrame, degree: int = DEGREE, trees: int = TREES, leaf: int = LEAF, settled: float = SETTLED) -> DataFrame:
    """(node, near, score): the neighbour graph, after rounds of NN-descent until one changes no more than the share ``settled`` of its edges.

    Each round draws its sample of reverse neighbours anew, so a node that many name meets other ones of them every time.
    """
    graph, turn = materialize(first_graph(nodes, degree, trees, leaf)), 0
    while True:
        before, turn = graph, turn + 1
        graph = materialize(descend(before, nodes, degree, turn))
        changed = graph.join(before, ["node", "near"], "left_anti").count()
        if changed <= settled * graph.count():
            return graph


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """(query, node, score) of the best nodes of each query; ``queries``: query, node (its own), vec."""
    spark = nodes.sparkSession
    both = graph.select("node", "near").union(graph.select(F.col("near").alias("node"), F.col("node").alias("near")))
    edges = materialize(both.distinct())
    blocks = max(1, -(-nodes.count() // block))
    place = F.pmod(F.xxhash64("node"), F.lit(blocks))
    stored = materialize(nodes.select(place.alias("block"), "node", "vec"))
    asked = queries.select("query", "vec")

    def score(ask: pa.Table, hold: pa.Table) -> pa.Table:
        names = {"query": pa.int64(), "node": pa.int64(), "score": pa.float64()}
        if not ask.num_rows or not hold.num_rows:
            return pa.table({k: pa.array([], type=t) for k, t in names.items()})
        node, held = hold.column("node").to_numpy(), _matrix(hold.column("vec"), np.float64)
        order = np.argsort(node)
        node, held = node[order], held[order]
        size = np.linalg.norm(held, axis=1)
        vecs, worst, who = _matrix(ask.column("vec"), np.float64), ask.column("worst").to_numpy(), ask.column("query").to_numpy()
        out = []
        for k, wanted in enumerate(ask.column("nodes").combine_chunks()):
            at = np.searchsorted(node, wanted.values.to_numpy())
            value = np.einsum("ij,j->i", held[at], vecs[k]) / (size[at] * np.linalg.norm(vecs[k]))
            good = value >= worst[k]
            out.append((np.full(good.sum(), who[k]), node[at][good], value[good]))
        query_, node_, score_ = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query": query_, "node": node_, "score": score_})

    top = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    fresh = queries.select("query", "node")
    seen = None
    held = spark.createDataFrame([], "query long, node long, score double, open boolean")
    while True:
        asks = fresh.select("query", "node", place.alias("block")).groupBy("query", "block").agg(F.collect_list("node").alias("nodes"))  # at most a block
        full = held.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        full = full.select("query", F.when(F.col("n") >= beam, F.col("worst")).otherwise(-2.0).alias("worst"))
        asks = asks.join(asked, "query").join(full, "query", "left").select("query", "block", "nodes", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
        found = asks.groupBy("block").cogroup(stored.groupBy("block")).applyInArrow(score, "query long, node long, score double")
        merged = held.withColumn("open", F.lit(False)).unionByName(found.withColumn("open", F.lit(True)))
        held = materialize(merged.withColumn("place", F.row_number().over(top)).where(F.col("place") <= beam).drop("place"))
        seen = fresh if seen is None else materialize(seen.unionByName(fresh))
        frontier = held.where("open").select("query", "node")
        fresh = frontier.join(edges, "node").select("query", F.col("near").alias("node")).distinct()
        fresh = materialize(fresh.join(seen, ["query", "node"], "left_anti"))
        if fresh.isEmpty():
            break
    return held.select("query", "node", "score")


def nearest(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = EVERY,
    top: int = TOP,
    degree: int = DEGREE,
    trees: int = TREES,
    leaf: int = LEAF,
    settled: float = SETTLED,
    beam: int = BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows found for every row whose id is divisible by ``every``."""
    nodes, members = nodes_of(vectors, id_column, vector_column, top)
    # an id lists its node if it is among the node's least ids; the others are found through the vectors
    owner = vectors.select(F.col(id_column).cast("long").alias("query"), F.col(vector_column).cast("array<double>").alias("v"))
    owner = owner.where(F.col("query") % every == 0)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if x is None or None in x else (np.array(x, dtype=np.float64) + 0.0).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, type=pa.binary())], names=["query", "vec"])

    owner = owner.mapInArrow(raw, "query long, vec binary").join(nodes.select("vec", "node"), "vec")
    queries = materialize(owner.groupBy("query").agg(F.min(F.struct("vec", "node")).alias("own")).select("query", "own.node", "own.vec"))
    found = vectors.sparkSession.createDataFrame([], "query long, node long, score double")
    for row in queries.select(F.length("vec").alias("width")).distinct().collect():  # vectors of each width have an index of their own
        own = F.length("vec") == row["width"]
        part = materialize(nodes.where(own))
        graph = build_graph(part, degree, trees, leaf, settled)
        found = found.unionByName(search(queries.where(own), graph, part, beam))
    named = found.join(members, "node").where(F.col("vec_id") != F.col("query"))
    best = named.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
