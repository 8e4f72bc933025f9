"""Conversation structure repair (operator 12): a min-plus program over grammar-compressed role and fault sequences.

A conversation is read as a sequence of symbols, one for each row: its role's initial (s, u, a or another) and whether it must go
(blank or repeated) or is truncated. The cheapest edits that give the role initials ``(s?(ua)+)?`` are a shortest path through four states
(nothing yet, after s, after u, after a); a symbol is a 4 x 4 matrix of (cost, audit), composed in the min-plus semiring, where of
equal costs the ASCII-least audit wins. Inside one entry no two audits of equal cost can be prefixes of each other (the longer one
would hold more inserts and cost more), so choosing early is safe. Re-Pair replaces the most frequent neighbours in all
sequences by new symbols, round by round, so frequent stretches are one symbol with one matrix, computed once, bottom-up, from its two
halves; audits in it are ropes, pairs of shared ropes, written out only at the end.

Spark's part: identical rows are counted first, so a repeated row is one row. A row is the first with its role and text if its turn is the
least of that pair, found by a combined aggregate and a join on unique keys. Rows are sorted by range over (conversation, turn), so one
conversation may lie in many tasks, and cut into segments of at most SEGMENT_ROWS rows. Segments inside a task that hold their whole conversation
are finished there; the others yield a matrix, and neighbours are composed 64 at a time until one is left. The rule
count is bounded by ``max_rules``: rules only share work, results do not depend on them. Only the rules, at most that many,
and the most frequent pairs of a round come to the driver.
Applying the audit streams the rows of a conversation, in order, through one digest in constant memory: SHA-256 is a
chain, and an audit of one row is what the contract returns, so a single conversation is the unit there.

Nulls in role or text are one space, as are nulls in the damage key; a null turn sorts first and counts in no gap; null ids are one
conversation. Rows of one turn are ordered by role, then by the SHA-256 of role and text. Roles count by their first character. Other columns are ignored,
an empty table gives no rows. Texts are only hashed and streamed, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import arrow_rows
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

SEGMENT_ROWS = 4096
MAX_RULES = 1024
LEAST_COUNT = 8
ROUND_PAIRS = 256
FAN_IN = 64
MEMO = 50_000
BLANKS = " \t\n\x0b\x0c\r"

#: Costs of the edits.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Where a state goes on the initial of a row; missing: not allowed. States: nothing yet, after s, after u, after a.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
LEGAL = ("su", "ua", "au")
#: Symbol 0 must go; 1 + 2 * role + truncated for the others.
ROLES = "sua?"
TERMINALS = 9

Rope = str | tuple
Matrix = tuple[dict[int, tuple[int, Rope]], ...]


def joined(a: Rope, b: Rope, known: dict | None = None) -> Rope:
    """The rope of both; with ``known`` the same two ropes always give the same object."""
    if not a or not b:
        return a or b
    if known is None:
        return (a, b)
    return known.setdefault((id(a), id(b)), (a, b))


def earlier(a: Rope, b: Rope) -> bool:
    """Whether the text of ``a`` comes before that of ``b``. Shared parts at the same place are skipped unread."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, tuple) or isinstance(y, tuple):
            left += [x[1], x[0]] if isinstance(x, tuple) else [x]
            right += [y[1], y[0]] if isinstance(y, tuple) else [y]
            continue
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        left += [x[n:]] if len(x) > n else []
        right += [y[n:]] if len(y) > n else []
    return bool(right)


def written(rope: Rope) -> str:
    out, rest = [], [rope]
    while rest:
        x = rest.pop()
        if isinstance(x, tuple):
            rest += [x[1], x[0]]
        else:
            out.append(x)
    return "".join(out)


def _offer(row: dict, to: int, cost: int, rope: Rope) -> None:
    if to not in row or cost < row[to][0] or (cost == row[to][0] and earlier(rope, row[to][1])):
        row[to] = (cost, rope)


def through(row: dict, matrix: Matrix, known: dict | None = None) -> dict:
    """A vector of states times a matrix."""
    out: dict[int, tuple[int, Rope]] = {}
    for middle, (cost, rope) in row.items():
        for to, (more, tail) in matrix[middle].items():
            if to not in out or cost + more <= out[to][0]:
                _offer(out, to, cost + more, joined(rope, tail, known))
    return out


def composed(a: Matrix, b: Matrix, known: dict | None = None) -> Matrix:
    return tuple(through(row, b, known) for row in a)


IDENTITY: Matrix = tuple({q: (0, "")} for q in range(4))


def _inserts() -> Matrix:
    """Any number of inserts: the role is the one that the state goes on with."""
    rows = []
    for start in range(4):
        row, at = {start: (0, "")}, start
        for many in range(1, 4):
            at = NEXT[at]["a"] if "a" in NEXT[at] else NEXT[at]["u"]
            _offer(row, at, INSERT * many, "I" * many)
        rows.append(row)
    return tuple(rows)


INSERTS = _inserts()


def terminal_matrices() -> list[Matrix]:
    """For each symbol: its row's edit and the inserts behind it."""
    matrices = []
    for symbol in range(TERMINALS):
        rows = []
        for state in range(4):
            row: dict[int, tuple[int, Rope]] = {state: (DELETE, "D")}
            if symbol:
                initial, extra = ROLES[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
                if initial in NEXT[state]:
                    _offer(row, NEXT[state][initial], extra, "K")
                for role in "ua":
                    if role in NEXT[state]:
                        _offer(row, NEXT[state][role], REROLE + extra, "R")
            rows.append(row)
        matrices.append(composed(tuple(rows), INSERTS))
    return matrices


Rules = list[list[tuple[int, int]]]


def rule_matrices(rounds: Rules) -> list[Matrix]:
    """The matrices of all symbols, rules bottom-up from their halves, with shared ropes."""
    matrices, known = terminal_matrices(), {}
    for pairs in rounds:
        matrices += [composed(matrices[a], matrices[b], known) for a, b in pairs]
    return matrices


def compressed(flat: np.ndarray, owner: np.ndarray, rounds: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (and the sequence each belongs to) after all rounds. The pairs of one round cannot overlap, but for a
    symbol with itself, where every second one of a run is taken."""
    new = TERMINALS
    for pairs in rounds:
        left, right = np.array(pairs, dtype=np.int64).T
        keys = (left << 32) | right
        order = np.argsort(keys)
        here = (flat[:-1] << 32) | flat[1:]
        spot = np.minimum(np.searchsorted(keys[order], here), len(keys) - 1)
        hit = (keys[order][spot] == here) & (owner[:-1] == owner[1:])
        at = np.flatnonzero(hit)
        if len(at):
            fresh = np.concatenate([[True], np.diff(at) > 1])
            run = at[fresh][np.cumsum(fresh) - 1]
            at = at[(at - run) % 2 == 0]
            flat = flat.copy()
            flat[at] = new + order[spot[at]]
            kept = np.ones(len(flat), dtype=bool)
            kept[at + 1] = False
            flat, owner = flat[kept], owner[kept]
        new += len(pairs)
    return flat, owner


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in column]
    flat = np.concatenate(raw).astype(np.int64) if raw else np.zeros(0, dtype=np.int64)
    return flat, np.repeat(np.arange(len(raw)), [len(x) for x in raw])


def build_rules(sequences: DataFrame, max_rules: int = MAX_RULES, least_count: int = LEAST_COUNT) -> Rules:
    """Re-Pair over all (symbols, n): in each round the most frequent neighbours that cannot overlap become symbols.

    A round goes on down to a quarter of its best count, so that rarer pairs are counted anew after the frequent ones have gone.
    """
    rounds: Rules = []
    while (made := sum(map(len, rounds))) < max_rules:

        def count(batches: Iterator[pa.RecordBatch], rounds=rounds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat, owner = compressed(*_flat(batch.column(0)), rounds)
                inside = owner[:-1] == owner[1:]
                keys, which = np.unique(((flat[:-1] << 32) | flat[1:])[inside], return_inverse=True)
                weights = batch.column(1).to_numpy()[owner[:-1][inside]]
                n = np.zeros(len(keys), dtype=np.int64)
                np.add.at(n, which, weights)
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(n)], names=["a", "b", "n"])

        counts = sequences.select("symbols", "n").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = counts.where(F.col("n") >= least_count).orderBy(F.desc("n"), "a", "b").limit(ROUND_PAIRS).collect()
        chosen: list[tuple[int, int]] = []
        lefts, rights = set(), set()
        for a, b, n in top:
            if len(chosen) + made >= max_rules or 4 * n < top[0].n:
                break
            if a not in rights and b not in lefts and (a != b or (a not in lefts and b not in rights)):
                chosen.append((a, b))
                lefts.add(a)
                rights.add(b)
        if not chosen:
            break
        rounds = [*rounds, chosen]
    return rounds


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows of a conversation table as faulty as a hash of their key says."""
    spaced = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).alias("key"),
    )
    kind = F.crc32("key") % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return spaced.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _key() -> Column:
    """A digest of role and text together; the role's length keeps the two apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def marked_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, key, piece, n, first, blank, cut) without texts: each distinct row once, with its number in pieces of at most
    SEGMENT_ROWS; ``first``: the first row of the conversation with its role and text is among them."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select(
        F.col("conv_id").alias("conv"),
        "turn",
        "role",
        _key().alias("key"),
        (shown == "").alias("blank"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    distinct = narrow.groupBy("conv", "turn", "role", "key").agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    least = distinct.groupBy("conv", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("least"))
    least = least.select(F.col("conv").alias("c"), F.col("key").alias("k"), F.col("least.turn").alias("t"))
    same = distinct["conv"].eqNullSafe(least["c"]) & (distinct["key"] == least["k"]) & distinct["turn"].eqNullSafe(least["t"])
    joined_ = distinct.join(least, same, "left").withColumn("first", F.col("k").isNotNull())
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SEGMENT_ROWS)))
    cut_up = joined_.select("conv", "turn", "role", "key", "n", "first", "blank", "cut", pieces.alias("piece"))
    return cut_up.select(
        "conv",
        "turn",
        "role",
        "key",
        "piece",
        F.least(F.lit(SEGMENT_ROWS).cast("long"), F.col("n") - F.col("piece") * SEGMENT_ROWS).alias("n"),
        (F.col("first") & (F.col("piece") == 0)).alias("first"),
        "blank",
        "cut",
        F.substring("role", 1, 1).alias("initial"),
    )


_FACTS = ["first_initial", "last_initial", "first_turn", "last_turn", "least_turn", "most_turn", "turns", "blank", "duplicate", "truncated", "illegal"]
_FACT_TYPES = (
    "first_initial string, last_initial string, first_turn long, last_turn long, least_turn long, most_turn long, turns long, "
    "blank long, duplicate long, truncated long, illegal long"
)


def _segment(part: pa.Table) -> list:
    """The symbols and facts of consecutive rows of one conversation."""
    n = part.column("n").to_numpy()
    first, blank, cut = (part.column(c).to_numpy(zero_copy_only=False) for c in ("first", "blank", "cut"))
    initials = part.column("initial").to_pylist()
    turns = part.column("turn").to_pylist()
    role = np.array([ROLES.find(x) if x and x in "sua" else 3 for x in initials], dtype=np.int64)
    whole = first & ~blank
    lead = np.where(whole, 1 + 2 * role + cut, 0)
    symbols = np.repeat(lead, n)
    again = np.ones(len(symbols), dtype=bool)
    again[np.cumsum(n) - n] = False
    symbols[again] = 0
    known = [t for t in turns if t is not None]
    steps = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)) + int((n - 1).sum())
    return [
        symbols.astype(np.uint8).tobytes(),
        initials[0],
        initials[-1],
        turns[0],
        turns[-1],
        min(known, default=None),
        max(known, default=None),
        len(set(known)),
        int(n[blank].sum()),
        int((n[~blank]).sum() - whole.sum()),
        int((whole & cut).sum()),
        steps,
    ]


_PLACE_TYPES = "part long, piece long, edge boolean"


_ARROW = {
    "part": pa.int64(),
    "piece": pa.int64(),
    "edge": pa.bool_(),
    "symbols": pa.binary(),
    "cost": pa.int64(),
    "audit": pa.string(),
    "costs": pa.list_(pa.int64()),
    "audits": pa.list_(pa.string()),
    **{name: pa.string() if "initial" in name else pa.int64() for name in _FACTS},
}


def _rows(rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    arrays = [pa.array(list(values), type=_ARROW.get(name, kind)) for name, values in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def segments(marked: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(conv, part, piece, edge, symbols, facts): rows in order, cut where a conversation or a task ends and each ``segment_rows`` symbols.
    ``edge``: the conversation may go on in another segment."""
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "key", "piece")]
    kind = marked.schema["conv"].dataType.simpleString()
    ready = marked.withColumn("turn", F.col("turn").cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["conv", "part", "piece", "edge", "symbols", *_FACTS]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        open_ = True  # the conversation at hand may have begun before
        held: pa.Table | None = None
        for batch in chain(batches, [None]):
            over = batch is None
            if not over:
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new])
            if held is None or not held.num_rows:
                continue
            conv = held.column("conv").to_pylist()
            starts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
            out = []
            for low, high in pairwise(starts):
                run = held.slice(low, high - low)
                n = run.column("n").to_numpy()
                spans = list(pairwise([0, *(np.flatnonzero(np.diff((np.cumsum(n) - n) // segment_rows)) + 1).tolist(), len(n)]))
                ended = over or high < len(conv)
                many = len(spans) > 1
                rest = None if ended else spans.pop()
                for a, b in spans:
                    edge = open_ or many or high == len(conv)
                    out.append((conv[low], part, piece, edge, *_segment(run.slice(a, b - a))))
                    piece, open_ = piece + 1, True
                if ended:
                    open_ = False
                else:
                    held = run.slice(rest[0])
            yield _rows(out, names, held.schema.field("conv").type)

    schema = f"conv {kind}, {_PLACE_TYPES}, symbols binary, {_FACT_TYPES}"
    return ready.select("conv", "turn", "initial", "n", "first", "blank", "cut").mapInArrow(cut, schema)


def _best(row: dict) -> tuple[int, str]:
    ends = [row[q] for q in ACCEPTED if q in row]
    cost, rope = ends[0]
    for more, other in ends[1:]:
        if more < cost or (more == cost and earlier(other, rope)):
            cost, rope = more, other
    return cost, written(rope)


def _listed(matrix: Matrix) -> tuple[list, list]:
    cells = [matrix[i].get(j) for i in range(4) for j in range(4)]
    return [c and c[0] for c in cells], [c and written(c[1]) for c in cells]


def _matrix(costs: list, audits: list) -> Matrix:
    return tuple({j: (costs[4 * i + j], audits[4 * i + j]) for j in range(4) if costs[4 * i + j] is not None} for i in range(4))


def solved(parts: DataFrame, rounds: Rules) -> DataFrame:
    """(conv, part, piece, edge, cost, audit, costs, audits, facts): the cheapest audit of a whole conversation, the matrix of an edge."""
    kind = parts.schema["conv"].dataType.simpleString()
    names = ["conv", "part", "piece", "edge", "cost", "audit", "costs", "audits", *_FACTS]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = rule_matrices(rounds)
        memo: dict[bytes, tuple[int, str]] = {}
        for batch in batches:
            flat, owner = compressed(*_flat(batch.column("symbols")), rounds)
            upto = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
            edge, symbols = batch.column("edge").to_pylist(), batch.column("symbols").to_pylist()
            costs, audits, whole_cost, whole_audit = ([None] * batch.num_rows for _ in range(4))
            for k in range(batch.num_rows):
                mine = flat[upto[k] : upto[k + 1]].tolist()
                if edge[k]:
                    total = IDENTITY
                    for symbol in mine:
                        total = composed(total, matrices[symbol])
                    costs[k], audits[k] = _listed(total)
                    continue
                found = memo.get(symbols[k])
                if found is None:
                    row = INSERTS[0]
                    for symbol in mine:
                        row = through(row, matrices[symbol])
                    found = _best(row)
                    if len(memo) < MEMO:
                        memo[symbols[k]] = found
                whole_cost[k], whole_audit[k] = found
            new = {"cost": whole_cost, "audit": whole_audit, "costs": costs, "audits": audits}
            arrays = [pa.array(new[c], type=_ARROW[c]) if c in new else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"conv {kind}, {_PLACE_TYPES}, cost long, audit string, costs array<long>, audits array<string>, {_FACT_TYPES}"
    return parts.mapInArrow(solve, schema)


def _facts_of_both(a: dict, b: dict) -> dict:
    least = [x for x in (a["least_turn"], b["least_turn"]) if x is not None]
    most = [x for x in (a["most_turn"], b["most_turn"]) if x is not None]
    shared = a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    return {
        "first_initial": a["first_initial"],
        "last_initial": b["last_initial"],
        "first_turn": a["first_turn"],
        "last_turn": b["last_turn"],
        "least_turn": min(least, default=None),
        "most_turn": max(most, default=None),
        "turns": a["turns"] + b["turns"] - shared,
        "illegal": a["illegal"] + b["illegal"] + (a["last_initial"] + b["first_initial"] not in LEGAL),
        **{name: a[name] + b[name] for name in ("blank", "duplicate", "truncated")},
    }


def merged(edges: DataFrame) -> DataFrame:
    """One row for each conversation: neighbouring segments composed FAN_IN at a time, first inside tasks, then over them.

    What a merge holds is at most 16 audits of what it spans; the last one's result is one row by contract.
    """
    names = ["conv", "part", "piece", "edge", "cost", "audit", "costs", "audits", *_FACTS]
    schema = edges.schema

    def both(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["piece"]))
        total, facts = _matrix(rows[0]["costs"], rows[0]["audits"]), {name: rows[0][name] for name in _FACTS}
        for row in rows[1:]:
            total, facts = composed(total, _matrix(row["costs"], row["audits"])), _facts_of_both(facts, row)
        place = rows[0]["place"]
        at = (rows[0]["part"], place) if rows[0]["inside"] else (place, 0)
        one = (rows[0]["conv"], *at, True, None, None, *_listed(total), *(facts[name] for name in _FACTS))
        return pa.Table.from_batches([_rows([one], names, group.schema.field("conv").type)])

    for unit, by in (("piece", ["conv", "part"]), ("part", ["conv"])):
        while not edges.groupBy(*by).count().where("count > 1").isEmpty():
            placed = edges.withColumn("place", F.floor(F.col(unit) / FAN_IN)).withColumn("inside", F.lit(unit == "piece"))
            edges = materialize(placed.groupBy(*by, "place").applyInArrow(both, schema))
    return edges


def cheapest_edits(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, max_rules: int = MAX_RULES) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit), a row for each conversation of ``rows`` (conv_id, turn, role, text)."""
    parts = materialize(segments(marked_rows(rows), segment_rows))
    sequences = materialize(parts.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))
    found = materialize(solved(parts, build_rules(sequences, max_rules)))
    ends = merged(found.where("edge"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = zip(batch.column("costs").to_pylist(), batch.column("audits").to_pylist(), strict=True)
            best = [_best(through(INSERTS[0], _matrix(*both))) for both in lists]
            new = {"cost": [c for c, _ in best], "audit": [a for _, a in best]}
            arrays = [pa.array(new[c], type=_ARROW[c]) if c in new else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    gaps = F.coalesce(F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    done = found.where("NOT edge").unionByName(ends.mapInArrow(finish, found.schema))
    return done.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Repair:
    """Applies one audit to rows as they come; only a digest is kept."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest = audit, 0, 0, hashlib.sha256()

    def _say(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.state else "").encode() + f"{role}:{text}".encode())
        self.state = NEXT[self.state][role[0]]

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say("assistant" if "a" in NEXT[self.state] else "user", "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else "assistant" if "a" in NEXT[self.state] else "user", text)

    def end(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``edits`` with ``repaired_sha256``: the digest of the repaired conversation. Rows are streamed in order behind their audit."""
    kind = edits.schema["conv"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = edits.withColumns({"head": F.lit(True), "turn": F.lit(None).cast("long"), "role": F.lit(""), "key": F.lit(b""), "text": F.lit(None).cast("string")})
    texts = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", _key().alias("key"), F.lit(False).alias("head"))
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv")
    ready = both.sortWithinPartitions("conv", F.desc("head"), "turn", "role", "key").select("conv", *counts, "audit", "head", "role", "text")
    names = ["conv", *counts, "audit", "repaired_sha256"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, facts, of = None, (), pa.null()
        types = [pa.int64()] * len(counts) + [pa.string(), pa.string()]

        def table_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, [of, *types], strict=True)], names=names)

        for batch in batches:
            done, of = [], batch.schema.field("conv").type
            for *values, audit, head, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if head:
                    if repair:
                        done.append((*facts, repair.audit, repair.end()))
                    repair, facts = _Repair(audit), tuple(values)
                else:
                    repair.row(role, text)
            yield table_of(done)
        if repair:
            yield table_of([(*facts, repair.audit, repair.end())])

    return ready.mapInArrow(apply, f"conv {kind}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string")


def repair_conversations(turns: DataFrame, every: DataFrame | None = None, **options) -> DataFrame:
    """(conv_id, counts, cost, audit, repaired_sha256) of each conversation of ``turns`` (conv_id, turn, role, text; no nulls in the
    last two) and of ``every`` (conv_id), whose further conversations have no rows."""
    with arrow_rows(turns.sparkSession):
        edits = cheapest_edits(turns, **options)
        if every is not None:
            ids = every.select(F.col("conv_id").alias("c")).distinct()
            edits = ids.join(edits, ids["c"].eqNullSafe(edits["conv"]), "left").drop("conv").withColumnRenamed("c", "conv")
            edits = edits.fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna("", ["audit"])
        return materialize(repaired_digests(turns, edits).withColumnRenamed("conv", "conv_id"))


def _repair_sql() -> str:
    """Row by row through the four states, each state one text of cost and audit, which sorts as both do."""

    def step(state: str, cost: str, letter: str) -> str:
        return f"printf('%012d', CAST(left({state}, 12) AS BIGINT) + {cost}) || substr({state}, 13) || '{letter}'"

    extra = "CASE WHEN cut THEN 5 ELSE 0 END"

    def edit(states: str, initial: str, reroled: bool = True) -> list[str]:
        out = []
        for state in states:
            out.append(f"CASE WHEN fine AND initial = '{initial}' THEN {step(f's{state}', extra, 'K')} END")
            if reroled:
                out.append(f"CASE WHEN fine THEN {step(f's{state}', f'1 + {extra}', 'R')} END")
        return out

    def least(items: list[str]) -> str:
        return f"list_min([{', '.join(items)}])"

    kept = [step(f"s{q}", "2", "D") for q in range(4)]
    after = [kept[0], least([kept[1], *edit("0", "s", False)]), least([kept[2], *edit("013", "u")]), least([kept[3], *edit("2", "a")])]
    more = [
        "t0",
        "t1",
        least(["t2", *(step(f"t{q}", "5", "I") for q in (0, 1, 3))]),
        least(["t3", step("t2", "5", "I"), step("t0", "10", "II"), step("t1", "10", "II")]),
    ]
    zero = "0" * 12
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), keyed AS (
  SELECT spaced.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM spaced, tab
), rows_ AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE kind <> 0
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    NOT regexp_matches(text, '[^ 	-
]') AS blank, left(role, 1) AS initial FROM rows_
), marked AS MATERIALIZED (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed
), ready AS MATERIALIZED (SELECT *, NOT blank AND NOT again AS fine FROM marked),
run AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '{zero}' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000000005I' AS s2, '000000000010II' AS s3 FROM ready
  UNION ALL
  SELECT conv_id, pos, {", ".join(f"{m} AS s{q}" for q, m in enumerate(more))} FROM (
    SELECT run.conv_id, ready.pos, {", ".join(f"{a} AS t{q}" for q, a in enumerate(after))}
    FROM run JOIN ready ON run.conv_id IS NOT DISTINCT FROM ready.conv_id AND ready.pos = run.pos + 1
  )
), facts AS (
  SELECT conv_id, max(pos) AS pos, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again) AS duplicate, count(*) FILTER (fine AND cut) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM ready GROUP BY conv_id
), best AS MATERIALIZED (
  SELECT facts.*, list_min([s0, s3]) AS found FROM facts JOIN run ON facts.conv_id IS NOT DISTINCT FROM run.conv_id AND facts.pos = run.pos
), letters AS (
  SELECT conv_id, i, substr(found, 12 + i, 1) AS letter FROM (SELECT conv_id, found, unnest(range(1, length(found) - 11)) AS i FROM best)
), steps AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS pos, count(*) FILTER (letter <> 'D') OVER w AS said
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
), said AS (
  SELECT steps.conv_id, i, letter, said, role, text, initial,
    max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY steps.conv_id) AS led
  FROM steps LEFT JOIN ready ON steps.conv_id IS NOT DISTINCT FROM ready.conv_id AND steps.pos = ready.pos AND letter <> 'I' WHERE letter <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (said - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
    chr(10) ORDER BY i) AS repaired FROM said GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(left(found, 12), '0') AS BIGINT) AS cost,
  coalesce(substr(found, 13), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e
LEFT JOIN best ON e.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN texts ON e.conv_id IS NOT DISTINCT FROM texts.conv_id
"""


@query("op12_structure_repair", _repair_sql())
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(turns), turns)


__all__ = ["build_rules", "cheapest_edits", "damaged", "repair_conversations", "rule_matrices"]
