"""Personal data: base patterns plus bootstrapped contextual extraction (operator 2).

One pass over the texts finds the base spans (email, ip, card, phone) and, beside them, *candidates*: blank-separated
tokens holding a digit or an at sign, and runs of digit groups parted by single blanks, that no base span touches. For base spans and candidates
it notes the lexical pattern to the left: the two tokens before, lower-cased, digits as 0; a start mark stands for a token that is
missing, and of one longer than LONG_TOKEN its last characters count.

The graph of patterns and instances is then scored in rounds of Spark joins. Known instances start as the seeds
(base spans). A pattern's confidence for a kind is the share of known instances of that kind among all its distinct
instances; it is trusted with at least ``support`` of them and a confidence of ``confidence`` or more. An unknown
candidate that trusted patterns of a kind extract and whose shape fits the kind becomes known. Candidates that are
known in the end and stand behind a trusted pattern of their kind are added as spans of that kind.

Hot patterns and instances are only ever counted (combined before the shuffle), never gathered. Positions are code points,
ends exclusive. Null and empty texts have no spans; repeated rows each give a row; null ids stay null; an empty table gives no rows.
All scans are linear in the text: no pattern retries inside a long run.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import small_enough, trimmed, whole_row
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

KINDS = ("email", "ip", "card", "phone")
LONG_TOKEN = 64
SUPPORT = 3
CONFIDENCE = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_TOKEN = re.compile(r"\S+")
_GROUPS = re.compile(r"[0-9(][0-9()./-]*(?:\x20[0-9(][0-9()./-]*)+")
_START = "^"
_EDGE = " \t\"'()[]{}<>,;:.!?*#$%&|"

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if k % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    cursor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > cursor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, 0, found.end()
            cursor = found.end()
        at = text.find("@", max(at + 1, cursor))


def _addresses(text: str) -> Iterator[Span]:
    for chain in _CHAIN.finditer(text):
        if text.count(".", chain.start(), chain.end()) < 3:
            continue
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, 1, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """The base spans, by start and then kind."""
    spans = list(_emails(text))
    if _DIGIT.search(text):
        spans += _addresses(text)
        for found in _CARD.finditer(text):
            if 12 <= found.end() - found.start():
                digits = found.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((found.start(), 2, found.end()))
        for found in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(found.group())) <= 15:
                spans.append((found.start(), 3, found.end()))
        spans.sort()
    return spans


class _Tokens:
    """The blank-separated tokens of a text, found once and only if asked for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def pattern(self, at: int) -> str:
        """The two tokens before ``at`` (the nearer one may be the begun part of a token), lower-cased, digits as 0. A start mark stands
        for each that is missing, and of a long one its end counts."""
        if self.starts is None:
            found = [m.span() for m in _TOKEN.finditer(self.text)]
            self.starts, self.ends = [s for s, _ in found], [e for _, e in found]
        upto = bisect_left(self.starts, at)
        parts = [_START] * (2 - upto)
        for k in range(max(0, upto - 2), upto):
            end = min(self.ends[k], at)
            part = self.text[max(self.starts[k], end - LONG_TOKEN - 1) : end]
            parts.append(part if len(part) <= LONG_TOKEN else "…" + part[-LONG_TOKEN // 2 :])
        return _DIGIT.sub("0", " ".join(parts).lower())


def _instance(token: str) -> str:
    return token if len(token) <= 128 else hashlib.sha256(token.encode()).hexdigest()


def candidates(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Spans of tokens with a digit or an at sign, and of runs of digit groups parted by single blanks, stripped of marks at
    their edges, that touch no taken span."""
    cursor, k = 0, 0
    covered: list[list[int]] = []
    for start, _, end in taken:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    found = _MARK.search(text)
    while found:
        at = found.start()
        start = at
        while start > cursor and not text[start - 1].isspace():
            start -= 1
        stop = _BLANK.search(text, at)
        end = cursor = stop.start() if stop else len(text)
        while start < end and text[start] in _EDGE:
            start += 1
        last = end
        run = _GROUPS.match(text, start)
        if run and run.end() > end and (run.end() == len(text) or text[run.end()].isspace() or text[run.end()] in _EDGE):
            last = end = cursor = run.end()  # digit groups with a single blank between them are one number
        while last > start and text[last - 1] in _EDGE:
            last -= 1
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if last - start >= 5 and not (k < len(covered) and covered[k][0] < last):
            yield start, last
        found = _MARK.search(text, cursor)


def shape_kinds(token: str) -> int:
    """Bit k is set if the token could be of kind k: an at sign or its usual disguise; digits in three or more
    parts; seven or more digits that make up most of the token."""
    digits = len(_DIGIT.findall(token))
    bits = 1 if "@" in token or "(at)" in token.lower() or "[at]" in token.lower() else 0
    if digits and len(re.split(r"[.:]", token)) >= 4:
        bits |= 2
    if digits >= 7 and 2 * digits > len(token):
        bits |= 12
    return bits


_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_NOTED = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.int32()), ("shape", pa.int32())])
)
_SCANNED = (
    "base array<struct<start:long,kind:int,end:long>>, "
    "noted array<struct<start:long,end:long,pattern:string,instance:string,kind:int,shape:int>>"
)


def scan(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(_row, id, base, noted) of every text; noted has base spans (with kind) and candidates (kind null)."""
    narrow = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    return _scanned(narrow, 2, ["_row", "id"])


def _scanned(narrow: DataFrame, position: int, kept: list[str]) -> DataFrame:
    places = [narrow.columns.index(c) for c in kept]
    fields = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in kept)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, noted = [], []
            for text in batch.column(position):
                spans = base_spans(body) if (body := text.as_py()) else []
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                tokens = _Tokens(body or "")
                own = [(start, end, tokens.pattern(start), _instance(body[start:end]), kind, 0) for start, kind, end in spans]
                if body and _MARK.search(body):
                    for start, end in candidates(body, spans):
                        shape = shape_kinds(body[start:end])
                        if shape:
                            own.append((start, end, tokens.pattern(start), _instance(body[start:end]), None, shape))
                noted.append([dict(zip(("start", "end", "pattern", "instance", "kind", "shape"), x, strict=True)) for x in own])
            columns = [*(batch.column(p) for p in places), pa.array(base, type=_BASE), pa.array(noted, type=_NOTED)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "base", "noted"])

    return narrow.mapInArrow(trimmed(look), f"{fields}, {_SCANNED}")


def bootstrap(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(trusted patterns: pattern, kind, confidence; known instances: instance, kind).

    ``edges``: distinct (pattern, instance, kind or null, shape). Every round joins the graph with what is known so far, scores
    the patterns and lets trusted ones name new instances; rounds go on until one names none.
    """
    graph = edges.select("pattern", "instance").distinct()
    known = edges.where(F.col("kind").isNotNull()).select("instance", "kind").distinct()
    unknown = edges.where(F.col("kind").isNull()).select("pattern", "instance", "shape").distinct()
    unknown = unknown.join(known.select("instance").distinct(), "instance", "left_anti")
    total = materialize(graph.groupBy("pattern").agg(F.count("*").alias("n")))
    known, unknown, graph = materialize(known), materialize(unknown), materialize(graph)

    def score() -> DataFrame:
        hits = graph.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("hits")).where(F.col("hits") >= support)
        share = hits.join(total, "pattern").withColumn("confidence", F.col("hits") / F.col("n"))
        return materialize(share.where(F.col("confidence") >= confidence).select("pattern", "kind", "confidence"))

    trusted = score()
    while True:
        fits = F.expr("(shape & shiftleft(1, kind)) <> 0")
        named = unknown.join(trusted, "pattern").where(fits).groupBy("instance", "kind").agg(F.sum("confidence").alias("weight"))
        best = named.groupBy("instance").agg(F.max(F.struct("weight", (-F.col("kind")).alias("order"))).alias("best"))
        new = materialize(best.select("instance", (-F.col("best.order")).cast("int").alias("kind")))
        if new.isEmpty():
            break
        known = materialize(known.unionByName(new))
        unknown = materialize(unknown.join(new, "instance", "left_anti"))
        trusted = score()
    return trusted, known


def _listed(spans: str | Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def _all_spans(scanned: DataFrame, support: int, confidence: float) -> DataFrame:
    """(_row, extra) for rows where trusted patterns found more."""
    noted = scanned.select("_row", F.explode("noted").alias("x")).select("_row", "x.*")
    edges = materialize(noted.groupBy("pattern", "instance", "kind").agg(F.max("shape").alias("shape")))
    trusted, known = bootstrap(edges, support, confidence)
    spots = noted.where(F.col("kind").isNull()).drop("kind", "shape")
    found = spots.join(trusted.select("pattern", "kind"), "pattern").join(known, ["instance", "kind"])
    spans = F.array_sort(F.collect_set(F.struct("start", "kind", "end")))
    return found.groupBy("_row").agg(spans.alias("extra"))


def find_personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    support: int = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """(_row, id, base, extra) of every text: arrays of (start, kind number, end), in order."""
    scanned = materialize(scan(docs, id_column, text_column))
    more = materialize(_all_spans(scanned, support, confidence))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    both = scanned.select("_row", "id", "base").join(small_enough(more, cells=F.size("extra")), "_row", "left")
    return both.select("_row", F.col("id").alias(id_column), "base", F.coalesce("extra", none).alias("extra"))


def mask_personal_data(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans by the first one's); other
    columns stay, the length column follows the new text. Null texts stay null."""
    whole = materialize(docs.select(F.monotonically_increasing_id().alias("_row"), whole_row(docs)))
    narrow = whole.select("_row", F.col("whole")[text_column].alias("body"))
    scanned = materialize(_scanned(narrow, 1, ["_row"]))
    more = _all_spans(scanned, options.get("support", SUPPORT), options.get("confidence", CONFIDENCE))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    marks = scanned.select("_row", "base").join(more, "_row", "left")
    marks = marks.select("_row", F.array_sort(F.concat("base", F.coalesce("extra", none))).alias("spans")).where(F.size("spans") > 0)
    marks = materialize(marks)

    @F.udf("string", useArrow=True)
    def masked(text: str | None, spans: list | None) -> str | None:
        if not text or not spans:
            return text
        out, cursor = [], 0
        for span in spans:
            if span["start"] >= cursor:
                out += [text[cursor : span["start"]], f"[{KINDS[span['kind']].upper()}]"]
            cursor = max(cursor, span["end"])
        return "".join([*out, text[cursor:]])

    joined = whole.join(small_enough(marks, cells=F.size("spans")), "_row", "left")
    marked = F.col("spans").isNotNull()
    body = F.col("whole")[text_column]
    joined = joined.withColumn("masked", masked(F.when(marked, body), "spans")).withColumn("masked", F.when(marked, F.col("masked")).otherwise(body))
    columns = []
    for name in docs.columns:
        value = F.col("whole")[name]
        if name == text_column:
            value = F.col("masked")
        elif name == length_column:
            value = F.when(marked, F.length("masked").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return joined.select(*columns)


def _number(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [_number("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        F.size("extra").cast("long").alias("n_added"),
    )
