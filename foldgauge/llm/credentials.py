"""Secret scan with multipart credential linking (operator 5), in DataFrame functions only.

Base kinds (assign, access, hex) stand alone. Weak parts are reported only when complementary parts co-occur within
``scope`` characters: *weak* secrets (assignments to password-like names that the base pattern does not know) need an
identifier near, *identifier* parts (user, client or key names; access keys count as identifiers too) need a secret near,
and *endpoint* parts (URLs, host assignments) need both. "Near" is an interval join: the scopes of all anchors of a text
are merged to disjoint intervals, cut into bins of ``scope`` characters, and joined to the parts by text and bin, so each part
meets at most one interval in a bin and no pairs of parts are formed. A part that is reported names the nearest span of each kind it was linked with.

Positions come without a user function: the text is split by the same pattern that extracts the matches, and a running sum of the
lengths of gaps and matches gives every start. That sum and the joins carry lengths, never texts.

Positions are code points, ends exclusive. Null and empty texts have no spans; repeated rows each give a row; null ids stay null; an empty
table gives no rows; other columns are ignored. Spans of different kinds may overlap; a weak part that overlaps a base span is dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldgauge.llm.common import small_enough
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

SCOPE = 200
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint")

_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_SET = r"[\"']?\x20*+[:=]\x20*+[\"']?"
PATTERNS = {
    "assign": _NAME + _SET + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "weak": r"(?i:\b(?:pwd|pass|passphrase|credential|auth|private_?key|secret_?key|access_?key))" + _SET + r"[^\s\"',;<>]{4,}+",
    "identifier": r"(?i:\b(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key_?id|key_?id))" + _SET + r"[^\s\"',;<>]{3,}+",
    "endpoint": r"(?i:\b(?:https?|ftp|ssh|jdbc:[a-z0-9]{1,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://|\b(?:host(?:name)?|server|endpoint)"
    + _SET
    + r")[^\s\"',;<>]{3,}+",
}
_VALUE = r"^" + _NAME + _SET


def _matches(kind: str) -> tuple[Column, Column]:
    """The matches, and array<struct<gap, size, fits>>: for each match the characters since the one before, its length, and whether
    it passes the kind's condition. Failing matches stay, as the positions behind them count from their end."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all("body", pattern, F.lit(0))
    gaps = F.split("body", PATTERNS[kind], -1)

    def fits(match: Column) -> Column:
        if kind == "assign":
            return F.length(F.regexp_replace(match, _VALUE, "")) >= 6
        return F.length(match) >= 20 if kind == "access" else F.lit(True)

    pairs = F.zip_with(
        f"found_{kind}",
        F.slice(gaps, F.lit(1), F.size(f"found_{kind}")),
        lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), fits(m).alias("fits")),
    )
    return found, F.when(F.size(f"found_{kind}") > 0, pairs)


def _parts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row for each text with the matches of every kind; written once."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("body")
    )
    for kind in KINDS:
        rows = rows.withColumn(f"found_{kind}", _matches(kind)[0])
    return materialize(rows.select("_row", "id", *(_matches(kind)[1].alias(kind) for kind in KINDS)))


def _spans(parts: DataFrame) -> DataFrame:
    """(_row, kind number, start, end) of every fitting match."""
    each = [
        parts.where(F.col(kind).isNotNull()).select("_row", F.lit(k).alias("kind"), F.posexplode(kind).alias("at", "x")).select("_row", "kind", "at", "x.*")
        for k, kind in enumerate(KINDS)
    ]
    long = reduce(DataFrame.unionByName, each)
    so_far = Window.partitionBy("_row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(so_far)
    placed = long.withColumn("end", end).where("fits")
    return placed.select("_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _bins(low: Column, high: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def merged_scopes(anchors: DataFrame, scope: int) -> DataFrame:
    """(_row, low, high): the union of [start - scope, end + scope] over the anchors of each row."""
    wide = anchors.select("_row", F.greatest(F.col("start") - scope, F.lit(0)).alias("low"), (F.col("end") + scope).alias("high"))
    order = Window.partitionBy("_row").orderBy("low", "high")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    new = F.when(F.col("low") > F.max("high").over(before), 1).otherwise(0)
    wide = wide.withColumn("new", F.coalesce(new, F.lit(0)))
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return wide.withColumn("island", island).groupBy("_row", "island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("island")


def near(parts: DataFrame, anchors: DataFrame, scope: int) -> DataFrame:
    """The parts that begin or end inside the scope of an anchor of the same text."""
    scopes = merged_scopes(anchors, scope)
    scopes = scopes.select("_row", "low", "high", _bins(F.col("low"), F.col("high"), scope).alias("bin"))
    binned = parts.select("*", _bins(F.col("start"), F.col("end"), scope).alias("bin"))
    inside = (F.col("start") <= F.col("high")) & (F.col("end") >= F.col("low"))
    return binned.join(scopes, ["_row", "bin"]).where(inside).select(*parts.columns).distinct()


def _apart(parts: DataFrame, base: DataFrame, scope: int) -> DataFrame:
    """The parts that overlap no base span of their text."""
    spans = base.select("_row", F.col("start").alias("low"), F.col("end").alias("high"), _bins(F.col("start"), F.col("end"), scope).alias("bin"))
    binned = parts.select("*", _bins(F.col("start"), F.col("end"), scope).alias("bin"))
    overlap = binned.join(spans, ["_row", "bin"]).where((F.col("start") < F.col("high")) & (F.col("end") > F.col("low")))
    return parts.join(overlap.select(*parts.columns).distinct(), parts.columns, "left_anti")


def nearest_anchor(parts: DataFrame, anchors: DataFrame) -> DataFrame:
    """``parts`` with ``partner``: the anchor (start, kind, end) of the same text that begins nearest, the earlier one if two do.

    Two running windows over the spans of a text, last anchor before and first one behind: no pairs are formed.
    """
    both = parts.select("*", F.lit(False).alias("anchor")).unionByName(anchors.select(*parts.columns, F.lit(True).alias("anchor")))
    order = Window.partitionBy("_row").orderBy("start", "end", "kind", "anchor")
    span = F.when(F.col("anchor"), F.struct("start", "kind", "end"))
    before = F.last(span, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    behind = F.first(span, ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = both.withColumns({"before": before, "behind": behind}).where("NOT anchor")
    closer = F.col("behind.start") - F.col("start") < F.col("start") - F.col("before.start")
    partner = F.when(F.col("before").isNull() | closer, F.coalesce("behind", "before")).otherwise(F.col("before"))
    return placed.select(*parts.columns, partner.alias("partner"))


def linked_parts(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts to report, (_row, kind, start, end, partners): each with the nearest span of every kind of part it needs."""

    def of(*names: str) -> DataFrame:
        return spans.where(F.col("kind").isin([KINDS.index(n) for n in names]))

    base = of("assign", "access", "hex")
    weak, identifier, endpoint = (_apart(of(n), base, scope) for n in ("weak", "identifier", "endpoint"))
    keys = of("access").unionByName(identifier)
    secret = of("assign", "hex").unionByName(weak)
    linked = [
        (near(weak, keys, scope), (keys,)),
        (near(identifier, secret, scope), (secret,)),
        (near(near(endpoint, keys, scope), secret, scope), (keys, secret)),
    ]
    out = []
    for found, needs in linked:
        each = [nearest_anchor(found, anchors).withColumn("partners", F.array("partner")).drop("partner") for anchors in needs]
        together = reduce(DataFrame.unionByName, each).groupBy(*found.columns)
        out.append(together.agg(F.array_sort(F.flatten(F.collect_set("partners"))).alias("partners")))  # two at most
    return reduce(DataFrame.unionByName, out)


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """(_row, id, base, all, links) of every text: arrays of (start, kind number, end), in order; ``links`` tells for each weak part that is
    reported which spans it was linked with."""
    parts = _parts(docs, id_column, text_column)
    spans = materialize(_spans(parts))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    linked = linked_parts(spans, scope)
    strong = spans.where(F.col("kind") < 3).select("*", F.lit(None).cast(linked.schema["partners"].dataType).alias("partners"))
    both = strong.unionByName(linked)
    span, partners = F.struct("start", "kind", "end"), F.col("partners")
    found = materialize(
        both.groupBy("_row").agg(
            listed.alias("all"),
            F.array_sort(F.collect_list(F.when(partners.isNull(), span))).alias("base"),
            F.array_sort(F.collect_list(F.when(partners.isNotNull(), F.struct("start", "kind", "end", "partners")))).alias("links"),
        )
    )
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    unlinked = F.array().cast(found.schema["links"].dataType)
    rows = parts.select("_row", "id").join(small_enough(found, cells=F.size("all")), "_row", "left")
    return rows.select("_row", F.col("id").alias(id_column), *(F.coalesce(c, e).alias(c) for c, e in (("base", none), ("all", none), ("links", unlinked))))


def _listed(spans: str | Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _number(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    counts = [_number("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    linked = F.array_join(F.transform("links", lambda x: F.concat(_listed(F.array(x)), F.lit(">"), F.replace(_listed(x["partners"]), F.lit(","), F.lit("+")))), ",")
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"), linked.alias("links"))
