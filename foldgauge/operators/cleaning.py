"""Corpus cleaning: Unicode hygiene, entities, then structural rules in a fixed order.

Everything a row needs in the common case stays in the JVM. Python is needed only for NFKC and for
unusual entities; a row that needs neither sends a null to the Arrow function instead of its text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldgauge import fixed_values as V

HYGIENE = "hygiene"

# Characters that NFKC never changes and that never combine with the one before them. Leaving a stable
# character out only costs speed; the tests check that every listed one is stable.
NFKC_STABLE = (
    r"\u0000-\u007F"  # ASCII
    r"¡-§©«-¬®°-±¶-·»¿"  # Latin-1 signs
    r"À-ıĴ-ľŁ-ňŊ-ž"  # Latin letters with marks
    r"Α-ΡΣ-ώЀ-џ"  # Greek, Cyrillic
    r"–-—‘-„†-•€"  # dashes, quotes, bullets, euro
    r"、-〩ぁ-ゖァ-ヺー"  # Japanese
    r"一-鿿가-힣"  # Chinese, Korean
    r"א-תء-غف-ي"  # Hebrew, Arabic letters
    r"अ-नप-रलळव-हก-ะ"  # Devanagari, Thai letters
    "\U0001f300-\U0001f64f\U0001f680-\U0001f6d7\U0001f900-\U0001f9ff"  # pictographs
)
# Entities replaced by plain string replacement; the ampersand itself goes last so that nothing is
# unescaped twice.
PLAIN_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&copy;": "©", "&middot;": "·", "&amp;": "&"}
# Stops only at ampersands and beyond ASCII, then looks back: an ampersand that may start some other entity,
# or a character that is not known to be stable.
NEEDS_PYTHON = (
    r"[^\x00-%'-\x7F](?:(?<=&)(?!"
    + "|".join(name[1:] for name in PLAIN_ENTITIES)
    + rf"|[\t\n\f <&;]|\z)|(?<![&{NFKC_STABLE}]))"
)


def unicode_and_entities(text: str) -> str:
    """NFKC, then zero-width removal, then HTML entities: the per-row rule for unusual texts."""
    return html.unescape(re.sub(V.ZERO_WIDTH, "", unicodedata.normalize("NFKC", text)))


@F.arrow_udf(T.StringType())
def _hygiene(texts: pa.Array) -> pa.Array:
    """Finished texts with their ampersands escaped, so the plain entity step after it only restores them."""
    if texts.null_count == len(texts):
        return pa.nulls(len(texts), pa.string())
    done = [None if t is None else unicode_and_entities(t).replace("&", "&amp;") for t in texts.to_pylist()]
    return pa.array(done, pa.string())


@dataclass(frozen=True)
class Rule:
    """A replacement over the text as the rules before it left it."""

    name: str
    pattern: str
    replacement: str

    upto: str = ""

    def apply(self, text: Column) -> Column:
        """A pattern that must end in ``upto`` is tried only before the last of these, where every start finds
        an end; behind it each start would search the whole rest in vain."""
        if not self.upto:
            return F.regexp_replace(text, F.lit(self.pattern), F.lit(self.replacement))
        rest = F.substring_index(text, self.upto, -1)
        head = F.left(text, F.length(text) - F.length(rest))
        return F.concat(F.regexp_replace(head, F.lit(self.pattern), F.lit(self.replacement)), rest)


CHUNK_ENDS = r"(?<=\])(?!\])"


@dataclass(frozen=True)
class BracketRule(Rule):
    """A rule for links closed by ``]]`` that hold no ``]``, in linear time.

    The first ``]`` behind a ``[[`` settles the fate of every start before it. So the text is cut behind each run of ``]``: a
    piece that ends in a single one (or in none) holds no link and is left alone as a whole, and in
    any other piece the links are those whose target reads on to its end, of which the leftmost counts.
    """

    def apply(self, text: Column) -> Column:
        pieces = F.split(text, CHUNK_ENDS, -1)
        return F.array_join(F.transform(pieces, lambda piece: F.when(F.endswith(piece, F.lit("]]")), self.inside(piece)).otherwise(piece)), "")

    def inside(self, piece: Column) -> Column:
        return F.regexp_replace(piece, F.lit(self.pattern), F.lit(self.replacement))


@dataclass(frozen=True)
class PageLinkRule(BracketRule):
    """``[[page]]`` and ``[[page|shown]]`` become the page; neither part may be empty.

    In a piece a start reads up to the first bar or to the brackets, and fails only if that is nothing or if the bar is the
    last character. Starts behind the last bar but one would all meet that last bar, so they are not tried.
    """

    def inside(self, piece: Column) -> Column:
        body = F.rtrim(piece, F.lit("]"))
        closing = F.length(piece) - F.length(body) - 2
        tried = F.when(F.endswith(body, F.lit("|")), self._before_last_bar(body)).otherwise(body)
        found = F.regexp_replace(tried, F.lit(r"(?s)\[\[([^|]++)(?:\|.*)?\z"), F.lit("$1"))
        return F.when(found == tried, piece).otherwise(F.concat(found, F.repeat(F.lit("]"), closing)))

    @staticmethod
    def _before_last_bar(body: Column) -> Column:
        """Up to the last bar but one, itself included; empty without one."""
        open_ = F.left(body, F.length(body) - 1)
        return F.left(open_, F.length(open_) - F.length(F.substring_index(open_, "|", -1)))


_PATTERNS = {name: pattern.replace("@B", V.BLANK).replace("@N", V.NON_BLANK) for name, pattern, _ in V.CLEANING}
_PATTERNS["user_link"] = _PATTERNS["user_link"].replace("(?i)", "(?iU)")
# The same matches in forms that look at fewer places: blanks inside a heading are left to the last rule, which keeps
# the heading linear; urls and addresses are tried only at their first character; a lone space is no run, which is seen
# without looking back: texts are full of them.
_PATTERNS["wiki_heading"] = r"(?<!=)={2,}+([^=]++)={2,}"
_PATTERNS["url"] = rf"(?U)(?=[hHwW])(?i:https?://|www\.){V.NON_BLANK}+"
_PATTERNS["ip_address"] = r"(?U)(?=[^\x00-/:-\x7F])(?=\d)\b(?:\d{1,3}\.){3}\d{1,3}\b"
_PATTERNS["blank_run"] = rf"(?U) {V.BLANK}+|[\s\x1c-\x1f&&[^ ]]{V.BLANK}*"
_KINDS = {"user_link": BracketRule, "wiki_link": PageLinkRule}
_UPTO = {"html_tag": ">"}

# Each rule refers to the text once: a plan that puts the cleaned text into a Python function writes the whole
# chain out, and rules that test the text first would multiply it with every step.
STRUCTURAL_RULES = tuple(
    _KINDS.get(name, Rule)(name, _PATTERNS[name], shown.replace("\\1", "$1"), _UPTO.get(name, "")) for name, _, shown in V.CLEANING
)


# Texts without any of these skip the wiki rules, which need one of them.
WIKI_MARKS = ("[[", "{{", "==", "~~~")
WIKI_RULES = ("user_link", "wiki_template", "wiki_heading", "wiki_link", "signature")


def _apply_rules(text: Column, rules: Sequence[Rule]) -> Column:
    for rule in rules:
        text = rule.apply(text)
    return text


def _step(name: str) -> str:
    return f"_cleaning_after_{name}"


def cleaning_steps(df: DataFrame, text: str, rules: Sequence[Rule] = STRUCTURAL_RULES) -> DataFrame:
    """Adds one column per rule holding the text after it; its columns begin with ``_cleaning_``. Each step is a projection of its own, so a
    text is computed once and then referenced."""
    source = "_cleaning_before"
    out = df.withColumn(source, F.coalesce(F.col(text).cast("string"), F.lit("")))
    in_python = _hygiene(F.when(F.col(source).rlike(NEEDS_PYTHON), F.col(source)))
    plain = F.coalesce(in_python, F.col(source))
    for entity, character in PLAIN_ENTITIES.items():
        plain = F.replace(plain, F.lit(entity), F.lit(character))
    out = out.withColumn(_step(HYGIENE), plain)
    previous = _step(HYGIENE)
    for rule in rules:
        out = out.withColumn(_step(rule.name), rule.apply(F.col(previous)))
        previous = _step(rule.name)
    return out.withColumn("_cleaning_done", F.trim(previous))


def clean_corpus(
    df: DataFrame,
    text: str,
    out: str = "cleaned",
    enabled: bool = True,
    rules: Sequence[Rule] = STRUCTURAL_RULES,
) -> DataFrame:
    """Adds ``out``: the cleaned text; null becomes empty. Disabled, the text passes unchanged.

    The wiki rules follow each other, so one test for their marks spares ordinary texts all of them.
    """
    if not enabled:
        return df.withColumn(out, F.coalesce(F.col(text).cast("string"), F.lit("")))
    kept = [F.col(name) for name in df.columns if name != out]
    place = [i for i, rule in enumerate(rules) if rule.name in WIKI_RULES]
    if not place or place != list(range(place[0], place[-1] + 1)):
        return cleaning_steps(df, text, rules).select(*kept, F.col("_cleaning_done").alias(out))
    before, wiki, after = rules[: place[0]], rules[place[0] : place[-1] + 1], rules[place[-1] + 1 :]
    tagless = cleaning_steps(df, text, before).withColumn("_cleaning_tagless", F.col(_step(before[-1].name if before else HYGIENE)))
    marked = F.lit(False)
    for mark in WIKI_MARKS:
        marked = marked | F.contains("_cleaning_tagless", F.lit(mark))
    unmarked = tagless.withColumn(
        "_cleaning_unmarked", F.when(marked, _apply_rules(F.col("_cleaning_tagless"), wiki)).otherwise(F.col("_cleaning_tagless"))
    )
    return unmarked.select(*kept, F.trim(_apply_rules(F.col("_cleaning_unmarked"), after)).alias(out))


def clean_audit(
    df: DataFrame, text: str, by: Sequence[str], rules: Sequence[Rule] = STRUCTURAL_RULES
) -> DataFrame:
    """Rows changed and characters removed per rule and group.

    One aggregate with two sums per rule, combined on the map side; only its few rows become long.
    """
    names = [HYGIENE, *[rule.name for rule in rules]]
    befores = ["_cleaning_before", *[_step(name) for name in names[:-1]]]
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for name, before in zip(names, befores):
        after = _step(name)
        sums.append(F.sum((F.col(before) != F.col(after)).cast("long")).alias(f"hit_{name}"))
        sums.append(
            F.sum((F.char_length(before) - F.char_length(after)).cast("long")).alias(f"removed_{name}")
        )
    wide = cleaning_steps(df.select(*by, text), text, rules).groupBy(*by).agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"hit_{name}").alias("rows_changed"),
                F.col(f"removed_{name}").alias("chars_removed"),
            )
            for name in names
        ]
    )
    return wide.select(*by, "n_rows", F.inline(rows))
