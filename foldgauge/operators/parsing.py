"""Model replies to labels.

Stages, each a built-in expression: the first innermost ``{...}`` that is valid JSON and names a label
(``json``), else the first 0 or 1 after each quoted label name (``pattern``), else zeros (``none``). Only
``json`` counts as success.

Each candidate is parsed once and written back as canonical JSON: no blanks, no repeated keys, plain
escapes. Labels are then read off that text by one short pattern each. Spark's parser refuses a few texts
Python accepts (repeated keys, NaN); replies with a refused candidate, and only those, send their candidates
to an Arrow function that reads them with ``json.loads``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldgauge import fixed_values as V
from foldgauge.functions.text import strip_blanks

# Canonical JSON values that are empty or zero: everything else counts as 1.
FALSY_JSON = r'(?:null|false|""|\[\]|-?0+(?:\.0*)?(?:[eE][-+]?\d+)?)[,}]'


# Stands for a reply whose reading failed as a whole: no label is set and it counts as a failure.
UNREADABLE = "!"


def unfenced(raw: Column) -> Column:
    """The reply without surrounding blanks and code fences.

    ``parse_replies`` does not need it: fences and blanks lie outside every object and every quoted label, so
    removing them changes no match.
    """
    opened = strip_blanks(F.regexp_replace(strip_blanks(raw), V.FENCE_OPEN, ""))
    return strip_blanks(F.regexp_replace(opened, V.FENCE_CLOSE, ""))


def _key_pattern(labels: Sequence[str]) -> str:
    """A key of canonical JSON. An escaped quote in front would make it the end of a longer key."""
    return r'(?<!\\)"(?:' + "|".join(rf"\Q{label}\E" for label in labels) + r')":'


def _python_reader(labels: Sequence[str]):
    """Replies to label bits such as ``010``, null without a usable object. Texts cross to Python, not arrays:
    Spark writes a mostly null array column to Arrow far more slowly than a mostly null text column."""
    names = list(labels)

    def read_object(found: re.Match) -> dict | None:
        try:
            return json.loads(found.group())
        except ValueError:
            return None

    def bits(reply: str) -> str | None:
        objects = (read_object(found) for found in re.finditer(V.JSON_OBJECT, reply))
        try:
            values = next((o for o in objects if o and not o.keys().isdisjoint(names)), None)
        except RecursionError:  # brackets nested too deep
            return UNREADABLE
        return values and "".join("1" if values.get(name) else "0" for name in names)

    @F.arrow_udf(T.StringType())
    def read(replies: pa.Array) -> pa.Array:
        if replies.null_count == len(replies):
            return pa.nulls(len(replies), pa.string())
        return pa.array([None if reply is None else bits(reply) for reply in replies.to_pylist()], pa.string())

    return read


def parse_replies(df: DataFrame, raw: str, labels: Sequence[str], prefix: str = "pred_") -> DataFrame:
    """Adds ``<prefix><label>`` ints, ``parse_stage`` and ``parse_failure``; all other columns stay. Columns that begin with
    ``_parsing_`` are its own."""
    kept = list(df.columns)
    found = df.withColumn("_parsing_reply", F.coalesce(F.col(raw), F.lit(""))).withColumn(
        "_parsing_candidates", F.regexp_extract_all("_parsing_reply", F.lit(V.JSON_OBJECT), F.lit(0))
    )
    canonical = found.withColumn("_parsing_canonical", F.transform("_parsing_candidates", lambda c: F.to_json(F.try_parse_json(c))))
    # The arrays end here: only texts travel past the Python step.
    chosen = canonical.select(
        *kept,
        "_parsing_reply",
        F.get(F.filter("_parsing_canonical", lambda text: text.rlike(_key_pattern(labels))), F.lit(0)).alias("_parsing_object"),
        F.when(F.exists("_parsing_canonical", lambda text: text.isNull()), F.col("_parsing_reply")).alias("_parsing_refused_reply"),
    ).withColumn("_parsing_from_python", _python_reader(labels)("_parsing_refused_reply"))
    value_bits = [
        F.when(
            F.col("_parsing_object").rlike(_key_pattern([label])) & ~F.col("_parsing_object").rlike(_key_pattern([label]) + FALSY_JSON), "1"
        ).otherwise("0")
        for label in labels
    ]
    json_bits = F.when(F.col("_parsing_refused_reply").isNotNull(), F.col("_parsing_from_python")).when(F.col("_parsing_object").isNotNull(), F.concat(*value_bits))
    digits = F.array(*[F.regexp_extract("_parsing_reply", V.LABEL_DIGIT % label, 1) for label in labels])
    staged = chosen.withColumn("_parsing_json_bits", json_bits).withColumn(
        "_parsing_digits", F.when(F.col("_parsing_json_bits").isNull(), digits)
    )
    stage = (
        F.when(F.col("_parsing_json_bits") == UNREADABLE, "none")
        .when(F.col("_parsing_json_bits").isNotNull(), "json")
        .when(F.array_contains("_parsing_digits", "1") | F.array_contains("_parsing_digits", "0"), "pattern")
        .otherwise("none")
    )
    out = [
        F.when(F.coalesce(F.substring("_parsing_json_bits", i + 1, 1), F.get("_parsing_digits", F.lit(i))) == "1", 1)
        .otherwise(0)
        .alias(f"{prefix}{label}")
        for i, label in enumerate(labels)
    ]
    return staged.select(*kept, *out, stage.alias("parse_stage")).withColumn(
        "parse_failure", F.col("parse_stage") != "json"
    )


def parse_stage_counts(parsed: DataFrame, by: Sequence[str]) -> DataFrame:
    return parsed.groupBy(*by, "parse_stage").agg(F.count(F.lit(1)).alias("n_replies"))


def parse_failure_stats(parsed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Failures and their share of all replies."""
    failures = F.sum(F.col("parse_failure").cast("long"))
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_test"),
        failures.alias("parse_failures"),
        (failures / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("parse_failure_rate"),
    )


def exact_seconds(seconds: Column | str) -> Column:
    """Seconds as a decimal, so sums do not depend on the order rows arrive in."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return seconds.cast("decimal(18,6)")


def latency_stats(parsed: DataFrame, by: Sequence[str], latency: str = "latency_seconds") -> DataFrame:
    """Mean over all calls, failed ones counting with their 0 seconds, and the total."""
    total = F.coalesce(F.sum(exact_seconds(latency)).cast("double"), F.lit(0.0))
    calls = F.count(latency)
    return parsed.groupBy(*by).agg(
        calls.alias("n_calls"),
        (total / F.greatest(calls, F.lit(1))).alias("mean_latency_seconds"),
        total.alias("total_inference_seconds"),
    )
