"""URL filter: rules first, gradient-boosted trees on lexical features for the rest (operator 3).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end. A rule
(``host/path``) fits its host and all subdomains if the url's path starts with its path; the longest rule wins. URLs that a rule
decides are the labelled ones: a hash-drawn sample of at most ``train_rows`` of them (the parameter bounds the fit, not the
result) trains the trees, which judge all others by length, depth, digit ratio, entropy, parameter count and suffix
statistics (how common the host's last label is, and how its labelled urls were judged), counted over all rows. Of a labelled url's own part,
a fifth of all urls by a hash of their text, no judgement enters its statistic, so the trees cannot read its label there.

Null urls and urls without ``://`` have an empty host and path and go to the trees like any other. If the labelled urls all
agree, their verdict is the method's; without any it is allow. Repeated rows each give a row; null ids stay null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.common import small_enough
from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

#: The rules, in the order given.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
TRAIN_ROWS = 100_000
TREES = 10
DEPTH = 4
SEED = 5
PARTS = 5
FEATURES = ("url_length", "depth", "digit_ratio", "entropy", "parameters", "suffix_log_rows", "suffix_block_rate")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url without nulls."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, shape, 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(url, shape, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule, or null. Rules are few and given, so they stand in the plan."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    share = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    )
    return F.when(size > 0, F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with its own features and the suffix its statistics go by."""
    url, size = F.col("url"), F.length("url")
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    asked = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return urls.select(
        "*",
        size.cast("double").alias("url_length"),
        F.size(F.filter(F.split("path", "/"), lambda part: part != "")).cast("double").alias("depth"),
        F.when(size > 0, digits / size).otherwise(0.0).alias("digit_ratio"),
        _entropy(url).alias("entropy"),
        F.when(asked == "", 0.0).otherwise(F.size(F.split(asked, "&")).cast("double")).alias("parameters"),
        F.element_at(F.split("host", r"\."), -1).alias("suffix"),
    )


def judge_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    train_rows: int = TRAIN_ROWS,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> DataFrame:
    """(id, host, path, rule, verdict, p_block) of every url; p_block is the trees' probability."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    raw = pages.select(F.col(id_column).alias("id"), F.coalesce(F.col(url_column), F.lit("")).alias("url"))
    host, path = parsed(F.col("url"))
    raw = raw.select("id", "url", host.alias("host"), path.alias("path"))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    raw = raw.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked).cast("double"))
    part = F.pmod(F.xxhash64("host", "path", "url_length"), F.lit(PARTS)).cast("int").alias("part")
    urls = lexical_features(raw).withColumn("label", label).select("*", part, F.monotonically_increasing_id().alias("number"))
    urls = materialize(urls.drop("url"))

    by_part = materialize(
        urls.groupBy("suffix", "part").agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"))
    )
    labelled, n_blocked = by_part.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    prior = n_blocked / labelled if labelled else 0.0
    totals = by_part.groupBy("suffix").agg(F.sum("n").alias("rows"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))

    def rate(blocked: Column, of: Column) -> Column:
        return (blocked + 10 * F.lit(prior)) / (of + 10)

    statistics = by_part.join(totals, "suffix").select(
        "suffix",
        "part",
        F.log1p(F.col("rows").cast("double")).alias("suffix_log_rows"),
        rate(F.col("all_blocked"), F.col("all_labelled")).alias("whole_rate"),
        rate(F.col("all_blocked") - F.col("blocked"), F.col("all_labelled") - F.col("labelled")).alias("other_rate"),
    )
    statistics = materialize(statistics)
    seen = F.when(F.col("label").isNull(), F.col("whole_rate")).otherwise(F.col("other_rate")).alias("suffix_block_rate")
    known = urls.join(small_enough(statistics, 100_000), ["suffix", "part"]).select("*", seen)
    if 0 < n_blocked < labelled:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known)
        share = int(min(1.0, train_rows / labelled) * 1_000_000)
        drawn = ready.where(F.col("label").isNotNull() & (F.pmod(F.xxhash64("number"), F.lit(1_000_000)) < share))
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, checkpointInterval=-1).fit(
            materialize(drawn.select("features", "label"))
        )
        scored = model.transform(ready).withColumn("p_block", vector_to_array("probability")[1])
    else:
        scored = known.withColumn("p_block", F.lit(float(prior)))
    own = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    by_rule = F.when(F.col("label") == 1, "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.when(F.col("rule").isNotNull(), by_rule).otherwise(own).alias("verdict"), "p_block"
    )


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
