"""Exemplar choice and prompt construction as table operators; all folds in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldgauge import fixed_values as V
from foldgauge.functions.labels import HASH_BITS, cardinality, labels_json, seeded_hash
from foldgauge.functions.text import message, render_messages, truncate_clean
from foldgauge.operators.cleaning import clean_corpus
from foldgauge.operators.ranking import BROADCAST_ROWS, first_rows, refined_cells, totals_before
from foldgauge.schema import CorpusSchema


_COMMENT = "_prompt_comment"
PART_CHARS = 1 << 20


def truncated_comments(df: DataFrame, schema: CorpusSchema, out: str = "comment", clean: bool = True) -> DataFrame:
    """Adds the one-line, cleaned and shortened comment used inside prompts."""
    kept = [F.col(f"`{name}`") for name in df.columns if name != out]
    return clean_corpus(df, schema.text, "_prompt_cleaned", enabled=clean).select(
        *kept, truncate_clean(F.col("_prompt_cleaned")).alias(out)
    )


def few_shot_exemplars(
    corpus: DataFrame,
    roles: DataFrame,
    schema: CorpusSchema,
    n_folds: int | None = None,
    seed: int = V.EXEMPLAR_SEED,
    clean_negatives: int = V.CLEAN_NEGATIVES,
    k: int | None = None,
    clean: bool = True,
    texts: DataFrame | None = None,
) -> DataFrame:
    """``(fold, slot, id, text, labels)``: exemplars from each fold's train part, in prompt order.

    Slot i shows label i: a row with only that label if there is one, else any row with it, else the slot
    stays empty. The last slots show rows without labels. Among candidates the seeded hash decides.
    A row is a candidate for each label it holds; winners are found from cell counts, so no fold or label
    is sorted or collected as a whole, and texts are fetched for the winners only (from ``texts``, a table with
    id and text, where the corpus itself is a join that would carry texts along). Rows of the last slots
    hold no label, so with unique ids (see ``corpus_checks``) they never repeat an earlier exemplar. Every fold of
    ``roles`` gets exemplars; ``n_folds`` only spares counting them, and decides nothing but the kind of join.
    """
    n_folds = roles.select("fold").distinct().count() if n_folds is None else n_folds
    n_labels = len(schema.labels)
    k = n_labels + clean_negatives if k is None else k
    keys = corpus.select(schema.id, *schema.labels)
    train = roles.where(F.col("role") == "train").select("fold", schema.id)
    card = cardinality(schema.labels)
    slots = F.array_compact(
        F.array(
            *[F.when(F.col(label) == 1, F.lit(i)) for i, label in enumerate(schema.labels)],
            F.when(card == 0, F.lit(n_labels)),
        )
    )
    # A row with several labels ranks behind every single-label row: one bit above the hash.
    order_key = seeded_hash(seed, schema.id) + F.when(card > 1, F.lit(1 << HASH_BITS)).otherwise(F.lit(0))
    candidates = train.join(
        keys.select(schema.id, *schema.labels, order_key.alias("order_key"), slots.alias("slots")), schema.id
    ).select("fold", schema.id, *schema.labels, "order_key", F.explode("slots").alias("slot"))
    candidates, cells = refined_cells(candidates, ["fold", "slot"], "order_key", hash_bits=HASH_BITS + 1)
    chosen = first_rows(
        candidates,
        by=["fold", "slot"],
        cell="cell",
        order=["order_key", schema.id],
        quota=F.when(F.col("slot") < n_labels, 1).otherwise(clean_negatives),
        most=n_folds * (n_labels + clean_negatives),
        cells=cells,
    ).withColumn("slot", F.col("slot") + F.col("position").cast("int") - 1)
    in_prompt = Window.partitionBy("fold").orderBy("slot")
    chosen = chosen.withColumn("place", F.row_number().over(in_prompt)).where(F.col("place") <= k)
    texts = corpus if texts is None else texts
    winners = chosen.select("fold", "slot", schema.id, *schema.labels)
    if n_folds * (n_labels + clean_negatives) <= BROADCAST_ROWS:
        winners = F.broadcast(winners)
    shown = texts.select(schema.id, schema.text).join(winners, schema.id)
    return truncated_comments(shown, schema, out="text", clean=clean).select(
        "fold", "slot", schema.id, "text", *schema.labels
    )


def clean_negatives(df: DataFrame, schema: CorpusSchema, used: DataFrame | None = None) -> DataFrame:
    """Rows without any label, minus ids already used."""
    rows = df.where(cardinality(schema.labels) == 0)
    return rows if used is None else rows.join(used.select(schema.id), schema.id, "left_anti")


def few_shot_prefixes(exemplars: DataFrame, schema: CorpusSchema) -> DataFrame:
    """``(fold, prefix)``: header plus exemplar blocks; one row per fold of a few thousand characters."""
    block = F.concat(
        F.lit(V.FEW_SHOT_TEXT_PREFIX),
        F.col("text"),
        F.lit(V.FEW_SHOT_JSON_PREFIX),
        labels_json(schema.labels),
        F.lit(V.FEW_SHOT_EXEMPLAR_END),
    )
    blocks = F.array_sort(F.collect_list(F.struct("slot", block.alias("block"))))
    return exemplars.groupBy("fold").agg(
        F.concat(F.lit(V.FEW_SHOT_HEADER), F.array_join(F.transform(blocks, lambda b: b["block"]), "")).alias("prefix")
    )


def _chat(user: Column, system_prompt: str) -> Column:
    return F.array(message("system", F.lit(system_prompt)), message("user", user))


def zero_shot_messages(
    df: DataFrame, schema: CorpusSchema, system_prompt: str = V.SYSTEM_PROMPT, clean: bool = True
) -> DataFrame:
    """Adds ``messages`` asking for one comment's labels; all other columns stay as they are."""
    user = F.concat(F.lit(V.ZERO_SHOT_PREFIX), F.col(_COMMENT), F.lit(V.PROMPT_SUFFIX))
    return truncated_comments(df, schema, _COMMENT, clean).withColumn("messages", _chat(user, system_prompt)).drop(_COMMENT)


def few_shot_messages(
    rows: DataFrame,
    exemplars: DataFrame,
    schema: CorpusSchema,
    system_prompt: str = V.SYSTEM_PROMPT,
    clean: bool = True,
) -> DataFrame:
    """Adds ``messages`` with the exemplars of the row's fold in front of its comment.

    The exemplar text is rendered once per fold; Spark measures that table and broadcasts it if it is small. The left
    join keeps rows of folds without exemplars; ``folds_without_exemplars`` names them. All columns of ``rows`` stay.
    """
    prefixes = few_shot_prefixes(exemplars, schema).withColumnRenamed("prefix", "_prompt_prefix")
    user = F.concat(
        F.coalesce("_prompt_prefix", F.lit(V.FEW_SHOT_HEADER)),
        F.lit(V.FEW_SHOT_QUERY_PREFIX),
        F.col(_COMMENT),
        F.lit(V.PROMPT_SUFFIX),
    )
    return (
        truncated_comments(rows, schema, _COMMENT, clean)
        .join(prefixes, "fold", "left")
        .withColumn("messages", _chat(user, system_prompt))
        .drop(_COMMENT, "_prompt_prefix")
    )


def folds_without_exemplars(roles: DataFrame, exemplars: DataFrame) -> DataFrame:
    """``(fold)``: folds whose few-shot prompts would show no exemplar."""
    return roles.select("fold").distinct().join(exemplars.select("fold").distinct(), "fold", "left_anti")


def prompt_templates(exemplars: DataFrame, roles: DataFrame, schema: CorpusSchema, system_prompt: str = V.SYSTEM_PROMPT) -> DataFrame:
    """``(mode, fold, template)``: the rendered prompts with a placeholder comment, which is not cleaned.

    Every fold of ``roles`` has both templates, exemplars or not; the few-shot one of a fold without exemplars
    shows the header only.
    """
    folds = roles.select("fold").distinct()
    prefixes = folds.join(few_shot_prefixes(exemplars, schema), "fold", "left").fillna({"prefix": V.FEW_SHOT_HEADER})
    hole = F.lit(V.TEMPLATE_PLACEHOLDER)
    zero = F.concat(F.lit(V.ZERO_SHOT_PREFIX), hole, F.lit(V.PROMPT_SUFFIX))
    few = F.concat(F.col("prefix"), F.lit(V.FEW_SHOT_QUERY_PREFIX), hole, F.lit(V.PROMPT_SUFFIX))
    templates = F.array(
        F.struct(F.lit("zero_shot").alias("mode"), render_messages(_chat(zero, system_prompt)).alias("template")),
        F.struct(F.lit("few_shot").alias("mode"), render_messages(_chat(few, system_prompt)).alias("template")),
    )
    return prefixes.select("fold", F.inline(templates)).select("mode", "fold", "template")


def render_turns(turns: DataFrame, role: str, content: str, out: str = "block") -> DataFrame:
    """Adds the rendered block of each turn, row by row; ``render_conversations`` puts them together."""
    turn = F.array(F.struct(F.col(role).alias("role"), F.col(content).alias("content")))
    return turns.withColumn(out, render_messages(turn))


def render_conversations(
    turns: DataFrame, conversation: str, turn: str, role: str, content: str, part_chars: int = PART_CHARS
) -> DataFrame:
    """``(conversation, part, n_turns, text)``: transcripts in turn order, blank lines between blocks, cut into parts.

    The characters ahead of each turn are a running sum over ranges of (conversation, turn), so a conversation of any length is
    spread over tasks; a part, a group of its own, holds the turns that begin inside one stretch of ``part_chars`` characters. The parts
    of a conversation, in order and with a blank line between them, are its transcript. Null roles and texts are empty, null
    turns come first; turns of the same number are ordered by a hash of their block.
    """
    filled = turns.withColumns({name: F.coalesce(name, F.lit("")) for name in (role, content)})
    blocks = render_turns(filled, role, content, "_block").select(conversation, turn, "_block", F.xxhash64("_block").alias("_mark"))
    order = [F.asc_nulls_first(turn), F.asc("_mark")]
    placed = totals_before(blocks, [conversation], order, (F.char_length("_block") + 2).cast("long"), "_ahead")
    part = F.floor(F.col("_ahead") / part_chars)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("_ahead", "_block"))), lambda b: b["_block"])
    return placed.groupBy(conversation, part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_turns"), F.array_join(in_order, "\n\n").alias("text")
    )
