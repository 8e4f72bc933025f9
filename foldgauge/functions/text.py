"""Expressions over text: blanks, prompt truncation, token windows, message rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldgauge import fixed_values as V


def strip_blanks(text: Column) -> Column:
    """Trim any Unicode blank; Spark's ``trim`` only knows the space."""
    return F.regexp_replace(text, V.BLANK_ENDS, "")


def truncate_clean(cleaned: Column, max_chars: int = V.MAX_PROMPT_CHARS) -> Column:
    """One-line comment of at most ``max_chars`` code points plus a mark, from an already cleaned column."""
    line = F.replace(strip_blanks(cleaned), F.lit("\n"), F.lit(" "))
    # Matches longer lines only; a dot is one code point. One reference to the text, whatever comes around it.
    return F.regexp_replace(line, F.lit(rf"(?s)\A(.{{{max_chars}}}).+\z"), F.lit(f"$1{V.TRUNCATION_MARK}"))


def tokens(cleaned: Column) -> Column:
    """Blank-separated tokens; no token for an empty text."""
    return F.filter(F.split(strip_blanks(cleaned), V.BLANKS), lambda word: word != "")


def token_window(cleaned: Column, max_tokens: int = V.MAX_TOKENS) -> Column:
    return F.slice(tokens(cleaned), 1, max_tokens)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def render_messages(messages: Column) -> Column:
    """``[ROLE]`` blocks separated by a blank line."""
    return F.array_join(
        F.transform(messages, lambda m: F.concat(F.lit("["), F.upper(m["role"]), F.lit("]\n"), m["content"])),
        "\n\n",
    )
