"""Result tables as Markdown lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(name: str) -> Column:
    return F.coalesce(F.replace(F.col(name).cast("string"), F.lit("|"), F.lit("\\|")), F.lit(""))


def markdown_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds ``line``: the row between bars. Bars inside a value are escaped, null is an empty cell."""
    columns = list(columns or df.columns)
    cells = F.concat_ws(" | ", *[_cell(name) for name in columns])
    return df.withColumn("line", F.concat(F.lit("| "), cells, F.lit(" |")))


def markdown_table(df: DataFrame, title: str, order: Sequence[str]) -> DataFrame:
    """``(section, place, line)`` rows of a titled table: heading, header and rule, then the rows.

    Sorted by section and place the lines are the document; see ``sources.write_markdown``.
    """
    bars = "| " + " | ".join(df.columns) + " |"
    rule = "|" + "|".join(":---" for _ in df.columns) + "|"
    header = F.array(*[F.lit(text) for text in (f"# {title}", "", bars, rule)])
    place = F.struct(*[F.col(name) for name in order])
    body = markdown_rows(df).select(F.lit(4).alias("section"), place.alias("place"), "line")
    head = df.sparkSession.range(1).select(F.posexplode(header).alias("section", "line"))
    empty_place = F.lit(None).cast(body.schema["place"].dataType)
    return head.select("section", empty_place.alias("place"), "line").unionByName(body)
