"""Registered queries of the ten operators, with their SQL where SQL can state them."""

from __future__ import annotations

from foldgauge.llm import chat_format, clusters, credentials, decontaminate, lm_scores, near_dups, neighbours, packing, pii, quality, structure, token_counts, url_filter  # noqa: F401
from foldgauge.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
