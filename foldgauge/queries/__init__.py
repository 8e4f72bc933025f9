"""Registered queries: each runs operators over the given tables, with its SQL counterpart beside it."""

from foldgauge.queries import cleaning, corpus, flows, metrics, models, prompts, replies, results, splits  # noqa: F401
from foldgauge.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
