"""Expressions over model scores and call settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldgauge import fixed_values as V


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def over_threshold(prob: Column, threshold: float = V.DECISION_THRESHOLD) -> Column:
    """Inclusive: a score equal to the threshold is a positive."""
    return (prob >= F.lit(threshold)).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """A quotient that is 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def is_reasoning_model(model: Column) -> Column:
    name = F.lower(model)
    found = F.lit(False)
    for tag in V.REASONING_TAGS:
        found = found | name.contains(tag)
    return found


def token_budget(model: Column, think: Column, requested: Column) -> Column:
    """Reasoning models get at least a floor that depends on thinking; other models get what was asked."""
    floor = F.when(think, F.lit(V.NUM_PREDICT_THINK)).otherwise(F.lit(V.NUM_PREDICT_REASONING))
    return F.when(is_reasoning_model(model), F.greatest(requested, floor)).otherwise(requested)


def mean_pm_std(mean: Column, std: Column) -> Column:
    return F.format_string("%.4f ± %.4f", mean, std)
