"""Load reports: counts of accepted, rejected and partly unparsable lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wayline.operators.parse import BAD_FIELDS, REASON


def load_metrics(parsed: DataFrame) -> list[Column]:
    """Aggregates of a parsed frame: lines, success, failed, bad_fields."""
    bad = F.sum(F.size(BAD_FIELDS)) if BAD_FIELDS in parsed.columns else F.sum(F.lit(0))
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(REASON).isNull()).alias("success"),
        F.count_if(F.col(REASON).isNotNull()).alias("failed"),
        F.coalesce(bad, F.lit(0)).alias("bad_fields"),
    ]


def load_report(parsed: DataFrame) -> DataFrame:
    """The counts as a one-row frame."""
    return parsed.agg(*load_metrics(parsed))


def observed(parsed: DataFrame, observation: Observation | str = "load") -> DataFrame:
    """Count while the frame is consumed: no extra pass, also on streams."""
    return parsed.observe(observation, *load_metrics(parsed))
