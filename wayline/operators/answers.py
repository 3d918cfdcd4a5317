"""Answers of lookup queries, kept across batches and runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.scratch import stored

_FOUND = "_found"


class AnswerStore:
    """A table of answers by query text, under a folder that belongs to one build of a lookup table.

    A batch's queries are compared with the stored ones; only new ones are answered, and
    their answers, misses included, are appended. A retried batch finds its queries there. Two
    jobs that append the same query at once store equal answers, of which one is read.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _stored(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException:
            return None

    def answered(self, asked: DataFrame, compute: Callable[[DataFrame], DataFrame], part: str) -> DataFrame:
        """Answers of the distinct ``_query`` texts in ``asked`` (stored). ``compute`` answers new
        ones; ``part`` tells apart what is asked in different ways."""
        known = self._stored(part)
        new = asked if known is None else stored(asked.join(known.select("_query"), "_query", "left_anti"), "new_queries")
        if known is None or not new.isEmpty():
            answers = new.join(compute(new).withColumn(_FOUND, F.lit(True)), "_query", "left")
            answers.withColumn(_FOUND, F.coalesce(_FOUND, F.lit(False))).write.mode("append").parquet(f"{self.path}/{part}")
        found = self._stored(part)
        return found.where(_FOUND).drop(_FOUND).join(asked, "_query", "left_semi").dropDuplicates(["_query"])
