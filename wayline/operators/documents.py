"""Document envelope, content ids and last-write-wins by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.functions.ids import document_id, json_body

ENVELOPE = ("_id", "_index", "_type", "_source")


def with_document_id(df: DataFrame, fields: Sequence[str], exclude: Sequence[str] = (), name: str = "_id") -> DataFrame:
    """Add the content id of the given fields."""
    return df.withColumn(name, document_id(fields, exclude))


def to_documents(
    df: DataFrame, index: str, doc_type: str, id_column: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Wrap rows as ``_index``, ``_type``, ``_source`` (JSON) and, if given, ``_id``."""
    fields = [c for c in df.columns if c not in (id_column, *keep)]
    columns = [F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), json_body(fields).alias("_source")]
    ids = [F.col(id_column).alias("_id")] if id_column else []
    return df.select(*keep, *ids, *columns)


def latest_by_id(df: DataFrame, order: Sequence[str | Column], id_column: str = "_id") -> DataFrame:
    """Keep the last document of each id.

    Spark trims each map task's groups to their last row before the shuffle, so an id
    that holds most of the rows costs one row per task.
    """
    newest = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(id_column).orderBy(*newest)))
    return ranked.where("_rank = 1").drop("_rank")


def merge_documents(current: DataFrame, updates: DataFrame, order: str = "seq", id_column: str = "_id") -> DataFrame:
    """Next snapshot: updates replace current documents of the same id."""
    both = current.withColumn("_round", F.lit(0)).unionByName(
        updates.withColumn("_round", F.lit(1)), allowMissingColumns=False
    )
    return latest_by_id(both, ["_round", order], id_column).drop("_round")
