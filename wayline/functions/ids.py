"""Document ids and JSON bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def document_id(fields: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """MD5 hex of the canonical JSON of the given fields, in the given order.

    Nulls are written out, so a missing value and a missing field differ.
    """
    kept = [F.col(f"`{f}`") for f in fields if f not in set(exclude)]
    if not kept:
        raise ValueError("every id field is excluded")
    return F.md5(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}))


def json_body(fields: Sequence[str]) -> Column:
    """JSON object of the given fields; null fields are left out."""
    return F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields]))
