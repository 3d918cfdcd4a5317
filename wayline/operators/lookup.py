"""Lookups by equal keys: country table, or any table described by a spec."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.operators.first_match import attach, first_match
from wayline.operators.sizing import is_small
from wayline.operators.union_match import first_match_of_union, subsets
from wayline.scratch import stored

# Up to so many optional keys there is an answer for every subset of them; of more keys
# only for the subsets that occur in a probe that can be read ahead.
FEW_KEYS = 4


@dataclass(frozen=True)
class LookupSpec:
    """Shape of a lookup table: its key columns, output attributes, point and row id."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    lat: str = "latitude"
    lon: str = "longitude"
    row_id: str = "row_id"

    def output(self) -> list[str]:
        return [*self.attributes, "location", "representative_point"]


COUNTRY = LookupSpec(("country_code", "country_name"), ("country_code", "country_name"))
IP_RANGE_PLACES = LookupSpec(
    ("country_code", "country_name", "region_name", "place_name", "zip_code"),
    ("country_code", "country_name", "place_name", "region_name", "zip_code"),
)


def _checked(spec: LookupSpec, on: Mapping[str, object]) -> list[str]:
    unknown = [k for k in on if k not in spec.keys]
    if unknown or not on:
        raise ValueError(f"unknown lookup keys {unknown}" if unknown else "no lookup key given")
    return list(on)


def _probe_key(column: str | Column) -> Column:
    return F.upper((F.col(f"`{column}`") if isinstance(column, str) else column).cast("string"))


def key_answers(
    table: DataFrame, spec: LookupSpec, keys: Sequence[str], every_subset: bool = False, masks: Sequence[int] | None = None
) -> DataFrame:
    """Answer per key combination: attributes, location and representative point.

    With ``every_subset`` there is an answer for each non-empty subset of the keys, or
    for those in ``masks``. ``_mask`` tells which keys take part (bit i for key i); the
    others are ''. Build it once and store it when a table serves many runs.
    """
    if masks is not None:
        subsets = [{k for i, k in enumerate(keys) if mask >> i & 1} for mask in masks]
    else:
        sizes = range(1, len(keys) + 1) if every_subset else [len(keys)]
        subsets = [set(s) for n in sizes for s in combinations(keys, n)]
    choices = F.array(
        *[
            F.struct(
                F.lit(sum(1 << i for i, k in enumerate(keys) if k in s)).alias("_mask"),
                *[(F.col(k).cast("string") if k in s else F.lit("")).alias(f"_key_{k}") for k in keys],
            )
            for s in subsets
        ]
    )
    group = ["_mask", *[f"_key_{k}" for k in keys]]
    needed = list(dict.fromkeys([*spec.attributes, spec.lat, spec.lon, spec.row_id]))
    rows = table.select(*needed, F.explode(choices).alias("_choice")).select(*needed, "_choice.*")
    rows = rows.dropna(subset=group)
    return first_match(rows, group, spec.attributes, spec.lat, spec.lon, spec.row_id)


def lookup(
    probe: DataFrame,
    table: DataFrame,
    spec: LookupSpec,
    on: Mapping[str, str | Column],
    prefix: str = "geo_",
    optional_keys: bool = False,
    answers: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Left lookup; all keys given in ``on`` (table key to probe column) must match.

    Probe keys are upper-cased, as table text is. With ``optional_keys`` only the keys
    that are non-null in a row take part, and a row without any key gets nulls; with more
    than :data:`FEW_KEYS` of them the probe is read once more for the key sets in use.
    ``answers`` takes a stored :func:`key_answers` result. ``small`` skips measuring.
    """
    keys = _checked(spec, on)
    values = {k: _probe_key(on[k]) for k in keys}
    mask = reduce(
        lambda a, b: a + b,
        [F.when(values[k].isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(keys)],
    )
    if answers is None:
        masks = None
        if optional_keys and len(keys) > FEW_KEYS and not probe.isStreaming:
            # At most 2 ** len(keys) numbers; without any key in the probe one subset stands for none.
            masks = [m for (m,) in probe.select(mask).distinct().collect() if m] or [1]
        answers = key_answers(table, spec, keys, every_subset=optional_keys, masks=masks)
        if small is None:
            small = is_small(table, rows_per_row=(len(masks) if masks else 2 ** len(keys)) if optional_keys else 1)
    elif small is None:
        small = is_small(answers)
    if optional_keys:
        pairs = [(mask, "_mask")] + [(F.coalesce(values[k], F.lit("")), f"_key_{k}") for k in keys]
    else:
        pairs = [(values[k], f"_key_{k}") for k in keys]
    return attach(probe, answers, pairs, spec.output(), prefix, small)


def lookup_any(
    probe: DataFrame,
    table: DataFrame,
    spec: LookupSpec,
    on: Mapping[str, str | Column],
    prefix: str = "geo_",
) -> DataFrame:
    """Left lookup where one matching key is enough.

    Works on the distinct key tuples, which are stored. Their answers follow from one aggregate per key
    value and one per combination of key values that a tuple asks for (see :mod:`union_match`),
    so no table row is listed per tuple. Rows, overlaps and answers are stored; the
    answers come back by broadcast if they measure small.
    """
    keys = _checked(spec, on)
    # A name holds its key's number and its value's length, so joined names stay distinct.
    asked_names = [_key_name(i, _probe_key(on[k])) for i, k in enumerate(keys)]
    own_names = [_key_name(i, F.col(k).cast("string")) for i, k in enumerate(keys)]
    given = F.array_compact(F.array(*asked_names))
    query = F.when(F.size(given) > 0, F.array_join(given, ""))
    asked = stored(probe.select(query.alias("_query"), given.alias("_names")).dropna().distinct(), "asked_keys")
    combined = asked.select("_query", F.explode(subsets(F.col("_names"))).alias("_subset"))
    overlaps = stored(
        combined.select("_query", F.size("_subset").alias("_size"), F.array_join("_subset", "").alias("_name")),
        "asked_overlaps",
    )
    own = table.select(
        F.col(spec.row_id).alias("_row"), spec.lat, spec.lon, F.explode(subsets(F.array_compact(F.array(*own_names)))).alias("_subset")
    )
    rows = own.withColumn("_name", F.array_join("_subset", "")).drop("_subset")
    rows = stored(rows.join(overlaps.select("_name").distinct(), "_name", "left_semi"), "key_matches")
    answers = first_match_of_union(asked, overlaps, rows, spec.attributes, table, spec.lat, spec.lon, spec.row_id)
    answers = stored(answers, "key_answers")
    return attach(probe, answers, [(query, "_query")], spec.output(), prefix, is_small(answers))


def _key_name(number: int, value: Column) -> Column:
    return F.concat(F.lit(f"{number}:"), F.length(value).cast("string"), F.lit(":"), value)
