"""Import configuration: declared columns and the options of one import."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared type names and the Spark type of their parsed value.
SPARK_TYPES = {
    "date": T.LongType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "text": T.StringType(),
    "keyword": T.StringType(),
    "ip": T.StringType(),
    "geopoint": T.StringType(),
    "boolean": T.StringType(),
}

# Which lookup keys each precision accepts.
GEO_KEYS = {
    "country_level": ("country_code", "country_name"),
    "multilevel": ("country_code", "region_name", "place_name", "zip_code"),
    "ip": ("ip",),
}

# Generated columns.
GEO_COLUMNS = {
    "country_level": ("country_code", "country_name", "location", "representative_point"),
    "multilevel": (
        "accuracy", "admin_code1", "admin_code2", "admin_code3", "admin_name1", "admin_name2",
        "admin_name3", "country_code", "country_name", "location", "place_name",
        "representative_point", "zip_code",
    ),
    "ip": (
        "country_code", "country_name", "location", "place_name", "region_name",
        "representative_point", "zip_code",
    ),
}
TOR_COLUMNS = {
    "tor_info": T.StringType(),
    "tor_is_exit_node": T.BooleanType(),
    "tor_is_tor_server": T.BooleanType(),
}


@dataclass(frozen=True)
class ImportConfig:
    """Declared columns of the input: their order in the line and their types."""

    index: str
    doc_type: str
    properties: Mapping[str, str]
    order_in_file: tuple[str, ...]

    def __post_init__(self) -> None:
        unknown = [c for c in self.order_in_file if c not in self.properties]
        if unknown:
            raise ValueError(f"columns without a declared type: {', '.join(unknown)}")
        if len(set(self.order_in_file)) != len(self.order_in_file):
            raise ValueError("order_in_file names a column twice")

    @classmethod
    def from_json(cls, text: str) -> "ImportConfig":
        """Read the JSON form with ``meta``, ``properties`` and ``order_in_file``."""
        try:
            raw = json.loads(text)
            meta = raw["meta"]
            return cls(meta["index"], str(meta["type"]), dict(raw["properties"]), tuple(raw["order_in_file"]))
        except json.JSONDecodeError as err:
            raise ValueError(f"invalid JSON in the import config: {err}") from err
        except KeyError as err:
            raise ValueError(f"the import config lacks {err}") from err

    def date_columns(self) -> list[str]:
        return [c for c in self.order_in_file if self.properties[c] == "date"]

    def schema(self, typed: bool) -> T.StructType:
        """Schema of the declared columns, typed or all text."""
        text = T.StringType()
        return T.StructType(
            [
                T.StructField(c, SPARK_TYPES.get(self.properties[c], text) if typed else text)
                for c in self.order_in_file
            ]
        )


def parse_constants(pairs: str | None) -> dict[str, str]:
    """Read ``name:value;;;name:value``; a value may not hold a colon."""
    constants: dict[str, str] = {}
    for pair in pairs.split(";;;") if pairs else []:
        parts = pair.split(":")
        if len(parts) != 2:
            raise ValueError(f"not a name:value pair: {pair!r}")
        constants[parts[0]] = parts[1]
    return constants


@dataclass(frozen=True)
class ImportOptions:
    """Options of one import run.

    ``geo_columns`` maps lookup keys to input columns, ``rejects`` is one of
    ``collect``, ``drop`` and ``fail``.
    """

    separator: str = ";"
    typed: bool = False
    exact_long: bool = False
    dates_in_seconds: bool = False
    geo_precision: str | None = None
    geo_columns: Mapping[str, str] = field(default_factory=dict)
    geo_int_ip: bool = False
    tor_column: str | None = None
    tor_int_ip: bool = False
    constants: Mapping[str, str] = field(default_factory=dict)
    md5_id: bool = False
    md5_exclude: Sequence[str] = ()
    rejects: str = "collect"
    index: str | None = None
    doc_type: str | None = None

    def check(self, cfg: ImportConfig) -> None:
        """Raise ``ValueError`` listing every option that does not fit the config."""
        problems = []
        if self.rejects not in ("collect", "drop", "fail"):
            problems.append(f"unknown reject policy {self.rejects!r}")
        if self.geo_precision is not None:
            precision = self.geo_precision.lower()
            allowed = GEO_KEYS.get(precision)
            if allowed is None:
                problems.append(f"unknown geo precision {self.geo_precision!r}")
            elif not self.geo_columns:
                problems.append("geo precision given without geo columns")
            else:
                problems += [f"{k} is not a key of {precision}" for k in self.geo_columns if k not in allowed]
        named = list(self.geo_columns.values()) + ([self.tor_column] if self.tor_column else [])
        problems += [f"column {c} is not in the config" for c in named if c not in cfg.order_in_file]
        problems += [f"excluded column {c} is not in the config" for c in self.md5_exclude if c not in cfg.order_in_file]
        if problems:
            raise ValueError("; ".join(problems))


def output_schema(cfg: ImportConfig, options: ImportOptions) -> T.StructType:
    """Schema of the documents an import with these options yields."""
    schema = {f.name: f.dataType for f in cfg.schema(options.typed)}
    if options.geo_precision is not None:
        for name in GEO_COLUMNS[options.geo_precision.lower()]:
            schema["geo_" + name] = T.DoubleType() if name == "accuracy" else T.StringType()
    if options.tor_column:
        schema.update(TOR_COLUMNS)
    schema.update({name: T.StringType() for name in options.constants})
    return T.StructType([T.StructField(n, t) for n, t in schema.items()])
