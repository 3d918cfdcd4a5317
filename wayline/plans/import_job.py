"""Import of delimited lines: parse, cast, enrich, tag, identify."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.config import ImportConfig, ImportOptions
from wayline.functions.ids import document_id
from wayline.functions.ip import ip_to_int
from wayline.operators.documents import to_documents
from wayline.operators.lookup import COUNTRY, lookup
from wayline.operators.parse import (
    BAD_FIELDS,
    LINE,
    REASON,
    apply_reject_policy,
    dates_to_ms,
    parse_typed,
    parse_untyped,
    with_constants,
)
from wayline.operators.places import PlaceIndex, check_place_keys, lookup_place
from wayline.operators.ranges import RangeTable, lookup_ip
from wayline.operators.sizing import is_small
from wayline.operators.tor import tag_relays
from wayline.plans.report import observed


@dataclass(frozen=True)
class LookupTables:
    """Lookup tables an import may use; see :mod:`wayline.plans.tables`.

    The ``small`` flags say whether a table was measured to fit a broadcast.
    """

    countries: DataFrame | None = None
    places: PlaceIndex | None = None
    ranges: RangeTable | None = None
    relays: DataFrame | None = None
    countries_small: bool | None = None
    relays_small: bool | None = None

    def measured(self) -> "LookupTables":
        """Measure once what every batch of a stream would measure again."""
        def small(table: DataFrame | None, known: bool | None) -> bool | None:
            return is_small(table) if table is not None and known is None else known

        return replace(
            self,
            countries_small=small(self.countries, self.countries_small),
            relays_small=small(self.relays, self.relays_small),
        )


@dataclass(frozen=True)
class Imported:
    """Rows of an import and its rejected lines (None unless collected)."""

    rows: DataFrame
    rejects: DataFrame | None


def parse(lines: DataFrame, cfg: ImportConfig, options: ImportOptions) -> DataFrame:
    """Parsed lines with reject reasons, typed or as text."""
    required = [c for c in cfg.order_in_file if c not in options.md5_exclude] if options.md5_id else []
    if options.typed:
        return parse_typed(lines, cfg, options.separator, options.dates_in_seconds, options.exact_long, required)
    return parse_untyped(lines, cfg, options.separator, required)


def enrich_geo(rows: DataFrame, options: ImportOptions, tables: LookupTables, address: str | None = None) -> DataFrame:
    """Add the ``geo_`` columns of the chosen precision."""
    precision = (options.geo_precision or "").lower()
    if precision == "ip":
        ranges = _given(tables.ranges, "ranges")
        return lookup_ip(rows, options.geo_columns["ip"], ranges, int_ip=options.geo_int_ip, address=address)
    if precision == "country_level":
        # Stored answers cover every subset of the table's keys, in the table's order.
        on = {k: F.lit(None).cast("string") for k in COUNTRY.keys}
        on.update({k: F.col(f"`{c}`") for k, c in options.geo_columns.items()})
        answers = _given(tables.countries, "countries")
        return lookup(rows, answers, COUNTRY, on, optional_keys=True, answers=answers, small=tables.countries_small)
    if precision == "multilevel":
        check_place_keys(options.geo_columns)
        return lookup_place(rows, _given(tables.places, "places"), options.geo_columns)
    return rows


def _given(table, name: str):
    if table is None:
        raise ValueError(f"the import needs the lookup table {name!r}")
    return table


def enrich(rows: DataFrame, cfg: ImportConfig, options: ImportOptions, tables: LookupTables) -> DataFrame:
    """Everything after parsing: lookups, relay flags, constants, dates, id."""
    # One address column for both lookups is parsed once.
    shared = options.geo_columns.get("ip") if options.geo_columns.get("ip") == options.tor_column else None
    address = "_address" if shared and not options.geo_int_ip and not options.tor_int_ip else None
    if address:
        rows = rows.withColumn(address, ip_to_int(F.col(f"`{shared}`")))
    rows = enrich_geo(rows, options, tables, address)
    if options.tor_column:
        relays = _given(tables.relays, "relays")
        rows = tag_relays(rows, options.tor_column, relays, options.tor_int_ip, tables.relays_small, address)
    if address:
        rows = rows.drop(address)
    rows = with_constants(rows, options.constants)
    if options.dates_in_seconds and not options.typed:
        rows = dates_to_ms(rows, cfg.date_columns())
    if options.md5_id:
        rows = rows.withColumn("_id", document_id(cfg.order_in_file, options.md5_exclude))
    return rows


def import_lines(
    lines: DataFrame, cfg: ImportConfig, options: ImportOptions, tables: LookupTables | None = None,
    counts: Observation | None = None,
) -> Imported:
    """Rows of an import as one lazy plan. Other columns of ``lines`` are carried along.

    ``counts`` observes the load counts (see :mod:`wayline.plans.report`) when the rows are consumed.
    """
    options.check(cfg)
    parsed = parse(lines, cfg, options)
    if counts is not None:
        parsed = observed(parsed, counts)
    good, rejects = apply_reject_policy(parsed, options.rejects)
    if rejects is not None:
        extra = [c for c in parsed.columns if c not in (*cfg.order_in_file, LINE, REASON, BAD_FIELDS)]
        rejects = parsed.where(F.col(REASON).isNotNull()).select(
            *extra, F.col(LINE).alias("line"), F.col(REASON).alias("reason")
        )
    return Imported(enrich(good, cfg, options, tables or LookupTables()), rejects)


def import_documents(
    lines: DataFrame, cfg: ImportConfig, options: ImportOptions, tables: LookupTables | None = None,
    keep: tuple[str, ...] = (), counts: Observation | None = None,
) -> Imported:
    """Like :func:`import_lines`, wrapped as documents. The ``keep`` columns stay outside."""
    result = import_lines(lines, cfg, options, tables, counts)
    return Imported(_wrapped(result.rows, cfg, options, keep), result.rejects)


def _wrapped(rows: DataFrame, cfg: ImportConfig, options: ImportOptions, keep: tuple[str, ...]) -> DataFrame:
    return to_documents(
        rows, options.index or cfg.index, options.doc_type or cfg.doc_type, "_id" if options.md5_id else None, keep
    )


# Column and folders of a one-pass import: what became of a line.
OUTCOME = "_outcome"
ROWS, REJECTS = "rows", "rejects"


@dataclass(frozen=True)
class WrittenImport:
    """A one-pass import on disk, and its load counts."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    carried: tuple[str, ...]
    schema: T.StructType
    counts: dict[str, int]

    def _outcome(self, outcome: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col(OUTCOME) == outcome)

    def rows(self) -> DataFrame:
        """The imported rows or documents."""
        return self._outcome(ROWS).select(*self.columns)

    def rejects(self) -> DataFrame:
        """Lines that did not parse, with their reason and the columns the lines carried."""
        return self._outcome(REJECTS).select(*self.carried, F.col(LINE).alias("line"), F.col(REASON).alias("reason"))

    def bad_fields(self) -> DataFrame:
        """One row per value that did not parse and became null: the carried columns, its field and the line."""
        found = self._outcome(ROWS).where(F.size(BAD_FIELDS) > 0)
        return found.select(*self.carried, F.explode(BAD_FIELDS).alias("field"), F.col(LINE).alias("line"))


def tagged_import(
    lines: DataFrame, cfg: ImportConfig, options: ImportOptions, tables: LookupTables | None = None,
    documents: bool = False, counts: Observation | None = None,
) -> tuple[DataFrame, tuple[str, ...], tuple[str, ...]]:
    """All lines in one plan, each marked with what became of it.

    Returns the frame, the columns of its rows, and those of them that the lines carried. A rejected line
    is looked up by no key, since its fields are null; a row keeps its line only where a value did not parse.
    """
    options.check(cfg)
    parsed = parse(lines, cfg, options)
    if counts is not None:
        parsed = observed(parsed, counts)
    good = F.col(REASON).isNull()
    carried = tuple(c for c in parsed.columns if c not in (*cfg.order_in_file, LINE, REASON, BAD_FIELDS))
    if options.rejects == "fail":
        message = F.concat(F.lit("line rejected: "), F.col(REASON), F.lit(": "), F.col(LINE))
        parsed = parsed.withColumn(REASON, F.when(~good, F.raise_error(message).cast("string")))
    elif options.rejects == "drop":
        parsed = parsed.where(good)
    bad = F.col(BAD_FIELDS) if BAD_FIELDS in parsed.columns else F.array().cast("array<string>")
    # The bookkeeping goes in one column of its own, which no step of the import names.
    book = F.struct(F.col(REASON).alias("reason"), bad.alias("bad"), F.when(~good | (F.size(bad) > 0), F.col(LINE)).alias("line"))
    named = parsed.select(
        *carried, *[F.when(good, F.col(f"`{c}`")).alias(c) for c in cfg.order_in_file], book.alias("_book")
    )
    rows = enrich(named, cfg, options, tables or LookupTables())
    if documents:
        rows = _wrapped(rows, cfg, options, (*carried, "_book"))
    columns = tuple(c for c in rows.columns if c != "_book")
    marked = rows.select(
        *columns, F.col("_book.line").alias(LINE), F.col("_book.reason").alias(REASON), F.col("_book.bad").alias(BAD_FIELDS),
        F.when(F.col("_book.reason").isNull(), ROWS).otherwise(REJECTS).alias(OUTCOME),
    )
    return marked, columns, carried


def write_import(
    lines: DataFrame, cfg: ImportConfig, options: ImportOptions, path: str, tables: LookupTables | None = None,
    documents: bool = False, replace: bool = False,
) -> WrittenImport:
    """Import in one pass: rows, rejects and values that became null go out in a single write.

    Every line goes to the folder of its outcome; the load counts are observed by the same job.
    Rejects are written if the options collect them, and end the job if they say ``fail``.
    Place words and large range tables read the lines once more beforehand, for their distinct keys.
    """
    counts = Observation()
    marked, columns, carried = tagged_import(lines, cfg, options, tables, documents, counts)
    marked.write.partitionBy(OUTCOME).mode("overwrite" if replace else "append").parquet(path)
    return WrittenImport(lines.sparkSession, path, columns, carried, marked.schema, counts.get)
