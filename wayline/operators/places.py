"""Place lookup by words: an inverted index of folded words, joined by term.

A term is ``column:word`` or, for a word in any column, ``*:word``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.text import words
from wayline.operators.answers import AnswerStore
from wayline.operators.first_match import SALTS, attach, first_match
from wayline.operators.sizing import is_small, spread
from wayline.operators.union_match import first_match_of_union, subsets
from wayline.scratch import stored
from wayline.sources.tables import PLACE_COLUMNS

# Output attributes of the place table.
ATTRIBUTES = (
    "accuracy", "admin_code1", "admin_code2", "admin_code3", "admin_name1", "admin_name2",
    "admin_name3", "country_code", "place_name", "zip_code",
)
# Lookup keys that name another column of the table.
KEY_COLUMNS = {"region_name": "admin_name1"}
# Lookup keys the table has no column for.
ABSENT_KEYS = ("country_name",)

OUTPUT = (*ATTRIBUTES, "location", "representative_point")


@dataclass(frozen=True)
class PlaceIndex:
    """Place rows with their terms, postings per term, and how many rows hold a term.

    ``answers`` optionally holds the stored answer of every single term, ``known`` those of
    earlier batches' queries.
    """

    rows: DataFrame
    postings: DataFrame
    frequency: DataFrame
    answers: DataFrame | None = None
    known: AnswerStore | None = None


def _column_terms(column: str) -> Column:
    def both(word: Column) -> Column:
        return F.array(F.concat(F.lit(f"{column}:"), word), F.concat(F.lit("*:"), word))

    return F.flatten(F.transform(words(F.col(column)), both))


def place_rows(places: DataFrame, columns: tuple[str, ...] = PLACE_COLUMNS) -> DataFrame:
    """Add the distinct ``terms`` of each row; numbers are indexed as text.

    A row grows into dozens of postings, so the rows of a large table are spread first.
    """
    return spread(places, *places.columns).withColumn("terms", F.array_distinct(F.concat(*[_column_terms(c) for c in columns])))


def place_postings(rows: DataFrame) -> DataFrame:
    """One row per term and place.

    An inner explode is planned with a filter on the terms, which would compute them once more, and
    before the rows are spread.
    """
    return rows.select(F.explode_outer("terms").alias("term"), "row_id").where(F.col("term").isNotNull())


def term_frequency(postings: DataFrame) -> DataFrame:
    """How many places hold each term."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def term_answers(rows: DataFrame, postings: DataFrame) -> DataFrame:
    """Answer of each single-term query: first place and representative point."""
    points = rows.select("row_id", "latitude", "longitude")
    return first_match(postings.join(points, "row_id"), ["term"], ATTRIBUTES, source=rows)


def place_index(places: DataFrame, columns: tuple[str, ...] = PLACE_COLUMNS) -> PlaceIndex:
    """Index over a place table with a unique, ordered ``row_id`` column."""
    rows = place_rows(places, columns)
    postings = place_postings(rows)
    return PlaceIndex(rows, postings, term_frequency(postings))


def condition_terms(column: str, value: Column, scope: str, columns: tuple[str, ...] = PLACE_COLUMNS) -> Column:
    """Terms of one ``column:value`` condition.

    With scope ``first_token`` only the first word is bound to the column and later
    words match anywhere; with ``column`` all words are bound. An unknown or empty
    column name matches anywhere.
    """
    if scope not in ("first_token", "column"):
        raise ValueError(f"unknown scope {scope!r}")
    bound = f"{column}:" if column in columns else "*:"

    def term(word: Column, position: Column) -> Column:
        first = F.concat(F.lit(bound), word)
        return first if scope == "column" else F.when(position == 0, first).otherwise(F.concat(F.lit("*:"), word))

    return F.array_sort(F.array_distinct(F.transform(words(value), term)))


def query_text(on: Mapping[str, str | Column], op: str, scope: str) -> Column:
    """Canonical text of a row's query, so that equal queries are looked up once.

    Conditions are separated by ``|`` and terms by blanks. Null keys take no part. The
    text is null when nothing can match: no key, or a condition without words.
    """
    values = {k: F.col(f"`{c}`") if isinstance(c, str) else c for k, c in on.items()}
    terms = [
        F.when(v.isNotNull(), condition_terms(KEY_COLUMNS.get(k, k), v, scope)) for k, v in values.items()
    ]
    given = F.array_compact(F.array(*terms))
    filled = F.filter(given, lambda c: F.size(c) > 0)
    if op == "AND":
        text = F.concat_ws(" ", F.array_sort(F.array_distinct(F.flatten(given))))
        return F.when((F.size(given) > 0) & (F.size(filled) == F.size(given)), text)
    joined = F.concat_ws("|", F.transform(filled, lambda c: F.concat_ws(" ", c)))
    if op == "OR":
        return F.when(F.size(filled) > 0, joined)
    return F.when(F.size(F.get(given, F.lit(0))) > 0, joined)


def _holds(terms: Column, condition: Column) -> Column:
    return F.forall(condition, lambda term: F.array_contains(terms, term))


def _matches(queries: DataFrame, index: PlaceIndex, op: str) -> DataFrame:
    """Places matching each AND or NOT query of several terms: candidates come from the
    rarest term of the first condition, the other terms are checked on the place row.

    AND queries have one condition; NOT leaves out the places another condition matches.
    """
    conditions = F.transform(F.split("_query", r"\|"), lambda c: F.split(c, " "))
    parsed = queries.withColumn("_conditions", conditions)
    first = parsed.select("_query", F.get("_conditions", F.lit(0)).alias("_terms"))
    counted = first.select("_query", F.size("_terms").alias("_size"), F.explode("_terms").alias("term")).join(
        index.frequency, "term"
    )
    rarest = (
        counted.groupBy("_query", "_size")
        .agg(F.min(F.struct("n", "term")).alias("_rarest"), F.count(F.lit(1)).alias("_known"))
        .where("_known = _size").select("_query", "_rarest.term")
    )
    wanted = F.array_remove(F.get("_conditions", F.lit(0)), F.col("term"))
    unwanted = F.slice("_conditions", F.lit(2), F.size("_conditions"))
    checks = rarest.withColumn("_conditions", conditions).select(
        "_query", "term", wanted.alias("_wanted"), unwanted.alias("_unwanted"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    # A few small rows grow into many candidates here. The salt splits the places of a
    # frequent term, and a fixed partition count keeps the small rows from being merged.
    partitions = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = checks.repartition(partitions, "term", "_salt")
    salted = index.postings.withColumn("_salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
    candidates = spread.join(salted, ["term", "_salt"]).select("_query", "_wanted", "_unwanted", "row_id")
    rows = candidates.join(index.rows, "row_id")
    matching = _holds(F.col("terms"), F.col("_wanted"))
    if op != "AND":
        matching = matching & ~F.exists("_unwanted", lambda c: _holds(F.col("terms"), c))
    return rows.where(matching).select("_query", "row_id", "latitude", "longitude")


def _union_sets(queries: DataFrame, index: PlaceIndex) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conditions of OR queries, their overlaps, and the places of each (stored), for
    :func:`first_match_of_union`.

    The overlap of conditions is the AND of all their terms. Each term and each AND that
    occurs is matched once; a place belongs to as many of them as its words combine to,
    so matches grow with the places and not with the pairs of queries and places.
    """
    conditions = F.array_distinct(F.split("_query", r"\|"))
    asked = queries.select("_query", conditions.alias("_names"))
    terms = F.array_sort(F.array_distinct(F.flatten(F.transform("_subset", lambda c: F.split(c, " ")))))
    overlaps = stored(
        asked.select("_query", F.explode(subsets(F.col("_names"))).alias("_subset"))
        .select("_query", F.size("_subset").alias("_size"), F.array_join(terms, " ").alias("_name")),
        "asked_overlaps",
    )
    names = overlaps.select("_name").distinct()
    is_single = ~F.contains("_name", F.lit(" "))
    points = index.rows.select("row_id", "latitude", "longitude")
    held = index.postings.join(names.where(is_single).withColumnRenamed("_name", "term"), "term", "left_semi")
    one = held.join(points, "row_id").select(F.col("term").alias("_name"), "row_id", "latitude", "longitude")
    several = _matches(names.where(~is_single).withColumnRenamed("_name", "_query"), index, "AND")
    rows = one.unionByName(several.withColumnRenamed("_query", "_name")).withColumnRenamed("row_id", "_row")
    return asked, overlaps, stored(rows, "place_matches")


def place_answers(queries: DataFrame, index: PlaceIndex, op: str) -> DataFrame:
    """Answer of each distinct query text in ``_query``.

    A single-term query reads the term's pre-aggregated answer, so a term that most
    places hold is aggregated once however many queries ask for it. A union of
    conditions is answered from theirs, without listing its places.
    """
    is_single = ~F.col("_query").rlike(r"[ |]")
    single = queries.where(is_single)
    answers = index.answers
    if answers is None:
        asked = single.select(F.col("_query").alias("term"))
        answers = term_answers(index.rows, index.postings.join(asked, "term", "left_semi"))
    found = single.join(answers, F.col("_query") == F.col("term")).select("_query", *OUTPUT)
    many = queries.where(~is_single)
    if op == "OR":
        unions = F.contains("_query", F.lit("|"))
        sets = _union_sets(many.where(unions), index)
        found = found.unionByName(first_match_of_union(*sets, ATTRIBUTES, index.rows))
        many = many.where(~unions)
    matches = stored(_matches(many, index, "AND" if op == "OR" else op), "place_matches")
    return found.unionByName(first_match(matches, ["_query"], ATTRIBUTES, source=index.rows))


def lookup_place(
    probe: DataFrame,
    index: PlaceIndex,
    on: Mapping[str, str | Column],
    op: str = "AND",
    scope: str = "first_token",
    prefix: str = "geo_",
) -> DataFrame:
    """Left lookup by words. ``on`` maps place columns to probe columns; an unknown
    column, or '', searches every column. ``op`` joins the conditions: AND, OR or NOT
    (the first without the others).

    The probe is read twice: once for its distinct queries, which are stored, and once
    to attach their answers, by broadcast if these measure small. With ``index.known`` only
    queries that no earlier batch asked are matched.
    """
    if op not in ("AND", "OR", "NOT"):
        raise ValueError(f"unknown operator {op!r}")
    if not on:
        raise ValueError("no lookup key given")
    query = query_text(on, op, scope)
    asked = stored(probe.select(query.alias("_query")).dropna().distinct(), "asked_places")
    if index.known is not None:
        answers = index.known.answered(asked, lambda new: place_answers(new, index, op), op)
    else:
        answers = place_answers(asked, index, op)
    answers = stored(answers, "place_answers")
    answered = answers.withColumn("country_name", F.lit(None).cast("string"))
    return attach(probe, answered, [(query, "_query")], [*OUTPUT, "country_name"], prefix, is_small(answers))


def check_place_keys(on: Mapping[str, object]) -> None:
    """Raise for lookup keys the place table has no column for."""
    absent = [k for k in on if k in ABSENT_KEYS]
    if absent:
        raise ValueError(f"the place table has no column for {', '.join(absent)}")
