"""Line dedup within one word edit, by the deletion neighbourhood; DataFrame functions only.

A line is the words between two newlines, lower-cased. Lines equal after that, or within
one inserted, deleted or replaced word of an earlier line, are repeats; the earliest line
(by document id, then line number) stays. Lines of fewer than ``SHORT`` words, of which
one word is too large a part, repeat only if equal.

Two lines within one word edit have equal variants once one word is deleted from either.
Each distinct line that can have a neighbour emits the hashes of its variants, one per
deleted word, and of itself. Lines of one variant that deleted the same position differ in
that word alone, so a bucket needs one candidate per position, its earliest line, and not
its pairs; the bucket is aggregated, never listed. What a line meets there is then
verified on the words themselves.

A line can have a neighbour only if another line shares its first or its last half,
counted from the same end: one edit leaves one of the halves as it was. That drops most
lines before variants are made, and none that has a neighbour.

Defined cases: null and empty texts have one empty line and keep it; empty lines and lines
without words are never repeats; a null id comes last; rows repeated in id and text are
one document; an empty table gives an empty result; other columns are passed through by
:func:`dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.text import WORD, narrow
from wayline.operators.sizing import hinted, is_small
from wayline.scratch import stored

SHORT = 5


def _place() -> Column:
    """Order of lines in the corpus, as one struct."""
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc"), F.col("row"), F.col("line_no"))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[\x20\x09-\x0D]+"), "")


def _hash(words: Column) -> Column:
    return F.xxhash64(words)


def _hash2(words: Column) -> Column:
    return F.xxhash64(F.lit(31), words)


def _split_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, words`` of every line that has words; ``row`` hashes the whole text.

    A filter on the words themselves would be planned below them, and split each line once more.
    """
    lines = narrow(docs, "doc_id", "text").select("doc_id", _row().alias("row"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    lines = lines.where(F.col("line").rlike(WORD))
    return lines.select("doc_id", "row", "line_no", _words(F.col("line")).alias("words"))


def _half_keys(words: Column) -> Column:
    """Hashes of the first and last words, for the two counts a neighbour may also use.

    A line of n words and one of n or n + 1 share a count, floor(n / 2) of the shorter,
    and one edit leaves that many words as they were at the front or at the back.
    """
    n = F.size(words)
    keys = []
    for size in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys.append(F.xxhash64(F.lit("first"), size, F.slice(words, F.lit(1), size)))
        keys.append(F.xxhash64(F.lit("last"), size, F.slice(words, n - size + 1, size)))
    return F.array_distinct(F.array(*keys))


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, h, h2, ends``: the lines that have words, by hashes only.

    ``ends`` holds the half keys of lines long enough for neighbours.
    """
    lines = _split_lines(docs)
    ends = F.when(F.size("words") >= SHORT, _half_keys(F.col("words"))).otherwise(F.array().cast("array<bigint>"))
    return lines.select("doc_id", "row", "line_no", _hash(F.col("words")).alias("h"), _hash2(F.col("words")).alias("h2"), ends.alias("ends"))


def _able_lines(docs: DataFrame, first: DataFrame) -> DataFrame:
    """``h, h2, place, words`` of the distinct lines that share a half with another one.

    Half keys move with no more than a hash of their line. Words are read again from the
    documents that the lines first stand in.
    """
    keys = first.select("h", F.explode("ends").alias("key"))
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key")
    able = stored(keys.join(often, "key", "left_semi").select("h").distinct(), "able_hashes")
    able = first.select("h", "h2", "place").join(hinted(able, is_small(able)), "h", "left_semi")
    places = able.select("h", "h2", "place", F.col("place.doc").alias("_doc"), F.col("place.row").alias("_r"), F.col("place.line_no").alias("_no"))
    places = stored(places, "able_places")
    wanted = stored(places.groupBy("_doc", "_r").agg(F.collect_set("_no").alias("_nos")), "able_documents")
    wanted = hinted(wanted, is_small(wanted))
    rows = narrow(docs, "doc_id", "text").withColumn("row", _row())
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_r"))).select("doc_id", "row", "text", "_nos")
    lines = rows.select("doc_id", "row", "_nos", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.where(F.array_contains("_nos", F.col("line_no"))).select("doc_id", "row", "line_no", _words(F.col("line")).alias("words"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_r")) & (F.col("line_no") == F.col("_no"))
    return lines.join(places, same).select("h", "h2", "place", "words").dropDuplicates(["h", "h2"])


def _names(words: Column) -> list[Column]:
    """Hashes of each word with its place, and with the place before, where it moves if an earlier word goes."""
    return [
        F.transform(words, lambda w, i: F.xxhash64(w, i)).alias("stays"),
        F.transform(words, lambda w, i: F.xxhash64(w, i - 1)).alias("moves"),
    ]


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))


def _deleted() -> Column:
    """Names of a line's variants, by the place of the word that goes.

    A name is the exclusive or of the hashes of words with places, so each follows from the one
    before it, in which the word at one place moves and the next one goes.
    """
    n = F.size("stays")
    rest = F.slice("moves", F.lit(2), n)
    steps = F.zip_with(F.slice("stays", F.lit(1), n - 1), rest, lambda x, y: x.bitwiseXOR(y))
    return F.aggregate(steps, F.array(_xor(rest)), lambda names, step: F.concat(names, F.array(F.element_at(names, -1).bitwiseXOR(step))))


def _shared_variants(able: DataFrame) -> DataFrame:
    """``h, at, v``: the variants of lines that another variant equals.

    Most equal no other, so all move with no more than a hash of their line, and only these meet its place.
    """
    named = able.select("h", *_names(F.col("words")))
    deleted = F.transform(_deleted(), lambda v, i: F.struct(i.alias("at"), v.alias("v")))
    # A variant without position is the line itself.
    itself = F.array(F.struct(F.lit(-1).alias("at"), _xor(F.col("stays")).alias("v")))
    variants = stored(named.select("h", F.explode(F.concat(deleted, itself)).alias("d")).select("h", "d.at", "d.v"), "line_variants")
    often = variants.groupBy("v").agg(F.count(F.lit(1)).alias("equal")).where("equal > 1").select("v")
    often = stored(often, "shared_variant_names")
    return variants.join(hinted(often, is_small(often)), "v", "left_semi").select("h", "at", "v")


def _near_pairs(able: DataFrame) -> DataFrame:
    """``h, h2, w, w2``: a line and an earlier one that shares a variant with it."""
    variants = _shared_variants(able).join(able.select("h", "h2", "place"), "h").select("h", "h2", "place", "at", "v")
    variants = stored(variants, "shared_variants")
    line = F.struct("place", "h", "h2")
    # Earliest line per variant and position; per variant the line itself, and the earliest other.
    by_place = stored(variants.groupBy("v", "at").agg(F.min(line).alias("first"), F.count(F.lit(1)).alias("lines")), "variant_firsts")
    own = by_place.where("at = -1").select("v", "first")
    other = by_place.where("at >= 0").groupBy("v").agg(F.min("first").alias("first"))
    crowded = by_place.where("at >= 0 and lines > 1").select("v", "at", "first")
    # A line meets an earlier one that deleted the same position,
    met = variants.where("at >= 0").join(crowded, ["v", "at"]).select("h", "h2", "place", "first")
    # one that is its variant, or one of which it is the variant.
    met = met.unionByName(variants.where("at >= 0").join(own, "v").select("h", "h2", "place", "first"))
    met = met.unionByName(variants.where("at = -1").join(other, "v").select("h", "h2", "place", "first"))
    return met.where("first.place < place").select("h", "h2", F.col("first.h").alias("w"), F.col("first.h2").alias("w2")).distinct()


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one inserted, deleted or replaced word apart."""
    replaced = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x)) <= 1
    long, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    gone = F.exists(
        F.sequence(F.lit(0), F.size(short)),
        lambda i: F.concat(F.slice(long, F.lit(1), i), F.slice(long, i + 2, F.size(long))) == short,
    )
    return F.when(F.size(a) == F.size(b), replaced).when(F.abs(F.size(a) - F.size(b)) == 1, gone).otherwise(False)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no`` of every line that repeats an earlier one."""
    lines = stored(document_lines(docs), "lines")
    first = stored(
        lines.groupBy("h", "h2").agg(F.min(_place()).alias("place"), F.first("ends").alias("ends"), F.count(F.lit(1)).alias("copies")), "first_lines"
    )
    able = stored(_able_lines(docs, first), "able_lines")
    pairs = stored(_near_pairs(able), "near_pairs")
    words = able.select("h", "h2", "words")
    met = pairs.join(words, ["h", "h2"]).join(words.select(F.col("h").alias("w"), F.col("h2").alias("w2"), F.col("words").alias("witness")), ["w", "w2"])
    near = stored(met.where(within_one_edit(F.col("words"), F.col("witness"))).select("h", "h2", F.lit(True).alias("near")).distinct(), "near_lines")
    judged = first.select("h", "h2", "place", "copies").join(hinted(near, is_small(near)), ["h", "h2"], "left")
    # A line that stands once and is near no other is no repeat.
    judged = stored(judged.where("near or copies > 1").select("h", "h2", "place", F.coalesce("near", F.lit(False)).alias("near")), "judged_lines")
    found = lines.select("doc_id", "row", "line_no", "h", "h2").join(hinted(judged, is_small(judged)), ["h", "h2"])
    return found.where(F.col("near") | (F.col("place") < _place())).select("doc_id", "row", "line_no").distinct()


def _row() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _dropped(docs: DataFrame) -> DataFrame:
    """Per document the numbers of its repeated lines, ascending."""
    gone = repeated_lines(docs).groupBy("doc_id", "row").agg(F.array_sort(F.collect_list("line_no")).alias("gone"))
    return gone.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_gone_row"), F.col("gone").alias("_gone"))


def line_report(docs: DataFrame) -> DataFrame:
    """Per document how many lines it has, how many repeat, and their numbers from 0."""
    text = F.coalesce("text", F.lit(""))
    rows = narrow(docs, "doc_id", "text").select("doc_id", _row().alias("row"), F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_gone_row"))
    joined = rows.join(_dropped(docs), same, "left")
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", "n_lines", F.size(gone).cast("bigint").alias("n_dropped"), F.array_join(gone.cast("array<string>"), ",").alias("dropped_lines")
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines, with the columns of ``docs``."""
    rows = docs.withColumn("_row", _row())
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_row") == F.col("_gone_row"))
    joined = rows.join(_dropped(docs), same, "left")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("_gone").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
