"""Mix sources to target weights: hash order within each source, prefix sums, exact cuts.

Every document gets a hash key. Within its source the documents stand in key order; the
key space is cut into equal ranges (keys are uniform, so a source of any size spreads over
its ranges), and the words before a document are the words of earlier ranges plus those
before it in its own range. A source takes whole epochs while its target lasts and then
the first documents of the order, the last one cut to the word.

Defined cases: null text has no words; a null source is a source of its own, after all
others; documents without words are taken zero times; rows repeated in id and text stand
side by side; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.text import WORD, narrow, word_count
from wayline.scratch import stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20
ROWS_PER_RANGE = 65_536


def _key():
    return F.xxhash64(F.lit(SEED), "doc_id", "text")


def document_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key`` of every document, written once to the shared folder."""
    rows = narrow(docs, "doc_id", "text", "source")
    return stored(rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key().alias("key")), "mix_sizes")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target``: shares of all words by weight, none above ``most`` times its source.

    Resharing the excess by weight until no target is above its limit ends at
    ``least(limit, level * weight)`` with one level for all, found here by prefix sums
    over the sources in order of ``limit / weight``. One row per source is handled in
    one task; documents are not.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("total", F.sum("source_size").over(everything)).withColumn(
        "level", (F.col("total") - filled) / open_weight
    )
    free = F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "level"))
    found = levels.withColumn("level", F.min(free).over(everything)["level"])
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return found.select("source", "source_size", target.alias("target"))


def taken_words(sizes: DataFrame, targets: DataFrame, rows: int | None = None) -> DataFrame:
    """Add to each document its source's target and the words the mix takes of it.

    ``sizes`` is read more than once. ``rows`` is its row count, if known.
    """
    rows = sizes.count() if rows is None else rows
    bits = max(5, min(20, math.ceil(math.log2(max(1, rows / ROWS_PER_RANGE)))))
    ranged = sizes.withColumn("range", F.shiftrightunsigned("key", 64 - bits))
    before_range = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size")).withColumn(
        "before_range", F.coalesce(F.sum("range_size").over(before_range), F.lit(0))
    )
    goal = targets.withColumn("budget", F.floor(F.col("target") + 0.5).cast("bigint"))
    ranges = ranges.alias("r").join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).select(
        "r.source", "range", "before_range", "source_size", "target", "budget"
    )
    order = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    within = ranged.withColumn(
        "within", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    same = F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.range") == F.col("r.range"))
    joined = within.alias("d").join(ranges.hint("merge").alias("r"), same)
    before = F.col("before_range") + F.col("within")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return joined.select(
        "doc_id", "d.source", "key", "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken."""
    sizes = document_sizes(docs)
    return taken_words(sizes, source_targets(sizes)).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: as many copies as epochs take, the last one cut at the budget.

    Columns stay those of ``docs``; ``n_chars``, if there, follows a cut text. Rows
    repeated in id and text count as one document that holds the words of all.
    """
    columns = docs.columns
    sizes = document_sizes(docs)
    plan = taken_words(sizes, source_targets(sizes)).groupBy("doc_id", "key").agg(
        F.max("size").alias("_size"), F.sum("taken").alias("_taken")
    ).where("_taken > 0").withColumnRenamed("doc_id", "_doc")
    rows = docs.withColumn("_key", _key())
    one = Window.partitionBy("_key", "doc_id").orderBy(*[c for c in ("source", "lang") if c in columns])
    rows = rows.withColumn("_one", F.row_number().over(one)).where("_one = 1")
    same = (F.col("_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    found = rows.join(plan.hint("merge"), same)
    full = F.floor(F.col("_taken") / F.col("_size"))
    rest = F.col("_taken") - full * F.col("_size")
    copies = F.concat(
        F.array_repeat(F.col("_size"), full.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>"))
    )
    found = found.withColumn("_words", F.explode(copies))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col("_words").cast("int")), "")
    found = found.withColumn("text", F.when(F.col("_words") < F.col("_size"), head).otherwise(F.col("text")))
    if "n_chars" in columns:
        cut = F.col("_words") < F.col("_size")
        found = found.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`") for c in columns])
