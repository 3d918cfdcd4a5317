"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct five-word shingles (64-bit hashes). Documents with
one set are one class. All shingles stand in one global order, frequent ones last; two
sets of similarity 0.75 or more must share one of the first ``n/4 + 1`` of each, their
prefixes. Classes of one prefix and size form a group, groups that share a prefix
shingle are filtered by size, position and number of shared prefix shingles, and the
members of the pairs that remain are verified on their whole sets.

Which shingles are frequent is counted over all documents; the list is the most frequent
:data:`FREQUENT` of those, so its size is bounded. It decides the order only: any order
gives the same result, a good one fewer candidates. A shingle still shared by more than
:data:`LARGE` groups becomes a block (see :mod:`wayline.llm.linking`).

Defined cases: A-Z are lower-cased; a text of fewer than five words is one shingle; null
and empty texts have none and stand alone; rows repeated in text share a class; rows
without an id, and rows that share one, are compared like all others (a component of rows without an id
alone has none); an empty table gives an empty result; other columns are ignored. Identity
of texts and sets rests on 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.linking import degrees, linked_sets, needed, similar_sizes, sketch
from wayline.llm.text import as_longs, list_array, narrow, pieces, shingle_sets, utf8
from wayline.operators.sizing import hinted, is_small
from wayline.scratch import stored

# Documents of a task are counted together until they hold so many shingles; a shingle met
# at least OFTEN times among them is reported.
COUNTED = 2_000_000
OFTEN = 4
FREQUENT = 131_072
LARGE = 32
# A shingle counted so often makes a block without being counted again.
CROWDED = 4096


def _often(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that stand :data:`OFTEN` times or more, ascending, and how often; sorts ``held`` in place.

    Beside ``held`` only these are held.
    """
    held.sort()
    last = held[OFTEN - 1 :]
    values = last[last == held[: len(last)]]
    values = values[np.diff(values, prepend=values[:1] ^ np.uint64(1)) != 0]
    return values, np.searchsorted(held, values, side="right") - np.searchsorted(held, values)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = np.empty(COUNTED, dtype=np.uint64), 0

    def report() -> pa.RecordBatch:
        values, n = _often(held[:count])
        return pa.record_batch({"shingle": pa.array(as_longs(values)), "n": pa.array(n, pa.int64())})

    for batch in pieces(batches):
        found = shingle_sets(utf8(batch, "text"))
        more = sum(map(len, found))
        if count + more > len(held):
            held.resize(count + more, refcheck=False)
        for items in found:
            held[count : count + len(items)] = items
            count += len(items)
        if count >= COUNTED:
            yield report()
            count = 0
    if count:
        yield report()


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The most frequent shingles of the corpus, rarest first, at most :data:`FREQUENT`.

    From the second value on they were counted :data:`CROWDED` times or more.
    """
    counted = narrow(docs, "text").mapInArrow(_frequent, "shingle bigint, n bigint")
    top = counted.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT)
    rows = top.toPandas()[::-1]
    return rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64).copy(), int((rows["n"] < CROWDED).sum())


PREFIXES = "doc_id bigint, t bigint, n bigint, node bigint, g bigint, prefix array<bigint>, crowded int"


def prefix_length(n):
    """Shingles of a set of ``n`` of which a similar set must hold one: ``n - ceil(0.75 n) + 1``."""
    return n - -(-3 * n // 4) + 1


def _node(items: np.ndarray) -> int:
    """Name of a class of equal sets, as a signed 64-bit integer."""
    name = xxhash.xxh3_64_intdigest(items.tobytes(), seed=len(items))
    return name - (1 << 64) if name >= 1 << 63 else name


def _prefixes(frequent: np.ndarray, uncrowded: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Prefix of each text, given once per task and group; ``crowded`` is where crowded shingles begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = set()
        by_value = np.argsort(frequent)
        values = frequent[by_value]
        for batch in pieces(batches):
            sizes, nodes, groups, prefixes, crowded = [], [], [], [], []
            for items in shingle_sets(utf8(batch, "text")):
                rank = np.zeros(len(items), dtype=np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, items), len(values) - 1)
                    rank = np.where(values[at] == items, by_value[at] + 1, 0)
                order = np.argsort(rank, kind="stable")[: prefix_length(len(items)) if len(items) else 0]
                prefix = items[order]
                sizes.append(len(items))
                nodes.append(_node(items))
                groups.append(_node(prefix) ^ len(items))
                crowded.append(int((rank[order] <= uncrowded).sum()))
                prefixes.append(as_longs(prefix if groups[-1] not in given else prefix[:0]))
                given.add(groups[-1])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "t": batch.column("t"), "n": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.int64()),
                "g": pa.array(groups, pa.int64()), "prefix": list_array(prefixes, pa.int64()), "crowded": pa.array(crowded, pa.int32()),
            })

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        items = shingle_sets(utf8(batch, "text"))
        # A text of the same hash may have another node.
        own = [node == _node(i) for node, i in zip(batch.column("node").to_pylist(), items)]
        yield pa.record_batch({
            "node": batch.column("node").filter(pa.array(own)),
            "items": list_array([as_longs(i) for i, mine in zip(items, own) if mine], pa.int64()),
            "sketch": list_array([sketch(i) for i, mine in zip(items, own) if mine], pa.int8()),
        })


def _candidates(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Group pairs that pass the filters, and blocks of groups under frequent shingles.

    Postings meet once by shingle; those of crowded shingles go to blocks as they are.
    """
    postings = prefixes.select("g", "n", "crowded", F.posexplode("prefix").alias("pos", "shingle"))
    few = postings.where("pos < crowded").select("shingle", "g", F.col("n").cast("int").alias("n"), "pos")
    met = few.repartition("shingle").dropDuplicates(["shingle", "g"])
    groups = F.count(F.lit(1)).over(Window.partitionBy("shingle"))
    shared = stored(met.withColumn("groups", groups).where("groups > 1"), "shared_postings")
    crowded = postings.where("pos >= crowded").select("shingle", "g", "n", "pos").dropDuplicates(["shingle", "g"])
    large = shared.where(F.col("groups") > LARGE).select("shingle", "g", F.col("n").cast("bigint").alias("n"), "pos").unionByName(crowded)
    large = stored(large.withColumn("rest", F.col("n") - F.col("pos")), "large_postings")
    in_large = large.groupBy("g").agg(F.count(F.lit(1)).alias("in_large"))
    small = shared.where(F.col("groups") <= LARGE)
    x, y = small.alias("x"), small.alias("y")
    meets = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.g") < F.col("y.g")) & similar_sizes(F.col("x.n"), F.col("y.n"))
    met = x.join(y.hint("merge"), meets).groupBy(F.col("x.g").alias("g"), F.col("y.g").alias("h")).agg(
        F.count(F.lit(1)).alias("shared"), F.first("x.n").alias("n"), F.first("y.n").alias("m"),
        F.max("x.pos").alias("last_g"), F.max("y.pos").alias("last_h"),
    )
    # Behind the prefix that ends first only the rest of both sets can be shared.
    behind_g = F.least(F.col("n") - _prefix("n"), F.col("m") - F.col("last_h") - 1)
    behind_h = F.least(F.col("m") - _prefix("m"), F.col("n") - F.col("last_g") - 1)
    most = F.col("shared") + F.greatest(behind_g, behind_h)
    met = met.withColumn("most", most).withColumn("needed", needed(F.col("n"), F.col("m")))
    # The postings under blocks, which were not counted, may be shared as well.
    met = met.where(F.col("most") + F.least(_prefix("n"), _prefix("m")) >= F.col("needed")).select("g", "h", "most", "needed")
    met = met.join(in_large, "g", "left").join(in_large.select(F.col("g").alias("h"), F.col("in_large").alias("in_large_h")), "h", "left")
    both = F.least(F.coalesce("in_large", F.lit(0)), F.coalesce("in_large_h", F.lit(0)))
    pairs = met.where(F.col("most") + both >= F.col("needed")).select("g", "h")
    return pairs, large.select(F.col("shingle").alias("block"), "g", "n", "rest")


def _prefix(n: str):
    return F.col(n) - F.ceil(F.col(n) * 3 / 4) + 1


def _text() -> Column:
    """Name of a text; with the id it tells rows apart, whatever ids they have."""
    return F.xxhash64("text")


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prefixes of every row, components of linked classes, and the sets compared; all stored."""
    rows = narrow(docs, "doc_id", "text").withColumn("t", _text())
    prefixes = stored(rows.mapInArrow(_prefixes(*frequent_shingles(rows)), PREFIXES), "prefixes")
    members = prefixes.where("n > 0").select("g", "n", "node").distinct()
    counts = members.groupBy("g").agg(F.count(F.lit(1)).alias("members"))
    members = stored(members.join(counts, "g"), "group_members")
    pairs, blocks = _candidates(prefixes)
    pairs = stored(pairs, "group_pairs")
    # Expand: pairs of small groups into all member pairs, others and groups themselves into blocks.
    sized = members.groupBy("g").agg(F.first("members").alias("k")).where("k > 1")
    pairs = pairs.join(sized.withColumnRenamed("k", "kg"), "g", "left").join(
        sized.select(F.col("g").alias("h"), F.col("k").alias("kh")), "h", "left"
    ).fillna(1, ["kg", "kh"])
    wide = F.col("kg") * F.col("kh") > LARGE
    mine = members.select(F.col("g"), F.col("node").alias("x"))
    yours = members.select(F.col("g").alias("h"), F.col("node").alias("y"))
    member_pairs = pairs.where(~wide).join(mine, "g").join(yours, "h").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pair_blocks = pairs.where(wide).select(F.xxhash64("g", "h").alias("block"), F.explode(F.array("g", "h")).alias("g"))
    own = members.where("members > 1").select(F.xxhash64("g").alias("block"), "node", F.col("n").alias("size"), F.col("n").alias("rest"))
    spread = blocks.select("block", "g", "rest").join(members, "g").select("block", "node", F.col("n").alias("size"), "rest")
    met = pair_blocks.join(members, "g").select("block", "node", F.col("n").alias("size"), F.col("n").alias("rest"))
    texts = _first_rows(prefixes).select("node", F.col("row.doc_id").alias("of_doc"), F.col("row.t").alias("of_text"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = stored(texts.join(nodes, "node", "left_semi"), "wanted")
        same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("t") == F.col("of_text"))
        met = rows.join(hinted(wanted, is_small(wanted)), same)
        return met.select("node", "text").mapInArrow(_sets, "node bigint, items array<bigint>, sketch array<tinyint>")

    _, found, sets = linked_sets(member_pairs, spread.unionByName(own).unionByName(met), sets_of)
    return prefixes, stored(found, "found_components"), sets


def _first_rows(prefixes: DataFrame) -> DataFrame:
    """``node, row``: of each class the row of smallest id, those without an id last."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    return prefixes.where("n > 0").groupBy("node").agg(F.min(row).alias("row"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document.

    ``n_links`` counts the other classes whose sets are similar to that of the document.
    """
    prefixes, found, sets = _found(docs)
    return _answer(prefixes, degrees(found, sets), found)


def _answer(prefixes: DataFrame, degree: DataFrame, found: DataFrame) -> DataFrame:
    """Back to documents: classes are few per component, documents join their class once.

    Documents of one class are aggregated before they meet its component; a class that
    holds many documents meets them in a join that adaptive execution splits.
    """
    classes = prefixes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    joined = found.join(classes, "node")
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = joined.join(named, "component").join(degree, "node", "left").select("node", "component_id", "n_links")
    of_class = stored(
        classes.join(of_class, "node", "left").select(
            F.col("node").alias("of"), F.coalesce("component_id", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        ), "classes",
    )
    answer = prefixes.select("doc_id", "n", "node").join(of_class, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    return answer.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id; rows without words all stay.

    Links are not counted here. Of rows alike in id and text all stay or none. The rows that go
    are few columns: texts move only if these do not measure small.
    """
    prefixes, found, _ = _found(docs)
    first = _first_rows(prefixes).join(found, "node", "left")
    kept = first.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("row").alias("row"))
    rows = prefixes.where("n > 0").select(F.col("doc_id").alias("of_doc"), F.col("t").alias("of_text")).distinct()
    stays = F.col("of_doc").eqNullSafe(F.col("row.doc_id")) & (F.col("of_text") == F.col("row.t"))
    gone = stored(rows.join(kept, stays, "left_anti"), "near_copies")
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (_text() == F.col("of_text"))
    return docs.join(hinted(gone, is_small(gone)), same, "left_anti")
