"""Components of similar sets from candidate pairs and from large blocks of candidates.

A block is a list of nodes of which any two may be similar. Emitting all pairs of a large
block would grow with its square, so the nodes of a block first meet its smallest node
only. What that links, together with the links of all pairs, forms components; after
that only nodes of one block in different components can still change the result. These
meet a few drawn nodes of the block, some turns over, which joins most of what belongs
together; the pairs that are left in different components are all compared. No candidate
pair is dropped: it is either compared or already joined by other links.

So components are whole, but not all links in them are met. :func:`degrees` counts those:
all nodes of a component are compared by products of matrices, in chunks of bounded size,
and only counts leave the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.components import components
from wayline.operators.sizing import hinted, is_small
from wayline.scratch import stored

# Similarity as a fraction of whole numbers, so that comparisons are exact.
PERCENT = 75
# After the first links, so many drawn nodes of a block meet the others, so many times.
HEADS = 8
TURNS = 3
# Nodes and items of a chunk of a component, on the average of its chunks, and columns of a matrix.
CHUNK_NODES = 1024
CHUNK_ITEMS = 524_288
SLAB = 4096


def similar_sizes(a: Column, b: Column) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * PERCENT)


def needed(a: Column, b: Column) -> Column:
    """Smallest intersection of two similar sets of these sizes."""
    return F.ceil((a + b) * PERCENT / F.lit(100 + PERCENT))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``; stored) whose sets (``node``, ``items``) are similar.

    The second node's set joins first: a node that meets many is ``a``, the smallest of a
    block, and is joined last, where adaptive execution splits its rows. Only sets of nodes
    that stand on a side move there, by a measured broadcast of their names; where sets have a
    ``sketch``, only those of pairs that may be similar by these.
    """
    if "sketch" in sets.columns:
        pairs = stored(_met(pairs, sets, "sketch").where(_may_be_similar()).select("a", "b"), "sketched_pairs")
    both = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - both
    return _met(pairs, sets, "items").where(both * 100 >= union * PERCENT).select("a", "b").distinct()


def _met(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs with a column of the sets on either side (``_a``, ``_b``)."""
    def side(name: str) -> DataFrame:
        asked = pairs.select(F.col(name).alias("node")).distinct()
        wanted = sets.select("node", column).join(hinted(asked, is_small(asked)), "node", "left_semi")
        return wanted.select(F.col("node").alias(name), F.col(column).alias(f"{column}_{name}")).hint("merge")

    return pairs.join(side("b"), "b").join(side("a"), "a")


def sketch(items: np.ndarray) -> np.ndarray:
    """How many items (64-bit hashes) lie in each of some equal ranges: a power of two of them, half the
    items or more.

    Two sets share no more than the sum of the lesser counts, which bounds their similarity from
    a tenth of their bytes. Empty, which bounds nothing, where a count does not fit.
    """
    bits = max(int(len(items) - 1).bit_length() - 1, 1)
    counts = np.bincount((items >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.int8) if counts.max() < 128 else np.empty(0, dtype=np.int8)


def _may_be_similar() -> Column:
    """Whether sets of these sketches can be similar; similar sets have as many ranges, or twice as many."""
    def at(counts: str, i: Column) -> Column:
        return F.get(counts, i).cast("int")

    def ranges(counts: str, other: str) -> Column:
        halved = F.transform(F.sequence(F.lit(0), F.size(other) - 1), lambda i: at(counts, 2 * i) + at(counts, 2 * i + 1))
        return F.when(F.size(counts) > F.size(other), halved).otherwise(F.col(counts).cast("array<int>"))

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0), lambda x, n: x + n)

    a, b = "sketch_a", "sketch_b"
    most = total(F.zip_with(ranges(a, b), ranges(b, a), lambda x, y: F.least(x, y)))
    least = needed(total(F.col(a).cast("array<int>")), total(F.col(b).cast("array<int>")))
    known = (F.size(a) > 0) & (F.size(b) > 0) & (F.size(a) <= 2 * F.size(b)) & (F.size(b) <= 2 * F.size(a))
    return F.when(known, most >= least).otherwise(F.lit(True))


def linked(pairs: DataFrame, blocks: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Links found and the components (``node, component``) of all linked nodes.

    ``pairs`` has ``a < b``; ``blocks`` has ``block, node, size, rest``, where ``rest``
    bounds what a node can share with others of the block; ``sets_of`` makes the table
    ``node, items`` for a table of nodes.
    """
    return linked_sets(pairs, blocks, sets_of)[:2]


def linked_sets(
    pairs: DataFrame, blocks: DataFrame, sets_of: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`linked`, and the stored sets of all nodes that met another.

    Sets are made and written when their node first meets another: most nodes of a block may
    meet none that sizes and rests allow.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "link_pairs")
    blocks = stored(blocks.select("block", "node", "size", "rest"), "link_blocks")
    heads = blocks.groupBy("block").agg(F.min(F.struct("node", "size", "rest")).alias("head"))
    star = blocks.join(heads, "block").where(
        (F.col("node") != F.col("head.node")) & _may_link(F.col("size"), F.col("rest"), F.col("head.size"), F.col("head.rest"))
    ).select(F.col("head.node").alias("a"), F.col("node").alias("b"))
    star = stored(star.distinct().join(pairs, ["a", "b"], "left_anti"), "link_stars")
    tested = pairs.unionByName(star)
    sets = _grown(None, tested, sets_of)
    links = stored(verified(tested, sets), "links_first")
    found = components(links)
    if blocks.isEmpty():
        return links, found, sets
    for turn in range(TURNS):
        found = stored(found, "link_components")
        mixed = stored(_mixed(blocks, found), "link_mixed")
        met = stored(_headed(mixed, turn).join(tested, ["a", "b"], "left_anti"), "link_heads")
        if met.isEmpty():
            break
        sets = _grown(sets, met, sets_of)
        more = stored(verified(met, sets), "links_headed")
        tested, links, found = tested.unionByName(met), links.unionByName(more), _merged(found, more)
    found = stored(found, "link_components")
    rest = stored(_across(_mixed(blocks, found)).join(tested, ["a", "b"], "left_anti"), "links_across")
    if rest.isEmpty():
        return links, found, sets
    sets = _grown(sets, rest, sets_of)
    more = stored(verified(rest, sets), "links_more")
    return links.unionByName(more), _merged(found, more), sets


def _grown(sets: DataFrame | None, pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored sets, with those of the nodes of these pairs that are not among them yet."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if sets is None:
        return stored(sets_of(stored(nodes, "link_nodes")), "link_sets")
    new = stored(nodes.join(sets.select("node"), "node", "left_anti"), "link_nodes")
    return sets if new.isEmpty() else sets.unionByName(stored(sets_of(new), "link_sets"))


def similar_counts(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Whether each set of ``first`` is similar to each of ``second`` (distinct items each)."""
    sizes = [np.array([len(x) for x in part]) for part in (first, second)]
    flat = [np.concatenate(part) for part in (first, second)]
    owner = [np.repeat(np.arange(len(n)), n) for n in sizes]
    # Only items of both sides count.
    common = np.intersect1d(*flat)
    places = [np.minimum(np.searchsorted(common, x), max(len(common) - 1, 0)) for x in flat]
    both = np.zeros((len(first), len(second)), dtype=np.float32)
    inside = [common[at] == x if len(common) else np.zeros(len(x), dtype=bool) for at, x in zip(places, flat)]
    for start in range(0, len(common), SLAB):
        slabs = []
        for n, of, at, ok in zip(sizes, owner, places, inside):
            here = ok & (at >= start) & (at < start + SLAB)
            slab = np.zeros((len(n), min(SLAB, len(common) - start)), dtype=np.float32)
            slab[of[here], at[here] - start] = 1
            slabs.append(slab)
        both += slabs[0] @ slabs[1].T
    both = np.rint(both).astype(np.int64)
    return both * 100 >= (sizes[0][:, None] + sizes[1][None, :] - both) * PERCENT


def _degrees(table: pa.Table) -> pa.Table:
    """Links that the nodes of two chunks have with each other, or those of one chunk among themselves."""
    nodes, chunks = table.column("node").to_numpy(), table.column("chunk").to_numpy()
    lists = table.column("items").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    # Rows repeated in id and text give a node more than once.
    nodes, at = np.unique(nodes, return_index=True)
    chunks, items = chunks[at], [flat[ends[i] : ends[i + 1]] for i in at]
    own = np.flatnonzero(chunks == chunks.min())
    if table.column("one")[0].as_py():
        counts = similar_counts(items, items).sum(axis=1) - 1
        return pa.table({"node": nodes, "links": pa.array(counts, pa.int64())})
    other = np.flatnonzero(chunks != chunks.min())
    if not len(other):
        return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    met = similar_counts([items[i] for i in own], [items[i] for i in other])
    counts = np.concatenate([met.sum(axis=1), met.sum(axis=0)])
    return pa.table({"node": nodes[np.concatenate([own, other])], "links": pa.array(counts, pa.int64())})


def degrees(found: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, n_links``: how many other nodes each node of a component is similar to.

    Similar nodes share a component, so its nodes are compared with each other, chunk by chunk.
    """
    sizes = sets.select("node", F.size("items").alias("size")).distinct()
    sized = stored(found.join(sizes, "node"), "link_sizes")
    whole = sized.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"), F.sum("size").alias("items"))
    many = F.greatest(F.ceil(F.col("nodes") / CHUNK_NODES), F.ceil(F.col("items") / CHUNK_ITEMS)).cast("int")
    placed = sized.join(whole.select("component", many.alias("chunks")), "component").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    # A chunk meets each chunk, itself included.
    meets = placed.select("node", "component", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with")).select(
        "node", "component", "chunk", F.least("chunk", "with").alias("p"), F.greatest("chunk", "with").alias("q")
    )
    # The sets, which are large, stay where they are till then if the meetings measure small.
    meets = stored(meets, "link_meetings")
    rows = sets.join(hinted(meets, is_small(meets)), "node").select("component", "p", "q", "node", "chunk", (F.col("p") == F.col("q")).alias("one"), "items")
    counts = rows.groupBy("component", "p", "q").applyInArrow(_degrees, "node bigint, links bigint")
    return counts.groupBy("node").agg(F.sum("links").alias("n_links"))


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components after more links: those link components, so only these are gone through again."""
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    alone = ends.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    placed = stored(found.unionByName(alone), "link_placed_nodes")
    a = placed.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    b = placed.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    across = more.join(a, "a").join(b, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = components(across).select(F.col("node").alias("of"), F.col("component").alias("whole"))
    return placed.join(joined, F.col("component") == F.col("of"), "left").select(
        "node", F.coalesce("whole", "component").alias("component")
    )


def _mixed(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """The blocks with nodes of different components, and the component of each node."""
    placed = blocks.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = placed.groupBy("block").agg(F.min("component").alias("least"), F.max("component").alias("greatest"))
    return placed.join(ends.where("least < greatest").select("block"), "block", "left_semi")


def _may_link(m: Column, rest_m: Column, n: Column, rest_n: Column) -> Column:
    return similar_sizes(m, n) & (F.least(rest_m, rest_n) >= needed(m, n))


def _headed(mixed: DataFrame, turn: int) -> DataFrame:
    """The nodes of each mixed block with some of its nodes, others at each turn, of another component."""
    drawn = [
        F.min(F.struct(F.xxhash64("node", F.lit(turn * HEADS + k)).alias("draw"), "node", "component", "size", "rest"))
        for k in range(HEADS)
    ]
    heads = mixed.groupBy("block").agg(F.array_distinct(F.array(*drawn)).alias("heads"))
    others = F.filter("heads", lambda h: (h["component"] != F.col("component")) & _may_link(h["size"], h["rest"], F.col("size"), F.col("rest")))
    met = mixed.join(heads, "block").select("node", F.explode(others).alias("head"))
    return met.select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct()


def _across(mixed: DataFrame) -> DataFrame:
    """Pairs of one block in different components that sizes and rests allow."""
    mixed = stored(mixed, "link_placed")
    parts = stored(
        mixed.groupBy("block", "component").agg(
            F.min("size").alias("low"), F.max("size").alias("high"), F.max("rest").alias("rest"), F.count(F.lit(1)).alias("nodes")
        ), "link_parts",
    )
    p, q = parts.alias("p"), parts.alias("q")
    meets = (
        (F.col("p.block") == F.col("q.block")) & (F.col("p.component") < F.col("q.component"))
        & (F.col("p.high") * 100 >= F.col("q.low") * PERCENT) & (F.col("q.high") * 100 >= F.col("p.low") * PERCENT)
        & (F.least("p.rest", "q.rest") >= needed(F.col("p.low"), F.col("q.low")))
    )
    c, d = F.col("p.component"), F.col("q.component")
    fewer = F.col("p.nodes") <= F.col("q.nodes")
    meeting = p.join(q.hint("merge"), meets).select(
        "p.block", F.when(fewer, c).otherwise(d).alias("lesser"), F.when(fewer, d).otherwise(c).alias("other")
    )
    # The nodes of the lesser one, which are few rows, go to those of the other.
    x = mixed.select("block", F.col("component").alias("lesser"), F.col("node").alias("x"), F.col("size").alias("m"), F.col("rest").alias("rest_x"))
    y = mixed.select(
        F.col("block").alias("in"), F.col("component").alias("of"), F.col("node").alias("y"), F.col("size").alias("n"), F.col("rest").alias("rest_y")
    )
    same = (F.col("block") == F.col("in")) & (F.col("other") == F.col("of"))
    pairs = meeting.join(x, ["block", "lesser"]).join(y, same & _may_link(F.col("m"), F.col("rest_x"), F.col("n"), F.col("rest_y")))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
