"""Substring dedup: repeated paragraphs by MinHash banding, verified and clustered.

A paragraph is a line of at least ``LEAST`` words, or neighbouring shorter lines up to a blank
one that hold so many together. Its set is its distinct five-word shingles. Of 64 minimum hashes, 16 bands of four send paragraphs that share a band to one
bucket: two of similarity 0.75 meet with probability 0.998. Paragraphs that met are
verified by exact Jaccard similarity of 0.75 or more and clustered by components; of each
cluster the earliest paragraph (by document id, then line) stays and the others go.

Equal paragraphs are one node. Of a bucket of more than ``LARGE`` nodes no pairs are listed:
the nodes of all such buckets meet by the rarest shingles of their sets instead, which
misses no similar pair; where more than ``LARGE`` still share one, they form a block (see
:mod:`wayline.llm.linking`).

A passage is a run of ``LEAST`` words anywhere in a text, over line ends too, that begins at
an anchor: of any ``ANCHORS`` words in a row, the one whose next three words have the lowest
hash. So anchors depend on the words alone, two texts that share ``ANCHORS + LEAST - 1`` words
in a row share a whole passage, and a shared run is covered but for at most ``ANCHORS - 1``
words at each end. Equal passages are found by their hash. Of equal ones the earliest stays,
those that touch no paragraph that goes before others; the words of the others go, unless a
passage of the same text that stays holds them too.

Defined cases: null and empty texts have no paragraph; a null document id comes last; rows
repeated in id and text are one document; an empty table gives an empty result; other
columns are passed through by :func:`remove_repeats`. Identity of paragraphs rests on
64-bit hashes of their shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.linking import linked, needed, similar_sizes
from wayline.llm.text import SHINGLE, WordHashes, as_longs, list_array, mixed, narrow, pieces, shingle_sets, utf8, windows, word_hashes
from wayline.operators.sizing import hinted, is_small
from wayline.scratch import stored

LEAST = 20
ANCHORS = 8
BANDS = 16
ROWS = 4
LARGE = 32
# Words of the lines that a task hashes together.
WORDS_AT_ONCE = 131_072

_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def bands(items: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minimum-hash keys of the sets that begin at ``starts`` in ``items``: a row of one key per band for each."""
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(starts), axis=0)
    if not len(starts):
        return keys
    for number, seed in enumerate(_SEEDS):
        least = np.minimum.reduceat((items ^ seed) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11), starts)
        band = number // ROWS
        keys[:, band] = mixed(keys[:, band] ^ least)
    return keys


def line_shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of lines of five words or more, one line after the other, and where each begins."""
    h, begins = word_hashes(lines)
    lengths = np.diff(begins)
    if not len(lines):
        return np.empty(0, dtype=np.uint64), lengths
    found, whole = windows(h)
    of_word = np.repeat(np.arange(len(lines)), lengths)
    line = of_word[:whole]
    # Windows that run on into the next line are no shingles.
    inside = line == of_word[SHINGLE - 1 :]
    found, line = found[inside], line[inside]
    order = np.lexsort((found, line))
    found, line = found[order], line[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (line[1:] != line[:-1])
    found, line = found[new], line[new]
    return found, np.flatnonzero(np.r_[True, line[1:] != line[:-1]])


def paragraphs(text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """Number of the first line, count of lines, count of words and text of each paragraph."""
    first, joined, lines = 0, 0, text.split(b"\n")
    for no, line in enumerate([*lines, b""]):
        words = len(line.split())
        if words and words < LEAST:
            first = first if joined else no
            joined += words
            continue
        if joined >= LEAST:
            yield first, no - first, joined, b"\n".join(lines[first:no])
        if words:
            yield no, 1, words, line
        joined = 0


def passages(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the passages of texts begin, and their names, given the hashes of the words of all texts, one
    after the other, and where each text ends."""
    begins = np.concatenate([[0], ends[:-1]])
    long = ends - begins >= LEAST
    # Of the last words no window of ANCHORS words with three each begins in the same text.
    windows_of = np.where(long, ends - begins - ANCHORS - 1, 0)
    if not windows_of.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    inside = np.repeat(begins - np.cumsum(windows_of) + windows_of, windows_of) + np.arange(windows_of.sum())
    three = mixed(h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9))
    least, anchor = three[inside], inside.copy()
    for k in range(1, ANCHORS):
        other = three[inside + k]
        less = other < least
        least = np.where(less, other, least)
        anchor = np.where(less, inside + k, anchor)
    # Anchors rise with their windows.
    at = anchor[np.r_[True, anchor[1:] != anchor[:-1]]]
    at = at[at + LEAST <= ends[np.searchsorted(ends, at, side="right")]]
    names = np.zeros(len(at), dtype=np.uint64)
    for k in range(LEAST):
        names = mixed(names ^ h[at + k])
    return at, names


PASSAGES = "doc_id bigint, row bigint, spot bigint, line_ends array<int>, starts array<int>, names array<bigint>"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of each text; those of so many words that make a group are looked for side by side."""
    hashes = WordHashes()
    for batch in pieces(batches):
        line_ends: list[np.ndarray] = []
        words: list[bytes] = []
        ends: list[int] = []
        first = 0

        def report(upto: int) -> pa.RecordBatch:
            nonlocal line_ends, words, ends, first
            until = np.array(ends, dtype=np.int64)
            at, names = passages(hashes.of(words), until)
            cuts = np.searchsorted(at, until)
            froms, begins = np.concatenate([[0], cuts[:-1]]), np.concatenate([[0], until[:-1]])
            some = batch.slice(first, upto - first)
            found = pa.record_batch({
                "doc_id": some.column("doc_id"), "row": some.column("row"), "spot": some.column("spot"),
                "line_ends": list_array(line_ends, pa.int32()),
                "starts": list_array([(at[a:b] - begin).astype(np.int32) for a, b, begin in zip(froms, cuts, begins)], pa.int32()),
                "names": list_array([as_longs(names[a:b]) for a, b in zip(froms, cuts)], pa.int64()),
            })
            line_ends, words, ends, first = [], [], [], upto
            return found

        for number, text in enumerate(utf8(batch, "text"), 1):
            lines = [line.split() for line in (text or b"").lower().split(b"\n")]
            line_ends.append(np.cumsum([len(line) for line in lines]).astype(np.int32))
            for line in lines:
                words += line
            ends.append(len(words))
            if len(words) >= WORDS_AT_ONCE:
                yield report(number)
        if ends:
            yield report(batch.num_rows)


PARAGRAPHS = "doc_id bigint, row bigint, line_no int, line_count int, node bigint, n bigint, bands array<bigint>"


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places: list[tuple[int | None, int, int, int]] = []
    lines: list[bytes] = []

    def report() -> pa.RecordBatch:
        items, starts = line_shingles(lines)
        ends = np.append(starts[1:], len(items)) if len(starts) else starts
        docs, texts, nos, counts = zip(*places) if places else ((), (), (), ())
        batch = pa.record_batch({
            "doc_id": pa.array(docs, pa.int64()), "row": pa.array(texts, pa.int64()), "line_no": pa.array(nos, pa.int32()),
            "line_count": pa.array(counts, pa.int32()),
            "node": pa.array([_node(items[a:b]) for a, b in zip(starts, ends)], pa.int64()),
            "n": pa.array(ends - starts, pa.int64()), "bands": list_array(list(as_longs(bands(items, starts))), pa.int64()),
        })
        places.clear()
        lines.clear()
        return batch

    held = 0
    for batch in pieces(batches):
        for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), utf8(batch, "text")):
            for no, count, words, line in paragraphs(text or b""):
                places.append((doc, row, no, count))
                lines.append(line)
                held += words
                if held >= WORDS_AT_ONCE:
                    yield report()
                    held = 0
    yield report()


def _node(items: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(items.tobytes(), seed=len(items)) >> 1


def _paragraph_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the wanted paragraphs (``nos``: first line and count) of each text."""
    for batch in pieces(batches):
        wanted = []
        for text, nos in zip(utf8(batch, "text"), batch.column("nos").to_pylist()):
            lines = (text or b"").split(b"\n")
            wanted += [b"\n".join(lines[no : no + count]) for no, count in {(at["line_no"], at["line_count"]) for at in nos} if no < len(lines)]
        items = shingle_sets(wanted)
        nodes = [_node(found) for found in items]
        yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "items": list_array([as_longs(found) for found in items], pa.int64())})


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc"), "row", "line_no", "line_count")


def paragraph_clusters(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, line_count, cluster, stays`` of every paragraph that has a near copy or an equal one."""
    rows = narrow(docs, "doc_id", "text")
    found = stored(rows.withColumn("row", _row()).mapInArrow(_paragraphs, PARAGRAPHS), "paragraphs")
    distinct = stored(
        found.groupBy("node").agg(F.min(_place()).alias("place"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")), "distinct_paragraphs"
    )
    # Bands move once, with no more than their node; those of different nodes stay.
    of_band = Window.partitionBy("band")
    buckets = found.select("node", F.explode("bands").alias("band"))
    buckets = buckets.withColumn("low", F.min("node").over(of_band)).withColumn("high", F.max("node").over(of_band))
    met = stored(buckets.where("low < high").select("node", "band").distinct(), "met_buckets")
    counts = met.groupBy("band").agg(F.count(F.lit(1)).alias("nodes"))
    met = stored(met.join(counts, "band").join(distinct.select("node", "n"), "node"), "paragraph_buckets")
    small = met.where(F.col("nodes") <= LARGE)
    x, y = small.alias("x"), small.alias("y")
    meets = (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node")) & similar_sizes(F.col("x.n"), F.col("y.n"))
    pairs = x.join(y, meets).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        at = distinct.join(nodes, "node", "left_semi").select(F.col("place.doc").alias("doc"), F.struct("place.line_no", "place.line_count").alias("no"))
        wanted = at.where(F.col("doc").isNotNull()).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_set("no").alias("nos"))
        wanted = stored(wanted, "wanted")
        wanted = hinted(wanted, is_small(wanted))
        sets = rows.join(wanted, "doc_id").select("text", "nos").mapInArrow(_paragraph_sets, "node bigint, items array<bigint>")
        return sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])

    crowded = stored(met.where(F.col("nodes") > LARGE).select("node").distinct(), "crowded_paragraphs")
    near, blocks = _prefix_meetings(sets_of(crowded))
    _, clusters = linked(pairs.unionByName(near), blocks, sets_of)
    placed = distinct.join(clusters, "node", "left").select("node", "place", "copies", F.coalesce("component", "node").alias("cluster"))
    placed = stored(placed, "paragraph_places")
    firsts = placed.groupBy("cluster").agg(F.min("place").alias("first"), F.sum("copies").alias("lines")).where("lines > 1")
    of_node = placed.join(firsts, "cluster").select(F.col("node").alias("of"), "cluster", "first")
    joined = found.select("doc_id", "row", "line_no", "line_count", "node").join(of_node, F.col("node") == F.col("of"))
    # Rows repeated in id and text have one place.
    return joined.select("doc_id", "row", "line_no", "line_count", "cluster", (F.col("first") == _place()).alias("stays")).distinct()


def _prefix_meetings(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs and blocks (see :func:`linked`) that hold every similar pair of these sets.

    In one order of all shingles, rare ones first, two sets of similarity 0.75 or more share
    one of the first ``n/4 + 1`` of each. A paragraph changed in a few words shares a band
    with many others changed elsewhere, but its first shingles are then its own.
    """
    items = stored(sets.select("node", F.size("items").cast("bigint").alias("n"), F.explode("items").alias("shingle")), "crowded_shingles")
    often = items.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = items.join(often, "shingle")
    of_node = Window.partitionBy("node")
    after = F.row_number().over(of_node.orderBy("sets", "shingle")) - 1
    # Shingles of no other set stand first.
    placed = shared.withColumn("pos", F.col("n") - F.count(F.lit(1)).over(of_node) + after)
    prefix = stored(placed.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * 3 / 4)).select("shingle", "node", "n", "pos"), "paragraph_prefixes")
    counts = prefix.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    postings = stored(prefix.join(counts, "shingle"), "paragraph_postings")
    small = postings.where(F.col("nodes") <= LARGE)
    x, y = small.alias("x"), small.alias("y")
    most = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    # At their first common shingle all that both can share still lies ahead.
    meets = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & similar_sizes(F.col("x.n"), F.col("y.n"))
    meets = meets & (most >= needed(F.col("x.n"), F.col("y.n")))
    pairs = x.join(y, meets).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    blocks = postings.where(F.col("nodes") > LARGE).select(
        F.col("shingle").alias("block"), "node", F.col("n").alias("size"), (F.col("n") - F.col("pos")).alias("rest")
    )
    return pairs, blocks


def _row() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _lines(which: Column) -> Column:
    """Line numbers of the paragraphs of a group that meet a condition."""
    lines = F.sequence(F.col("line_no"), F.col("line_no") + F.col("line_count") - 1)
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(which, lines)))))


def _once(found: DataFrame) -> DataFrame:
    """Of rows repeated in id and text one; the others are found by columns that are few bytes."""
    spots = found.groupBy("doc_id", "row").agg(F.min("spot").alias("least"), F.max("spot").alias("most"))
    twice = spots.where("least < most").select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "least")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")) & (F.col("spot") > F.col("least"))
    others = stored(found.select("doc_id", "row", "spot").join(twice, same, "left_semi").select("spot"), "repeated_rows")
    return found.join(hinted(others, is_small(others)), "spot", "left_anti")


def repeated_passages(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Per document its passages that repeat: ``_doc, _of, line_ends, goes, stays``, the latter where they begin.

    ``gone`` has the lines that go as paragraphs (``_doc, _of, _gone``).
    """
    rows = rows.withColumn("row", _row()).withColumn("spot", F.monotonically_increasing_id())
    found = _once(stored(rows.mapInArrow(_passages, PASSAGES), "passages"))
    each = found.select("spot", F.explode(F.arrays_zip("starts", "names")).alias("p")).select(
        "spot", F.col("p.starts").alias("start"), F.col("p.names").alias("name")
    )
    # Counted and listed after one shuffle, with no more than the place of their text.
    met = each.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).where("n > 1")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_of"))
    # The words of lines that go, as intervals of word numbers.
    before = lambda no: F.coalesce(F.get("line_ends", no - 1), F.lit(0))
    lost = F.transform("_gone", lambda no: F.struct(before(no).alias("first"), F.get("line_ends", no).alias("end")))
    texts = found.select("spot", "doc_id", "row", "line_ends").join(gone.select("_doc", "_of", "_gone"), same, "left")
    texts = texts.select("spot", "doc_id", "row", F.when(F.size("_gone") > 0, lost).alias("lost"))
    placed = met.select("spot", "start", "name").join(texts, "spot")
    touches = F.coalesce(F.exists("lost", lambda x: (x["first"] < F.col("start") + LEAST) & (x["end"] > F.col("start"))), F.lit(False))
    place = F.struct(touches.alias("touches"), F.col("doc_id").isNull().alias("last"), "doc_id", "row", "start")
    placed = placed.select("name", place.alias("place"))
    told = placed.withColumn("first", F.min("place").over(Window.partitionBy("name"))).select(
        "place.doc_id", "place.row", "place.start", (F.col("place") == F.col("first")).alias("stay")
    )
    told = told.groupBy("doc_id", "row").agg(
        F.collect_list(F.when(~F.col("stay"), F.col("start"))).alias("goes"), F.collect_list(F.when(F.col("stay"), F.col("start"))).alias("stays")
    )
    counts = found.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_of"), "line_ends")
    return told.join(counts, same).select("_doc", "_of", "line_ends", "goes", "stays")


REMOVALS = "_doc bigint, _of bigint, _gone array<int>, _parts array<struct<line:int,first:int,end:int>>, _repeated bigint"


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, marked.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that go whole, parts of others, and how many paragraphs and runs of passages repeat."""
    for batch in batches:
        gone, parts, repeated = [], [], []
        for r in batch.select(["_lines", "_all", "_repeated", "line_ends", "goes", "stays"]).to_pylist():
            whole, cut, count = set(r["_lines"] or ()), [], r["_repeated"] or 0
            if r["line_ends"]:
                ends = r["line_ends"]
                spans = list(zip([0, *ends[:-1]], ends))
                goes, again, known = (np.zeros(ends[-1], dtype=bool) for _ in range(3))
                for at in r["goes"]:
                    goes[at : at + LEAST] = again[at : at + LEAST] = True
                for at in r["stays"]:
                    goes[at : at + LEAST] = False
                    again[at : at + LEAST] = True
                for no in r["_all"] or ():
                    known[slice(*spans[no])] = True
                count += sum(not known[a:b].all() for a, b in _runs(again))
                for no, (a, b) in enumerate(spans):
                    if a < b and no not in whole and goes[a:b].any():
                        if goes[a:b].all():
                            whole.add(no)
                        else:
                            cut += [{"line": no, "first": x, "end": y} for x, y in _runs(goes[a:b])]
            gone.append(sorted(whole))
            parts.append(cut)
            repeated.append(count)
        part = pa.struct([("line", pa.int32()), ("first", pa.int32()), ("end", pa.int32())])
        yield pa.record_batch({
            "_doc": batch.column("_doc"), "_of": batch.column("_of"), "_gone": pa.array(gone, pa.list_(pa.int32())),
            "_parts": pa.array(parts, pa.list_(part)), "_repeated": pa.array(repeated, pa.int64()),
        })


def _removals(docs: DataFrame) -> DataFrame:
    """Per document with repeats the lines that go, the parts of lines (words ``first`` to before ``end``), and how many repeat."""
    of = paragraph_clusters(docs).groupBy("doc_id", "row").agg(
        _lines(~F.col("stays")).alias("_gone"), _lines(F.lit(True)).alias("_all"), F.count(F.lit(1)).alias("_repeated")
    )
    of = stored(of.withColumnsRenamed({"doc_id": "_doc", "row": "_of"}), "paragraph_lines")
    found = repeated_passages(narrow(docs, "doc_id", "text"), of)
    lines = of.select(F.col("_doc").alias("d"), F.col("_of").alias("o"), F.col("_gone").alias("_lines"), "_all", "_repeated")
    both = found.join(lines, F.col("_doc").eqNullSafe(F.col("d")) & (F.col("_of") == F.col("o")), "full").select(
        F.when(F.col("_of").isNull(), F.col("d")).otherwise(F.col("_doc")).alias("_doc"), F.coalesce("_of", "o").alias("_of"),
        "_lines", "_all", "_repeated", "line_ends", "goes", "stays",
    )
    return both.mapInArrow(_cut, REMOVALS)


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document its paragraphs and passages that repeat in the corpus, and what goes.

    ``removed_lines`` are the lines that go whole, ``removed_words`` parts of others as
    ``line:first-end`` in words, the end exclusive; ``n_removed`` counts both.
    """
    rows = narrow(docs, "doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_of"))
    joined = rows.select("doc_id", _row().alias("row")).join(_removals(rows), same, "left")
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    parts = F.transform("_parts", lambda p: F.format_string("%d:%d-%d", p["line"], p["first"], p["end"]))
    parts = F.coalesce(parts, F.array().cast("array<string>"))
    return joined.select(
        "doc_id", F.coalesce("_repeated", F.lit(0)).alias("n_repeated"), (F.size(gone) + F.size(parts)).cast("bigint").alias("n_removed"),
        F.array_join(gone.cast("array<string>"), ",").alias("removed_lines"), F.array_join(parts, ",").alias("removed_words"),
    )


_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def without(text: bytes, gone: list[int], parts: list[dict[str, int]]) -> bytes:
    """A text without some lines and parts of lines; the space after a part goes with it."""
    lines, dropped = text.split(b"\n"), set(gone)
    for p in sorted(parts, key=lambda p: (p["line"], -p["first"])):
        line = lines[p["line"]]
        places = [m.span() for m in _WORD.finditer(line)]
        end = places[p["end"]][0] if p["end"] < len(places) else places[-1][1]
        lines[p["line"]] = line[: places[p["first"]][0]] + line[end:]
    return b"\n".join(line for no, line in enumerate(lines) if no not in dropped)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        told = zip(utf8(batch, "text"), batch.column("_gone").to_pylist(), batch.column("_parts").to_pylist())
        texts = [without(t, gone or [], parts or []) if t is not None and (gone or parts) else t for t, gone, parts in told]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.binary()).cast(pa.string()).cast(batch.schema.field(at).type))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated paragraphs and passages, with the columns of ``docs``."""
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_row") == F.col("_of"))
    joined = docs.withColumn("_row", _row()).join(_removals(docs), same, "left")
    cut = F.col("_gone").isNotNull() & (F.size("_gone") + F.size("_parts") > 0)
    joined = joined.mapInArrow(_without, joined.schema)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
