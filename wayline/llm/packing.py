"""Pack documents into token sequences along a space-filling curve.

Each document's words are hashed to fixed random directions; their mean is a point in a few
dimensions and its place on a Hilbert curve the sort key, so neighbours along the curve
share words. Documents are range-sorted by that key (ties by a hash of the id, so a large
group of copies spreads over ranges) and their tokens cut into sequences of 2,048, a
document running on into the next sequence. The last tokens of a range are cut at powers
of two, which need no padding.

The bounds of the ranges are quantiles of the keys of a stated sample; they decide how
even the ranges are, not which documents are packed.

Defined cases: null and empty texts have only the end id and the first key; repeated rows
are packed each; an empty table gives no pieces; other columns are ignored. A document of
any length is cut into as many pieces as needed.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.text import WordHashes, narrow, pieces
from wayline.llm.tokens import encoder

LENGTH = 2048
DIMENSIONS = 3
BITS = 10
BYTES_PER_RANGE = 16 << 20
# Documents whose keys set the range bounds, and ranges per partition.
SAMPLE = 4_000
SPREAD = 4

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def hilbert_key(point: list[int], bits: int) -> int:
    """Place on the Hilbert curve of a point with ``bits`` bits per coordinate.

    Works from the highest bit down: each level reads which half the point lies in along
    every axis, as a Gray code, then reflects and swaps axes so the next level's cell is
    entered where the curve left the last.
    """
    x, n = list(point), len(point)
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for axis in range(n):
            if x[axis] & high:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[axis]) & low
                x[0] ^= swap
                x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = 0
    for level in range(bits - 1, 0, -1):
        if x[n - 1] & (1 << level):
            flip ^= (1 << level) - 1
    key = 0
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = key << 1 | ((x[axis] ^ flip) >> level) & 1
    return key


def document_key(text: bytes, hashes: WordHashes) -> int:
    """Hilbert key of a text: the mean direction of its words, brought to its length's scale."""
    words = text.lower().split()
    if not words:
        return 0
    h = hashes.of(words)
    cells = []
    for d in range(DIMENSIONS):
        part = (h >> np.uint64(21 * d)) & np.uint64((1 << 21) - 1)
        mean = (float(part.mean()) / (1 << 20) - 1.0) * len(h) ** 0.5
        cells.append(int(min(max((mean + 2.5) / 5.0, 0.0), 0.9999999) * (1 << BITS)))
    return hilbert_key(cells, BITS)


def _place(key: int, doc_id: int | None) -> int:
    """Key and, below it, 31 hash bits of the id."""
    return key << 31 | zlib.crc32(str(doc_id).encode()) >> 1


def _keyed(bounds: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            places = [_place(document_key(t or b"", hashes), d) for t, d in zip(texts, batch.column("doc_id").to_pylist())]
            ranges = [bisect.bisect_right(bounds, p) for p in places]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text": batch.column("text"),
                "place": pa.array(places, pa.int64()), "range": pa.array(ranges, pa.int32()),
            })

    return run


KEYED = "doc_id bigint, text string, place bigint, range int"


def _cuts(tokens: int) -> list[int]:
    """Sequence lengths of the tokens left at the end of a range: powers of two, falling."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


def _pack(path: str, split: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path, split).encode
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        open_rows: list[tuple[int | None, int, bytes, int]] = []  # not yet in a full sequence
        open_tokens = 0

        def close(lengths: list[int]) -> None:
            """Put the open rows, in order, into sequences of the given lengths."""
            nonlocal sequence
            at, room = 0, list(reversed(lengths))
            for doc, start, ids, total in open_rows:
                done, count = 0, len(ids) // 4
                while done < count:
                    take = min(count - done, room[-1] - at)
                    out.append((doc, start + done, take, zlib.crc32(ids[4 * done : 4 * (done + take)]), total, sequence, at))
                    done, at = done + take, at + take
                    if at == room[-1]:
                        room.pop()
                        sequence, at = sequence + 1, 0
            open_rows.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            names = [c.split()[0] for c in PIECES.split(", ")]
            batch = pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
            out.clear()
            return batch

        for batch in pieces(batches, 128):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                total = len(ids) // 4
                full = (open_tokens + total) // LENGTH
                if not full:
                    open_rows.append((doc, 0, ids, total))
                    open_tokens += total
                    continue
                left = open_tokens + total - full * LENGTH
                open_rows.append((doc, 0, ids[: 4 * (total - left)], total))
                close([LENGTH] * full)
                if left:
                    open_rows.append((doc, total - left, ids[4 * (total - left) :], total))
                open_tokens = left
            yield rows()
        close(_cuts(open_tokens))
        yield rows()

    return run


def pack(docs: DataFrame, tokenizer: str, split: str, end_id: int, partitions: int | None = None) -> DataFrame:
    """One row per piece: where it comes from and where it stands in its sequence."""
    rows = narrow(docs, "doc_id", "text")
    stats = rows.agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n")).first()
    partitions = int(partitions or max(1, (stats["size"] or 0) // BYTES_PER_RANGE + 1))
    bounds: list[int] = []
    if partitions > 1:
        chosen = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(max(1, stats["n"] // SAMPLE))) == 0
        sample = rows.where(chosen).limit(4 * SAMPLE).mapInArrow(_keyed([]), KEYED)
        places = sorted(r[0] for r in sample.select("place").collect())
        cuts = partitions * SPREAD
        bounds = sorted({places[i * len(places) // cuts] for i in range(1, cuts)}) if places else []
    ranged = rows.mapInArrow(_keyed(bounds), KEYED).repartition(partitions, "range")
    ordered = ranged.sortWithinPartitions("range", "place", "doc_id")
    return ordered.mapInArrow(_pack(tokenizer, split, end_id), PIECES)
