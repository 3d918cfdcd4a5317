"""Token ids of a corpus in Simple-8b files, in ascending id order of the documents.

A file row is a segment: whole documents of one shard, their ids coded together. Ids are
coded in blocks of 1,024; each block starts a new 64-bit word at a known offset, so all
blocks of a segment are coded and decoded side by side with array operations. The low four
bits of a word select how many ids it packs and how wide; selector 0 is an escape whose
following word holds one value of more than 60 bits.

Shards are id ranges. Files are written by Spark's committed Parquet writer, so a retried
task replaces its own output.

Defined cases: null and empty texts have only the end id; a null document id sorts last;
repeated ids stand side by side in order of their text's hash; an empty table gives no
files' rows and an empty index; other columns are ignored. A document is never split over
segments, so a segment holds at least one whole document.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayline.llm.text import list_array, narrow, pieces
from wayline.llm.tokens import encoder
from wayline.scratch import shared_folder

BLOCK = 1024
SEGMENT_IDS = 65_536
BYTES_PER_SHARD = 64 << 20

# Fixed values of the coding: ids per word and bits per id, by selector from 1.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

SEGMENTS = "shard int, segment int, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, block_words binary, words binary"


_LIMITS = np.array([(1 << int(w)) - 1 for w in WIDTHS], dtype=np.uint64)


def _width_classes(values: np.ndarray) -> np.ndarray:
    """1 if the first width holds a value, 14 if 60 bits do, 15 if it needs the escape."""
    return np.searchsorted(_LIMITS, values, side="left") + 1


def encode_ids(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code unsigned values: all words, and the word offset at which each block starts."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.empty(0, dtype="<u8"), np.empty(0, dtype="<u4")
    padded = np.zeros((blocks, BLOCK + int(COUNTS[0])), dtype=np.uint64)
    classes = np.ones(padded.shape, dtype=np.uint8)
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(values) - BLOCK * (blocks - 1)
    inside = np.arange(BLOCK) < sizes[:, None]
    padded[:, :BLOCK][inside] = values
    classes[:, :BLOCK][inside] = _width_classes(values)
    # Of each position the first selector, so the one that packs most, whose window all fits.
    choice = np.zeros((blocks, BLOCK), dtype=np.int8)
    for s in range(len(COUNTS), 0, -1):
        n = int(COUNTS[s - 1])
        fits = classes <= s
        width = 1
        # Windows of n that fit, from windows of doubling width.
        while width * 2 <= n and fits.any():
            fits = fits[:, :-width] & fits[:, width:]
            width *= 2
        if not fits.any():
            continue
        if width < n:
            fits = fits[:, : width - n] & fits[:, n - width :]
        choice[fits[:, :BLOCK]] = s
    at = np.zeros(blocks, dtype=np.int64)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    steps = np.concatenate(([1], COUNTS))
    live = np.arange(blocks)
    while len(live):
        rows.append((live, at[live]))
        at[live] += steps[choice[live, at[live]]]
        live = live[at[live] < sizes[live]]
    block = np.concatenate([r[0] for r in rows])
    start = np.concatenate([r[1] for r in rows])
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    selector = choice[block, start]
    words_of = np.where(selector == 0, 2, 1)
    place = np.cumsum(words_of) - words_of
    words = np.zeros(int(words_of.sum()), dtype="<u8")
    for s in range(1, len(COUNTS) + 1):
        chosen = np.flatnonzero(selector == s)
        if len(chosen):
            window = padded[block[chosen, None], start[chosen, None] + np.arange(COUNTS[s - 1])]
            shifts = (4 + np.arange(COUNTS[s - 1]) * WIDTHS[s - 1]).astype(np.uint64)
            words[place[chosen]] = np.bitwise_or.reduce(window << shifts, axis=1) | np.uint64(s)
    escaped = np.flatnonzero(selector == 0)
    words[place[escaped] + 1] = padded[block[escaped], start[escaped]]
    firsts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    return words, place[firsts].astype("<u4")


def decode_ids(words: np.ndarray, block_words: np.ndarray, count: int) -> np.ndarray:
    """The values of :func:`encode_ids`; every block starts at its own offset."""
    if not count:
        return np.empty(0, dtype=np.uint64)
    words = np.ascontiguousarray(words, dtype=np.uint64)
    blocks = len(block_words)
    ends = np.append(block_words[1:], len(words)).astype(np.int64)
    selector = (words & np.uint64(15)).astype(np.int64)
    steps = np.concatenate(([1], COUNTS))
    coded = np.ones(len(words), dtype=bool)
    if (selector == 0).any():
        # A word after an escape is a raw value: walk the blocks side by side to find them.
        coded[:] = False
        at = block_words.astype(np.int64)
        live = np.arange(blocks)
        while len(live):
            coded[at[live]] = True
            at[live] += np.where(selector[at[live]] == 0, 2, 1)
            live = live[at[live] < ends[live]]
    heads = np.flatnonzero(coded)
    block = np.searchsorted(block_words, heads, side="right") - 1
    packed = steps[selector[heads]]
    before = np.cumsum(packed) - packed
    first = np.searchsorted(heads, block_words.astype(np.int64))
    start = block * BLOCK + before - before[first][block]
    out = np.zeros(blocks * BLOCK + int(COUNTS[0]), dtype=np.uint64)
    limit = np.minimum((block + 1) * BLOCK, count)
    for s in range(1, len(COUNTS) + 1):
        chosen = np.flatnonzero(selector[heads] == s)
        if len(chosen):
            lanes = np.arange(COUNTS[s - 1])
            shifts = (4 + lanes * WIDTHS[s - 1]).astype(np.uint64)
            mask = np.uint64((1 << int(WIDTHS[s - 1])) - 1)
            value = (words[heads[chosen], None] >> shifts) & mask
            place = start[chosen, None] + lanes
            real = place < limit[chosen, None]
            out[place[real]] = value[real]
    escaped = np.flatnonzero(selector[heads] == 0)
    out[start[escaped]] = words[heads[escaped] + 1]
    return out[:count]


def _segments(path: str, split: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path, split).encode
        shard = TaskContext.get().partitionId()
        number, total, held, docs, sizes = 0, 0, [], [], []

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            words, starts = encode_ids(ids)
            return pa.record_batch({
                "shard": pa.array([shard], pa.int32()), "segment": pa.array([number], pa.int32()),
                "n_ids": pa.array([len(ids)], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "doc_tokens": list_array([np.array(sizes)], pa.int64()),
                "block_words": pa.array([starts.tobytes()], pa.binary()), "words": pa.array([words.tobytes()], pa.binary()),
            })

        for batch in pieces(batches, 128):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                held.append(ids + end)
                docs.append(doc)
                sizes.append(len(held[-1]) // 4)
                total += sizes[-1]
                if total >= SEGMENT_IDS:
                    yield segment()
                    number, total, held, docs, sizes = number + 1, 0, [], [], []
        if docs:
            yield segment()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, split: str, end_id: int, shards: int | None = None) -> None:
    """Encode all texts and write their ids under ``path``.

    ``tokenizer`` is a vocabulary file every executor can read, ``split`` its kind of
    piece (see :data:`wayline.llm.tokens.CUTS`).
    """
    rows = narrow(docs, "doc_id", "text")
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(rows.sparkSession.sparkContext.defaultParallelism, size // BYTES_PER_SHARD + 1)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(int(shards), *order).sortWithinPartitions(*order)
    ranged.mapInArrow(_segments(tokenizer, split, end_id), SEGMENTS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 16):
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], dtype="<u8")
            ids = decode_ids(words, np.frombuffer(row["block_words"], dtype="<u4"), row["n_ids"]).astype("<u4")
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - row["doc_tokens"]
            yield pa.record_batch({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                "segment": pa.array([row["segment"]] * len(ends), pa.int32()),
                "within": pa.array(starts, pa.int64()), "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                "ids": pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            })


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: ``doc_id, shard, segment, within, n_tokens, ids`` per document.

    ``ids`` are little-endian unsigned 32-bit integers, ``within`` the ids before the
    document in its segment.
    """
    schema = "doc_id bigint, shard int, segment int, within bigint, n_tokens bigint, ids binary"
    return spark.read.schema(SEGMENTS).parquet(path).mapInArrow(_documents, schema)


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document: how many ids stand before it, how many it has, and their checksum.

    Segment sizes are summed from file columns alone: within a shard by window, over
    shards from one row per shard, which is at most one per 64 MB of text.
    """
    sizes = spark.read.schema(SEGMENTS).parquet(path).select("shard", "segment", "n_ids")
    in_shard = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start")
    )
    starts = segments.join(shards, "shard").select("shard", "segment", (F.col("before") + F.col("shard_start")).alias("at"))
    # Decoded and checked in one step: a second one would be another worker to each task, and the ids would pass
    # through the JVM in between.
    rows = spark.read.schema(SEGMENTS).parquet(path).mapInArrow(_indexed, "doc_id bigint, shard int, segment int, within bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("at") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = pa.array([zlib.crc32(b) for b in batch.column("ids").to_pylist()], pa.int64())
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids_crc32", crc)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _checksums(_documents(batches))


def encoded_documents(docs: DataFrame, tokenizer: str, split: str, end_id: int) -> DataFrame:
    """Write the corpus to the shared folder and index it from its files."""
    path = shared_folder(docs.sparkSession, f"token_files/{uuid.uuid4().hex}")
    write_token_files(docs, path, tokenizer, split, end_id)
    return document_index(docs.sparkSession, path)
