"""Word helpers shared by the operators, as column expressions and for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
# Distinct words whose hash a Python worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64
)


def word_count(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra ones cannot clash with working names."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


class WordHashes(dict):
    """64-bit hash by word (bytes), computed on first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KEPT_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Hash of each run of five words, by the word it begins at, and how many there are."""
    end = max(len(h) - SHINGLE + 1, 0)
    return mixed(sum(h[k : end + k] * _ODD[k] for k in range(SHINGLE))), end


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a UTF-8 text.

    A-Z are lower-cased; a text of fewer words is one shingle, a text of none has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = hashes.of(words)
    if len(h) < SHINGLE:
        whole = (h * _ODD[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))
        return mixed(np.array([whole], dtype=np.uint64))
    return np.unique(windows(h)[0])


# Longer words are hashed one by one.
LONG_WORD = 64
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Of a word's next eight bytes so many count.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and where each text's begin, with the end.

    Words are found and hashed side by side, eight bytes at a time, so what a task holds does not
    grow with its distinct words. They are other hashes than those of :class:`WordHashes`.
    """
    flat = b" ".join([b"", *texts, bytes(LONG_WORD)]).lower()
    data = np.frombuffer(flat, dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate([[0], np.cumsum(lengths + 1)]) + 1
    inside = data[: len(flat) - LONG_WORD]
    edges = np.flatnonzero(np.diff(_SPACES[inside])) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(flat) - 7, dtype="<u8", buffer=flat, strides=(1,))
    h = eight[starts] & _BYTES[np.minimum(sizes, 8)]
    h = mixed(h ^ (sizes.astype(np.uint64) * _ODD[0]))
    at, done = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(at):
        h[at] = mixed(h[at] * _ODD[1] ^ (eight[starts[at] + done] & _BYTES[np.minimum(sizes[at] - done, 8)]))
        done += 8
        at = at[sizes[at] > done]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(flat[starts[i] : starts[i] + sizes[i]])
    return h, np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its five-word shingles, as :func:`shingles` defines
    them, by the hashes of :func:`word_hashes`."""
    h, begins = word_hashes([t or b"" for t in texts])
    found, sets = windows(h)[0], []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= SHINGLE:
            items = np.sort(found[a : b - SHINGLE + 1])
            new = np.ones(len(items), dtype=bool)
            np.not_equal(items[1:], items[:-1], out=new[1:])
            sets.append(items[new])
        elif b > a:
            whole = (h[a:b] * _ODD[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mixed(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that little is held as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def as_longs(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones Spark holds."""
    return values.view(np.int64)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column of numpy arrays."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
