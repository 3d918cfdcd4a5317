"""Periodic runs of words, by internal pattern matching.

A run is a stretch of a text's words with smallest period ``q`` (words ``q`` apart are equal)
of at least :data:`LEAST_LENGTH` words and :data:`LEAST_EXPONENT` periods that no neighbouring
word extends. Texts are independent; a task handles many at once, each position of them one
entry of the arrays below.

1. **Names.** Prefix doubling names every block of ``2**k`` words so that equal blocks of a text
   have equal names, and orders the positions of a text as its suffix array does as far as blocks
   repeat. Words are told apart exactly, not by hash.
2. **Queries.** A run of period ``q`` in ``[m, 2m)``, ``m = 2**k``, holds a block that begins at
   a multiple of ``m`` and occurs again ``q`` later. The occurrences of a block are one interval
   of the suffix array, and a wavelet tree over it gives the first one from any position on
   (range successor). Blocks that occur once ask nothing. The least ``m`` is the largest with
   ``3 m <= LEAST_LENGTH``; there a run of a smaller period repeats its block one period later.
3. **Progressions.** Occurrences that begin in a window of ``m`` words are an arithmetic
   progression. Of one or two each gives a candidate period. Of more, block and window lie in
   stretches of the progression's difference, and a larger period shifts the one stretch onto
   the other: the distances of their left ends and of their right ends are the candidates.
4. **Runs.** A candidate is extended both ways by names; of equal stretches the smallest period
   is the run's.

Memory grows with the longest text (about 150 bytes a word) and otherwise with
:data:`BATCH_WORDS`.

Defined cases: a text that is null or without words has no runs and collapses to ''; repeated
rows and null ids are handled like any others; other columns play no part; no rows, no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.text import narrow, utf8

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
# Texts are handled together up to so many words; a longer one is handled alone.
BATCH_WORDS = 300_000

Words = list[bytes]
Rewrite = Callable[[int | None, Words], Words]

_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


class WaveletMatrix:
    """Range queries over a fixed array of small non-negative numbers."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.levels = []
        for b in reversed(range(bits)):
            bit = (values >> b) & 1
            ones = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((b, ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least ``least`` in each range ``[left, right)``; -1 without one."""
        none = least >> self.bits != 0
        least = np.where(none, 0, least)
        a, b = left, right
        below = np.zeros(len(left), dtype=np.int64)
        for bit, ones, zeros in self.levels:
            a1, b1 = ones[a], ones[b]
            up = (least >> bit) & 1 == 1
            below += np.where(up, (b - b1) - (a - a1), 0)
            a, b = np.where(up, zeros + a1, a - a1), np.where(up, zeros + b1, b - b1)
        found = np.full(len(left), -1, dtype=np.int64)
        some = np.flatnonzero((below < right - left) & ~none)
        a, b, k = left[some], right[some], below[some]
        value = np.zeros(len(some), dtype=np.int64)
        for bit, ones, zeros in self.levels:
            a1, b1 = ones[a], ones[b]
            n = (b - b1) - (a - a1)
            up = k >= n
            k = np.where(up, k - n, k)
            value += up.astype(np.int64) << bit
            a, b = np.where(up, zeros + a1, a - a1), np.where(up, zeros + b1, b - b1)
        found[some] = value
        return found


class Names:
    """Names of the blocks of ``2**k`` words from every position, and the positions in their order.

    ``begin`` and ``end`` bound the text of each position. A name is the place in the order
    at which its block's positions begin; blocks that a text's end cuts short differ from all others.
    """

    def __init__(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        self.begin, self.end = begin, end
        n = len(words)
        places = np.arange(n, dtype=np.int64)
        self.order = np.argsort(begin.astype(np.int64) * (int(words.max()) + 1) + words)
        key = begin[self.order].astype(np.int64) * (int(words.max()) + 1) + words[self.order]
        self.by_level: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        slots = places
        names = np.empty(n, dtype=np.int32)
        while True:
            fresh = np.ones(len(slots), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(fresh)
            size = np.diff(np.append(first, len(slots)))
            names = names.copy()
            names[self.order[slots]] = np.repeat(slots[first], size)
            sizes = np.ones(n, dtype=np.int32)
            sizes[slots[first]] = size
            self.by_level.append(names)
            self.sizes.append(sizes)
            slots = slots[np.repeat(size > 1, size)]
            if not len(slots):
                break
            at = self.order[slots]
            after = at + (1 << (len(self.by_level) - 1))
            inside = after < end[at]
            second = np.where(inside, names[np.where(inside, after, 0)] + 1, 0)
            key = names[at].astype(np.int64) * (n + 1) + second
            by_key = np.argsort(key)
            self.order[slots] = at[by_key]
            key = key[by_key]

    def same_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``j`` on, where ``i < j`` lie in one text."""
        x, y, end = i.copy(), j.copy(), self.end[i]
        for k in reversed(range(len(self.by_level))):
            names = self.by_level[k]
            inside = y < end
            same = inside & (names[x] == names[np.where(inside, y, 0)])
            x += same.astype(np.int64) << k
            y += same.astype(np.int64) << k
        return y - j

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those before ``j``."""
        x, y, begin = i.copy(), j.copy(), self.begin[i]
        for k in reversed(range(len(self.by_level))):
            names, width = self.by_level[k], 1 << k
            inside = x - width >= begin
            same = inside & (names[np.where(inside, x - width, 0)] == names[np.where(inside, y - width, 0)])
            x -= same.astype(np.int64) << k
            y -= same.astype(np.int64) << k
        return i - x


def _candidates(names: Names, least_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(i, q)`` such that every run of period ``q`` holds some ``i`` and ``i + q``."""
    none = np.empty(0, dtype=np.int64)
    first = (least_length // 3).bit_length() - 1
    if first >= len(names.by_level):
        return none, none
    # Only blocks that repeat are asked about, and only their positions are in the tree.
    n = len(names.order)
    starts = np.flatnonzero(names.sizes[first] > 1)
    if not len(starts):
        return none, none
    kept = np.zeros(n + 1, dtype=np.int64)
    np.add.at(kept, starts, 1)
    np.add.at(kept, starts + names.sizes[first][starts], -1)
    kept = np.cumsum(kept[:n]) > 0
    slot = np.cumsum(kept) - 1
    at = names.order[kept]
    bits = int((names.end - names.begin).max() + 1).bit_length()
    tree = WaveletMatrix(at - names.begin[at], bits)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(first, len(names.by_level)):
        m = 1 << k
        i = np.arange(0, n, m, dtype=np.int64)
        left = names.by_level[k][i].astype(np.int64)
        size = names.sizes[k][left]
        asked = np.flatnonzero((size > 1) & (i + m <= names.end[i]))
        if not len(asked):
            continue
        i, left, size = i[asked], slot[left[asked]], size[asked]
        right, begin = left + size, names.begin[i].astype(np.int64)
        x = i - begin
        if k == first:
            near = tree.successor(left, right, x + 1)
            some = (near >= 0) & (near <= x + m)
            found.append((i[some], (near - x)[some]))
        one = tree.successor(left, right, x + m)
        some = np.flatnonzero((one >= 0) & (one < x + 2 * m))
        i, x, left, right, one, begin = i[some], x[some], left[some], right[some], one[some], begin[some]
        two = tree.successor(left, right, one + 1)
        two = np.where(two < x + 2 * m, two, -1)
        found.append((i, one - x))
        some = np.flatnonzero(two >= 0)
        i, x, left, right, one, two, begin = (v[some] for v in (i, x, left, right, one, two, begin))
        three = tree.successor(left, right, two + 1)
        many = (three >= 0) & (three < x + 2 * m)
        found.append((i[~many], (two - x)[~many]))
        i, p, j = i[many], (two - one)[many], (one + begin)[many]
        # The difference is the block's own period; both stretches are extended by it.
        for q in (
            (j + names.same_after(j, j + p)) - (i + names.same_after(i, i + p)),
            (j - names.same_before(j, j + p)) - (i - names.same_before(i, i + p)),
        ):
            some = (q >= m) & (q < 2 * m)
            found.append((i[some], q[some]))
    i, q = (np.concatenate(part) for part in zip(*found))
    return i, q


def find_runs(
    texts: list[np.ndarray], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[np.ndarray]:
    """Runs of each text, given as word numbers: rows of (start, length, period) by start, period."""
    if least_exponent < 3 or least_length < 3:
        raise ValueError("runs of fewer than three periods or words are not found by this method")
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    empty = np.empty((0, 3), dtype=np.int64)
    if not lengths.sum():
        return [empty] * len(texts)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    begin, end = np.repeat(offsets[:-1], lengths), np.repeat(offsets[1:], lengths)
    names = Names(np.concatenate(texts).astype(np.int64), begin, end)
    i, q = _candidates(names, least_length)
    start = i - names.same_before(i, i + q)
    stop = i + q + names.same_after(i, i + q)
    long = stop - start >= np.maximum(least_length, least_exponent * q)
    start, stop, q = start[long], stop[long], q[long]
    by_place = np.lexsort((q, stop, start))
    start, stop, q = start[by_place], stop[by_place], q[by_place]
    fresh = np.ones(len(q), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, q = start[fresh], stop[fresh], q[fresh]
    by_period = np.lexsort((q, start))
    rows = np.stack([start, stop - start, q], axis=1)[by_period]
    rows[:, 0] -= begin[rows[:, 0]] if len(rows) else 0
    text = np.searchsorted(offsets, start[by_period], side="right") - 1
    return np.split(rows, np.searchsorted(text, np.arange(1, len(texts))))


def collapsed(words: Words, runs: np.ndarray) -> bytes:
    """The words joined by blanks, without those after the first period of a run that holds them."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def made_periodic(doc_id: int | None, words: Words) -> Words:
    """A rewrite for trials: some texts, chosen by id, repeat a stretch of theirs up to the end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _texts(batches: Iterator[pa.RecordBatch], rewrite: Rewrite | None) -> Iterator[tuple[list, list[Words]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part, "text")):
                words = (text or b"").split()
                ids.append(doc_id)
                texts.append(rewrite(doc_id, words) if rewrite else words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _arrow(ids: list, texts: list[Words], least_length: int, least_exponent: int) -> pa.RecordBatch:
    numbers = _Numbers()
    coded = [np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w)) for w in texts]
    runs = find_runs(coded, least_length, least_exponent)
    flat = np.concatenate(runs)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(w) for w in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
            pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row; no shuffle.

    ``runs`` holds (start, length, period) by start, then period; ``collapsed`` is the text
    with each run cut to its first period. ``rewrite`` changes the words of a text beforehand.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches, rewrite):
            yield _arrow(ids, texts, least_length, least_exponent)

    return narrow(docs, "doc_id", "text").mapInArrow(scan, f"doc_id bigint, n_words bigint, runs {_RUN}, collapsed string")


def run_report(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Digests of :func:`periodic_runs`: number of runs, the one of greatest exponent, hashes."""

    def better(best, run):
        higher = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | higher, run).otherwise(best)

    found = periodic_runs(docs, rewrite=rewrite)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), better)
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda t: F.concat(t, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
