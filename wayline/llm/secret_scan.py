"""Secret scans: fixed patterns, and long tokens that look random for their encoding.

Tokens of twenty or more letters, digits and ``+/_=-`` are tested, with digits or without. The narrowest encoding
that holds a token's characters (hex, base32, lower, alphanumeric, base64) gives its
alphabet; under the hypothesis of independent uniform symbols three tests apply:
chi-squared uniformity over the alphabet, Wald-Wolfowitz runs about the alphabet's middle,
and lag-one serial correlation. The score is the smallest of the three p-values, times
three. Running text is the other hypothesis: the words of every document, of ASCII letters
alone and joined, are cut into strings of each length class in turn and scored alike; what
a task's texts leave over is joined to the next one's, and its last letters are cut into the
classes that still fit. Which words a string joins thus depends on how rows lie in tasks. Their
counts over the whole corpus give each candidate's chance among text of its length.
Benjamini-Hochberg over all candidates at rate ``RATE`` then sets, per length class, the
score a token must reach. Only that table of counts, bounded by the
number of classes, leaves the tasks.

Defined cases: null text is empty; an empty text has no spans and the checksum of the
empty string; repeated rows are scanned each; an empty table gives an empty result; other
columns are ignored. Offsets count code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.text import narrow, pieces
from wayline.scratch import stored

KINDS = ("assign", "access", "hex", "random")
# The patterns asked for.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "api")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ENCODINGS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=",
)
RATE = 0.01
LENGTHS = np.array([20, 24, 32, 48, 64, 96, 128])
WORDS = re.compile(r"(?<![^\s])[A-Za-z]+(?![^\s.,])")
# Where joined words are cut: one string of each length class per cycle.
CUTS = [(int(LENGTHS[:k].sum()), int(LENGTHS[: k + 1].sum())) for k in range(len(LENGTHS))]
CYCLE = int(LENGTHS.sum())
SCORES = 60  # score classes: half decades of the p-value
CLASSES = len(LENGTHS) * SCORES


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    spans = []
    small = text.lower() if text.isascii() else text
    if not text.isascii() or any(n in small for n in NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the standard normal (rational approximation of erfc, error under 2e-7)."""
    x = np.abs(z) / np.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * np.exp(-x * x)
    return np.where(z >= 0, half, 1 - half)


def _rank_table() -> tuple[np.ndarray, np.ndarray]:
    table = np.full((len(ENCODINGS), 128), -1, dtype=np.int16)
    for i, alphabet in enumerate(ENCODINGS):
        for rank, c in enumerate(alphabet):
            table[i, ord(c)] = rank
    return table, np.array([len(a) for a in ENCODINGS])


RANKS, ALPHABETS = _rank_table()


def randomness(tokens: list[str]) -> np.ndarray:
    """Score of each token: three times the smallest p-value of the battery, at most 1."""
    n = np.array([len(t) for t in tokens])
    flat = np.frombuffer("".join(tokens).encode(), dtype=np.uint8)
    owner = np.repeat(np.arange(len(tokens)), n)
    first = np.cumsum(n) - n
    fits = np.minimum.reduceat((RANKS[:, flat] >= 0).astype(np.int8), first, axis=1)
    encoding = fits.argmax(axis=0)
    size = ALPHABETS[encoding].astype(float)
    rank = RANKS[encoding[owner], flat].astype(float)
    counts = np.bincount(owner * 68 + rank.astype(int), minlength=68 * len(tokens)).reshape(-1, 68)
    chi = (counts.astype(float) ** 2).sum(axis=1) * size / n - n
    # Moments of the statistic at small n: mean k-1, variance 2(k-1)(n-1)/n.
    uniform = _normal_tail((chi - (size - 1)) / np.sqrt(2 * (size - 1) * (n - 1) / n))
    inner = np.ones(len(flat), dtype=bool)
    inner[first] = False
    upper = rank >= size[owner] / 2
    change = np.zeros(len(flat))
    change[1:] = (upper[1:] != upper[:-1]) & inner[1:]
    high = np.bincount(owner, weights=upper, minlength=len(tokens))
    both = 2 * high * (n - high)
    spread = np.maximum(both * (both - n), 0) / np.maximum(n * n * (n - 1.0), 1)
    z = (np.bincount(owner, weights=change, minlength=len(tokens)) + 1 - (both / n + 1)) / np.sqrt(np.maximum(spread, 1e-9))
    runs = np.where((high == 0) | (high == n), 0.0, 2 * _normal_tail(np.abs(z)))
    centred = rank - (size[owner] - 1) / 2
    product = np.zeros(len(flat))
    product[1:] = np.where(inner[1:], centred[1:] * centred[:-1], 0.0)
    lag = np.bincount(owner, weights=product, minlength=len(tokens)) / ((size**2 - 1) / 12)
    serial = 2 * _normal_tail(np.abs(lag) / np.sqrt(n - 1.0))
    return np.minimum(1.0, 3 * np.minimum(uniform, np.minimum(runs, serial)))


def classes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Length class and score class (0 is most random) of each token."""
    lengths = np.searchsorted(LENGTHS, [len(t) for t in tokens], side="right") - 1
    scores = np.minimum(SCORES - 1, np.floor(-2 * np.log10(np.maximum(randomness(tokens), 1e-40)))).astype(int)
    return lengths, scores


SCANNED = (
    "doc_id bigint, base array<string>, n_assign bigint, n_access bigint, n_hex bigint, "
    "starts array<int>, ends array<int>, lengths array<int>, scores array<int>, words array<int>, word_counts array<bigint>"
)


def text_strings(letters: str, last: bool) -> tuple[list[str], str]:
    """Strings of each length class in turn, and the letters left over for the next texts.

    Of the ``last`` letters the longest class that fits is cut first; under 20 none fits.
    """
    rounds = len(letters) // CYCLE
    cut = [letters[start + a : start + b] for start in range(0, rounds * CYCLE, CYCLE) for a, b in CUTS]
    rest = letters[rounds * CYCLE :]
    while last and len(rest) >= LENGTHS[0]:
        size = int(LENGTHS[np.searchsorted(LENGTHS, len(rest), side="right") - 1])
        cut.append(rest[:size])
        rest = rest[size:]
    return cut, rest


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    over = ""
    for batch, last in _and_last(pieces(batches, 128)):
        docs, tokens, owners, places, out = batch.column("doc_id").to_pylist(), [], [], [], []
        plain: list[str] = []
        plain_owner: list[int] = []
        for i, text in enumerate(batch.column("text").to_pylist()):
            spans = base_spans(text or "")
            count = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
            out.append((docs[i], [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans], *count))
            for m in TOKEN.finditer(text or ""):
                tokens.append(m[0])
                owners.append(i)
                places.append((m.start(), m.end()))
            # Counts are summed over the corpus: a string over two texts counts with the second.
            cut, over = text_strings(over + "".join(WORDS.findall(text or "")), last and i == batch.num_rows - 1)
            plain += cut
            plain_owner += [i] * len(cut)
        found: list[list[tuple]] = [[] for _ in out]
        if tokens:
            for i, place, length, score in zip(owners, places, *classes(tokens)):
                found[i].append((*place, int(length), int(score)))
        words: list[dict[int, int]] = [{} for _ in out]
        if plain:
            length, score = classes(plain)
            of, n = np.unique(np.array(plain_owner) * CLASSES + length * SCORES + score, return_counts=True)
            for key, count in zip(of.tolist(), n.tolist()):
                words[key // CLASSES][key % CLASSES] = count
        columns = list(zip(*out))
        columns += [[[f[k] for f in row] for row in found] for k in range(4)]
        columns += [[list(w) for w in words], [list(w.values()) for w in words]]
        kinds = [pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 5, pa.list_(pa.int64())]
        names = [c.split()[0] for c in SCANNED.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Each batch with rows, and whether it is the last."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held, False
            held = batch
    if held is not None:
        yield held, True


def accepted_classes(candidates: dict[tuple[int, int], int], words: dict[tuple[int, int], int]) -> set[tuple[int, int]]:
    """Length and score classes that pass Benjamini-Hochberg among all candidates.

    A class's chance is the share of text of its length that is at least as random; for a
    length class without text the nearest below serves.
    """
    chances = {}
    for length, score in candidates:
        near = next((at for at in range(length, -1, -1) if any(w[0] == at for w in words)), None)
        same = {s: n for (at, s), n in words.items() if at == near}
        chances[length, score] = (1 + sum(n for s, n in same.items() if s <= score)) / (1 + sum(same.values()))
    total, seen, passed, reach = sum(candidates.values()), 0, set(), 0.0
    for key in sorted(chances, key=lambda k: chances[k]):
        seen += candidates[key]
        if chances[key] <= RATE * seen / total:
            reach = chances[key]
    passed = {k for k, p in chances.items() if p <= reach}
    return passed


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: those of the patterns, and tokens found to be random."""
    scanned = stored(narrow(docs, "doc_id", "text").mapInArrow(_scan, SCANNED), "secret_scan")
    candidate = scanned.select(F.explode(F.arrays_zip("lengths", "scores")).alias("c")).groupBy("c.lengths", "c.scores").count()
    word = scanned.select(F.explode(F.arrays_zip("words", "word_counts")).alias("w")).groupBy("w.words").agg(F.sum("w.word_counts").alias("n"))
    # At most one row per length and score class each.
    counts = {(r[0], r[1]): r[2] for r in candidate.collect()}
    passed = accepted_classes(counts, {divmod(r[0], SCORES): r[1] for r in word.collect()})
    return scanned.mapInArrow(_report(passed), REPORT)


REPORT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"


def _report(passed: set[tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    order = {k: i for i, k in enumerate(KINDS)}

    def position(span: str) -> tuple[int, int]:
        kind, start, _ = span.split(":")
        return int(start), order[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            shas, spans, random = [], [], []
            for base, *found in zip(*[batch.column(c).to_pylist() for c in ("base", "starts", "ends", "lengths", "scores")]):
                shas.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                more = [f"random:{a}:{b}" for a, b, length, score in zip(*found) if (length, score) in passed]
                random.append(len(more))
                spans.append(",".join(sorted(base + more, key=position) if more else base))
            yield pa.record_batch({
                **{c: batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex")},
                "base_sha256": pa.array(shas, pa.string()), "spans": pa.array(spans, pa.string()), "n_random": pa.array(random, pa.int64()),
            })

    return run
