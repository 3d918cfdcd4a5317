"""Language identification by a byte convolutional network, trained and run in numpy.

A window of 256 bytes passes through filters of two, four and six bytes (one weight per
byte value, position and filter), the maximum of each filter over the window, and a
softmax. A text's prediction is the mean over all its windows, by their bytes.

A filter over one-hot bytes is a sum of table entries. For prediction the entries of two
neighbouring bytes are summed beforehand, so each byte pair costs one table row.

Defined cases: a text that is null or holds no letter is ``und`` with score 0, and so is
every text if no labelled one exists; ties go to the language first in code-point order;
repeated rows are predicted each; other columns are never inputs.

Training sees every window of every labelled document outside the held-out fold. The documents
are dealt by hash into rounds, and those of a round into shards of some :data:`SHARD` windows. A task
takes gradient steps over its shard, from the parameters that the round began with; the mean of all
tasks' parameters, by their windows, begins the next round. Only parameters pass through the driver.
Languages weigh inversely to their windows, within bounds. Reruns over the same rows agree.

The filter :func:`known_language` trains the network with one more class, ``und``: texts made
from the labelled ones that are of no language (see :func:`noise`). A text's score is its
highest probability of a language. The least score a text must reach comes from a fifth
of the labelled documents, which training leaves out: per length class all of them are cut to its
shortest length, and half of what all but :data:`SHARE` of them reach is asked for, so that
documents of the known languages stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.text import narrow, pieces, utf8

WINDOW = 256
WIDTHS = (2, 4, 6)
FILTERS = 8
# Windows of a shard, and over how many rounds the documents are dealt if one shard does not hold all.
SHARD = 16_384
ROUNDS = 4
# A small corpus is gone over several times, until so many windows are seen.
SEEN = 120_000
PASSES = 12
# Parameters of a round's shards are added up in so many groups before the driver adds those.
GROUPS = 16
UNKNOWN = "und"
# A fifth of the documents of each language that has some sets the least scores, by length classes
# that begin at these byte counts; a shorter text cannot be judged.
EVERY = 5
FEW = 20
FLOORS = (4, 8, 16, 32, 64, 128, 256)
SHARE = 0.005
MARGIN = 0.5
# Steps in which least scores are measured.
BINS = 65_536
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SYMBOLS = ("0123456789abcdef", _LETTERS, _LETTERS.upper() + _LETTERS + "0123456789+/", "".join(map(chr, range(33, 127))))
# Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, Kana, Han, Hangul.
_SCRIPTS = (0x370, 0x400, 0x590, 0x620, 0x900, 0xE00, 0x3040, 0x4E00, 0xAC00)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


@dataclass(frozen=True)
class Network:
    """Filter weights by width (position, byte, filter), and the softmax layer."""

    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]
    weight: np.ndarray
    bias: np.ndarray


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last padded with zeros, and the bytes in each."""
    count = max(1, -(-len(text) // WINDOW))
    out = np.zeros(count * WINDOW, dtype=np.uint8)
    out[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    sizes = np.full(count, WINDOW)
    sizes[-1] = max(1, len(text) - WINDOW * (count - 1))
    return out.reshape(count, WINDOW), sizes


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def begin(languages: int, seed: int = 5) -> list[np.ndarray]:
    """Parameters to start from (filters, softmax weights, bias), and their sums of squared gradients."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    params.append(rng.normal(0, 0.3, (FILTERS * len(WIDTHS), languages)).astype(np.float32))
    params.append(np.zeros(languages, dtype=np.float32))
    return [*params, *[np.full_like(p, 1e-6) for p in params]]


def descend(state: list[np.ndarray], x: np.ndarray, y: np.ndarray, weights: np.ndarray, passes: int, rng: np.random.Generator) -> None:
    """Stochastic gradient steps with momentum-free Adagrad over the windows ``x``, in place."""
    params, sums = state[: len(state) // 2], state[len(state) // 2 :]
    *filters, weight, bias = params

    def step(i: int, grad: np.ndarray, rate: float) -> None:
        sums[i] += grad * grad
        params[i] -= rate * grad / np.sqrt(sums[i])

    for _ in range(passes):
        order = rng.permutation(len(x))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            bx = x[rows]
            tops, places = [], []
            for f in filters:
                span = WINDOW - len(f) + 1
                act = sum(f[j][bx[:, j : j + span]] for j in range(len(f)))
                places.append(act.argmax(axis=1))
                tops.append(np.maximum(np.take_along_axis(act, places[-1][:, None, :], axis=1)[:, 0], 0))
            hidden = np.concatenate(tops, axis=1)
            error = _softmax(hidden @ weight + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error *= weights[y[rows], None] / len(rows)
            back = (error @ weight.T) * (hidden > 0)
            step(len(filters), hidden.T @ error, 0.1)
            step(len(filters) + 1, error.sum(axis=0), 0.1)
            for i, f in enumerate(filters):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                grad = np.zeros_like(f)
                for j in range(len(f)):
                    byte = np.take_along_axis(bx, places[i] + j, axis=1)
                    np.add.at(grad[j], (byte, np.arange(FILTERS)), part)
                step(i, grad, 0.05)


class Predictor:
    """A network with its tables summed over byte pairs, for batches of windows."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.tables: list[np.ndarray] = []
        # Pair k of every filter wide enough to have one, side by side.
        for k in range(max(WIDTHS) // 2):
            pairs = [(f[2 * k][:, None, :] + f[2 * k + 1][None, :, :]).reshape(65536, FILTERS) for f in net.filters if len(f) > 2 * k]
            self.tables.append(np.concatenate(pairs, axis=1))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of each window."""
        pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        span, narrow_filters = WINDOW - 1, len(WIDTHS) * FILTERS
        act = self.tables[0][pair]
        for k in range(1, len(self.tables)):
            skip = narrow_filters - self.tables[k].shape[1]
            act[:, : span - 2 * k, skip:] += self.tables[k][pair[:, 2 * k :]]
        tops = [
            act[:, : WINDOW - w + 1, i * FILTERS : (i + 1) * FILTERS].max(axis=1) for i, w in enumerate(WIDTHS)
        ]
        return _softmax(np.maximum(np.concatenate(tops, axis=1), 0) @ self.net.weight + self.net.bias)

    def texts(self, texts: list[bytes], chunk: int = 64) -> np.ndarray:
        """Language probabilities of each text: the mean over its windows."""
        parts = [windows(t) for t in texts]
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        x = np.concatenate([p[0] for p in parts])
        size = np.concatenate([p[1] for p in parts])
        found = np.concatenate([self.windows(x[i : i + chunk]) for i in range(0, len(x), chunk)])
        sums = np.zeros((len(texts), found.shape[1]))
        np.add.at(sums, owner, found * size[:, None])
        return sums / np.bincount(owner, weights=size)[:, None]


def labelled(docs: DataFrame) -> DataFrame:
    """Documents to learn from: labelled, with a letter, outside the held-out fold."""
    rows = narrow(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    return rows.select(
        "doc_id", "text", "lang", F.xxhash64(F.lit(11), "doc_id").alias("order"),
        F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(ROUNDS)).alias("round"),
        (F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(EVERY)) == 0).alias("apart"),
    ).where(F.col("text").rlike(r"\p{L}"))


def _counted(rows: DataFrame) -> dict[tuple[str, bool], tuple[int, int]]:
    """Documents and windows by language and by whether they set the least scores."""
    size = F.greatest(F.ceil(F.octet_length("text") / WINDOW), F.lit(1))
    found = rows.groupBy("lang", "apart").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("windows"))
    return {(r["lang"], r["apart"]): (r["n"], r["windows"]) for r in found.collect()}


def _to_bytes(state: list[np.ndarray], kind: type) -> bytes:
    return np.concatenate([a.ravel() for a in state]).astype(kind).tobytes()


def _from_values(values: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    cuts = np.cumsum([a.size for a in like])[:-1]
    return [part.astype(np.float32).reshape(a.shape) for part, a in zip(np.split(values, cuts), like)]


def _learn(
    state: list[np.ndarray], languages: tuple[str, ...], weights: np.ndarray, passes: int, noisy: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gradient steps over a shard: its windows, and the sum of the state it ends with over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(languages)}
        mine, seen = [a.copy() for a in state], 0
        x: list[np.ndarray] = []
        y: list[np.ndarray] = []

        def take() -> None:
            nonlocal seen
            if x:
                bx = np.concatenate(x)
                descend(mine, bx, np.concatenate(y), weights, passes, np.random.default_rng(seen))
                seen += len(bx)
                x.clear()
                y.clear()

        def add(text: bytes, label: str) -> None:
            x.append(windows(text)[0])
            y.append(np.full(len(x[-1]), number[label]))

        held = 0
        for batch in pieces(batches):
            for text, lang, order in zip(utf8(batch, "text"), batch.column("lang").to_pylist(), batch.column("order").to_pylist()):
                add(text, lang)
                if noisy and order & 1:
                    add(noise(text.decode(), order >> 1 & 3, np.random.default_rng(order & (1 << 63) - 1)).encode(), UNKNOWN)
                held += len(text)
                if held > 3 * SHARD * WINDOW:  # a shard is dealt by documents and may be larger than meant
                    take()
                    held = 0
        take()
        if seen:
            summed = [a.astype(np.float64) * seen for a in mine]
            yield pa.record_batch({"n": pa.array([seen], pa.int64()), "state": pa.array([_to_bytes(summed, np.float64)], pa.binary())})

    return run


def _added(table: pa.Table) -> pa.Table:
    """One group's windows and summed states; in the order of their shards, so that reruns agree."""
    table = table.sort_by("shard")
    total = sum(np.frombuffer(value.as_py(), dtype=np.float64) for value in table.column("state"))
    return pa.table({
        "group": table.column("group")[:1], "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
        "state": pa.array([total.tobytes()], pa.binary()),
    })


def train(rows: DataFrame, sizes: dict[str, int], noisy: bool = False) -> Network:
    """Fit the network on all ``rows`` of :func:`labelled`; ``sizes`` tells the windows of each language."""
    sizes = dict(sizes)
    total = sum(sizes.values())
    if noisy:
        sizes[UNKNOWN] = sizes.get(UNKNOWN, 0) + max(1, total // 2)
    languages = tuple(sorted(sizes))
    weights = np.array([np.clip(sum(sizes.values()) / len(sizes) / max(1, sizes[name]), 0.25, 4) for name in languages], dtype=np.float32)
    passes = int(np.clip(-(-SEEN // max(1, total)), 1, PASSES))
    rounds = ROUNDS if total > SHARD else 1
    state = begin(len(languages))
    for k in range(rounds):
        part = rows.where(F.col("round") == k) if rounds > 1 else rows
        shards = -(-total // (SHARD * rounds))
        dealt = part.select("text", "lang", "order", F.xxhash64(F.lit(19), "doc_id", "text").alias("deal")).repartition(shards, "deal")
        learned = dealt.sortWithinPartitions("order", "deal", "lang").mapInArrow(_learn(state, languages, weights, passes, noisy), "n bigint, state binary")
        grouped = learned.select("n", "state", F.spark_partition_id().alias("shard")).withColumn("group", F.pmod("shard", F.lit(GROUPS)))
        found = sorted(grouped.groupBy("group").applyInArrow(_added, "group int, n bigint, state binary").collect(), key=lambda r: r["group"])
        if found:
            mean = sum(np.frombuffer(r["state"], dtype=np.float64) for r in found) / sum(r["n"] for r in found)
            state = _from_values(mean, state)
    params = state[: len(state) // 2]
    return Network(languages, tuple(params[:-2]), params[-2], params[-1])


def fit(docs: DataFrame) -> Network | None:
    """Train on all labelled documents outside the held-out fold; None without any."""
    rows = labelled(docs)
    sizes: dict[str, int] = {}
    for (lang, _), (_, size) in _counted(rows).items():
        sizes[lang] = sizes.get(lang, 0) + size
    return train(rows, sizes) if sizes else None


def noise(text: str, kind: int, rng: np.random.Generator) -> str:
    """A text of no language: letters renamed, in another script, drawn symbols, or a few of them repeated."""
    letters = sorted({c for c in text.lower() if c.isalpha()} | set(_LETTERS))
    if kind == 0:
        return text.translate({ord(a): b for a, b in zip(letters, rng.permutation(letters).tolist())})
    if kind == 1:
        first = _SCRIPTS[rng.integers(len(_SCRIPTS))]
        return text.lower().translate({ord(a): chr(first + b) for a, b in zip(letters, rng.integers(0, 80, len(letters)).tolist())})
    symbols = list(_SYMBOLS[rng.integers(len(_SYMBOLS))])
    if kind == 2:
        return "".join(rng.choice(symbols, len(text)))
    return ("".join(rng.choice(symbols, rng.integers(1, 6))) * len(text))[: len(text)]


def language_scores(predictor: Predictor, texts: list[bytes]) -> np.ndarray:
    """Highest probability of a language for each text."""
    found = predictor.texts(texts)[:, [name != UNKNOWN for name in predictor.net.languages]]
    return found.max(axis=1, initial=0.0)


def least_scores(net: Network, rows: DataFrame) -> np.ndarray:
    """Score that a text must reach, by length class; class 0 is shorter than all :data:`FLOORS`.

    All ``rows`` are scored; scores are counted in :data:`BINS` steps, so the quantile is exact to a step.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net)
        for batch in pieces(batches):
            texts = utf8(batch, "text")
            for k, floor in enumerate(FLOORS):
                cut = [t[:floor] for t in texts if len(t) >= floor]
                if cut:
                    steps = np.minimum(language_scores(predictor, cut) * BINS, BINS - 1).astype(np.int32)
                    yield pa.record_batch({"k": pa.array(np.full(len(cut), k, dtype=np.int32)), "step": pa.array(steps)})

    counts = rows.select("text").mapInArrow(run, "k int, step int").groupBy("k", "step").agg(F.count(F.lit(1)).alias("n"))
    upto = counts.select(
        "k", "step", F.sum("n").over(Window.partitionBy("k").orderBy("step")).alias("upto"),
        F.sum("n").over(Window.partitionBy("k")).alias("all"),
    )
    lowest = upto.where(F.col("upto") > F.floor((F.col("all") - 1) * SHARE)).groupBy("k").agg(F.min("step").alias("step"))
    found = {r["k"]: r["step"] / BINS for r in lowest.collect()}  # one row per length class
    least = [0.0]
    for k in range(len(FLOORS)):
        least.append(MARGIN * found[k] if k in found else least[-1])
    return np.array(least)


def fit_known(docs: DataFrame) -> tuple[Network, np.ndarray] | None:
    """A network that also knows noise, and the least scores; None without labelled documents.

    Every labelled document outside the held-out fold either trains the network or, in languages
    of :data:`FEW` documents and more, a fifth of them by hash, sets the least scores. Where no
    language has so many the training documents set the scores.
    """
    rows = labelled(docs)
    counted = _counted(rows)
    if not counted:
        return None
    names = {lang for lang, _ in counted}
    many = sorted(lang for lang in names if sum(counted.get((lang, part), (0, 0))[0] for part in (False, True)) >= FEW)
    apart = F.col("apart") & F.col("lang").isin(many) if many else F.lit(False)
    sizes = {
        lang: counted.get((lang, False), (0, 0))[1] + (0 if lang in many else counted.get((lang, True), (0, 0))[1]) for lang in names
    }
    net = train(rows.where(~apart), sizes, noisy=True)
    measured = rows.where((apart if many else F.lit(True)) & (F.col("lang") != UNKNOWN))
    return net, least_scores(net, measured)


PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double"


def _predict(net: Network | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net) if net else None
        for batch in pieces(batches):
            texts = utf8(batch, "text")
            known = np.array(batch.column("letters").to_pylist(), dtype=bool)
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if predictor and known.any():
                rows = np.flatnonzero(known)
                found = predictor.texts([texts[i] for i in rows])
                best = found.argmax(axis=1)
                scores[rows] = np.clip(found[np.arange(len(rows)), best], 0.0, 1.0)
                for i, b in zip(rows, best):
                    names[i] = predictor.net.languages[b]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()),
            })

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """Language and score of every whole text."""
    rows = docs.select(
        "doc_id", "text", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(_predict(net), PREDICTED)


def language_report(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def known_language(docs: DataFrame, min_score: float | None = None) -> DataFrame:
    """The documents whose language is known; those without a letter or of a lower score go.

    The score to reach is measured (see :func:`fit_known`) unless ``min_score`` gives one for
    all lengths. Rows pass through as they are, next to their prediction, so nothing is joined.
    """
    fitted = fit_known(docs)
    kept = [f for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(fitted[0]) if fitted else None
        for batch in pieces(batches):
            letters = np.array(batch.column("_letters").to_pylist(), dtype=bool)
            good = np.zeros(batch.num_rows, dtype=bool)
            if predictor and letters.any():
                texts, rows = utf8(batch, "text"), np.flatnonzero(letters)
                texts = [texts[i] for i in rows]
                least = fitted[1][np.searchsorted(FLOORS, [len(t) for t in texts], side="right")] if min_score is None else min_score
                good[rows] = language_scores(predictor, texts) >= least
            yield batch.select([f.name for f in kept]).filter(pa.array(good))

    marked = docs.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(run, docs.schema)
