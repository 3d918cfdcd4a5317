"""URL filter: rules of host and path, and logistic regression on hashed character n-grams.

A URL's host is what lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; its path goes on to ``?``, ``#`` or the end. A rule fits its host and all
subdomains where the path starts with the rule's; of several the longest decides. Where none
fits the model decides: runs of :data:`GRAMS` bytes of host and path (each between marks for its
ends, counted apart, each part's counts scaled to unit effect) are hashed to
``2**BUCKETS`` weights, fitted by gradient steps with an L2 penalty on a small labelled table.

The table is trained on the driver: at most :data:`MOST_LABELLED` rows, those of lowest hash of
the URL, are taken. Rules are a short list, applied as one expression; scoring is a batch of
array operations per Arrow batch and moves no rows.

Defined cases: a URL that is null or holds no ``://`` has an empty host and path and fits no
rule; a URL without host and path, and any URL if nothing is labelled, scores by the bias alone,
which is 0 without labels; a score of exactly 0.5 allows; labelled rows with a null URL or label
are left out; repeated rows are judged each; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm.text import mixed, narrow

GRAMS = (3, 4)
BUCKETS = 16
MOST_LABELLED = 10_000
STEPS = 1500
RATE = 20.0
PENALTY = 1e-5

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Verdict on a host, its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

# The small labelled table: what sites that a text corpus leaves out are about, and those it wants.
BLOCKED_STEMS = (
    "ads", "adserver", "banner", "track", "tracker", "pixel", "popup", "casino", "poker", "slots", "jackpot", "bets",
    "betting", "lottery", "adult", "porn", "xxx", "cams", "escorts", "dating", "pills", "meds", "viagra", "pharma",
    "spam", "clicks", "coupons", "loans", "replica", "warez", "malware", "phishing",
)
WANTED_STEMS = (
    "library", "museum", "university", "weather", "garden", "recipes", "history", "physics", "literature", "river",
    "mountain", "school", "teacher", "medicine", "hospital", "archive", "newspaper", "journal", "software", "council",
    "theatre", "orchestra", "painting", "travel", "railway", "station", "astronomy", "biology", "kitchen", "children",
    "science", "nation", "other", "another", "nothing", "reading", "writing", "together", "family", "animals", "forest",
    "ocean", "architecture", "lesson", "philosophy", "interest", "thread", "region", "culture", "heritage", "letters",
    "notes", "stories", "cities", "villages", "farming", "harvest", "winter", "shore", "leather", "morning", "thousand",
)
# Words that go with either kind.
_COMPANIONS = ("free", "best", "online", "my", "new", "top", "city", "world", "go", "net", "house", "club", "farm")
_FORMS = ("http://{}.com/", "https://www.{}.net/page/{}", "https://m.{}.org/en/{}.html", "http://blog.{}.com/{}/index")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, blocked``: each stem alone and with three companions, each name in one of four forms."""
    rows = []
    for blocked, stems in ((True, BLOCKED_STEMS), (False, WANTED_STEMS)):
        for i, stem in enumerate(stems):
            one, two, three = (_COMPANIONS[(i * k + k) % len(_COMPANIONS)] for k in (1, 3, 5))
            names = (stem, f"{stem}-{one}", f"{two}-{stem}", f"{stem}{three}")
            rows += [(_FORMS[(i + k) % 4].format(name, 17 * i + k), blocked) for k, name in enumerate(names)]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of ``text`` and ``verdict`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        under = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        answer = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(under & F.startswith(path, F.lit(rule.path)), answer).otherwise(found)
    return found


def _grams(parts: list[str], part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of every run of bytes of one part of many URLs."""
    marked = [b"\x02" + p.encode() + b"\x03" if p else b"" for p in parts]
    sizes = np.array([len(m) for m in marked], dtype=np.int64)
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(parts)), sizes)
    rows, buckets = [], []
    for n in GRAMS:
        count = max(len(data) - n + 1, 0)
        packed = np.full(count, n + 8 * part, dtype=np.uint64)
        for k in range(n):
            packed = (packed << np.uint64(8)) | data[k : k + count]
        whole = row[:count] == row[n - 1 : n - 1 + count]
        rows.append(row[:count][whole])
        buckets.append((mixed(packed[whole]) >> np.uint64(64 - BUCKETS)).astype(np.int64))
    rows, buckets = np.concatenate(rows), np.concatenate(buckets)
    total = np.bincount(rows, minlength=len(parts))
    return rows, buckets, 1 / np.sqrt(np.maximum(total, 1))[rows]


def _features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = _grams(hosts, 0), _grams(paths, 1)
    return tuple(np.concatenate(column) for column in zip(*found))


@dataclass(frozen=True)
class UrlModel:
    """Weight per bucket, and bias, of the probability that a URL is to be blocked."""

    weights: np.ndarray
    bias: float

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        rows, buckets, values = _features(hosts, paths)
        z = np.bincount(rows, weights=self.weights[buckets] * values, minlength=len(hosts)) + self.bias
        return 1 / (1 + np.exp(-z))


def train(hosts: list[str], paths: list[str], blocked: np.ndarray) -> UrlModel:
    """Fit by full gradient steps; the same table in any order gives the same model but for rounding."""
    weights = np.zeros(1 << BUCKETS)
    if not len(hosts):
        return UrlModel(weights, 0.0)
    rows, buckets, values = _features(hosts, paths)
    used, column = np.unique(buckets, return_inverse=True)
    w, bias, y = np.zeros(len(used)), 0.0, blocked.astype(float)
    for _ in range(STEPS):
        z = np.bincount(rows, weights=w[column] * values, minlength=len(y)) + bias
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        w -= RATE * (np.bincount(column, weights=error[rows] * values, minlength=len(used)) + PENALTY * w)
        bias -= RATE * error.sum()
    weights[used] = w
    return UrlModel(weights, float(bias))


def fit(labelled: DataFrame) -> UrlModel:
    """Train on a table of ``url, blocked``."""
    chosen = (
        narrow(labelled, "url", "blocked").dropna()
        .orderBy(F.xxhash64("url"), "url", "blocked").limit(MOST_LABELLED)
        .select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked").collect()
    )
    return train([r.host for r in chosen], [r.path for r in chosen], np.array([r.blocked for r in chosen], dtype=bool))


def judge(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES, model: UrlModel | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row; ``score`` is the model's."""
    if model is None:
        model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)

    @F.pandas_udf("double")
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series(model.scores(host.tolist(), path.tolist()))

    url = narrow(pages, "page_id", "url")
    parts = url.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    scored = ruled.withColumn("score", score("host", "path"))
    own = F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "score",
    )
