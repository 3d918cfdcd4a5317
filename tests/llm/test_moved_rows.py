"""What operators write, shuffle and hold is little beside their input."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wayline.llm import line_dedup, ngram_join, substring_dedup
from wayline.llm.deploy import ship
from wayline.llm.text import WordHashes, mixed

SCHEMA = "doc_id bigint, text string"


@pytest.fixture
def watched(monkeypatch):
    """Each stored table and its plan, by its name."""
    def watch(module):
        found, plans, keep = {}, {}, module.stored

        def stored(df, name):
            found[name] = out = keep(df, name)
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return out

        monkeypatch.setattr(module, "stored", stored)
        return found, plans

    return watch


def test_lines_place_only_variants_that_meet(spark, watched):
    ship(spark)
    found, _ = watched(line_dedup)
    # All lines share their first half; two are one word apart, and one stands twice.
    lines = ["a b c d e " + " ".join(f"{w}{i}" for w in "vwxyz") for i in range(40)]
    lines += [lines[3].replace("x3", "other"), lines[5]]
    docs = spark.createDataFrame(list(enumerate(lines)), SCHEMA)
    gone = {r["doc_id"] for r in line_dedup.line_report(docs).collect() if r["n_dropped"]}
    assert gone == {40, 41}
    assert found["line_variants"].count() == 41 * 11
    assert found["variant_firsts"].count() <= 2
    assert found["judged_lines"].count() == 2


def test_passages_and_bands_move_once(spark, watched):
    ship(spark)
    _, plans = watched(substring_dedup)
    run = " ".join(f"w{i}" for i in range(60))
    texts = [(1, f"a b {run} c"), (2, f"d {run} e f"), (2, f"d {run} e f"), (3, run.replace("w9 ", "x ")), (None, run), (None, run)]
    found = {(r["doc_id"], r["n_repeated"] > 0, r["n_removed"] > 0) for r in substring_dedup.repeat_report(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert found == {(1, True, False), (2, True, True), (3, True, True), (None, True, True)}
    assert "Exchange" not in plans["passages"]
    assert plans["met_buckets"].count("Exchange hashpartitioning(band") == 1 and "bands" not in plans["distinct_paragraphs"]


def test_passages_of_texts_side_by_side():
    rng = np.random.default_rng(7)
    texts = [[f"w{i}".encode() for i in rng.integers(0, 30 if k % 4 else 2, int(n))] for k, n in enumerate(rng.choice([0, 1, 10, 19, 20, 21, 29, 30, 90], 300))]
    hashes = WordHashes()
    at, names = substring_dedup.passages(hashes.of([w for t in texts for w in t]), np.cumsum([len(t) for t in texts]))
    expected, before = {}, 0
    for words in texts:
        h = [np.array([x], dtype=np.uint64) for x in hashes.of(words)]
        factors = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
        three = [int(mixed(sum(h[i + k] * factors[k] for k in range(3)))[0]) for i in range(len(h) - 2)]
        if len(words) >= substring_dedup.LEAST:
            for i in range(len(three) - substring_dedup.ANCHORS + 1):
                anchor = min(range(i, i + substring_dedup.ANCHORS), key=lambda j: (three[j], j))
                if anchor + substring_dedup.LEAST <= len(words):
                    name = np.zeros(1, dtype=np.uint64)
                    for k in range(substring_dedup.LEAST):
                        name = mixed(name ^ h[anchor + k])
                    expected[before + anchor] = int(name[0])
        before += len(words)
    assert dict(zip(at.tolist(), names.tolist())) == expected


def test_counting_shingles_holds_them_once(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40_000 if k % 2 else 1 << 62, 1000, dtype=np.uint64)) for k in range(512)]
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda texts: sets[: len(texts)])
    monkeypatch.setattr(ngram_join, "COUNTED", 500_000)
    batches = [pa.record_batch({"text": pa.array(["x"] * 512)})]
    list(ngram_join._frequent(iter(batches)))
    tracemalloc.start()
    found = list(ngram_join._frequent(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    values, n = np.unique(np.concatenate(sets), return_counts=True)
    assert [b.column("shingle").to_pylist() for b in found] == [values[n >= 4].view(np.int64).tolist()]
    assert found[0].column("n").to_pylist() == n[n >= 4].tolist()
    assert peak < 2 * 8 * sum(map(len, sets))
