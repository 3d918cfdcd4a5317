"""Shingles of a batch at once, sketches of sets, and which sets are made and compared."""

import random

import numpy as np

from wayline.llm.linking import linked, sketch, verified
from wayline.llm.text import SHINGLE, mixed, shingle_sets, word_hashes

PARTS = [b"a", b"bb", b"ABCDEFGH", b"ABCDEFGHI", b" ", b"\n", b"\x0b", b"\x1f", b"\x00", b"\xc3\x89", b"z" * 64, b"z" * 65, b"y" * 130]


def test_words_of_a_batch_are_split_and_hashed_as_one_by_one():
    drawn = random.Random(5)
    texts = [b"", b" ", b"a", b"a\x00 a", b"x" * 16 + b" " + b"x" * 8]
    texts += [b"".join(drawn.choices(PARTS, k=drawn.randrange(40))) for _ in range(400)]
    h, begins = word_hashes(texts)
    names: dict[bytes, int] = {}
    for text, a, b in zip(texts, begins[:-1], begins[1:]):
        words = text.lower().split()
        assert len(words) == b - a
        assert all(names.setdefault(w, x) == x for w, x in zip(words, h[a:b].tolist()))
    assert len(set(names.values())) == len(names)
    assert word_hashes([])[1].tolist() == [0]


def test_shingles_of_a_batch_equal_in_number_and_identity():
    drawn = random.Random(6)
    texts = [" ".join(drawn.choices("abc", k=drawn.randrange(30))).encode() for _ in range(300)] + [None, b"A b C d e", b"a B c D e"]
    found = shingle_sets(texts)
    names: dict[tuple, int] = {}
    for text, items in zip(texts, found):
        words = (text or b"").lower().split()
        expected = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)} or ({tuple(words)} if words else set())
        assert len(items) == len(expected) and (np.diff(items.astype(object)) > 0).all()
        if len(expected) == 1:
            assert names.setdefault(*expected, items[0]) == items[0]
    assert len(set(names.values())) == len(names)
    assert found[-1].tolist() == found[-2].tolist()


def _table(spark, sets, sketches=True):
    rows = [(i, s.view(np.int64).tolist(), sketch(s).tolist()) for i, s in sets.items()]
    table = spark.createDataFrame(rows, "node bigint, items array<bigint>, sketch array<tinyint>")
    return table if sketches else table.drop("sketch")


def test_a_sketch_drops_no_similar_pair(spark):
    rng = np.random.default_rng(4)
    sets, pairs = {}, []
    for n in [*range(1, 40), 100, 128, 129, 170, 400]:
        base = mixed(rng.integers(1, 1 << 62, n).astype(np.uint64))
        for share in (1.0, 0.9, 0.86, 0.8, 0.75, 0.5, 0.0):
            kept = base[: max(round(n * share), 0)]
            more = mixed(rng.integers(1, 1 << 62, rng.integers(0, n - len(kept) + 1) + (not len(kept))).astype(np.uint64))
            sets[len(sets)] = np.unique(base)
            sets[len(sets)] = np.unique(np.concatenate([kept, more]))
            pairs.append((len(sets) - 2, len(sets) - 1))
    # More than 127 in one range: no sketch, so no bound.
    n = len(sets)
    sets[n] = sets[n + 1] = np.arange(1, 300, dtype=np.uint64)
    pairs.append((len(sets) - 2, len(sets) - 1))
    assert not len(sketch(sets[len(sets) - 1]))
    asked = spark.createDataFrame(pairs, "a bigint, b bigint")
    both = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in pairs}
    similar = {p for p, n in both.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    assert 0 < len(similar) < len(pairs)
    for sketches in (True, False):
        assert {tuple(r) for r in verified(asked, _table(spark, sets, sketches)).select("a", "b").collect()} == similar


def test_sets_are_made_only_of_nodes_that_may_meet(spark):
    """A block whose nodes' sizes and rests allow two of them to be similar: the others' sets are not asked for."""
    rng = np.random.default_rng(8)
    one = np.unique(mixed(rng.integers(1, 1 << 62, 50).astype(np.uint64)))
    sets = {1: one, 2: one[:-2], **{i: np.unique(mixed(rng.integers(1, 1 << 62, 10 ** (i - 1)).astype(np.uint64))) for i in range(3, 6)}}
    sizes = {i: len(s) for i, s in sets.items()} | {6: 49, 7: 48}
    blocks = [(7, i, n, 1 if i > 5 else n) for i, n in sizes.items()]
    asked: list[int] = []

    def sets_of(nodes):
        asked.extend(r["node"] for r in nodes.collect())
        return _table(spark, sets).join(nodes, "node", "left_semi")

    none = spark.createDataFrame([], "a bigint, b bigint")
    table = spark.createDataFrame(blocks, "block bigint, node bigint, size bigint, rest bigint")
    _, found = linked(none, table, sets_of)
    assert {r["node"]: r["component"] for r in found.collect()} == {1: 1, 2: 1}
    assert sorted(asked) == [1, 2]
