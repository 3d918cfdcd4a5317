"""Components from candidate pairs and blocks, against all pairs."""

import numpy as np

from wayline.llm.components import components
from wayline.llm.linking import linked


def test_block_members_unlike_its_head_are_linked(spark):
    """Chains of drifting sets: few are like the block's smallest node, so later passes find the rest."""
    rng = np.random.default_rng(2)
    sets, node = {}, 0
    for family in range(4):
        items = list(range(family * 1000, family * 1000 + 40))
        for step in range(12):
            items = [*items[2:], family * 1000 + 100 + 2 * step, family * 1000 + 101 + 2 * step]
            sets[node] = set(items)
            node += 1
    order = rng.permutation(len(sets)).tolist()
    sets = {order[i]: s for i, s in sets.items()}
    table = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node bigint, items array<bigint>")
    blocks = spark.createDataFrame([(7, i, len(s), len(s)) for i, s in sets.items()], "block bigint, node bigint, size bigint, rest bigint")
    none = spark.createDataFrame([], "a bigint, b bigint")
    links, found = linked(none, blocks, lambda nodes: table.join(nodes, "node", "left_semi"))
    group = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    for _ in sets:
        for i, j in pairs:
            group[i] = group[j] = min(group[i], group[j])
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {i: got.get(i, i) for i in sets} == group and len(set(group.values())) == 4
    assert {(r["a"], r["b"]) for r in links.collect()} <= set(pairs)


def test_components_of_a_chain_a_star_and_repeated_links(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(200, 201)] * 3 + [(300, 300)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {
        **{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200
    }
