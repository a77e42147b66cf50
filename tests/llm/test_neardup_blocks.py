"""Step 2 of the near-duplicate classes: blocks of a bucket, strays, chains over several components."""

from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from marketstar.llm import neardup
from marketstar.llm.common import importable


@pytest.mark.parametrize("sizes,block", [([2000, 1], 64), ([5, 3, 3], 64), ([40, 30, 20, 1, 1], 16), ([3, 3], 2)])
def test_every_two_components_meet_in_a_block(spark, sizes, block):
    rows = [(7, bytes([c]) + i.to_bytes(3, "big"), bytes([c])) for c, n in enumerate(sizes) for i in range(n)]
    main = max(range(len(sizes)), key=lambda c: (sizes[c], c))
    mixed = spark.createDataFrame(rows, "bucket bigint, node binary, root binary").withColumns(
        {"main": F.lit(bytearray([main])), "n_main": F.lit(sizes[main]).cast("long"), "n_rest": F.lit(sum(sizes) - sizes[main]).cast("long")}
    )
    dealt = neardup.blocks_of(mixed, block).collect()
    blocks = defaultdict(set)
    for r in dealt:
        blocks[r["kind"], r["i"], r["j"]].add(bytes(r["node"]))
    met = set()
    for members in blocks.values():
        met |= {frozenset(p) for p in combinations(sorted(members), 2) if p[0][0] != p[1][0]}
    nodes = [bytes(r[1]) for r in rows]
    assert met == {frozenset(p) for p in combinations(nodes, 2) if p[0][0] != p[1][0]}
    if sizes == [2000, 1]:  # one stray travels to each block, the others travel once
        assert len(dealt) == 2000 + len({k for k in blocks if k[0] == "main"}) + 1
    assert max(map(len, blocks.values())) <= 3 * block


@pytest.mark.parametrize("block", [8, 512])
def test_chain_and_strays_equal_all_pairs(spark, block, monkeypatch):
    importable(spark)
    monkeypatch.setattr(neardup, "_BLOCK", block)
    monkeypatch.setattr(neardup, "_TASK_ROWS", 50)
    base = [f"b{i}" for i in range(100)]
    texts = [" ".join([f"c{i}" for i in range(k)] + base[k:]) for k in range(0, 60, 1)]  # each near the next, the ends far apart
    texts += [" ".join(base[:50] + [f"v{k}"] + base[51:]) for k in range(120)]
    texts += [" ".join(base[:20] + [f"s{k}_{i}" for i in range(9)] + base[29:]) for k in range(40)]  # strays under the threshold
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [neardup.shingle_weights(t.encode()) for t in texts]
    group = list(range(len(texts)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if find(i) != find(j) and neardup.probability_jaccard(sets[i], sets[j]) >= 0.8:
            group[find(i)] = find(j)
    want = defaultdict(set)
    for i in range(len(texts)):
        want[find(i)].add(i)
    got = defaultdict(set)
    for r in neardup.duplicate_classes(table).collect():
        got[bytes(r["root"])].add(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(want) > 1 and max(map(len, want.values())) >= 100
