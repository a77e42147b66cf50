"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A group is the set of documents with one text.  A partial partition is a
vector of ``k`` part sums; differencing takes the two with the largest spread
(largest minus smallest part) and adds them in opposite order, until one is
left.  Partial partitions add up the same way at every level, so the work is a
tree: groups go to blocks of bounded size, each block is differenced in one
task to one vector, blocks of vectors are differenced again, until one vector
is left.  Going back down, the permutations give each group its shard.

Sums and permutations travel, never members: the driver sees counts alone, a
task one block, and the last level one block of vectors.

Defined cases: a null text is the empty one (0 bytes, one group with the empty
texts); an empty table gives an empty result; repeated rows are documents of
their own, and many equal rows (a hot id) are spread over windows; ties go by
group and id; texts count whole, whatever their length; a group larger than an
equal share has a shard to itself, and differencing balances the others; other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstar.llm.common import staged, utf8_bytes
from marketstar.llm.mixing import BUCKET, in_buckets

BLOCK = 2048


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over vectors of part sums.

    ``sums`` has one row of ``k`` part sums per unit.  Returns the final part
    sums and, per unit, the final part of each of its own parts.
    """
    n, k = sums.shape
    vectors = [row for row in sums.astype(np.int64)]
    trees: list[tuple | int] = list(range(n))
    heap = [(-int(v.max() - v.min()), i, i) for i, v in enumerate(vectors)]
    heapq.heapify(heap)
    nxt = n
    ascending = np.arange(k)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        down = np.argsort(-vectors[a], kind="stable")
        up = np.argsort(vectors[b], kind="stable")
        merged = vectors[a][down] + vectors[b][up]
        # position of each old part in the merged vector
        to_a, to_b = np.empty(k, np.int64), np.empty(k, np.int64)
        to_a[down], to_b[up] = ascending, ascending
        vectors[a] = vectors[b] = None
        vectors.append(merged)
        trees.append((a, to_a, b, to_b))
        heapq.heappush(heap, (-int(merged.max() - merged.min()), nxt, nxt))
        nxt += 1
    place = np.empty((n, k), np.int32)
    todo = [(nxt - 1, ascending)]
    while todo:
        i, perm = todo.pop()
        if i < n:
            place[i] = perm
        else:
            a, to_a, b, to_b = trees[i]
            todo += [(a, perm[to_a]), (b, perm[to_b])]
    return vectors[nxt - 1], place


def _difference_block(k: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("unit", kind="stable")
        sums = np.zeros((len(block), k), np.int64)
        for i, s in enumerate(block["sums"]):
            sums[i, : len(s)] = s
        final, place = difference(sums)
        return pd.DataFrame(
            {
                "unit": block["unit"].to_numpy(),
                "parent": block["parent"].to_numpy(),
                "place": list(place),
                "sums": [final if i == 0 else None for i in range(len(block))],
            }
        )

    return run


def shard_groups(groups: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``groups`` (group string, bytes long, unique groups) with the ``shard`` of each.

    Level 0 differences groups within blocks dealt by the group's hash; every
    further level differences the vectors of ``block`` units.
    """
    n = groups.count()
    parents = max(1, -(-n // block))
    units = groups.select(
        F.col("group").alias("unit"), F.pmod(F.xxhash64("group"), F.lit(parents)).cast("string").alias("parent"), F.array("bytes").alias("sums")
    )
    levels: list[DataFrame] = []
    while True:
        done = staged(
            units.groupBy("parent").applyInPandas(_difference_block(k), "unit string, parent string, place array<int>, sums array<bigint>"),
            "shard_level",
        )
        levels.append(done)
        if parents == 1:
            break
        n, parents = parents, max(1, -(-parents // block))
        units = done.where("sums is not null").select(
            F.col("parent").alias("unit"), F.pmod(F.xxhash64("parent"), F.lit(parents)).cast("string").alias("parent"), "sums"
        )
    # back down: a unit's parts end where its parent's parts end
    final = levels[-1].select("unit", "place")
    for level in reversed(levels[:-1]):
        up = final.select(F.col("unit").alias("parent"), F.col("place").alias("up"))
        final = level.drop("sums").join(up, "parent").select("unit", F.expr("transform(place, p -> up[p])").alias("place"))
    return final.select(F.col("unit").alias("group"), F.col("place")[0].alias("shard"))


def shard_documents(docs: DataFrame, k: int = 24, block: int = BLOCK) -> DataFrame:
    """Shard and slot of every document; shards have near-equal bytes and equal texts stay together.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard and text_group (the text's SHA-256).
    """
    rows = staged(
        docs.select(
            "doc_id",
            (utf8_bytes(F.col("text")) + 8).alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.sha2(F.coalesce("text", F.lit("")), 256).alias("group"),
            F.monotonically_increasing_id().alias("salt"),  # written, so all later passes see the same
        ),
        "shard_rows",
    )
    groups = staged(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard_groups")
    own, left = [], groups.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    # fewer than k groups can each exceed a k-th of all bytes: only these are looked at
    for g in groups.where(F.col("bytes") * k > left).orderBy(F.desc("bytes"), "group").collect():
        if g["bytes"] * (k - len(own)) <= left:
            break
        own.append(g["group"])
        left -= g["bytes"]
    shards = shard_groups(groups.where(~F.col("group").isin(own)), k - len(own), block).withColumn("shard", F.col("shard") + len(own))
    if own:
        places = F.create_map(*[F.lit(x) for pair in zip(own, range(len(own)), strict=True) for x in pair])
        shards = shards.unionByName(groups.where(F.col("group").isin(own)).select("group", places[F.col("group")].alias("shard")))
    keyed = rows.join(shards, "group").withColumns({"id": F.col("doc_id"), "text_key": F.xxhash64("group")})
    # rows of one id and text are alike: which of them takes which slot makes no difference, so many of them are split
    placed = staged(in_buckets(keyed, -(-rows.count() // k)), "shard_placed")
    before = Window.partitionBy("shard").orderBy(*BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", *BUCKET).agg(F.count("*").alias("c")).select("shard", *BUCKET, F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    )
    rank = F.row_number().over(Window.partitionBy("shard", *BUCKET).orderBy("doc_id", "group")) - 1
    return (
        placed.join(offsets, ["shard", *BUCKET])
        .withColumn("slot", (F.col("offset") + rank).cast("long"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
            F.lit(None).cast("int").alias("grown_shard"), F.col("group").alias("text_group"),
        )
    )
