"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is the weighted set of its five-word shingles; one that occurs n times
weighs 1 + ln n.  Each
shingle's points arrive as a Poisson process with its weight as rate; a point
goes to a random register, which keeps the earliest.  A shingle stops once
its next arrival is later than every register of the text.  Two texts agree in
a register with the probability Jaccard similarity of their weights.  Texts
that agree in all registers of one of the bands are candidates; the exact
similarity of the weights decides, at ``threshold`` or more.

Classes are the connected components of these links:

1. Equal texts are one node.  In each band's bucket all nodes pair with its
   least one only, and each node is verified against the leader with which it
   shares most bands: at most one pair a node, also in huge buckets.
2. Buckets whose nodes still lie in several components are compared across
   them, so no link between two components is lost.  The nodes outside a
   bucket's largest component (often a few strays) meet all its nodes, in
   blocks: the smaller side travels.  A task takes two blocks, computes the
   exact similarities of their texts as matrix products and yields a spanning
   forest of the links between components: at most one pair a node, whatever
   the size of the group.  Buckets of the same nodes are compared once.

Defined cases: null text is empty; texts without words form one class; a text
of one to four words has one shingle, all of its words; a class is named by
its smallest doc_id (null only if all are null), which classes of null or
repeated ids may share, and told apart by its root, the least text MD5 in it;
repeated rows fall into one class; a similarity of just the threshold is a
link; texts of any length are compared whole; an empty table gives an empty
result; columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged
from marketstar.llm.text import U64, chunks, mix64, rows_at, run_hashes, word_hashes, words

SHINGLE = 5
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
_BLOCK = 512
#: Texts compared by one task of step 2, about.
_TASK_ROWS = 4000
_COLUMNS = 8192


def weighted_shingles(c) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, weight) of a chunk, by document; short texts have one shingle of all words."""
    w = words(c)
    h = word_hashes(c.data, w)
    doc, at = rows_at(w.doc_at, SHINGLE)
    runs = run_hashes(h, SHINGLE)
    runs = runs[at] if len(at) else np.empty(0, U64)
    size = np.diff(w.doc_at)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        whole = [int(run_hashes(h[w.doc_at[i] : w.doc_at[i + 1]], int(size[i]), 1000 + int(size[i]))[0]) for i in short]
        doc, runs = np.concatenate([doc, short]), np.concatenate([runs, np.array(whole, U64)])
    order = np.lexsort((runs, doc))
    doc, runs = doc[order], runs[order]
    if not len(doc):
        return doc, runs, np.empty(0)
    first = np.flatnonzero(np.append(True, (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])))
    return doc[first], runs[first], 1.0 + np.log(np.diff(np.append(first, len(doc))))


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """(n, m) registers: per document the element that arrives first in each; 0 for a document without elements."""
    earliest = np.full(n * m, np.inf)
    winner = np.zeros(n * m, U64)
    clock = np.zeros(len(doc))
    seed = mix64(element)  # neighbouring elements must not share arrivals
    arrival = 0
    while len(doc):
        k = int(np.clip(200_000 // len(doc), 1, 64))  # points of each element at once
        step = mix64((seed[:, None] + U64(0x9E3779B97F4A7C15) * np.arange(arrival + 1, arrival + k + 1, dtype=U64)[None, :]).ravel()).reshape(-1, k)
        gap = -np.log(((step >> U64(12)).astype(float) + 0.5) / float(1 << 52)) / weight[:, None]
        time = clock[:, None] + np.cumsum(gap, axis=1)
        cell = (doc[:, None] * m + (mix64(step) % U64(m)).astype(np.int64)).ravel()
        flat = time.ravel()
        np.minimum.at(earliest, cell, flat)
        won = earliest[cell] == flat
        winner[cell[won]] = np.repeat(element, k)[won]
        arrival += k
        clock = time[:, -1]
        go = clock < earliest.reshape(n, m).max(axis=1)[doc]  # early termination
        doc, element, seed, weight, clock = doc[go], element[go], seed[go], weight[go], clock[go]
    return winner.reshape(n, m)


def _registers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = batch.column("node")
        for c in chunks(batch.column("text")):
            doc, element, weight = weighted_shingles(c)
            got = (prob_minhash(doc, element, weight, c.n) >> U64(32)).astype("<u4")
            size = REGISTERS * 4
            body = pa.Array.from_buffers(pa.binary(), c.n, [None, pa.py_buffer(np.arange(0, (c.n + 1) * size, size, dtype=np.int32)), pa.py_buffer(got.tobytes())])
            yield pa.RecordBatch.from_pydict({"node": node.slice(c.first, c.n), "registers": body})


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u4").reshape(n, BANDS, ROWS).astype(U64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64)[None, :], (n, BANDS)).copy()
        for r in range(ROWS):
            key = mix64(key * U64(0x9E3779B97F4A7C15) + regs[:, :, r])
        node = batch.column("node").take(pa.array(np.repeat(np.arange(n), BANDS)))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(key.ravel().view(np.int64)), "node": node})


def probability_jaccard(a: dict, b: dict) -> float:
    """Exact probability Jaccard similarity of two weighted sets; 1 for two empty ones."""
    if not a and not b:
        return 1.0
    common = a.keys() & b.keys()
    if not common:
        return 0.0
    every = list(a.keys() | b.keys())
    x = np.array([a.get(e, 0) for e in every], float)
    y = np.array([b.get(e, 0) for e in every], float)
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    above = np.append(np.cumsum(x[::-1])[::-1], 0)  # sum of x from here on
    below = np.append(0, np.cumsum(y))
    at = np.searchsorted(ratio, ratio, "left")
    both = (x > 0) & (y > 0)
    return float((1.0 / (above[at[both]] / x[both] + below[at[both]] / y[both])).sum())


def shingle_weights(text: bytes) -> dict[tuple, float]:
    w = text.split()
    if len(w) < SHINGLE:
        return {tuple(w): 1.0} if w else {}
    return {s: 1.0 + math.log(n) for s, n in Counter(zip(*(w[i:] for i in range(SHINGLE)), strict=False)).items()}


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, kept_b, of_b = [], None, None
            a, b = batch.column("text_a"), batch.column("text_b")
            for i in range(batch.num_rows):
                ta, tb = a[i].as_buffer().to_pybytes(), b[i].as_buffer().to_pybytes()
                if tb != kept_b:
                    kept_b, of_b = tb, shingle_weights(tb)
                keep.append(probability_jaccard(shingle_weights(ta), of_b) >= threshold - 1e-12)
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    return run


def _similar(texts: pd.Series, threshold: float) -> np.ndarray:
    """Whether each two of the texts are similar enough, as an (n, n) matrix; exact up to 64-bit shingle hashes."""
    n = len(texts)
    docs, hashes, weights, done = [], [], [], 0
    for c in chunks(pa.array(texts, pa.string())):
        d, h, w = weighted_shingles(c)
        docs.append(d + done)
        hashes.append(h)
        weights.append(w)
        done += c.n
    doc, weight = np.concatenate(docs), np.concatenate(weights)
    _, column, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    column = column.reshape(-1)
    size, mass = np.bincount(doc, minlength=n).astype(float), np.bincount(doc, weight, minlength=n)
    shared = often[column] > 1
    order = np.flatnonzero(shared)[np.argsort(column[shared], kind="stable")]
    rank = np.cumsum(np.append(0, np.diff(column[order]) != 0)) if len(order) else order
    common, affinity = np.zeros((n, n)), np.zeros((n, n))
    unit = np.bincount(doc, weight != 1.0, minlength=n) == 0
    for at in range(0, int(rank[-1]) + 1 if len(rank) else 0, _COLUMNS):
        part = order[np.searchsorted(rank, at) : np.searchsorted(rank, at + _COLUMNS)]
        place = rank[np.searchsorted(rank, at) : np.searchsorted(rank, at + _COLUMNS)] - at
        x = np.zeros((n, _COLUMNS), np.float32)
        x[doc[part], place] = 1
        common += x @ x.T
        if not unit.all():
            x[doc[part], place] = np.sqrt(weight[part] / mass[doc[part]])
            affinity += x @ x.T
    union = size[:, None] + size[None, :] - common
    near = (common / np.maximum(union, 1) >= threshold - 1e-9) & unit[:, None] & unit[None, :]
    near |= (size == 0)[:, None] & (size == 0)[None, :]
    # unequal weights: no similarity exceeds the affinity of the normalised weights; the others are computed
    weighed = ~(unit[:, None] & unit[None, :]) & (affinity >= threshold - 1e-4)
    if weighed.any():
        begin = np.append(0, np.cumsum(size)).astype(int)
        by_doc = np.argsort(doc, kind="stable")
        sets = {}
        for i in np.flatnonzero(weighed.any(axis=1)):
            mine = by_doc[begin[i] : begin[i + 1]]
            sets[i] = dict(zip(column[mine].tolist(), weight[mine].tolist(), strict=True))
        for i, j in zip(*np.nonzero(np.triu(weighed, 1)), strict=True):
            near[i, j] = near[j, i] = probability_jaccard(sets[i], sets[j]) >= threshold - 1e-9
    return near


def _connect(threshold: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        """A spanning forest of the links between the components that meet in two blocks of a bucket."""
        block = block.drop_duplicates("node", ignore_index=True)
        near = _similar(block["text"], threshold)
        node = block["node"].to_numpy()
        # nodes of one component are connected already: a step to one of them costs no link
        _, root = np.unique(block["root"].to_numpy(), return_inverse=True)
        members = [np.flatnonzero(root == r) for r in range(int(root.max()) + 1)]
        free = np.ones(len(block), bool)
        out_a, out_b = [], []
        for start in range(len(block)):
            todo = members[root[start]][free[members[root[start]]]].tolist()
            free[todo] = False
            while todo:
                i = todo.pop()
                for j in np.flatnonzero(near[i] & free):
                    if free[j]:
                        out_a.append(max(node[i], node[j]))
                        out_b.append(min(node[i], node[j]))
                        more = members[root[j]][free[members[root[j]]]]
                        free[more] = False
                        todo += more.tolist()
        return pd.DataFrame({"a": out_a, "b": out_b})

    return run


def blocks_of(mixed: DataFrame, block: int) -> DataFrame:
    """The block pairs (bucket, kind, i, j) in which each node of a mixed bucket meets the others.

    ``mixed`` has bucket, node, root, main (the root of most of the bucket's nodes), n_main and n_rest.  Nodes of other
    roots meet each other and those of ``main``; nodes of ``main`` do not meet each other.
    """
    half = block // 2
    cuts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(half)).cast("int"))
    dealt = mixed.withColumns({"rests": cuts("n_rest"), "mains": cuts("n_main"), "is_main": F.col("root") == F.col("main")})
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("own")
    among = F.transform(each("rests"), lambda k: pair("rest", F.least(own, k), F.greatest(own, k)))
    with_main = F.transform(each("mains"), lambda k: pair("main", own, k))
    as_main = F.transform(each("rests"), lambda k: pair("main", k, own))
    # one block of the others meets the main nodes and itself in one go
    small = (F.col("rests") == 1) & (F.col("mains") == 1)
    meets = F.when(small, F.array(pair("both", F.lit(0), F.lit(0)))).when(F.col("is_main"), as_main).otherwise(F.concat(among, with_main))
    return dealt.select("bucket", "node", "root", F.inline(meets))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its connected component.

    Every round takes the least root among neighbours, then jumps to that root's root, until nothing changes; a long path halves each round.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "cc_edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "cc_labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = staged(hooked.join(jump, "root", "left").select("node", "old", F.least(F.col("root"), F.coalesce("up", "root")).alias("root")), "cc_labels")
        changed = new.where("old <> root").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify(threshold), "a binary, b binary")


def duplicate_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Returns doc_id, class_id (smallest doc_id of the class), class_size (rows), node (the text's MD5) and root (the class's least node) per row."""
    text = F.coalesce("text", F.lit(""))
    node = F.unhex(F.md5(text))
    members = staged(docs.select("doc_id", node.alias("node")), "near_members")
    # one row of registers per distinct text
    registers = docs.select(node.alias("node"), text.alias("text")).mapInArrow(_registers, "node binary, registers binary").groupBy("node").agg(F.first("registers").alias("registers"))
    bands = staged(registers.mapInArrow(_bands, "bucket bigint, node binary"), "near_bands")
    shared = bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last").select("bucket", "leader")
    shared = staged(bands.join(shared, "bucket"), "near_shared")

    # 1. every node with the leader it shares most bands with
    stars = (
        shared.where("node <> leader")
        .groupBy("node", "leader")
        .agg(F.count("*").alias("n"))
        .groupBy(F.col("node").alias("a"))
        .agg(F.max(F.struct("n", "leader")).alias("best"))
        .select("a", F.col("best.leader").alias("b"))
    )
    stars = staged(stars, "near_stars")
    wanted = shared.select("node").distinct()
    texts = docs.select(node.alias("node"), text.alias("text")).join(wanted, "node", "left_semi")
    # copies of a text are one row; the hash is the text's, so any of them serves
    texts = staged(texts.groupBy("node").agg(F.first("text").alias("text")), "near_texts")
    links = staged(verified(stars, texts, threshold), "near_links")
    roots = components(links)

    # 2. what lies in one bucket but in different components
    placed = shared.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    per_root = placed.groupBy("bucket", "root").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    buckets = per_root.groupBy("bucket").agg(
        F.count("*").alias("roots"), F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("top"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    buckets = buckets.where("roots > 1").groupBy("all", "x", "y").agg(F.min(F.struct("bucket", "top")).alias("b"))  # the same nodes: once
    buckets = buckets.select("b.bucket", F.col("b.top.root").alias("main"), F.col("b.top.n").alias("n_main"), (F.col("all") - F.col("b.top.n")).alias("n_rest"))
    mixed = staged(blocks_of(placed.join(buckets, "bucket"), _BLOCK), "near_mixed")
    tasks = max(8, -(-mixed.count() // _TASK_ROWS))
    meeting = mixed.join(texts, "node").repartition(tasks, "bucket", "kind", "i", "j")
    more = meeting.groupBy("bucket", "kind", "i", "j").applyInPandas(_connect(threshold), "a binary, b binary")
    more = staged(more.distinct(), "near_more")
    if more.limit(1).count():
        roots = components(links.union(more))

    rooted = members.join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rooted.join(classes, "root").select("doc_id", "class_id", "class_size", "node", "root")


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents less all but one of each class: the row with the smallest doc_id, by text among equal ids."""
    classes = staged(duplicate_classes(docs, threshold), "near_classes")
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("k"))
    keep = best.select(F.col("k.doc_id").alias("__keep_id"), F.col("k.node").alias("__keep_node"))
    noded = docs.withColumn("__node", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    kept = noded.join(keep, noded["doc_id"].eqNullSafe(keep["__keep_id"]) & (noded["__node"] == keep["__keep_node"]), "left_semi")
    repeated = classes.groupBy("doc_id", "node").count().where("count > 1").limit(1).count()
    return (kept.dropDuplicates(["doc_id", "__node"]) if repeated else kept).drop("__node")
