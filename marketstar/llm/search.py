"""Exact top-k inner-product search by MaxScore, sharded.

A query's terms are the vector's components.  In a shard, a term's score
lies between known bounds (its component times the shard's smallest and
largest value), so it counts as its smallest score plus a non-negative rest.
Terms are ordered by the size of that rest: while the k-th best score so far
exceeds what the trailing terms can add, these are non-essential.  The
essential terms' postings (their columns) are traversed for all vectors of the
block; the others are probed a few at a time for the vectors whose bound is
still competitive.  Shards keep their k best per query, a window merges them.

Scores are integer inner products of floor(1024 * x), exact: in doubles while
every sum stays under 2^53, else in Python integers (saturating at long).

Defined cases: rows with a null id, a null vector, or null or non-finite
components take no part; vectors of different lengths are compared as if the
shorter ended in zeros; every row is a candidate of every query but the query's
own row (one row of the same id and vector), also where ids repeat; every query
row has a list of its own, which query_row tells from others of its id; ties go
to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstar.llm.common import staged

SHARD_ROWS = 4096
QUERY_BLOCK = 8192
_BLOCK = 256
_PROBE = 8
_LONG = (1 << 63) - 1


def _matrix(vectors: pd.Series, width: int, scale: float) -> list[list[float]] | np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(np.asarray(v, np.float64) * scale)
    return out


def top_k_block(ids: np.ndarray, docs: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The query's ``k`` best of the rows of ``docs`` (any one numeric type): their places and scores, best first."""
    lo, hi = docs.min(axis=0), docs.max(axis=0)
    low, high = np.minimum(query * lo, query * hi), np.maximum(query * lo, query * hi)
    order = np.argsort(-(high - low).astype(float), kind="stable")
    q, base = query[order], low[order]
    rest = np.concatenate([np.cumsum((high - low)[order][::-1])[::-1], [0]])  # what terms j.. can add to their least
    least = np.concatenate([np.cumsum(base[::-1])[::-1], [0]])  # the least that terms j.. score
    best_rows, best = np.empty(0, np.int64), np.empty(0, docs.dtype)
    for at in range(0, len(docs), _BLOCK):
        block = docs[at : at + _BLOCK]
        keep = np.arange(len(block))
        if len(best) < k:
            scores = block[keep] @ query
        else:
            worst = best[-1]
            # essential: the shortest prefix such that rows with nothing above the least in it cannot compete
            essential = int(np.argmax(least[0] + rest < worst)) if (least[0] + rest < worst).any() else len(q)
            essential = min(max(essential, _PROBE), len(q))
            scores = block[keep][:, order[:essential]] @ q[:essential]
            j = essential
            while True:
                alive = scores + least[j] + rest[j] >= worst
                keep, scores = keep[alive], scores[alive]
                if j >= len(q) or not len(keep):
                    break
                cols = order[j : j + _PROBE]
                scores = scores + block[keep][:, cols] @ q[j : j + _PROBE]
                j = min(j + _PROBE, len(q))
        best_rows, best = np.concatenate([best_rows, at + keep]), np.concatenate([best, scores])
        top = np.lexsort((ids[best_rows], -best))[:k]
        best_rows, best = best_rows[top], best[top]
    return best_rows, best


_FOUND = ["query_id", "query_row", "times", "vec_id", "row_key", "score"]


def _search_shard(k: int, scale: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        queries, docs = rows[rows["is_query"]], rows[~rows["is_query"]]
        if not len(queries) or not len(docs):
            return pd.DataFrame({c: [] for c in _FOUND}).astype("int64")
        width = max(1, int(rows["vec"].map(len).max()))
        d, q = _matrix(docs["vec"], width, scale), _matrix(queries["vec"], width, scale)
        ids, keys = docs["vec_id"].to_numpy(np.int64), docs["row_key"].to_numpy(np.int64)
        if np.abs(d).max(initial=0) * np.abs(q).max(initial=0) * width >= 2**53:
            d, q = (np.vectorize(int, otypes=[object])(m) for m in (d, q))
        else:
            longest = np.argsort(-np.einsum("ij,ij->i", d, d), kind="stable")  # high scores first raise the bound soon
            d, ids, keys = np.ascontiguousarray(d[longest]), ids[longest], keys[longest]
        out = []
        for qid, row, times, query in zip(*(queries[c].to_numpy(np.int64) for c in ("vec_id", "row_key", "times")), q, strict=True):
            got, scores = top_k_block(ids, d, query, k + 1)  # the query's own row may be among them
            out += [(int(qid), int(row), int(times), int(ids[i]), int(keys[i]), max(-_LONG - 1, min(_LONG, int(s)))) for i, s in zip(got, scores, strict=True)]
        return pd.DataFrame(out, columns=_FOUND).astype("int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row) of the ``k`` highest-scoring rows of ``vectors`` for each row of ``queries``.

    Both have vec_id and embedding.  Vectors are numbered in a written table, so that a task run anew deals them alike,
    and dealt to shards by their numbers; queries go to blocks.  A task holds one shard and one block of queries, so its
    memory is bounded whatever the tables' sizes.
    """
    usable = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    row = (F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    # adding zero makes -0.0 and 0.0 one value, as grouping does
    key = F.xxhash64("vec_id", F.transform("vec", lambda x: x + F.lit(0.0)))
    numbered = vectors.where(usable).select(*row, F.monotonically_increasing_id().alias("number"))
    docs = staged(numbered, "search_vectors").withColumns({"row_key": key, "times": F.lit(1).cast("long")})
    asked = queries.where(usable).select(*row).groupBy("vec_id", "vec").agg(F.count("*").alias("times")).withColumn("row_key", key)
    sizes = docs.agg(F.count("*").alias("n")).first()["n"], queries.agg(F.count("*").alias("n")).first()["n"]
    shards, blocks = max(1, -(-sizes[0] // SHARD_ROWS)), max(1, -(-sizes[1] // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["vec_id", "vec", "row_key", "times"]
    dealt = docs.select(*columns, F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int").alias("shard")).select("*", every(blocks).alias("block")).withColumn("is_query", F.lit(False))
    sent = asked.select(*columns, every(shards).alias("shard"), F.pmod("row_key", F.lit(blocks)).cast("int").alias("block")).withColumn("is_query", F.lit(True))
    found = dealt.unionByName(sent).groupBy("shard", "block").applyInPandas(_search_shard(k, scale), ", ".join(f"{c} bigint" for c in _FOUND))
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("row_key") == F.col("query_row"))
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    # one of the rows equal to the query is the query itself
    before = F.coalesce(F.max("own").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    ranked = found.withColumn("own", own).withColumns({"place": F.row_number().over(best), "after": before})
    others = ranked.where("not own or after").withColumn("rank", F.col("place") - F.col("after").cast("int")).where(F.col("rank") <= k)
    listed = others.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return listed.select("query_id", "rank", "vec_id", "score", "query_row")
