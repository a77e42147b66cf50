"""Spelling variants: words one edit apart, found by dynamic programming down a sorted list.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  A task scans a sorted list of words for many words at once: the
rows of the banded edit matrix (three cells: one edit leaves the diagonal by
one at most) belong to a *prefix*, so neighbours in the list share the rows of
their longest common prefix, and a range whose shared prefix already costs
more than one edit is left with no row and skipped whole.

Partition.  One edit falls into one part of a word, and what lies before and
behind that part is equal in both words.  Words therefore meet by (length,
part, letters before it, letters behind it): first with the two halves as
parts; a key that more than ``MOST`` words share cuts its part in two again,
down to one letter, where a key has no more words than there are letters.  So
no task holds an unbounded group.  A pair belongs to the part that holds its
first difference, hence it is found in one place.

Defined cases: a null text has no words; a null id counts as empty in the
deletion rule; texts of any length are read whole; repeated rows count again;
ties for a form go to the smallest word in code-point order; an empty table
gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged

#: Words of a key at most before its part is cut again, and rows of a bucket aimed at.
MOST, BUCKET_ROWS = 1_000, 40_000
_BIG = np.int8(9)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def noisy_words(docs: DataFrame, shortest: int = 7, every: int = 31) -> DataFrame:
    """(word, n): the letter runs of all texts in lower case (A-Z only), one letter deleted where crc32 says so.

    A run shorter than ``shortest`` can't become a word of that length, so runs are cut at that length at once.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{shortest},}})"), F.lit(1)))
    low = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    low = low.select("doc", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = low.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = h.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the strings in a row, and where each begins (n + 1)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.append(0, np.cumsum([len(w) for w in words])).astype(np.int64)


def common_prefixes(flat: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Longest common prefix of each string with the one before it; -1 where the key changes."""
    size = np.diff(at)
    lcp = np.full(len(size), -1, np.int64)
    live = np.flatnonzero(key[1:] == key[:-1]) + 1
    lcp[live] = 0
    depth = 0
    while len(live):
        live = live[(size[live] > depth) & (size[live - 1] > depth)]
        live = live[flat[at[live] + depth] == flat[at[live - 1] + depth]]
        depth += 1
        lcp[live] = depth
    return lcp


def one_edit_pairs(key: np.ndarray, middles: list[str], asks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(asker, other, first difference) for all pairs under one key that are exactly one edit apart.

    ``key`` and ``middles`` are sorted together; ``asks`` marks the words that look for others.  The walk goes down the
    sorted list one letter at a time for all askers at once; a node is a range of the list with one shared prefix.
    """
    flat, at = code_points(middles)
    size = np.diff(at)
    lcp = common_prefixes(flat, at, key)
    n = len(size)
    first_of_key = np.flatnonzero(lcp < 0)
    ask = np.flatnonzero(asks)
    lo = first_of_key[np.searchsorted(first_of_key, ask, "right") - 1]
    # the row of the empty prefix: cells for one letter less (none), as many, one more
    row = np.tile(np.array([_BIG, 0, 1], np.int8), (len(ask), 1))
    differs = np.full(len(ask), -1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    flat = np.append(flat, np.uint32(0))

    def letter(word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Code points of the words at 0-based places; 0 outside."""
        inside = (place >= 0) & (place < size[word])
        return np.where(inside, flat[np.where(inside, at[word] + place, 0)], 0)

    def end(word: np.ndarray, row: np.ndarray, other: np.ndarray, differs: np.ndarray, depth: int) -> None:
        """Words that end at this depth: the cell of the asker's length holds the distance."""
        cell = size[word] - depth + 1
        near = (size[other] == depth) & (cell >= 0) & (cell <= 2)
        near[near] = row[near, cell[near]] == 1
        if near.any():
            found.append((word[near], other[near], differs[near]))

    end(ask, row, lo, np.zeros(len(ask), np.int64), 0)  # the empty middle, one letter short of an asker
    depth = 0
    while len(ask):
        depth += 1
        # nodes of this depth and where each node of the last depth ends
        starts = np.flatnonzero((lcp < depth) & (size >= depth))
        borders = np.append(np.flatnonzero(lcp < depth - 1), n) if depth > 1 else np.append(first_of_key, n)
        hi = borders[np.searchsorted(borders, lo, "right")]
        a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
        count = b - a
        of = np.repeat(np.arange(len(ask)), count)
        node = starts[np.repeat(a, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)]
        word, old, differs = ask[of], row[of], differs[of]
        y = flat[at[node] + depth - 1]
        left = np.minimum(old[:, 0] + (letter(word, np.full(len(word), depth - 2)) != y), old[:, 1] + 1)
        here = np.minimum(np.minimum(old[:, 1] + (letter(word, np.full(len(word), depth - 1)) != y), old[:, 2] + 1), left + 1)
        right = np.minimum(old[:, 2] + (letter(word, np.full(len(word), depth)) != y), here + 1)
        m = size[word]
        new = np.stack([left, here, right], 1).astype(np.int8)
        new[:, 0][(depth - 1 > m)] = _BIG
        new[:, 1][(depth > m)] = _BIG
        new[:, 2][(depth + 1 > m)] = _BIG
        differs = np.where((differs < 0) & (new[:, 1] > 0), depth - 1, differs)
        alive = new.min(axis=1) <= 1  # the rest of these ranges costs more than one edit
        ask, lo, row, differs = word[alive], node[alive], new[alive], differs[alive]
        end(ask, row, lo, np.where(differs < 0, depth, differs), depth)
    if not found:
        e = np.empty(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _scan_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """All near pairs of a bucket, each in both directions where only one of the two asks."""
    by = rows.sort_values(["key", "middle"], kind="stable", ignore_index=True)
    number = by["key"].ne(by["key"].shift()).cumsum().to_numpy()
    alone = (np.append(True, number[1:] != number[:-1])) & (np.append(number[1:] != number[:-1], True))
    by, number = by[~alone].reset_index(drop=True), number[~alone]
    short = by["asks"].to_numpy(bool)
    a, b, first = one_edit_pairs(number, by["middle"].tolist(), short)
    ok = (first < by["part"].to_numpy(np.int64)[a]) | by["last"].to_numpy(bool)[a]
    a, b = a[ok], b[ok]
    back = ~short[b]  # the longer word does not ask
    a, b = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
    word, n = by["word"].to_numpy(object), by["n"].to_numpy(np.int64)
    return pd.DataFrame({"word": word[a], "near": word[b], "near_n": n[b]})


def _halved(rows: DataFrame) -> DataFrame:
    """Each row's part (lo to hi of the shorter word's places) cut in two."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    cut = rows.withColumn("p", F.explode(parts)).withColumns({"lo": F.col("p.lo"), "hi": F.col("p.hi")}).drop("p")
    return cut.where("lo < hi")


def _keyed(rows: DataFrame) -> DataFrame:
    behind: Column = F.col("size") - F.col("hi")  # letters behind the part, as many in the longer word
    before = F.substring("word", F.lit(1), F.col("lo"))
    after = F.substring("word", F.length("word") - behind + 1, behind)
    return rows.withColumn("key", F.concat_ws(" ", F.col("size").cast("string"), F.col("lo").cast("string"), F.col("hi").cast("string"), F.concat(before, after)))


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, near, near_n) in both directions for all pairs of distinct ``words`` (word, n) one edit apart."""
    size = F.length("word")
    roles = F.array(F.struct(size.alias("size"), F.lit(True).alias("asks")), F.struct((size - 1).alias("size"), F.lit(False).alias("asks")))
    left = words.select("word", "n", F.inline(roles)).where("size > 0")
    left = _keyed(_halved(left.withColumns({"lo": F.lit(0), "hi": F.col("size").cast("int")})))
    done: list[DataFrame] = []
    while True:
        full = left.groupBy("key").agg(F.count("*").alias("m")).where((F.col("m") > most) & (F.split("key", " ")[2].cast("int") - F.split("key", " ")[1].cast("int") > 1)).select("key")
        full = staged(full, "variant_keys")
        if full.isEmpty():
            done.append(left)
            break
        done.append(left.join(full, "key", "left_anti").select(*left.columns))
        left = staged(_keyed(_halved(left.join(full, "key", "left_semi").drop("key"))), "variant_parts")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    total = words.agg(F.count("*").alias("n")).first()["n"]
    buckets = max(16, -(-4 * total // BUCKET_ROWS))
    middle = F.substring("word", F.col("lo") + 1, F.length("word") - F.col("size") + F.col("hi") - F.col("lo"))
    sent = rows.select(
        "key", "word", "n", "asks", middle.alias("middle"), (F.col("hi") - F.col("lo")).alias("part"), (F.col("hi") == F.col("size")).alias("last"),
        F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"),
    )
    return sent.groupBy("bucket").applyInPandas(_scan_bucket, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last.  A form's count is ten times its word's at least, so
    the chains are as long as the count has digits; each round doubles the steps."""
    now = staged(forms.select("word", F.col("form").alias("root")), "variant_roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        joined = now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        nxt = staged(joined, "variant_roots")
        now = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return now


def variant_forms(docs: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10, every: int = 31, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``shortest`` code points that occurs ``least`` times.

    ``form`` is the near word of largest n if that is ``ratio`` times the word's n at least.  ``docs`` has doc_id, text.
    """
    words = staged(noisy_words(docs.select("doc_id", "text"), shortest, every).where(F.col("n") >= least), "variant_words")
    pairs = near_pairs(words, most)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("b"))
    own = words.join(best, "word", "left")
    fits = -F.col("b.n") >= ratio * F.col("n")
    own = own.select(
        "word", F.when(fits, F.col("b.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, -F.col("b.n")).alias("form_n")
    )
    own = staged(own, "variant_forms")
    ends = roots(own.where("form is not null").select("word", "form"))
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
