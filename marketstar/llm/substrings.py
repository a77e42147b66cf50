"""Repeated windows of words, found by super-k-mer partitioning.

A window is ``window`` consecutive words of one document; its minimiser is the
least ``m``-word run in it under a hash order.  Consecutive windows with one
minimiser travel as one packed string (a super-k-mer) to the minimiser's
bucket.  All windows with one word sequence meet there; sorting their hashes
puts equal ones side by side, and equal hashes are compared word by word, so
the counts are exact.

Skew.  The order puts ``m``-word runs that very many documents share last (a
first pass counts them), so a common line is a minimiser only for windows that
consist of nothing else.  Equal super-k-mers of a task are sent once, and as
they are repeats already, where they came from goes with the documents, not
to the bucket.  A bucket thus gets a hot passage once per task.

Defined cases: null and empty texts have no words; a text of fewer words than
a window loses nothing; null ids and repeated rows are documents of their own
(equal rows lose the same words); an empty table gives an empty result; long
texts are cut between windows, never inside one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged
from marketstar.llm.text import U64, Chunk, Words, chunks, mix64, rows_at, run_hashes, word_hashes, words

MINIMISER = 4
_CHUNK = 2 << 20
_HEAVY = U64(1) << U64(63)


def _order(h: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The runs' places in the minimiser order: heavy runs after all others."""
    o = h >> U64(1)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
        o[heavy[at] == h] |= _HEAVY
    return o


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _heavy_runs(m: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column("text"), _CHUNK):
                w = words(c)
                doc, at = rows_at(w.doc_at, m)
                runs = run_hashes(word_hashes(c.data, w), m)
                runs = np.sort(runs[at]) if len(at) else np.empty(0, U64)
                yield pa.RecordBatch.from_pydict({"run": pa.nulls(1, pa.int64()), "n": pa.array([len(runs)], pa.int64())})
                first = np.flatnonzero(np.append(True, runs[1:] != runs[:-1])) if len(runs) else np.empty(0, np.int64)
                n = np.diff(np.append(first, len(runs)))
                often = n >= max(2, share * c.n)
                yield pa.RecordBatch.from_pydict({"run": pa.array(runs[first][often].view(np.int64)), "n": pa.array(n[often])})

    return run


def super_kmers(c: Chunk, w: Words, h: np.ndarray, window: int, m: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, minimiser) of each super-k-mer of a chunk."""
    doc, at = rows_at(w.doc_at, window)
    if not len(at):
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, U64)
    least = _sliding_min(_order(run_hashes(h, m), heavy), window - m + 1)[at]
    new = np.append(True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), least[first]


def _normalised(c: Chunk, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of a chunk each followed by one space, and where each begins."""
    length = w.end - w.start + 1
    at = np.cumsum(length) - length
    total = int(length.sum())
    source = np.arange(total) - np.repeat(at - w.start, length)
    out = c.data[np.minimum(source, max(0, len(c.data) - 1))] if total else np.empty(0, np.uint8)
    out[at + length - 1] = 32
    return out, np.append(at, total)


def _send(window: int, m: int, heavy: np.ndarray, buckets: int):
    """Tasks over documents: one row per chunk and bucket, holding strings and origins, or decided origins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column("doc_id")
            no_id = np.asarray(ids.is_null())
            number = ids.fill_null(0).to_numpy(zero_copy_only=False)
            key = batch.column("text_key").to_numpy(zero_copy_only=False)
            for c in chunks(batch.column("text"), _CHUNK):
                w = words(c)
                start, count, least = super_kmers(c, w, word_hashes(c.data, w), window, m, heavy)
                if not len(start):
                    continue
                text, at = _normalised(c, w)
                raw = text.tobytes()
                doc = np.searchsorted(w.doc_at, start, "right") - 1
                lo, hi = at[start], at[start + count + window - 1]
                first = start - w.doc_at[doc]
                row = doc + c.first
                seen: dict[bytes, int] = {}
                twice: list[int] = [0] * len(start)
                for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
                    j = seen.setdefault(raw[a:b], i)
                    if j != i:
                        twice[j] = twice[i] = 1
                twice_at = np.asarray(twice, bool)
                bucket = (mix64(least) % U64(buckets)).astype(np.int64)
                # repeats inside this task: all their windows go; spans by document, spread over the buckets
                own = np.flatnonzero(twice_at)
                spread = (mix64(key[row[own]].view(U64) + U64(7)) % U64(buckets)).astype(np.int64)
                sent = np.fromiter(seen.values(), np.int64, len(seen))  # each string once
                out_bucket, out_body = [], []
                order = sent[np.argsort(bucket[sent], kind="stable")]
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    strings = b"".join(raw[lo[i] : hi[i]] for i in part)
                    head = np.stack([hi[part] - lo[part], count[part], twice_at[part], number[row[part]], key[row[part]], first[part], no_id[row[part]]], 1).astype("<i8")
                    out_bucket.append(int(bucket[part[0]]))
                    out_body.append(press.compress(struct.pack("<q", len(part)) + head.tobytes() + strings))
                by = np.argsort(spread, kind="stable")
                for part in np.split(by, np.flatnonzero(np.diff(spread[by])) + 1) if len(own) else []:
                    i = own[part]
                    head = np.stack([np.full(len(i), -1), count[i], np.ones(len(i), np.int64), number[row[i]], key[row[i]], first[i], no_id[row[i]]], 1).astype("<i8")
                    out_bucket.append(int(spread[part[0]]))
                    out_body.append(press.compress(struct.pack("<q", len(i)) + head.tobytes()))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(out_bucket, pa.int64()), "body": pa.array(out_body, pa.binary())})

    return run


def repeated_windows(strings: list[bytes], weight: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct packed strings: per window, whether its words occur as a window more than once.

    Returns (first window of each string (n + 1), flags).  ``weight`` is 2 for a string that occurs more than once.
    """
    data = np.frombuffer(b"".join(strings), np.uint8)
    offsets = np.append(0, np.cumsum([len(s) for s in strings]))
    c = Chunk(0, data, offsets)
    w = words(c)
    doc, at = rows_at(w.doc_at, window)
    per = np.bincount(doc, minlength=len(strings))
    first = np.append(0, np.cumsum(per))
    flag = (weight > 1)[doc]
    hashes = run_hashes(word_hashes(data, w), window)[at]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    lo, hi = w.start[at], w.end[at + window - 1]
    raw = data.tobytes()
    for a in np.flatnonzero(np.append(same, False) & ~np.append(False, same)):  # runs of equal hashes
        b = a + 1
        while b < len(same) and same[b]:
            b += 1
        by_words: dict[bytes, list[int]] = {}
        for i in order[a : b + 1].tolist():
            by_words.setdefault(raw[lo[i] : hi[i]], []).append(i)
        for members in by_words.values():
            if len(members) > 1:
                flag[members] = True
    return first, flag


def _count(window: int):
    """A bucket: sorts and counts its windows, returns the covered word spans of each document."""

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        index: dict[bytes, int] = {}
        weight: list[int] = []
        heads, string_of = [], []
        for body in bucket["body"]:
            body = opener.decompress(body)
            (n,) = struct.unpack_from("<q", body)
            head = np.frombuffer(body, "<i8", n * 7, 8).reshape(n, 7)
            at = 8 + n * 56
            which = np.full(n, -1)
            for i, size in enumerate(head[:, 0].tolist()):
                if size >= 0:
                    s = body[at : at + size]
                    at += size
                    j = index.setdefault(s, len(weight))
                    if j == len(weight):
                        weight.append(0)
                    weight[j] += 2 if head[i, 2] else 1
                    which[i] = j
            heads.append(head)
            string_of.append(which)
        head, which = np.concatenate(heads), np.concatenate(string_of)
        first, flag = repeated_windows(list(index), np.asarray(weight), window) if index else (np.zeros(1, np.int64), np.empty(0, bool))
        spans = []
        decided = which < 0
        if decided.any():
            d = head[decided]
            spans.append(np.stack([d[:, 3], d[:, 4], d[:, 6], d[:, 5], d[:, 5] + d[:, 1] + window - 1], 1))
        single = np.flatnonzero(~decided & (head[:, 2] == 0))
        if len(single):
            # every flagged window of the string a row, relative to the row's first word
            n = head[single, 1]
            base = np.repeat(first[which[single]], n)
            rel = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            hit = flag[base + rel]
            row = np.repeat(single, n)[hit]
            rel = rel[hit]
            if len(row):
                new = np.append(True, (row[1:] != row[:-1]) | (rel[1:] != rel[:-1] + 1))
                a = np.flatnonzero(new)
                z = np.append(a[1:], len(row)) - 1
                r = head[row[a]]
                spans.append(np.stack([r[:, 3], r[:, 4], r[:, 6], r[:, 5] + rel[a], r[:, 5] + rel[z] + window], 1))
        out = np.concatenate(spans) if spans else np.empty((0, 5), np.int64)
        return pd.DataFrame(out, columns=["id", "text_key", "no_id", "first", "end"]).astype("int64")

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        flat, span_at = spans.flatten(), spans.offsets.to_numpy()
        first, end = (np.asarray(flat.field(i)) for i in ("first", "end"))
        n_words, n_removed, kept = [], [], []
        for c in chunks(batch.column("text")):
            w = words(c)
            text, at = _normalised(c, w)
            base = span_at[c.first : c.first + c.n + 1] - span_at[0] if len(span_at) else np.zeros(c.n + 1, np.int64)
            a, z = int(base[0]), int(base[-1])
            doc = np.repeat(np.arange(c.n), np.diff(base))
            edge = np.zeros(len(w.start) + 1, np.int64)
            np.add.at(edge, w.doc_at[doc] + first[a:z], 1)
            np.add.at(edge, w.doc_at[doc] + end[a:z], -1)
            gone = np.cumsum(edge[:-1]) > 0
            keep_byte = np.repeat(~gone, np.diff(at))
            left = np.append(0, np.cumsum(np.diff(at) * ~gone))
            body = text[keep_byte].tobytes()
            lost = np.append(0, np.cumsum(gone))
            for i in range(c.n):
                p, q = int(w.doc_at[i]), int(w.doc_at[i + 1])
                n_words.append(q - p)
                n_removed.append(int(lost[q] - lost[p]))
                kept.append(body[left[p] : left[q]][:-1])
        names = [n for n in batch.schema.names if n not in ("spans", "text")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[*names, "n_words", "n_removed", "kept_text"],
        )


#: Share of all runs that a heavy one has at least, so that there are no more heavy ones than its inverse.
_RUN_SHARE = 2e-6


def heavy_runs(docs: DataFrame, m: int = MINIMISER, share: float = 0.005) -> np.ndarray:
    """Hashes of the ``m``-word runs whose counts reach ``share`` of the documents and ``_RUN_SHARE`` of all runs: half
    a million of them at most, however many and however long the documents are."""
    n = docs.agg(F.count("*").alias("n")).first()["n"]
    # a null run counts all
    found = staged(docs.select("text").mapInArrow(_heavy_runs(m, share), "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n")), "heavy_runs")
    runs = found.where("run is null").agg(F.sum("n").alias("n")).first()["n"] or 0
    found = found.where("run is not null").where(F.col("n") >= max(share * n, _RUN_SHARE * runs)).select("run").collect()
    return np.sort(np.array([r["run"] for r in found], np.int64).view(U64))


def repeated_spans(docs: DataFrame, window: int = 35, bucket_chars: int = 1_000_000) -> DataFrame:
    """Word spans covered by repeated windows: (id, text_key, no_id, first, end), overlapping spans not merged."""
    heavy = heavy_runs(docs)
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(256, size // bucket_chars)
    sent = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(_send(window, MINIMISER, heavy, buckets), "bucket bigint, body binary")
    return sent.groupBy("bucket").applyInPandas(_count(window), "id bigint, text_key bigint, no_id bigint, first bigint, end bigint")


def spans_of_texts(docs: DataFrame, window: int = 35) -> DataFrame:
    """The distinct spans of each (id, text_key, no_id) in one array; copies of a row share it."""
    # a set, made before the exchange as well: equal rows send equal spans
    return repeated_spans(docs, window).groupBy("id", "text_key", "no_id").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = 35, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document with n_words, n_removed and kept_text: its words outside all repeated windows, joined by spaces.

    ``doc_id`` must be a long.  Columns in ``carry`` are kept under their names.
    """
    spans = spans_of_texts(docs, window)
    rows = docs.select("doc_id", *carry, "text").withColumns(
        {"id": F.coalesce("doc_id", F.lit(0)), "text_key": F.xxhash64("text"), "no_id": F.col("doc_id").isNull().cast("long")}
    )
    none = F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)")
    joined = rows.join(spans, ["id", "text_key", "no_id"], "left").select("doc_id", *carry, "text", F.coalesce("spans", none).alias("spans"))
    fields = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in ("doc_id", *carry)]
    return joined.mapInArrow(_strip, ", ".join([*fields, "n_words bigint, n_removed bigint, kept_text string"]))
