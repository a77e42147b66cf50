"""Repeated byte strings by prefix-free parsing, for highly repetitive text.

A rolling hash of eight bytes triggers where its low bits are zero, and at the
least hash of any ``reach`` places without such a trigger; what lies between
two triggers, the second one's bytes included, is a phrase.  Triggers depend on
nearby bytes alone, so equal strings hold equal phrases.

1. Every phrase's hash is counted.  A phrase that occurs once can't lie inside
   a repeated string, so only strings whose inner phrases all occur again go on.
2. Neighbouring strings with one least inner phrase travel together, packed, to
   that phrase's bucket; where equal pieces of a task meet, one is sent.
3. A bucket parses its strings once more.  The suffix array of its dictionary
   (its distinct phrases) and that of its parse (the phrases' ranks in order)
   give the corpus order of all string starts: by the rest of the phrase, then
   by the rank of the parse that follows.  Starts side by side in that order
   are compared byte by byte, so that a clash of phrase hashes changes nothing.

Skew.  A phrase of more than ``HEAVY`` occurrences is least only if all inner
phrases are such; these strings (a common passage with little around it) travel
one by one as 128-bit digests, which stand for them, spread by digest, once per
chunk of a task each.  The driver holds no phrase and no string.

Defined cases: a null text is empty; a text shorter than the window keeps all;
null ids and repeated rows are documents of their own (equal rows lose the same
bytes); matches stay inside documents; one string may overlap its repeat; texts
are read whole; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstar.llm.text import U64, chunks, mix64

#: Bytes of a trigger's hash, its usual distance, and the occurrences from which a phrase is heavy.
WIDTH, EVERY, HEAVY = 8, 64, 2_000
_CHUNK = 4 << 20
_EVEN = U64(0x9E3779B97F4A7C15)
_TOP = np.uint32(0xFFFFFFFF)
_END = b"\xff" * WIDTH  # no UTF-8 text holds this byte
_INNER = 32  # usual distance of triggers inside a bucket


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as a little-endian number (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data), U64)
    for k in range(min(8, len(data))):
        part = out[k::8]
        part[:] = padded[k : k + 8 * len(part)].view("<u8")
    return out


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` consecutive entries, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def reach_of(window: int) -> int:
    """Places without a trigger at most; inside a window at least two triggers are then sure, whatever surrounds it."""
    if window < 4 * WIDTH:
        raise ValueError(f"the window must have {4 * WIDTH} bytes or more")
    return (window - WIDTH) // 6


def triggers(eight: np.ndarray, offsets: np.ndarray, reach: int) -> np.ndarray:
    """Places of all triggers; each document's depend on its own bytes alone."""
    n = len(eight)
    if not n:
        return np.empty(0, np.int64)
    h = ((eight * _EVEN) >> U64(32)).astype(np.uint32)
    h = np.where((h & np.uint32(EVERY - 1)) == 0, np.uint32(0), np.minimum(h, _TOP - np.uint32(1)))
    ends = offsets[1:]
    for k in range(1, WIDTH):  # no whole hash this near a document's end
        h[np.maximum(ends - k, offsets[:-1])[ends > offsets[:-1]]] = _TOP
    least = np.zeros(n, np.uint32)
    if n >= reach:
        least[: n - reach + 1] = _sliding(h, reach, np.minimum)
        # spans of places that reach over a document's last whole hash choose none
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.maximum(ends - WIDTH - reach + 2, offsets[:-1]), 1)
        np.add.at(edge, ends, -1)
        least[np.cumsum(edge[:-1]) > 0] = 0
    chosen = _sliding(np.concatenate([np.zeros(reach - 1, np.uint32), least]), reach, np.maximum)
    return np.flatnonzero((h == chosen) & (h != _TOP))


def phrase_hashes(eight: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each ``start`` to its ``stop`` (eight bytes or more)."""
    size = stop - start
    out = size.astype(U64) * _EVEN
    live, at = np.arange(len(start)), start.copy()
    while len(live):
        out[live] = mix64(out[live] + eight[at]) * _EVEN
        last = at == stop[live] - 8
        live = live[~last]
        at = np.minimum(at[~last] + 8, stop[live] - 8)
    return mix64(out)


class Parsed:
    """Phrases of a chunk of whole documents: ``trigger`` places, and ``phrase`` k from trigger[left[k]] to the next one's end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, reach: int):
        self.eight = eight_bytes(data)
        self.trigger = triggers(self.eight, offsets, reach)
        self.doc = np.searchsorted(offsets, self.trigger, "right") - 1
        self.left = np.flatnonzero(self.doc[1:] == self.doc[:-1]) if len(self.doc) else np.empty(0, np.int64)
        # a phrase's number within its document is its first trigger's
        self.first_trigger = np.searchsorted(self.doc, np.arange(len(offsets)))
        self.number = self.left - self.first_trigger[self.doc[self.left]]
        self.hash = phrase_hashes(self.eight, self.trigger[self.left], self.trigger[self.left + 1] + WIDTH)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "text_key"))


def _split_by(bucket: np.ndarray) -> Iterator[np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    if len(order):
        yield from np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)


def _phrases(reach: int, buckets: int):
    """Documents → per chunk and bucket one row: phrase hashes with the document and number of each occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, keys = _keys(batch)
            for c in chunks(batch.column("text"), _CHUNK):
                p = Parsed(c.data, c.offsets, reach)
                doc = p.doc[p.left]
                bucket = (p.hash % U64(buckets)).astype(np.int64)
                out_bucket, out_body = [], []
                for part in _split_by(bucket):
                    part = part[np.argsort(p.hash[part], kind="stable")]
                    used, local = np.unique(doc[part], return_inverse=True)
                    body = [
                        struct.pack("<qq", len(used), len(part)), ids[used + c.first].tobytes(), keys[used + c.first].tobytes(),
                        p.hash[part].tobytes(), local.astype("<u4").tobytes(), p.number[part].astype("<u4").tobytes(),
                    ]
                    out_bucket.append(int(bucket[part[0]]))
                    out_body.append(press.compress(b"".join(body)))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(out_bucket, pa.int64()), "body": pa.array(out_body, pa.binary())})

    return run


def _count_phrases(heavy: int):
    """A bucket of phrases → per document the numbers of its phrases that occur more than once (bit 0: heavy)."""

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        ids, keys, hashes, docs, numbers, base = [], [], [], [], [], 0
        for body in bucket["body"]:
            body = opener.decompress(body)
            m, n = struct.unpack_from("<qq", body)
            ids.append(np.frombuffer(body, "<i8", m, 16))
            keys.append(np.frombuffer(body, "<i8", m, 16 + 8 * m))
            at = 16 + 16 * m
            hashes.append(np.frombuffer(body, "<u8", n, at))
            docs.append(np.frombuffer(body, "<u4", n, at + 8 * n).astype(np.int64) + base)
            numbers.append(np.frombuffer(body, "<u4", n, at + 12 * n))
            base += m
        id_, key, h, doc, number = (np.concatenate(x) for x in (ids, keys, hashes, docs, numbers))
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
        n = np.diff(np.append(first, len(h)))
        count = np.repeat(n, n)
        again = order[count > 1]
        mark = (number[again].astype(np.uint64) << U64(1) | (count[count > 1] > heavy)).astype("<u8")
        by = np.lexsort((mark, doc[again]))
        mark, doc = mark[by], doc[again][by]
        cut = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
        packed = [mark[a:b].astype("<u4").tobytes() for a, b in pairwise([*cut.tolist(), len(doc)])] if len(doc) else []
        return pd.DataFrame({"id": id_[doc[cut]], "text_key": key[doc[cut]], "marks": packed})

    return run


def window_groups(p: Parsed, offsets: np.ndarray, window: int, reach: int, again: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, least inner phrase's order, heavy) of neighbouring windows whose inner phrases all occur again.

    ``again`` and ``heavy`` mark triggers by the phrase that starts there.  A window's inner triggers lie ``reach`` inside.
    """
    t, n_windows = p.trigger, np.maximum(np.diff(offsets) - window + 1, 0)
    inner = window - reach - WIDTH
    has = np.flatnonzero(n_windows)
    begin, stop = offsets[:-1][has], offsets[:-1][has] + n_windows[has]
    points = np.unique(np.concatenate([begin, stop, t - reach + 1, t - inner]))
    owner = np.searchsorted(begin, points, "right") - 1
    points = points[(owner >= 0) & (points < stop[np.maximum(owner, 0)])] if len(begin) else points[:0]
    owner = np.searchsorted(begin, points, "right") - 1
    length = np.minimum(np.append(points[1:], np.iinfo(np.int64).max), stop[owner]) - points
    a, b = np.searchsorted(t, points + reach), np.searchsorted(t, points + inner, "right") - 1  # inner phrases: a to b - 1
    other = np.append(0, np.cumsum(~again))
    fit = (b > a) & (other[np.maximum(b, a)] == other[a])
    points, length, a, b, owner = (x[fit] for x in (points, length, a, b, owner))
    order = np.where(again, 0, np.iinfo(np.uint64).max).astype(U64)
    order[p.left] = np.where(heavy[p.left], U64(1) << U64(63), U64(0)) | p.hash >> U64(1)
    least = np.empty(len(points), U64)
    table, level, span = order, 0, (b - a).astype(np.int64)
    top = np.floor(np.log2(np.maximum(span, 1))).astype(np.int64)
    while (top >= level).any():
        mine = top == level
        least[mine] = np.minimum(table[a[mine]], table[b[mine] - (1 << level)])
        step = 1 << level
        table, level = np.minimum(table[:-step], table[step:]) if len(table) > step else table[:0], level + 1
    new = np.append(True, (least[1:] != least[:-1]) | (points[1:] != points[:-1] + length[:-1]) | (owner[1:] != owner[:-1])) if len(points) else np.empty(0, bool)
    first = np.flatnonzero(new)
    total = np.add.reduceat(length, first) if len(first) else length[:0]
    return points[first], total, least[first], least[first] >= U64(1) << U64(63)


def _send(window: int, reach: int, buckets: int):
    """Documents with marked phrases → per chunk and bucket one row of packed strings and where they come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, keys = _keys(batch)
            marks = batch.column("marks")
            for c in chunks(batch.column("text"), _CHUNK):
                p = Parsed(c.data, c.offsets, reach)
                again, heavy = np.zeros(len(p.trigger), bool), np.zeros(len(p.trigger), bool)
                for k in range(c.n):
                    mark = np.frombuffer(b"".join(marks[c.first + k].as_py() or ()), "<u4")
                    at = p.first_trigger[k] + (mark >> np.uint32(1))
                    at, mark = at[at < p.first_trigger[k + 1]], mark[at < p.first_trigger[k + 1]]
                    again[at] = True
                    heavy[at[(mark & np.uint32(1)) > 0]] = True
                start, count, least, dense = window_groups(p, c.offsets, window, reach, again, heavy)
                if not len(start):
                    continue
                # strings of nothing but heavy phrases go window by window, as digests
                n = np.where(dense, count, 1)
                of = np.repeat(np.arange(len(start)), n)
                start = start[of] + np.where(dense[of], np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), 0)
                count, least, dense = np.where(dense[of], 1, count[of]), least[of], dense[of]
                doc = np.searchsorted(c.offsets, start, "right") - 1
                raw = c.data.tobytes()
                seen: dict[bytes, int] = {}
                same = np.empty(len(start), np.int64)
                for i, (x, y, d) in enumerate(zip(start.tolist(), (start + count + window - 1).tolist(), dense.tolist(), strict=True)):
                    s = hashlib.blake2b(raw[x:y], digest_size=16).digest() if d else raw[x:y]
                    same[i] = seen.setdefault(s, len(seen))
                    if d:
                        least[i] = int.from_bytes(s[:8], "little")
                strings, times = list(seen), np.bincount(same, minlength=len(seen))
                where = np.unique(same, return_index=True)[1]
                bucket = (mix64(least[where]) % U64(buckets)).astype(np.int64)
                first = start - c.offsets[doc]
                out_bucket, out_body = [], []
                order = np.argsort(same, kind="stable")
                upto = np.append(0, np.cumsum(times))
                for part in _split_by(bucket):
                    rows = np.concatenate([order[upto[k] : upto[k + 1]] for k in part])
                    size = np.array([len(strings[k]) for k in part], "<i8")
                    used, local = np.unique(doc[rows], return_inverse=True)
                    body = [
                        struct.pack("<qqq", len(part), len(rows), len(used)), size.tobytes(), times[part].astype("<i8").tobytes(), count[where[part]].astype("<i8").tobytes(), least[where[part]].astype("<u8").tobytes(),
                        local.astype("<u4").tobytes(), first[rows].astype("<i8").tobytes(), ids[used + c.first].tobytes(), keys[used + c.first].tobytes(), *(strings[k] for k in part),
                    ]
                    out_bucket.append(int(bucket[part[0]]))
                    out_body.append(press.compress(b"".join(body)))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(out_bucket, pa.int64()), "body": pa.array(out_body, pa.binary())})

    return run


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def corpus_order(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, order, eight) of all windows of the strings, laid end to end: ``order`` sorts ``start`` as the strings' bytes do.

    The suffix array of the dictionary ranks what is left of a phrase, the suffix array of the parse what follows it.
    """
    data = np.frombuffer(b"".join(s + _END for s in strings), np.uint8)
    size = np.array([len(s) + WIDTH for s in strings], np.int64)
    offsets = np.append(0, np.cumsum(size))
    eight = eight_bytes(data)
    cut = (eight * _EVEN) >> U64(64 - _INNER.bit_length() + 1) == 0
    of = np.repeat(np.arange(len(strings)), size)
    place = np.arange(len(data))
    cut &= place < offsets[of + 1] - 2 * WIDTH + 1  # the end's bytes trigger nothing
    cut[offsets[:-1]] = True
    start = np.flatnonzero(cut)  # a phrase begins at each trigger and holds the next one's bytes
    stop = np.minimum(np.append(start[1:], len(data)) + WIDTH, offsets[of[start] + 1])
    # dictionary: the distinct phrases, in order
    raw = data.tobytes()
    phrases = [raw[x:y] for x, y in zip(start.tolist(), stop.tolist(), strict=True)]
    words = sorted(set(phrases))
    number = dict(zip(words, range(len(words)), strict=True))
    parse = np.fromiter(map(number.__getitem__, phrases), np.int64, len(phrases))
    length = np.array([len(w) for w in words], np.int64)
    word_at = np.append(0, np.cumsum(length))
    letters = np.frombuffer(b"".join(words), np.uint8)
    left = np.repeat(word_at[1:], length) - np.arange(len(letters))  # bytes to the phrase's end
    # its suffix array: first seven bytes and how many there are, then twice as many at a time
    seven = eight_bytes(letters).byteswap() & ~U64(0xFF)
    short = np.minimum(left, 7).astype(U64)
    seven &= ~U64(0) << ((U64(8) - short) * U64(8))
    rank, have = _ranks(seven | short), 7
    while have < int(length.max(initial=0)):
        ahead = np.zeros(len(rank), np.int64)
        more = np.flatnonzero(left > have)
        ahead[more] = rank[more + have] + 1
        rank, have = _ranks(rank * (len(rank) + 1) + ahead), 2 * have
    # suffix array of the parse: phrases' ranks, each string by itself
    string = of[start]
    after = np.bincount(string, minlength=len(strings))
    to_end = np.repeat(np.cumsum(after), after) - np.arange(len(parse))
    parse_rank, have = _ranks(parse), 1
    while have < int(after.max(initial=0)):
        ahead = np.zeros(len(parse), np.int64)
        more = np.flatnonzero(to_end > have)
        ahead[more] = parse_rank[more + have] + 1
        parse_rank, have = _ranks(parse_rank * (len(parse) + 1) + ahead), 2 * have
    # both together: every window by the rest of its phrase, then by what follows
    windows = np.flatnonzero(place + window <= offsets[of + 1] - WIDTH)
    phrase = np.cumsum(cut)[windows] - 1
    follows = np.append(parse_rank[1:] + 1, 0)[phrase] * (to_end[phrase] > 1)
    key = rank[word_at[parse[phrase]] + windows - start[phrase]].astype(U64) * U64(len(parse) + 2) + follows.astype(U64)
    return windows, np.argsort(key, kind="stable"), eight


def repeated_windows(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each string's windows begin (n + 1), flags): windows whose bytes occur as a window elsewhere in ``strings``."""
    n = np.maximum(np.array([len(s) for s in strings], np.int64) - window + 1, 0)
    first = np.append(0, np.cumsum(n))
    flag = np.zeros(int(first[-1]), bool)
    if not len(flag):
        return first, flag
    start, order, eight = corpus_order(strings, window)
    a, b = start[order[:-1]], start[order[1:]]
    same = np.arange(len(a))
    for at in [0, window - 8, *range(8, window - 8, 8)]:  # neighbours in corpus order, byte by byte
        same = same[eight[a[same] + at] == eight[b[same] + at]]
    flag[order[same]] = True
    flag[order[same + 1]] = True
    return first, flag


def _decide(window: int):
    """A bucket of strings → byte spans of documents covered by repeated windows."""

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        index: dict[bytes, int] = {}
        weight, windows, least = [], [], []
        which, ids, keys, firsts = [], [], [], []
        for body in bucket["body"]:
            body = opener.decompress(body)
            n, rows, docs = struct.unpack_from("<qqq", body)
            size, times, count = np.frombuffer(body, "<i8", 3 * n, 24).reshape(3, n)
            order = np.frombuffer(body, "<u8", n, 24 + 24 * n)
            at = 24 + 32 * n
            local = np.frombuffer(body, "<u4", rows, at).astype(np.int64)
            firsts.append(np.frombuffer(body, "<i8", rows, at + 4 * rows))
            at += 12 * rows
            ids.append(np.frombuffer(body, "<i8", docs, at)[local])
            keys.append(np.frombuffer(body, "<i8", docs, at + 8 * docs)[local])
            at += 16 * docs
            mine = np.empty(n, np.int64)
            for i, (z, t, c, v) in enumerate(zip(size.tolist(), times.tolist(), count.tolist(), order.tolist(), strict=True)):
                s = body[at : at + z]
                at += z
                j = index.setdefault(s, len(weight))
                if j == len(weight):
                    weight.append(0)
                    windows.append(c)
                    least.append(v)
                weight[j] += t
                mine[i] = j
            which.append(np.repeat(mine, times))
        id_, key, first, string = (np.concatenate(x) for x in (ids, keys, firsts, which))
        strings, often = list(index), np.asarray(weight) > 1
        windows, least = np.asarray(windows, np.int64), np.asarray(least, U64)
        # a string that is alone under its phrase and occurs again needs no order
        _, group, members = np.unique(least, return_inverse=True, return_counts=True)
        whole = np.array([len(s) >= window for s in strings], bool)
        sort = np.flatnonzero(whole & ~(often & (members[group.reshape(-1)] == 1)))
        begin = np.append(0, np.cumsum(windows))
        flag = np.repeat(often, windows)
        at, hit = repeated_windows([strings[k] for k in sort], window)
        if len(sort):
            place = np.repeat(begin[sort], np.diff(at)) + np.arange(len(hit)) - np.repeat(at[:-1], np.diff(at))
            flag[place] |= hit
        # runs of flagged windows of each string, then of every place the string comes from
        new = np.append(True, flag[1:] != flag[:-1]) if len(flag) else np.empty(0, bool)
        new[begin[:-1]] = True
        run_at = np.flatnonzero(new)
        run_to = np.append(run_at[1:], len(flag))
        run_of = np.searchsorted(begin, run_at, "right") - 1
        good = flag[run_at]
        run_at, run_to, run_of = run_at[good], run_to[good], run_of[good]
        per = np.bincount(run_of, minlength=len(strings))
        run_first = np.append(0, np.cumsum(per))
        n = per[string]
        row = np.repeat(np.arange(len(string)), n)
        k = run_first[string[row]] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        lo = first[row] + run_at[k] - begin[string[row]]
        hi = lo + run_to[k] - run_at[k] + window - 1
        # spans of a document that touch become one
        by = np.lexsort((lo, key[row], id_[row]))
        row, lo, hi = row[by], lo[by], hi[by]
        if not len(row):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("id", "text_key", "first", "end")})
        other = np.append(True, (id_[row][1:] != id_[row][:-1]) | (key[row][1:] != key[row][:-1]))
        shift = np.cumsum(other) * (int(hi.max()) + 1)
        top = np.maximum.accumulate(hi + shift)
        cut = np.flatnonzero(np.append(True, (lo + shift)[1:] > top[:-1]))
        last = np.append(cut[1:], len(row)) - 1
        return pd.DataFrame({"id": id_[row[cut]], "text_key": key[row[cut]], "first": lo[cut], "end": (top - shift)[last]})

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        flat, span_at = spans.flatten(), spans.offsets.to_numpy()
        first, end = (np.asarray(flat.field(i)) for i in ("first", "end"))
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for c in chunks(batch.column("text")):
            base = span_at[c.first : c.first + c.n + 1] - span_at[0] if len(span_at) else np.zeros(c.n + 1, np.int64)
            a, z = int(base[0]), int(base[-1])
            doc = np.repeat(np.arange(c.n), np.diff(base))
            # documents one place apart, so that spans of neighbours do not touch
            edge = np.zeros(len(c.data) + c.n + 1, np.int32)
            np.add.at(edge, c.offsets[doc] + doc + first[a:z], 1)
            np.add.at(edge, c.offsets[doc] + doc + end[a:z], -1)
            covered = np.cumsum(edge[:-1]) > 0
            begins = np.append(0, np.cumsum(covered & ~np.append(False, covered[:-1])))[c.offsets + np.arange(c.n + 1)]
            gone = covered[np.arange(len(c.data)) + np.repeat(np.arange(c.n), np.diff(c.offsets))]
            left = np.append(0, np.cumsum(~gone))[c.offsets]
            body = c.data[~gone].tobytes()
            size = np.diff(c.offsets)
            out["n_bytes"] += size.tolist()
            out["n_removed"] += (size - np.diff(left)).tolist()
            out["n_spans"] += np.diff(begins).tolist()
            out["kept"] += [body[x:y] for x, y in pairwise(left.tolist())]
        names = [n for n in batch.schema.names if n not in ("spans", "text")]
        columns = [pa.array(out["kept"], pa.binary()) if k == "kept" else pa.array(out[k], pa.int64()) for k in out]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], names=[*names, *out])


def repeated_spans(rows: DataFrame, window: int = 400, heavy: int = HEAVY) -> DataFrame:
    """(id, text_key, spans): the byte spans of each document covered by strings of ``window`` bytes that occur again.

    ``rows`` has id, text_key and text (not null); a caller that joins the spans with all its columns shares the exchange.
    """
    reach = reach_of(window)
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    coarse, fine = max(16, size // 32_000_000), max(64, size // 2_000_000)
    found = rows.mapInArrow(_phrases(reach, coarse), "bucket bigint, body binary")
    marks = found.groupBy("bucket").applyInPandas(_count_phrases(heavy), "id bigint, text_key bigint, marks binary")
    marked = rows.join(marks.groupBy("id", "text_key").agg(F.collect_set("marks").alias("marks")), ["id", "text_key"])
    # all columns of the rows, so that both joins with the documents share one exchange of them
    sent = marked.select(*rows.columns, "marks").mapInArrow(_send(window, reach, fine), "bucket bigint, body binary")
    spans = sent.groupBy("bucket").applyInPandas(_decide(window), "id bigint, text_key bigint, first bigint, end bigint")
    # a set, made before the exchange as well: equal rows send equal spans
    return spans.groupBy("id", "text_key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def remove_repeated_bytes(docs: DataFrame, window: int = 400, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row of ``docs`` (doc_id, text)."""
    text, no_id = F.coalesce("text", F.lit("")), F.col("doc_id").isNull()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64(text, no_id).alias("text_key"), text.alias("text"), no_id.alias("no_id"))
    spans = repeated_spans(rows, window, heavy)
    none = F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)")
    joined = rows.join(spans, ["id", "text_key"], "left").select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(_strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
