"""Best-fit packing of tokenised documents by the linear grouping scheme.

A document's ids (and a final 0) are cut into pieces of the sequence length
only if they are longer.  The plan needs no more than the count of pieces of
each length, so it is the same work for any number of documents:

1. Large lengths, sorted, form groups of equal cardinality; each is rounded up
   to its group's largest.
2. The few-size problem is solved over configurations (multisets of rounded
   sizes that fit): a linear program by column generation, rounded down.
3. Actual documents take the places of the rounded sizes; sequences whose
   places get the same lengths stay one entry "count times these lengths".
4. What is left - small lengths and large ones without a place - goes best-fit
   into the free room, longest first; new sequences open where nothing fits.

The plan is a list of runs (length, first rank, count, first sequence, offset)
bounded by the sequence length and the number of groups, not by the data.
Each piece finds its run by its rank among the pieces of its length, counted
per task and then over tasks.

Defined cases: null and empty texts have the single id 0; repeated rows are
documents of their own; an empty table gives an empty result; very long texts
are cut into many pieces of one task's row batch; pieces of one length are
ranked by task and order of arrival, so which of them shares a sequence with
which is a tie of no meaning; columns other than those named are not read.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress, pairwise
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstar.llm.alignment import byte_of_character
from marketstar.llm.common import staged
from marketstar.llm.text import chunks

if TYPE_CHECKING:
    from tiktoken import Encoding

CACHE_WORDS = 200_000  # about 100 MB a worker; rarer words are cut again at little cost
GROUPS = 256
_AT_ONCE = 20_000  # new words in one call
#: Kinds of bytes in UTF-8: letters of ASCII and Latin-1, digits and marks; odd are all others, and the apostrophe and
#: the bar, which the vocabulary's patterns and special tokens treat apart.
_GAP, _LETTER, _DIGIT, _SIGN, _LEAD, _TAIL, _ODD = range(7)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127], _KIND[48:58], _KIND[65:91], _KIND[97:123] = _SIGN, _DIGIT, _LETTER, _LETTER
_KIND[32], _KIND[0xC3], _KIND[0x80:0xC0] = _GAP, _LEAD, _TAIL
_KIND[[0x27, 0x7C, 0x97, 0xB7]] = _ODD
_RUN_SHIFT = np.int64(44)
_END = "\ue000"  # a private character: no plain word holds it


# --- tokens -----------------------------------------------------------------


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, word by word through a bounded cache.

    The vocabulary's rules never join what ASCII white space separates, so a text's ids are its words' ids in order.
    """

    _loaded: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs, self.ids, self.ends = run_encoding(path)
        self.cache: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One per worker process and vocabulary file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]  # bytes split at space, \t, \n, \v, \f and \r alone
        distinct = set().union(*split)
        new = distinct.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache, new = {}, distinct
        self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def _learn(self, new: set[bytes]) -> None:
        """Caches the ids of words: plain ones many to a call, cut where their runs end; others one by one."""
        words = list(new)
        for at in range(0, len(words), _AT_ONCE):
            part = words[at : at + _AT_ONCE]
            runs, plain = plain_runs(part)
            alike, other = list(compress(part, plain)), list(compress(part, ~plain))
            ranks = np.array(self.runs.encode_ordinary(marked_runs(alike)), np.int64)
            ids = self.ids[ranks]
            last = np.append(0, np.flatnonzero(self.ends[ranks]) + 1)
            if len(last) == runs[plain].sum() + 1:
                coded, cut = ids.tobytes(), (4 * last[np.append(0, np.cumsum(runs[plain]))]).tolist()
                self.cache.update(zip(alike, [coded[a:b] for a, b in pairwise(cut)], strict=True))
            else:
                other = part
            got = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in other], add_special_tokens=False)
            self.cache.update((w, np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(other, got, strict=True))


def run_encoding(path: str) -> tuple[Encoding, np.ndarray, np.ndarray]:
    """The vocabulary's merges for lower-case runs that each end in ``_END``, as ranks; each rank's id, and whether it ends a run.

    The file marks a run's last byte; here the mark's own bytes are joined first and then to that byte.
    """
    from tiktoken import Encoding

    with open(path) as f:
        model = json.load(f)["model"]
    byte, suffix = byte_of_character(), model["end_of_word_suffix"]
    end = _END.encode()
    ranks = {bytes([k]): k for k in range(256)} | {end[:2]: 256, end: 257} | {bytes([k]) + end: 258 + k for k in range(256)}
    ids = np.zeros(514 + len(model["merges"]), "<u4")
    for c, k in byte.items():
        ids[k], ids[258 + k] = model["vocab"][c], model["vocab"][c + suffix]
    for k, pair in enumerate(model["merges"]):
        token = "".join(pair if isinstance(pair, list) else pair.split(" "))
        open_ = token.removesuffix(suffix)
        ranks.setdefault(bytes(byte[c] for c in open_) + (end if open_ != token else b""), 514 + k)
        ids[514 + k] = model["vocab"][token]
    ends = np.zeros(len(ids), bool)
    ends[[r for t, r in ranks.items() if t.endswith(end)]] = True
    return Encoding("runs", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={}), ids, ends


def _run_starts(kind: np.ndarray) -> np.ndarray:
    new = np.zeros(len(kind), bool)
    new[1:] = (kind[1:] != _GAP) & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    return new


def marked_runs(words: list[bytes]) -> str:
    """All runs of plain words in a row, in lower case, each followed by ``_END``."""
    text = np.frombuffer(b" ".join([*words, b""]).decode().lower().encode(), np.uint8)
    kind = _KIND[text]
    kind[(kind == _LEAD) | (kind == _TAIL)] = _LETTER
    over = np.append(False, (kind[:-1] != _GAP) & ((kind[1:] == _GAP) | _run_starts(kind)[1:]))
    at = np.flatnonzero(over)
    end = np.frombuffer(_END.encode(), np.uint8)
    out = np.insert(text, np.repeat(at, len(end)), np.tile(end, len(at)))
    return out[out != 32].tobytes().decode()


def plain_runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many runs (letters, marks, or one digit) each word has, and whether its kinds of bytes are known for sure."""
    kind = _KIND[np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)]
    lead, tail = kind == _LEAD, kind == _TAIL
    kind[1:][tail[1:] & ~lead[:-1]] = _ODD
    kind[:-1][lead[:-1] & ~tail[1:]] = _ODD
    odd = kind == _ODD
    kind[lead | tail] = _LETTER
    first = np.flatnonzero(kind == _GAP)[:-1]
    return np.add.reduceat(_run_starts(kind).astype(np.int64), first), ~np.logical_or.reduceat(odd, first)


def _pieces(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokenizer.of(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)  # pieces of each length so far in this task
        for batch in batches:
            ids = batch.column("doc_id")
            for c in chunks(batch.column("text"), 2 << 20):
                raw = c.data.tobytes()
                texts = [raw[a:b] for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True)]
                doc, piece, start, length, crc, body = [], [], [], [], [], []
                for i, coded in enumerate(tokens.encode(texts)):
                    coded += b"\0\0\0\0"
                    total = len(coded) // 4
                    for n, at in enumerate(range(0, total, size)):
                        part = coded[4 * at : 4 * (at + size)]
                        doc.append(c.first + i)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            body.append(part)
                lengths = np.asarray(length, np.int64)
                order = np.argsort(lengths, kind="stable")
                by = lengths[order]
                first = np.flatnonzero(np.append(True, by[1:] != by[:-1]))
                within = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
                rank = np.empty(len(by), np.int64)
                rank[order] = within + seen[by]
                seen += np.bincount(lengths, minlength=size + 1)
                columns = {
                    "doc_id": ids.take(pa.array(doc, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(lengths),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "task": pa.array(np.full(len(by), task, np.int32)),
                    "task_rank": pa.array(rank),
                }
                if with_ids:
                    columns["ids"] = pa.array(body, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


# --- plan -------------------------------------------------------------------


@dataclass
class Bins:
    """``count`` sequences alike: each takes one piece from every run in ``places`` (length, first rank)."""

    count: int
    free: int
    places: list[tuple[int, int]] = field(default_factory=list)

    def cut(self, k: int) -> tuple[Bins, Bins]:
        """The first ``k`` sequences and the rest."""
        rest = [(length, rank + k) for length, rank in self.places]
        return Bins(k, self.free, list(self.places)), Bins(self.count - k, self.free, rest)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of configurations (multiplicity per size) close below the optimum of the covering program.

    Column generation: the prices of the current basis value the sizes, a knapsack finds the configuration worth
    most, which enters the basis; stops when none is worth more than one sequence.
    """
    m = len(sizes)
    most = int(capacity // sizes.min())  # places of any configuration
    room_left = np.arange(capacity + 1)[None, :] - sizes[:, None]
    fits, room_left = room_left >= 0, np.maximum(room_left, 0)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for step in range(rounds):
        prices = inverse.sum(axis=0)  # every configuration costs one sequence
        worth, choices = np.zeros(capacity + 1), []
        for _ in range(most):  # best worth of every room with one place more
            value = np.where(fits, prices[:, None] + worth[room_left], -1.0)
            best = value.argmax(axis=0)
            more = value[best, np.arange(capacity + 1)]
            choices.append(np.where(more > worth + 1e-15, best, -1))
            worth = np.maximum(worth, more)
        if worth[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(m), capacity
        for choice in reversed(choices):
            if choice[room] >= 0:
                column[choice[room]] += 1
                room -= int(sizes[choice[room]])
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = column
        theta = max(0.0, float(ratio[out]))
        x -= theta * direction
        x[out] = theta
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
            x = inverse @ demand
        else:  # replace one column of the basis
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
    return [(basis[:, j].astype(int), int(x[j] + 1e-6)) for j in range(m) if x[j] >= 1]


def plan_bins(counts: dict[int, int], capacity: int, groups: int = GROUPS, small: int | None = None) -> list[Bins]:
    """Sequences for ``counts`` pieces of each length by linear grouping, configurations and best fit."""
    small = 3 * capacity // 8 if small is None else small
    used: dict[int, int] = defaultdict(int)
    done: list[Bins] = []
    if n := counts.get(capacity):
        done.append(Bins(n, 0, [(capacity, 0)]))
    left = {length: n for length, n in counts.items() if n > 0 and length < capacity}
    large = sorted((length for length in left if length > small), reverse=True)
    total = sum(left[length] for length in large)
    open_bins: list[Bins] = []
    if total:
        # groups of equal cardinality: a length may be shared by neighbouring groups
        per = -(-total // min(groups, total))
        queues: list[list[list[int]]] = []
        room = 0
        for length in large:
            n = left[length]
            while n:
                if room == 0:
                    queues.append([])
                    room = per
                k = min(n, room)
                queues[-1].append([length, k])
                n -= k
                room -= k
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(n for _, n in q) for q in queues], float)
        for column, count in configurations(sizes, demand, capacity):
            bins = [Bins(count, capacity)]
            for g in np.flatnonzero(column):
                for _ in range(column[g]):
                    queue, filled = queues[g], []
                    for b in bins:
                        while b.count and queue:
                            length, n = queue[0]
                            k = min(b.count, n)
                            first, b = b.cut(k)
                            first.places.append((length, used[length]))
                            first.free -= length
                            filled.append(first)
                            used[length] += k
                            left[length] -= k
                            queue[0][1] -= k
                            if not queue[0][1]:
                                queue.pop(0)
                        if b.count:
                            filled.append(b)
                    bins = filled
            open_bins += [b for b in bins if b.places]
    # best fit of all that is left, longest first
    by_room: dict[int, list[Bins]] = defaultdict(list)
    for b in open_bins:
        by_room[b.free].append(b)
    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            room = next((r for r in range(length, capacity) if by_room.get(r)), None)
            b = by_room[room].pop() if room is not None else Bins(n, capacity)
            each = min(b.free // length, n)
            take = min(b.count, n // each)
            first, rest = b.cut(take)
            for _ in range(each):
                first.places.append((length, used[length]))
                first.free -= length
                used[length] += take
            n -= take * each
            by_room[first.free].append(first)
            if rest.count and rest.places:
                by_room[rest.free].append(rest)
    return done + [b for bins in by_room.values() for b in bins]


def plan_runs(bins: list[Bins]) -> dict[str, np.ndarray]:
    """Runs sorted by (length, first rank): where each piece goes by its rank."""
    runs, sequence = [], 0
    for b in bins:
        offset = 0
        for length, rank in b.places:
            runs.append((length, rank, sequence, offset))
            offset += length
        sequence += b.count
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << _RUN_SHIFT) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _plan(capacity: int, groups: int):
    def run(histogram: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(histogram["length"].tolist(), histogram["n"].tolist(), strict=True))
        return pd.DataFrame(plan_runs(plan_bins(counts, capacity, groups)))

    return run


def _assign(runs: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(runs["key"], (length << _RUN_SHIFT) + rank, "right") - 1
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(runs["sequence"][at] + rank - runs["rank"][at]))
            yield out.append_column("offset", pa.array(runs["offset"][at]))

    return run


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, groups: int = GROUPS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``, the piece's
    little-endian unsigned 32-bit ids, if asked for).  ``tokenizer`` is the path of a vocabulary file.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, task_rank bigint" + ", ids binary" * with_ids
    pieces = staged(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity, with_ids), schema), "pack_pieces")
    per_task = pieces.groupBy("length", "task").agg(F.max("task_rank").alias("last"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("skip"))
    # at most one row per length: the bounded summary the plan is made from, in one task; the plan is bounded as well
    histogram = per_task.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n"))
    planned = histogram.groupBy().applyInPandas(_plan(capacity, groups), "key bigint, rank bigint, sequence bigint, offset bigint").toArrow()
    runs = {c: planned[c].to_numpy() for c in planned.column_names}
    ranked = pieces.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, (F.col("skip") + F.col("task_rank")).alias("rank")
    )
    out = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return ranked.mapInArrow(_assign(runs), out + ", sequence_id bigint, offset bigint")
