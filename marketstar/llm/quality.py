"""Quality scores by Bradley-Terry ranking.

Labelled documents give preference pairs: each of quality 1 is preferred to
one of quality 0.  A document's strength is linear in features of its whole
text; logistic loss over all pairs of all labelled documents fits it.  The
strengths' quantile at the share of quality 0 among the labelled documents is
the threshold; scores are a logistic curve through it, so that documents
below the threshold score less than ``cut``.

The pairs are never laid out.  A pair's loss depends on two strengths alone, so
each round of the fit sums, in Spark, the labelled documents of a side by their
strength to a sixteenth; the driver sees these sums (their number is bounded)
and takes a quasi-Newton step.  Sums are of whole numbers, so they do not
depend on how the rows are dealt.  The threshold is an exact order statistic.

Defined cases: null and empty texts have zero features and get a score like
any other; labels other than 0 and 1 are ignored, a document with several
labels counts as its lowest; rows with null ids are scored, never learnt from;
without labels of both kinds every document scores 0.5; an empty table gives
an empty result; repeated rows are scored alike, equal scores stay equal, and a
score at the cut is predicted 1; features are shares of whole texts of any
length; columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged
from marketstar.llm.text import Chunk, chunks, rows_at, run_hashes, word_hashes, words

#: A strength's step within which documents of a side are summed, steps each way at most, and rounds of the fit at most.
STEP, STEPS, ROUNDS = 1 / 16, 2048, 25
#: Features are summed as whole multiples of this.
_UNIT = 2.0**-20
_ENDINGS = 64

_UPPER, _LOWER, _DIGIT, _MARK, _WIDE, _LINE = (np.zeros(256, bool) for _ in range(6))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = _WIDE[128:] = _LINE[[10, 13]] = True
_MARK[33:127] = True
_MARK &= ~(_UPPER | _LOWER | _DIGIT)
#: A word's last byte as a feature: marks have one each, letters, digits and other bytes one a kind.
_ENDING = np.zeros(256, np.int64)
_ENDING[_UPPER], _ENDING[_LOWER], _ENDING[_DIGIT], _ENDING[_WIDE] = 1, 2, 3, 4
_ENDING[_MARK] = 5 + np.arange(int(_MARK.sum()))
WIDTH = 14 + _ENDINGS


def _distinct_share(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Per document: distinct values over values; 1 where there are none."""
    if not len(doc):
        return np.ones(n)
    order = np.lexsort((values, doc))
    d, v = doc[order], values[order]
    new = np.append(True, (v[1:] != v[:-1]) | (d[1:] != d[:-1]))
    total = np.bincount(d, minlength=n)
    return np.where(total > 0, np.bincount(d, new, minlength=n) / np.maximum(total, 1), 1.0)


def features(c: Chunk) -> np.ndarray:
    """(documents, WIDTH) features: shares of kinds of bytes and words, repetition, word endings."""
    w = words(c)
    n, doc = c.n, w.doc
    length = w.end - w.start
    n_words = np.maximum(np.diff(w.doc_at), 1)
    n_bytes = np.maximum(np.diff(c.offsets), 1)
    byte_doc = np.repeat(np.arange(n), np.diff(c.offsets))
    share = lambda kind: np.bincount(byte_doc, kind[c.data], minlength=n) / n_bytes
    of_words = lambda flag: np.bincount(doc, flag, minlength=n) / n_words
    h = word_hashes(c.data, w)
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    last = c.data[np.maximum(w.end - 1, 0)] if len(h) else np.empty(0, np.uint8)
    before = c.data[np.maximum(w.end - 2, 0)] if len(h) else last
    out = np.zeros((n, WIDTH), np.float32)
    doc3, at3 = rows_at(w.doc_at, 3)
    runs = run_hashes(h, 3)[at3] if len(at3) else at3
    columns = [
        np.log1p(np.diff(w.doc_at)) / 10,
        np.bincount(doc, length, minlength=n) / n_words / 10,
        share(_UPPER),
        share(_LOWER),
        share(_DIGIT),
        share(_MARK),
        share(_WIDE),
        share(_LINE),
        of_words(same),
        _distinct_share(doc, h, n),
        _distinct_share(doc3, runs, n),
        of_words(_MARK[last] & _MARK[before] & (length > 2)),
        of_words((length == 1) & _MARK[last]),
        of_words(length > 20),
    ]
    for i, x in enumerate(columns):
        out[:, i] = x
    if len(h):
        ends = np.bincount(doc * _ENDINGS + _ENDING[last] % _ENDINGS, minlength=n * _ENDINGS).reshape(n, _ENDINGS)
        out[:, 14:] = ends / n_words[:, None]
    return out


@dataclass
class Ranking:
    """Strength = ((x - mean) / spread) . weight; score = logistic(slope * (strength - threshold) + logit(cut))."""

    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    threshold: float
    slope: float
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _strength(x, self.mean, self.spread, self.weight)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weight):
            return np.full(len(x), 0.5)
        z = self.slope * (self.strength(x) - self.threshold) + math.log(self.cut / (1 - self.cut))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _strength(x: np.ndarray, mean: np.ndarray, spread: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Column by column, so that equal rows have equal strengths wherever they stand."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += (x[:, k].astype(np.float64) - mean[k]) / spread[k] * weight[k]
    return out


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, WIDTH)


def _sums(table: DataFrame, rows_of) -> dict[int, np.ndarray]:
    """Sums by key of ``rows_of(x, label)`` (keys and rows of whole numbers) over a table of features and labels."""

    def by_key(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.empty(0, np.int64)
        total = np.add.reduceat(value[order], first, axis=0) if len(first) else value[:0]
        return pa.RecordBatch.from_arrays([pa.array(key[order][first], pa.int64()), pa.array([t.tobytes() for t in total], pa.binary())], names=["key", "total"])

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        key = np.concatenate([b.column("key").to_numpy() for b in parts])
        value = np.frombuffer(b"".join(t for b in parts for t in b.column("total").to_pylist()), np.int64).reshape(len(key), -1)
        return by_key(key, value)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                found = [whole([*found, by_key(*rows_of(_rows(batch), batch.column("label").to_numpy()))])]
        yield from found

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                found = [whole([*found, batch])]
        yield from found

    form = "key long, total binary"
    got = table.select("x", "label").mapInArrow(part, form).repartition("key").mapInArrow(combine, form)
    return {r["key"]: np.frombuffer(bytes(r["total"]), np.int64) for r in got.collect()}


def _value_at(values: DataFrame, column: str, rank: int) -> float:
    """The ``rank``-th smallest value (from 1): ranges are counted and the one that holds it is cut again."""
    lo, hi = values.agg(F.min(column), F.max(column)).first()
    inside, left = values, rank
    while lo < hi:
        at = F.least(F.floor((F.col(column) - lo) / (hi - lo) * 1024), F.lit(1023)).alias("at")
        ranges = inside.groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for r in sorted(ranges.collect()):  # 1,024 at most
            lo, hi = r["lo"], r["hi"]
            if left <= r["n"]:
                break
            left -= r["n"]
        inside = values.where(F.col(column).between(lo, hi))
    return lo


def _pair_loss(sums: dict[int, np.ndarray], mean: np.ndarray, spread: np.ndarray, weight: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
    """Mean logistic loss over all pairs and its gradient, from each side's sums by strength."""
    sides = []
    for label in (1, 0):
        rows = np.array([v for k, v in sorted(sums.items()) if k % 2 == label], np.float64)
        n = rows[:, 0]
        z = (rows[:, 1:] * _UNIT - n[:, None] * mean) / spread
        sides.append((n, z, (z @ weight) / n))
    (n1, z1, s1), (n0, z0, s0) = sides
    gap = s1[:, None] - s0[None, :]
    lost = 1.0 / (1.0 + np.exp(np.clip(gap, -60, 60)))
    pairs = n1.sum() * n0.sum()
    loss = float(n1 @ np.logaddexp(0, -gap) @ n0) / pairs + decay / 2 * float(weight @ weight)
    return loss, (z0.T @ (lost.T @ n1) - z1.T @ (lost @ n0)) / pairs + decay * weight


def fit_ranking(table: DataFrame, cut: float, rounds: int = ROUNDS, decay: float = 1e-3) -> Ranking:
    """Fits the strengths on all pairs of a table of ``x`` and ``label``, by L-BFGS; each round is a job over the table."""
    units = lambda x: np.rint(x.astype(np.float64) / _UNIT).astype(np.int64)
    squares = lambda x: np.rint(x.astype(np.float64) ** 2 / _UNIT).astype(np.int64)
    sums = _sums(table, lambda x, label: (label.astype(np.int64), np.concatenate([np.ones((len(x), 1), np.int64), units(x), squares(x)], 1)))
    if set(sums) != {0, 1}:
        return Ranking(np.empty(0), np.empty(0), np.empty(0), 0.0, 1.0, cut)
    n_bad, n_good = int(sums[0][0]), int(sums[1][0])
    n, total = n_bad + n_good, (sums[0] + sums[1])[1:].astype(np.float64) * _UNIT
    mean = total[:WIDTH] / n
    spread = np.sqrt(np.maximum(total[WIDTH:] / n - mean**2, 0)) + 1e-3

    def products(x, label):  # steers the steps alone: of coarse values, one row of whole numbers a batch
        q = np.rint(np.clip((x - mean) / spread, -8, 8) * 256)
        return np.zeros(1, np.int64), (q.T @ q).astype(np.int64).reshape(1, -1)

    about = _sums(table, products)[0].reshape(WIDTH, WIDTH) / (65536.0 * n)
    steer = np.linalg.inv(0.5 * about + decay * np.eye(WIDTH))

    def look(weight):
        def rows_of(x, label):
            at = np.clip(np.floor(_strength(x, mean, spread, weight) / STEP), -STEPS, STEPS).astype(np.int64)
            return 2 * at + label, np.concatenate([np.ones((len(x), 1), np.int64), units(x)], 1)

        return _pair_loss(_sums(table, rows_of), mean, spread, weight, decay)

    weight, length, moves = np.zeros(WIDTH), 1.0, []
    loss, slope = look(weight)
    start, direction = float(np.linalg.norm(slope)), -steer @ slope
    for _ in range(rounds):
        if np.linalg.norm(slope) <= 1e-3 * start:
            break
        new = weight + length * direction
        new_loss, new_slope = look(new)
        if new_loss > loss + 1e-4 * max(loss, 1e-3):
            length /= 4
            continue
        moved, turned = new - weight, new_slope - slope
        if moved @ turned > 1e-12:
            moves = [*moves[-9:], (moved, turned)]
        weight, loss, slope, length = new, new_loss, new_slope, 1.0
        back, kept = slope.copy(), []
        for m, t in reversed(moves):
            kept.append((m @ back) / (m @ t))
            back -= kept[-1] * t
        back = steer @ back
        for (m, t), a in zip(moves, reversed(kept), strict=True):
            back += (a - (t @ back) / (m @ t)) * m
        direction = -back

    model = Ranking(mean, spread, weight, 0.0, 1.0, cut)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(model.strength(_rows(batch)), pa.float64())], names=["label", "strength"])

    strong = staged(table.select("x", "label").mapInArrow(strengths, "label int, strength double"), "quality_strengths")
    k = min(max(1, n_bad), n - 1)  # the quantile at the share of quality 0
    model.threshold = (_value_at(strong, "strength", k) + _value_at(strong, "strength", k + 1)) / 2
    middle = [_value_at(strong.where(F.col("label") == y), "strength", (m + 1) // 2) for y, m in ((0, n_bad), (1, n_good))]
    model.slope = 8.0 / max(middle[1] - middle[0], 1e-6)
    return model


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in chunks(batch.column("text")):
            rows = [r.tobytes() for r in features(c)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(c.first, c.n), pa.array(rows, pa.binary())], names=["doc_id", "x"])


def _score(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_rows(batch)), pa.float64())], names=["doc_id", "score"])

    return run


def labelled(labels: DataFrame, column: str, parts: int, held: int) -> DataFrame:
    """(doc_id, label) of the documents to learn from: all whose id's crc32 modulo ``parts`` is not ``held``."""
    return (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % parts != held)
        .groupBy("doc_id")
        .agg(F.min(column).cast("int").alias("label"))
    )


def held_out(doc_id, parts: int, held: int):
    """Whether a document is kept from learning; false for a null id (which has no label)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == held


def rank_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= ``cut``) of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    table = staged(docs.select("doc_id", "text").mapInArrow(_features_of, f"doc_id {id_type}, x binary"), "quality_features")
    known = table.join(labelled(labels, "quality", parts, held), "doc_id").select("doc_id", "x", "label")
    # of several texts of an id the one of least features counts
    known = known.groupBy("doc_id", "label").agg(F.min("x").alias("x")).select("x", "label")
    model = fit_ranking(staged(known, "quality_labelled"), cut)
    scored = table.mapInArrow(_score(model), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, held).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
