"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Tokenizer A splits space + text, tokenizer B the text (it adds the space
itself).  Both give a rising list of byte offsets where tokens end.  Merging
the two lists is cut by diagonals: a binary search on each diagonal finds how
many A and B ends lie before it, so that every piece merges equally many ends
and needs no other piece.  A piece emits the ends both lists share; an A end
and its equal B end that a diagonal separates are stitched afterwards.  Shared
ends cut the tokens into groups, and the two tokens that end there are a link.

What a task merges.  Neither tokenizer joins anything across a single space
that sure non-space bytes surround (A's pattern starts a token there, and no
piece of B has a space behind another character), so a text is cut there and
each distinct segment of a block of documents is encoded and aligned once: the
segments' ends follow each other in one stream, which the pieces share out
equally, whatever the lengths of documents and segments.

An id pair's count is the number of links all over the corpus.  Linked tokens
end together, so one's bytes are a suffix of the other's: the pairs that can
occur number at most the bytes of all vocabulary entries, whatever the size of
the corpus.  This bounded table alone passes through the driver.

Defined cases: null and empty texts, and texts whose joined A or B bytes are
not space + text, have no tokens (zeros and an empty digest) and count no
pairs; strings of special tokens are plain text; a long text is worked off in
blocks cut where tokens can't join; repeated rows and null ids are documents
of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged
from marketstar.llm.text import chunks

#: Ends merged by one piece, bytes of a block, and distinct segments a worker remembers at most.
PIECE, BLOCK, REMEMBERED = 8_192, 4 << 20, 400_000
#: Bytes that surely begin a character other than white space.
_SURE = rb"!-~\xc3-\xdf\xe4-\xf4"
_CUT = re.compile(rb"(?<=[^ ]) (?=[" + _SURE + rb"])")
#: Fixed value: the public pattern of byte-level vocabularies.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_STARTS = np.zeros(256, bool)
_STARTS[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before every ``piece``-th place of their merged order (a before b on ties)."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (lo < hi).any():  # all diagonals at once: the least i whose a[i] comes after b[d - i - 1]
        open_ = lo < hi
        mid = (lo + hi) // 2
        later = np.zeros(len(d), bool)
        later[open_] = a[mid[open_]] > b[d[open_] - mid[open_] - 1]
        hi = np.where(open_ & later, mid, hi)
        lo = np.where(open_ & ~later, mid + 1, lo)
    return lo, d - lo


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(place in a, place in b) of all ends that both strictly rising lists have, merged piece by piece."""
    i, j = diagonals(a, b, piece)
    in_a, in_b = [], []
    for i0, i1, j0, j1 in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist(), strict=True):
        if j0 < j1 and i0 and a[i0 - 1] == b[j0]:  # stitched: the piece before holds the A end
            in_a.append(np.array([i0 - 1]))
            in_b.append(np.array([j0]))
        if i0 < i1 and j0 < j1:
            at = np.searchsorted(b[j0:j1], a[i0:i1])
            hit = at < j1 - j0
            hit[hit] = b[j0:j1][at[hit]] == a[i0:i1][hit]
            in_a.append(np.flatnonzero(hit) + i0)
            in_b.append(at[hit] + j0)
    none = np.empty(0, np.int64)
    return (np.concatenate(in_a), np.concatenate(in_b)) if in_a else (none, none)


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def groups_as_text(ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` for each group that ends at A token ``at_a`` and B token ``at_b``, and where each group's text ends."""
    group_a = np.searchsorted(at_a, np.arange(len(ids_a)))
    group_b = np.searchsorted(at_b, np.arange(len(ids_b)))
    place_a = np.arange(len(ids_a)) + np.append(0, at_b + 1)[group_a]
    place_b = np.arange(len(ids_b)) + (at_a + 1)[group_b]
    value, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    value[place_a], value[place_b] = ids_a, ids_b
    mark[place_a[at_a]], mark[place_b[at_b]] = ord("|"), ord(";")
    digits = 1 + sum((value >= 10**k).astype(np.int64) for k in range(1, 5))
    end = np.cumsum(digits + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = mark
    for k in range(5):
        has = digits > k
        out[end[has] - 2 - k] = 48 + value[has] // 10**k % 10
    return out.tobytes(), end[place_b[at_b]]


class Aligner:
    """Both tokenizers with a bounded memory of aligned segments; one per worker process and pair of files."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        # tiktoken works off the file's vocabulary as ranks: the same ids, which the tests hold against the file's own tokenizer
        byte, own = byte_of_character(), Tokenizer.from_file(path_a)
        vocabulary = own.get_vocab()
        special = {t.content for t in own.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        self.a = Encoding("a", pat_str=_PATTERN, mergeable_ranks={self.a_bytes[i]: i for t, i in vocabulary.items() if t not in special}, special_tokens={})
        self.b = SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.a_bytes) > 1 << 16 or len(self.b_bytes) > 1 << 16:
            raise ValueError("a link is packed in 32 bits: both vocabularies must have at most 65,536 entries")
        #: Without pieces that hold a space behind another character a text may be cut at its spaces.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self._forget()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls._loaded:
            cls._loaded[path_a, path_b] = cls(path_a, path_b)
        return cls._loaded[path_a, path_b]

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.said: list[bytes] = []  # each segment's groups as text
        self.tallies = np.empty((0, 4), np.int64)  # each segment's A tokens, B tokens, groups, validity
        self.links, self.link_at = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _ids_of_a(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each segment's) by A.  Segments that surely begin no white space share one text, as a
        token starts at the space before each."""
        first = np.array([s[0] if s else 32 for s in segments], np.uint8)
        sure, n = np.flatnonzero(_STARTS[first]), np.zeros(len(segments), np.int64)
        together = [segments[k] for k in sure]
        ids = np.array(self.a.encode_ordinary(b"".join(b" " + s for s in together).decode()), np.int64)
        borders = np.cumsum([len(s) + 1 for s in together])
        n[sure] = np.diff(np.searchsorted(np.cumsum(self.a_size[ids]), borders, "right"), prepend=0)
        alone = {k: self.a.encode_ordinary(" " + segments[k].decode()) for k in np.flatnonzero(~_STARTS[first]).tolist()}
        if not alone:
            return ids, n
        n[[*alone]] = [len(x) for x in alone.values()]
        out, of = np.empty(int(n.sum()), np.int64), np.repeat(np.arange(len(segments)), n)
        apart = np.isin(of, [*alone])
        out[~apart], out[apart] = ids, [*chain.from_iterable(alone.values())]
        return out, n

    def _learn(self, segments: list[bytes]) -> None:
        """Encodes and aligns distinct segments (each stands for a space and these bytes)."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        of_b = self.b.encode(texts, num_threads=1)
        n_b = np.fromiter(map(len, of_b), np.int64, len(of_b))
        ids_b = np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum()))
        ok = np.ones(len(segments), bool)
        if b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != b"".join(b" " + s for s in segments):
            ok[:] = [b"".join(map(self.b_bytes.__getitem__, x)) == b" " + s for x, s in zip(of_b, segments, strict=True)]
            ids_b = ids_b[np.repeat(ok, n_b)]
        good = segments if ok.all() else [s for s, fit in zip(segments, ok, strict=True) if fit]
        per = np.zeros((len(segments), 4), np.int64)
        ids_a, per[ok, 0] = self._ids_of_a(good)  # byte-level tokens are the text's bytes
        per[ok, 1], per[:, 3] = n_b[ok], ok
        # the segments' bytes follow each other, so one merge aligns them all
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        at_a, at_b = shared_ends(ends_a, ends_b)
        link = (ids_a[at_a] << 16 | ids_b[at_b]).astype(np.uint32)
        borders = np.cumsum([len(s) + 1 for s in good])
        links_to = np.searchsorted(ends_a[at_a], borders, "right")
        per[ok, 2] = np.diff(links_to, prepend=0)
        text, group_to = groups_as_text(ids_a, ids_b, at_a, at_b)
        upto = group_to[links_to - 1].tolist() if len(good) else []
        said = iter([text[x : y - 1] for x, y in pairwise([0, *upto])])
        self.number.update(zip(segments, range(len(self.said), len(self.said) + len(segments)), strict=True))
        self.said += [next(said) if fit else b"" for fit in ok.tolist()]
        self.tallies = np.concatenate([self.tallies, per])
        self.links = np.concatenate([self.links, link])
        self.link_at = np.append(self.link_at, self.link_at[-1] + np.cumsum(per[:, 2]))

    def measure(self, texts: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(A tokens, B tokens, groups, validity), groups as text, and links (document, pair, times) of non-empty texts.

        ``plain`` marks texts whose spaces are all cuts.
        """
        if self.cuttable:
            split = [t.split(b" ") if p else _CUT.split(t) for t, p in zip(texts, plain, strict=True)]
        else:
            split = [[t] for t in texts]
        new = set().union(*split)
        known = new & self.number.keys()
        if len(self.number) + len(new) - len(known) > REMEMBERED:
            self._forget()
        else:
            new -= known
        if new:
            self._learn(list(new))
        count = np.array([len(s) for s in split], np.int64)
        place = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(count.sum()))
        at = np.append(0, np.cumsum(count))
        per = np.add.reduceat(self.tallies[place], at[:-1]) if len(texts) else np.empty((0, 4), np.int64)
        per[:, 3] = per[:, 3] == count
        said = [b";".join(map(self.said.__getitem__, place[x:y].tolist())) if ok else b"" for x, y, ok in zip(at[:-1].tolist(), at[1:].tolist(), per[:, 3].tolist(), strict=True)]
        doc = np.repeat(np.arange(len(texts)), count)
        kept = per[doc, 3] > 0
        place, doc = place[kept], doc[kept]
        n = self.link_at[place + 1] - self.link_at[place]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        code = self.links[np.repeat(self.link_at[place], n) + within]
        both, times = np.unique(np.repeat(doc, n).astype(np.uint64) << np.uint64(32) | code, return_counts=True)
        return per, said, (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32), times


def _blocks(text: bytes, cuttable: bool) -> Iterator[bytes]:
    """A long text in blocks; the spaces between them are cuts."""
    at = 0
    while cuttable and len(text) - at > BLOCK and (m := _CUT.search(text, at + BLOCK)):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def _spaces_are_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in which every space stands between a byte other than a space and one that surely begins no white space."""
    space = data == 32
    bad = np.zeros(len(data) + 1, np.int64)
    if len(data):
        odd = space.copy()
        odd[1:-1] &= space[:-2] | ~_STARTS[data[2:]]
        # at its ends a text has no neighbour; a space there is odd, whatever stands beyond
        inner = offsets[:-1][np.diff(offsets) > 0]
        odd[inner] |= space[inner]
        last = offsets[1:][np.diff(offsets) > 0] - 1
        odd[last] |= space[last]
        bad[1:] = np.cumsum(odd)
    return bad[offsets[1:]] == bad[offsets[:-1]]


_ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<int>, times array<int>"


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner.of(path_a, path_b)
        for batch in batches:
            ids = batch.column("doc_id")
            for c in chunks(batch.column("text"), BLOCK):
                raw = c.data.tobytes()
                used = np.flatnonzero(np.diff(c.offsets) > 0)
                texts = [raw[c.offsets[k] : c.offsets[k + 1]] for k in used]
                per, digest = np.zeros((c.n, 3), np.int64), [""] * c.n
                if len(raw) <= 2 * BLOCK:
                    tally, said, doc, pair, times = both.measure(texts, _spaces_are_cuts(c.data, c.offsets)[used])
                    ok = tally[:, 3] > 0
                    per[used[ok]] = tally[ok, :3]
                    for k, s in zip(used[ok].tolist(), [s for s, fit in zip(said, ok, strict=True) if fit], strict=True):
                        digest[k] = hashlib.sha256(s).hexdigest()
                    doc = used[doc]
                else:  # one long text
                    total, sha, found = np.zeros(3, np.int64), hashlib.sha256(), []
                    valid = True
                    for part in _blocks(raw, both.cuttable):
                        tally, said, _, pair, times = both.measure([part], np.zeros(1, bool))
                        valid &= bool(tally[0, 3])
                        sha.update(b";" * bool(total[2]) + said[0])
                        total += tally[0, :3]
                        found.append((pair, times))
                    pair, inverse = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
                    times = np.bincount(inverse, np.concatenate([t for _, t in found]), len(pair)).astype(np.int64)
                    if not valid:
                        pair, times = pair[:0], times[:0]
                    else:
                        per[0], digest[0] = total, sha.hexdigest()
                    doc = np.zeros(len(pair), np.int64)
                at = pa.array(np.searchsorted(doc, np.arange(c.n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(c.first, c.n), *(pa.array(per[:, k]) for k in range(3)), pa.array(digest, pa.string()),
                        pa.ListArray.from_arrays(at, pa.array(pair.view(np.int32))), pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
                )

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links of each pair, summed before anything is shuffled."""
    pair, n = np.empty(0, np.int32), np.empty(0, np.int64)
    for batch in batches:
        more = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
        times = batch.column("times").flatten().to_numpy(zero_copy_only=False)
        pair, inverse = np.unique(np.concatenate([pair, more]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n, times]), len(pair)).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"pair": pa.array(pair), "n": pa.array(n)})


def _sum_up(pair: np.ndarray, n: np.ndarray, best: np.ndarray):
    """Per document, links whose pair is the most frequent of its B id, and the sum of the links' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(pair, pairs.flatten().to_numpy(zero_copy_only=False))
            edge = pairs.offsets.to_numpy()
            edge = edge - edge[0] if len(edge) else np.zeros(1, np.int64)
            sums = [np.append(0, np.cumsum(x))[edge] for x in (times * best[at], times * n[at])] if len(pair) else [np.zeros(len(edge), np.int64)] * 2
            out = batch.drop_columns(["pairs", "times"])
            yield out.append_column("n_best", pa.array(np.diff(sums[0]))).append_column("count_sum", pa.array(np.diff(sums[1])))

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of
    ``docs`` (doc_id, text); and a_id, b_id, n of every linked id pair."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = staged(source.mapInArrow(_align(path_a, path_b), _ALIGNED), "aligned")
    counts = staged(aligned.select("pairs", "times").mapInArrow(_tally, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "aligned_pairs")
    table = counts.toArrow().sort_by("pair")  # at most as many rows as the vocabularies have bytes
    pair, n = table["pair"].to_numpy().astype(np.int32), table["n"].to_numpy().astype(np.int64)
    b_id = pair.view(np.uint32) & np.uint32(0xFFFF)
    highest = np.zeros(1 << 16, np.int64)
    np.maximum.at(highest, b_id, n)
    out = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    rows = aligned.mapInArrow(_sum_up(pair, n, (n == highest[b_id]).astype(np.int64)), out)
    pairs = counts.select(F.shiftrightunsigned("pair", 16).alias("a_id"), F.col("pair").bitwiseAND(0xFFFF).alias("b_id"), "n")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"), pairs
