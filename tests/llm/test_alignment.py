"""Alignment against whole-text encodings and a plain merge, and merge-path pieces of every size."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from marketstar.llm import alignment, queries
from marketstar.llm.common import importable


@pytest.fixture(scope="module")
def paths():
    return queries.alignment_tokenizers()


def plain(rows, paths):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    known = alignment.Aligner.of(*paths)
    docs, count = [], Counter()
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        if not text or b"".join(known.a_bytes[k] for k in x) != whole or b"".join(known.b_bytes[k] for k in y) != whole:
            docs.append((i, 0, 0, [], []))
            continue
        ends = [dict(zip(np.cumsum([len(t[k]) for k in ids]).tolist(), range(1, len(ids) + 1), strict=True)) for ids, t in ((x, known.a_bytes), (y, known.b_bytes))]
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append(",".join(map(str, x[p : ends[0][end]])) + "|" + ",".join(map(str, y[q : ends[1][end]])))
            p, q = ends[0][end], ends[1][end]
            links.append((x[p - 1], y[q - 1]))
        docs.append((i, len(x), len(y), groups, links))
        count.update(links)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [
        (i, na, nb, len(g), len(li), sum(count[x] == best[x[1]] for x in li), sum(count[x] for x in li), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
        for i, na, nb, g, li in docs
    ]


ROWS = [
    (1, "The quick  brown fox\n\n jumps\tover "), (2, " leading and <|endoftext|> <s> special </s> <0x41>"), (3, None), (4, ""), (5, "two ▁ marks"),
    (6, "“quotes” —   nbsp 　 wide  x \x00 \x1c a"), (7, "été naïve 日本語のテキスト 😀 x"), (8, "a" * 3000 + " b"), (8, "a" * 3000 + " b"),
    (None, "null id"), (9, " "), (10, "  "), (11, "it's 12345 we'll\r\n end. "), (12, "x \u0085 y  z"),
]


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_find_all_shared_ends(piece):
    rng = np.random.default_rng(piece)
    for n, m, top in [(0, 0, 5), (0, 9, 20), (9, 0, 20), (1, 1, 2), (40, 60, 90), (300, 20, 400), (50, 50, 51)]:
        a, b = (np.sort(rng.choice(top, min(k, top), replace=False)) for k in (n, m))
        i, j = alignment.diagonals(a, b, piece)
        assert (np.diff(i + j)[:-1] == piece).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
        at_a, at_b = alignment.shared_ends(a, b, piece)
        both, in_a, in_b = np.intersect1d(a, b, return_indices=True)
        assert at_a.tolist() == in_a.tolist() and at_b.tolist() == in_b.tolist()


def test_rows_equal_whole_text_encodings(spark, paths, monkeypatch):
    importable(spark)
    docs = spark.createDataFrame([("clash", t, i) for i, t in ROWS], "n_a string, text string, doc_id bigint")
    rows, pairs = alignment.align_documents(docs, *paths)
    assert sorted(map(tuple, rows.collect()), key=key) == sorted(plain(ROWS, paths), key=key)
    assert pairs.count() > 20
    assert alignment.align_documents(docs.limit(0), *paths)[0].count() == 0


def test_long_text_in_blocks(spark, paths, monkeypatch):
    text = " ".join(f"word{i % 977} été  x\n{i}" for i in range(4000))
    import pyarrow as pa

    monkeypatch.setattr(alignment, "BLOCK", 5000)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array([text, text + " ▁"], pa.string())})
    out = pa.Table.from_batches(alignment._align(*paths)([batch])).to_pydict()
    want = plain([(1, text)], paths)[0]
    assert (out["n_a"][0], out["n_b"][0], out["n_groups"][0], out["groups_sha256"][0]) == (*want[1:4], want[7])
    assert sum(out["times"][0]) == want[4] and out["n_a"][1] == 0 and out["pairs"][1] == [] and out["groups_sha256"][1] == ""


def test_query_equals_plain_version(spark, paths):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.queries()["op11_merge_path"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, paths), key=key)
