"""Prefix-free parsing against every string of every text, on ordinary, periodic and planted texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from compare import compare, duck
from marketstar.llm import prefixfree, queries
from marketstar.llm.common import importable


def plain(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    n = Counter(t[k : k + window] for _, t in texts for k in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - window + 1):
            if n[t[k : k + window]] > 1:
                gone[k : k + window] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(t) else 0, kept))
    return out


def _rows(window, seed=0):
    rng = np.random.default_rng(seed)
    prose = lambda n: " ".join(rng.choice([f"w{i}é" for i in range(300)], n))
    shared = [prose(window // 4) for _ in range(4)]
    rows = []
    for i in range(70):
        t = prose(int(rng.integers(1, window)))
        for s in rng.choice(shared, 2):
            cut = s[int(rng.integers(0, 9)) :]
            p = int(rng.integers(0, len(t)))
            t = t[:p] + cut + t[p:]
        rows.append((i, t))
    exact = shared[0].encode()[:window].decode("utf-8", "ignore")
    rows += [(200, "ab" * window), (201, "a" * (window + 1)), (202, "a" * window), (203, "xyz" * 40 + "abc" * window), (204, "\x00" * (2 * window)), (205, exact), (206, "!" + exact + "?")]
    rows += [(210, None), (211, ""), (212, "short"), (None, prose(window)), (None, rows[0][1]), (213, rows[3][1]), (213, rows[3][1]), (0, prose(window))]
    return rows


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("window,heavy", [(400, 2000), (60, 3), (60, 2000), (101, 20)])
def test_equals_every_string(spark, window, heavy):
    importable(spark)
    rows = _rows(window, window)
    docs = spark.createDataFrame([(1.5, t, i) for i, t in rows], "kept double, text string, doc_id bigint")
    got = sorted(((*r[:4], bytes(r[4])) for r in prefixfree.remove_repeated_bytes(docs, window, heavy).collect()), key=key)
    assert got == sorted(plain(rows, window), key=key)
    assert any(r[2] and r[3] > 1 for r in got) and any(r[2] == 0 for r in got)
    assert prefixfree.remove_repeated_bytes(docs.limit(0), window).count() == 0


def test_corpus_order_is_lexicographic():
    rng = np.random.default_rng(4)
    strings = [bytes(rng.integers(97, 99, int(n)).astype(np.uint8)) for n in rng.integers(40, 700, 30)] + [b"a" * 300, b"ab" * 200, b"\x00" * 90, strings0 := b"xyzw" * 60, strings0 + b"q"]
    start, order, _ = prefixfree.corpus_order(strings, 40)
    ends = np.cumsum([len(s) + prefixfree.WIDTH for s in strings])
    whole = b"".join(s + prefixfree._END for s in strings)
    suffix = [whole[k : ends[np.searchsorted(ends, k, "right")]] for k in start[order].tolist()]
    assert suffix == sorted(suffix) and len(suffix) == sum(len(s) - 39 for s in strings)


def test_triggers_are_near_and_local():
    rng = np.random.default_rng(6)
    for letters in (2, 26, 200):
        data = rng.integers(1, 1 + letters, 30_000).astype(np.uint8)
        reach = prefixfree.reach_of(400)
        at = prefixfree.triggers(prefixfree.eight_bytes(data), np.array([0, len(data)]), reach)
        assert np.diff(at).max() <= reach and at[0] <= reach
        part = prefixfree.triggers(prefixfree.eight_bytes(data[5000:9000]), np.array([0, 4000]), reach)
        inside = lambda x: x[(x >= 5000 + reach) & (x <= 9000 - reach - 8)]
        assert inside(at).tolist() == inside(part + 5000).tolist()


def test_query_matches_sql_and_every_string(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.queries()["op13_prefix_free"](spark, sf)
    r = compare(df, duck(sf), queries.oracle_sql()["op13_prefix_free"])
    assert r["ok"], r
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain(rows, 400)]
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)
