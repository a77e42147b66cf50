"""Spelling variants against all pairs and a plain recomputation of the counts."""

import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from marketstar.llm import queries, variants
from marketstar.llm.common import importable


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def plain(rows, shortest=7, least=2, ratio=10, every=31):
    n = Counter()
    for doc, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= shortest:
                n[low] += 1
    n = {w: c for w, c in n.items() if c >= least}
    by = sorted(n)
    near = {w: [v for v in by if one_apart(w, v)] for w in by}
    form = {}
    for w in by:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in by:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def _rows(seed=1, docs=60):
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abé"), rng.integers(6, 11))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Größe" * 2, "ÀÖßabcd"]
    weight = 1 / np.arange(1, len(stems) + 1) ** 1.5
    rows = []
    for i in range(docs):
        words = []
        for _ in range(80):
            w = str(rng.choice(stems, p=weight / weight.sum()))
            if rng.random() < 0.15:
                p = rng.integers(len(w))
                w = [w[:p] + w[p + 1 :], w[:p] + "b" + w[p:], w[:p] + "A" + w[p + 1 :]][rng.integers(3)]
            words.append(w)
        rows.append((i, " ".join(words)))
    return rows + [(i, "chainword " * 150 + "chainwore " * 12 + "chaimwore ") for i in (70, 71, 72)] + [(None, "aaaaaaa aaaaaaab " * 3), (None, None), (7, ""), (8, "aaaaaaa, aaaaaaa! x÷y×zabcd " * 40), (8, "aaaaaaa, aaaaaaa! x÷y×zabcd " * 40), (900, "long" * 4000 + " " + "long" * 4000)]


@pytest.mark.parametrize("most", [3, 1000])
def test_forms_equal_all_pairs(spark, most):
    importable(spark)
    rows = _rows()
    docs = spark.createDataFrame([(t, i, "clash", 1) for i, t in rows], "text string, doc_id bigint, word string, n int")
    got = sorted(map(tuple, variants.variant_forms(docs, most=most).collect()))
    want = plain(rows)
    assert got == want
    assert len(want) > 100 and any(r[1] and r[1] != r[2] for r in want)  # chains of forms occur
    assert variants.variant_forms(docs.limit(0)).count() == 0


def test_near_pairs_of_any_words(spark):
    importable(spark)
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab\U0001f600"), rng.integers(1, 8))) for _ in range(700)} | {"a", "b", "ab", "ba", "aab"})
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n bigint")
    for most in (2, 20, 5000):
        got = sorted((r["word"], r["near"]) for r in variants.near_pairs(table, most).collect())
        # no key holds words of no letters, so the single letters' pairs are those of the other lengths too
        assert got == sorted((a, b) for a in words for b in words if one_apart(a, b))


def test_query_equals_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.queries()["op12_variants"](spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {r["word"]: tuple(r) for r in got.collect()}
    n = {w: r[3] for w, r in got.items()}
    counted = Counter()
    for doc, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]{7,}", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{low}".encode())
            counted[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 31 == 0 else low] += 1
    assert n == {w: c for w, c in counted.items() if c >= 2 and len(w) >= 7}
    words = sorted(n)[:: max(1, len(n) // 150)]
    for w in words:  # some words against the whole vocabulary
        near = [v for v in n if one_apart(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        assert got[w][1] == form and got[w][4] == len(near) and got[w][5] == (n[form] if form else None)
