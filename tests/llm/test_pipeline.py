"""Every stage of the corpus pipeline, and ``run``, against brute force on tables with null and repeated ids."""

import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from marketstar.llm import mixing, packing
from marketstar.llm.common import importable
from marketstar.llm.queries import SEQUENCE, word_tokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, copies int"


def _text(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


SHARED = _text("shared", 40)
TEXTS = [
    (None, _text("a", 50)), (None, _text("b", 50)), (None, None), (None, ""), (1, _text("c", 60)), (1, _text("d", 60)),
    (2, _text("c", 60) + " end"), (3, _text("e", 20) + " " + SHARED), (4, SHARED + " " + _text("f", 45)), (5, "x y"), (5, "x y"), (None, _text("a", 50)),
]
ROWS = [(i, t, "en" if k % 2 else None, "web" if len(t or "") % 3 else None, len(t or ""), 0.5, 7) for k, (i, t) in enumerate(TEXTS)]


def _rows(df):
    return Counter((r["doc_id"], r["text"] or "") for r in df.collect())


def _words(t):
    return (t or "").split()


def _shingles(t):
    w = _words(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near_duplicates(rows):
    """The classes; no shingle repeats in these texts, so plain sets do."""
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = _shingles(rows[i][1]), _shingles(rows[j][1])
            if (not a and not b) or (a | b and len(a & b) / len(a | b) >= 0.8):
                group = [group[j] if g == group[i] else g for g in group]
    classes = defaultdict(list)
    for g, r in zip(group, rows, strict=True):
        classes[g].append(r)
    return list(classes.values())


def passages_cut(rows):
    """Each row's words outside all repeated windows."""
    count = Counter()
    for _, t in rows:
        w = _words(t)
        count.update(tuple(w[j : j + 35]) for j in range(len(w) - 34))
    out = []
    for _, t in rows:
        w = _words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 34):
            if count[tuple(w[j : j + 35])] > 1:
                gone[j : j + 35] = [True] * 35
        out.append(" ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    importable(spark)
    at = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_toxic_documents_go(spark, docs, folder, tmp_path):
    plain = lambda i: " ".join(f"word{(i * 7 + k * 3) % 40}" for k in range(20 + i % 30))
    rows = [(i if i % 50 else None, plain(i) if i % 4 else plain(i) + " vileword", None, "s", 0, 0.0, 1) for i in range(300)]
    table = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300) if i % 50], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = P.drop_toxic(spark, table, str(tmp_path))
    kept = _rows(got)
    assert got.columns == P.COLUMNS and not kept - _rows(table)
    wrong = sum((Counter((r[0], r[1]) for r in rows if "vileword" not in r[1]) - kept).values()) + sum(n for (_, t), n in kept.items() if "vileword" in t)
    assert wrong <= 0.1 * len(rows)
    assert _rows(P.drop_toxic(spark, docs, folder)) == _rows(docs)  # no labels: nothing is toxic


def test_one_of_each_class_stays(spark, docs, folder):
    got = P.drop_near_duplicates(spark, docs, folder)
    classes = brute_near_duplicates(TEXTS)
    kept = [(r["doc_id"], r["text"] or "") for r in got.collect()]
    assert got.columns == P.COLUMNS and len(kept) == len(classes)
    for members in classes:
        mine = [k for k in kept if k in [(i, t or "") for i, t in members]]
        assert len(mine) == 1 and mine[0][0] == min((i for i, _ in members if i is not None), default=None)


def test_repeated_passages_go(spark, docs, folder):
    got = P.drop_repeated_passages(spark, docs, folder)
    assert got.columns == P.COLUMNS and _rows(got) == Counter(zip([i for i, _ in TEXTS], passages_cut(TEXTS), strict=True))
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())


def test_copies_are_rows(spark, docs, folder):
    got = P.mix_sources(spark, docs, folder)
    want = Counter()
    for r in mixing.mix_documents(docs.select(*P.COLUMNS), weights=(5, 2, 1), cap=3).collect():
        want[(r["doc_id"], r["text"] or "")] += r["copies"]
    assert got.columns == P.COLUMNS and _rows(got) == +want


def _packed(df):
    return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())


def test_run_is_the_stages_in_order(spark, docs, folder):
    kept = [(r["doc_id"], r["text"]) for r in P.drop_near_duplicates(spark, docs, folder).collect()]
    sources = {(i, t or ""): s for i, t, _, s, _, _, _ in ROWS}
    cut = [(i, x, sources[(i, t or "")]) for (i, t), x in zip(kept, passages_cut(kept), strict=True)]
    table = spark.createDataFrame(cut, "doc_id bigint, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    mixed = P.mix_sources(spark, table, folder)
    assert _packed(P.run(spark, folder)) == _packed(packing.pack_documents(mixed, word_tokenizer(), SEQUENCE))


def test_empty_tables(spark, docs, folder, tmp_path):
    docs.limit(0).write.parquet(os.path.join(tmp_path, "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
