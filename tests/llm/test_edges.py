"""Very long values and clashing column names."""

import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from marketstar.llm import neardup, packing, quality, search, toxicity, urls
from marketstar.llm.common import importable
from marketstar.llm.queries import URL_RULES, word_tokenizer

LONG = "Some plain words of a very long text. " * 60_000  # over two million code points


def _labelled(spark, extra):
    importable(spark)
    rows = [(i, f"plain words number {i} that end well." if i % 2 else f"vileword {i} !! %% ##") for i in range(60)] + extra
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"]), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    return docs.withColumns({c: F.lit("clash") for c in ("label", "size", "score", "x", "held_out", "predicted")}), labels


def test_long_texts_are_scored_whole(spark):
    docs, labels = _labelled(spark, [(100, LONG), (101, LONG + " vileword 2 !! %% ## vileword 4 !! %% ##"), (102, "x" * 1_000_000)])
    for got in (toxicity.score_toxicity(docs, labels), quality.rank_quality(docs, labels)):
        by = {r["doc_id"]: r["score"] for r in got.collect()}
        assert len(by) == 63 and all(0 <= s <= 1 for s in by.values())
    toxic = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert toxic[101] > toxic[100]  # what is said at the end of a long text counts


def test_long_url(spark):
    importable(spark)
    url = "http://A." + "b." * 50_000 + "net/es/" + "x/" * 100_000 + "?q"
    pages = spark.createDataFrame([(1, url), (2, "x" * 300_000)], "page_id bigint, url string").withColumns({c: F.lit(1) for c in ("rule", "n", "bad", "domain")})
    got = {r["page_id"]: r for r in urls.filter_urls(pages, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), URL_RULES).collect()}
    assert got[1]["host"] == "a." + "b." * 50_000 + "net" and got[1]["path"] == "/es/" + "x/" * 100_000 and got[1]["rule"] == "net/es/" and got[1]["verdict"] == "block"
    assert got[2]["host"] == got[2]["path"] == ""


def test_clashing_columns(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id bigint, text string")
    for extra in (("node", "bucket", "root", "class_id"), ("piece", "task", "length", "ids"), ("n", "main", "i", "j")):
        clash = docs.withColumns({c: F.lit("clash") for c in extra})
        assert {(r["doc_id"], r["class_size"]) for r in neardup.duplicate_classes(clash).collect()} == {(1, 2), (2, 2), (3, 1)}
        assert neardup.keep_one(clash).count() == 2
        assert packing.pack_documents(clash, word_tokenizer()).count() == 3
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    clash = vectors.withColumns({c: F.lit("clash") for c in ("vec", "shard", "block", "number", "score", "row_key")})
    assert search.top_k(clash, clash.where("vec_id = 0"), k=2).count() == 2


def test_pipeline_stages_on_a_long_text(spark):
    docs, labels = _labelled(spark, [(100, LONG), (None, LONG), (7, None)])
    root = f"{spark.conf.get('spark.checkpoint.dir')}/edges"
    docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.mode("overwrite").parquet(f"{root}/documents.parquet")
    labels.write.mode("overwrite").parquet(f"{root}/labels.parquet")
    got = corpus_pipeline.run(spark, root)
    assert got.count() > 0 and got.agg(F.max("length")).first()[0] <= 2048
