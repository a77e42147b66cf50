"""The operators applied to their whole tables with production parameters, and SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstar.llm import alignment, fingerprints, mixing, neardup, packing, prefixfree, quality, search, sharding, substrings, toxicity, urls, variants
from marketstar.llm.common import importable, read_table

#: The filter's explicit rules, (action, host/path).
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SEQUENCE = 2048
SHARDS = 24


def word_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"), URL_RULES)


def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_documents(docs, weights=(5, 2, 1), cap=3, carry=["doc_id"])


def op3_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op4_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), parts=3, held=1, cut=0.7)


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    found = search.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, scale=1024.0)
    return found.select("query_id", "rank", "vec_id", "score")


def op8_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = neardup.duplicate_classes(read_table(spark, sf_dir, "documents"), threshold=0.8)
    return classes.select("doc_id", "class_id", "class_size", F.lower(F.hex("root")).alias("class_key"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), word_tokenizer(), SEQUENCE)


def op10_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rank_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), parts=5, held=0, cut=0.3)


def alignment_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


def op11_merge_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), *alignment_tokenizers())[0]


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_forms(read_table(spark, sf_dir, "documents"), shortest=7, least=2, ratio=10, every=31)


def op13_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prefixfree.remove_repeated_bytes(read_table(spark, sf_dir, "documents"), window=400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_url_filter, op2_entropy_mix, op3_one_permutation, op4_super_kmers, op5_karmarkar_karp,
        op6_toxicity, op7_maxscore, op8_prob_minhash, op9_pack, op10_bradley_terry,
        op11_merge_path, op12_variants, op13_prefix_free,
    )
    return {f.__name__: (lambda spark, sf_dir, f=f: f(importable(spark), sf_dir)) for f in ops}


#: Exact search as a join of the stated queries with all rows; the sum is of whole numbers.  ``k`` tells rows of one id apart.
_OP7_SQL = """
with rows as (
    select vec_id, embedding, row_number() over () as k
    from embeddings
    where vec_id is not null and embedding is not null
),
parts as (
    select k, vec_id, generate_subscripts(embedding, 1) as i, cast(unnest(embedding) as double) as x
    from rows
),
unfit as (select distinct k from parts where x is null or not isfinite(x)),
v as (
    select k, vec_id, i, cast(floor(1024 * x) as bigint) as e
    from parts where k not in (select k from unfit)
),
s as (
    select q.k as query, q.vec_id as query_id, d.k, d.vec_id, cast(sum(q.e * d.e) as bigint) as score
    from v q join v d on q.i = d.i and q.k <> d.k
    where q.vec_id % 100 = 0
    group by 1, 2, 3, 4
)
select query_id, cast("rank" as integer) as "rank", vec_id, score
from (select *, row_number() over (partition by query order by score desc, vec_id) as "rank" from s)
where "rank" <= 10
"""


#: Every 400-byte string of every text by its digest; texts as hex, two digits a byte.
_OP13_SQL = """
with d as (
    select row_number() over () as r, doc_id, lower(hex(encode(coalesce(text, '')))) as h
    from documents
),
w as (
    select r, i, md5(substr(h, cast(2 * i + 1 as bigint), 800)) as k
    from (select r, h, unnest(range(0, length(h) // 2 - 399)) as i from d where length(h) >= 800)
),
again as (select r, i from (select r, i, count(*) over (partition by k) as n from w) where n > 1),
runs as (
    select r, i, sum(new) over (partition by r order by i) as g
    from (select r, i, case when i - lag(i) over (partition by r order by i) <= 400 then 0 else 1 end as new from again)
),
spans as (select r, min(i) as a, max(i) + 400 as z from runs group by r, g),
pieces as (select r, a, z, coalesce(lag(z) over (partition by r order by a), 0) as before from spans),
per as (
    select r, sum(z - a) as n_removed, count(*) as n_spans, max(z) as last,
        string_agg(substr(h, cast(2 * before + 1 as bigint), cast(2 * (a - before) as bigint)), '' order by a) as kept
    from pieces join d using (r)
    group by r
)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
    cast(coalesce(n_spans, 0) as bigint) as n_spans,
    sha256(unhex(case when n_spans is null then h else kept || substr(h, cast(2 * last + 1 as bigint)) end)) as kept_sha256
from d left join per using (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_maxscore": _OP7_SQL, "op13_prefix_free": _OP13_SQL}
