"""Operators against plain recomputations, and their work on hot rows."""

import struct
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from marketstar.llm import fingerprints, mixing, quality, sharding, substrings, urls
from marketstar.llm.common import beside, importable


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _hash(values, seed=42):
    for v in values:
        raw = v if isinstance(v, bytes) else struct.pack("<q", _signed(v % (1 << 64)))
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def plain_fingerprint(text):
    """Bin by the top bits, keep each bin's least hash, let empty bins borrow in their own order, keep four bits."""
    words = [_hash([w]) for w in (text or "").encode().split()]
    k = fingerprints.SHINGLE
    hashes = [_hash(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [_hash(words)] if words else []
    if not hashes:
        return ""
    low = (1 << 56) - 1
    least = {}
    for h in hashes:
        place = ((h >> 56) + 128) % 256  # signed order puts the upper half first
        least[place] = min(least.get(place, low), h & low)
    least = {p: v | ((p + 128) % 256) << 56 for p, v in least.items() if v != low}
    out = []
    for i in range(256):
        if i in least:
            out.append(least[i] & 15)
        else:
            start, stride = fingerprints._order_of(i)
            j = next((start + t * stride) % 256 for t in range(256) if (start + t * stride) % 256 in least)
            out.append(_hash([least[j], struct.pack("<i", i)]) & 15)
    return "".join("0123456789abcdef"[d] for d in out)


def test_fingerprint_equals_plain_version(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice([f"w{k}é" for k in range(90)], int(n))) for n in [1, 3, 4, 5, 6, 7, 20, 60, 300, 1500, 4000]] + ["", " \t ", "a " * 50]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = table.select("i", fingerprints.fingerprint(fingerprints.digits(fingerprints.shingles(F.col("text")))).alias("f")).collect()
    assert {r["i"]: r["f"] for r in got} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_reputation_equals_plain_shrinkage(spark):
    importable(spark)
    rng = np.random.default_rng(2)
    pages = []
    for d in range(12):
        rate = rng.beta(1, 3)
        for h in range(4):
            pages += [(f"h{h}.d{d}.{'com' if d % 3 else 'org'}", int(rng.random() < rate)) for _ in range(int(rng.integers(0, 30)))]
    hosts = {h for h, _ in pages} | {"new.d1.com", "lone.net", ""}
    got = {r["host"]: r for r in urls.host_reputation(spark.createDataFrame([(h,) for h in hosts], "host string"), spark.createDataFrame(pages, "host string, bad int")).collect()}
    assert set(got) == hosts
    count = {h: [0, 0] for h in hosts}
    for h, bad in pages:
        count[h][0] += 1
        count[h][1] += bad
    domain = {h: got[h]["domain"] for h in hosts}
    suffix = {got[h]["domain"]: got[h]["suffix"] for h in hosts}
    assert domain["h1.d2.com"] == "d2.com" and suffix["d2.com"] == "com"

    def up(level, of):
        out = defaultdict(lambda: [0, 0])
        for g, (n, bad) in level.items():
            out[of[g]][0] += n
            out[of[g]][1] += bad
        return out

    def strength(level, mu):
        top = base = 0.0
        for g, (n, bad) in level.items():
            if n:
                top += n * ((bad - n * mu[g]) ** 2 / (n * mu[g] * (1 - mu[g])) - 1)
                base += n * (n - 1)
        return 1 / min(max(top / base if base else 0, 1e-3), 0.5) - 1

    domains = up(count, domain)
    suffixes = up(domains, suffix)
    n, bad = len(pages), sum(b for _, b in pages)
    mu = {s: (bad + 0.5) / (n + 1) for s in suffixes}
    k = strength(suffixes, mu)
    at_suffix = {s: (b + k * mu[s]) / (m + k) for s, (m, b) in suffixes.items()}
    mu = {d: at_suffix[suffix[d]] for d in domains}
    k = strength(domains, mu)
    at_domain = {d: (b + k * mu[d]) / (m + k) for d, (m, b) in domains.items()}
    mu = {h: at_domain[domain[h]] for h in hosts}
    k = strength(count, mu)
    grid = np.linspace(0, 1, 400_001)[1:-1]
    for h, (m, b) in count.items():
        alpha, beta = b + k * mu[h], m - b + k * (1 - mu[h])
        assert np.isclose(got[h]["bad_rate"], alpha / (alpha + beta))
        log = (alpha - 1) * np.log(grid) + (beta - 1) * np.log1p(-grid)
        mass = np.cumsum(np.exp(log - log.max()))
        if alpha > 1 and beta > 1:  # the grid resolves these densities
            assert np.isclose(got[h]["bad_lower"], grid[np.searchsorted(mass, 0.05 * mass[-1])], atol=2e-4)


def test_equal_rows_are_spread_and_slots_stay_gapless(spark):
    importable(spark)
    rows = [(None, "same text")] * 6000 + [(5, None)] * 10 + [(6, "")] * 10 + [(i, f"text {i % 700} " * (1 + i % 9)) for i in range(3000)]
    docs = spark.createDataFrame([(t, i, 7) for i, t in rows], "text string, doc_id bigint, size int").repartition(6)
    got = sharding.shard_documents(docs, 8, block=64).collect()
    assert len(got) == len(rows)
    shard, slots, load = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        shard[r["text_group"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shard.values())
    empty = {r["shard"] for r in got if r["size"] == 8}
    assert len(empty) == 1  # a null text is the empty one
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = max(Counter(t or "" for _, t in rows).items(), key=lambda x: x[1])[1] * (len("same text") + 8)
    rest = sorted(load.values())[:-1]
    assert max(load.values()) == hot and max(rest) - min(rest) <= 8  # one group fills a shard of its own, the others balance
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("salt"))
    sizes = [r["count"] for r in mixing.in_buckets(keyed, len(rows)).groupBy(*mixing.BUCKET).count().collect()]
    assert max(sizes) < 2 * mixing._IN_BUCKET and sum(sizes) == len(rows)
    again = sharding.shard_documents(docs.repartition(3), 8, block=64).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_heavy_runs_are_few_for_few_long_documents(spark, monkeypatch):
    importable(spark)
    text = " ".join(f"w{i % 5000}" for i in range(60_000))
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    monkeypatch.setattr(substrings, "_RUN_SHARE", 1e-3)
    assert len(substrings.heavy_runs(docs)) <= 1000
    monkeypatch.setattr(substrings, "_RUN_SHARE", 0.0)
    assert len(substrings.heavy_runs(docs)) >= 4000
    assert len(substrings.heavy_runs(docs.limit(0))) == 0


def test_quality_learns_alike_from_repeated_ids(spark):
    importable(spark)
    rows = [(i, f"A plain text, number {i}, that ends well." if i % 3 else f"JUNK{i}!! %% " * 9) for i in range(150)]
    rows += [(i, "another text of the same id !!") for i in range(0, 150, 2)] * 2
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    a, b = (Counter(map(tuple, quality.rank_quality(d, labels).collect())) for d in (docs.repartition(7), docs.orderBy(F.desc("text"))))
    assert a == b


def test_sides_are_broadcast_only_when_few(spark, monkeypatch):
    from marketstar.llm import common

    assert beside(spark.range(0)) is None
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(beside(spark.range(5)))
    monkeypatch.setattr(common, "FEW_ROWS", 3)
    assert not hinted(beside(spark.range(5)))
