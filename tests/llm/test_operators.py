"""Every operator against a brute-force version on small tables with nulls, empties, ties, repeats and extra columns."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketstar.llm import fingerprints, mixing, neardup, packing, quality, search, sharding, substrings, toxicity, urls
from marketstar.llm.common import importable
from marketstar.llm.queries import URL_RULES, word_tokenizer

LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"),
    (2, " ".join(f"w{i}" for i in range(10, 70)), "a"),
    (3, None, None),
    (4, "", "b"),
    (5, " \t\n", "b"),
    (6, "x y", "b"),
    (6, "x y", "b"),
    (7, "na " * 100, "c"),
    (8, LONG + " tail", None),
    (None, "lone é text of six words", "c"),
    (9, "big " + "very long " * 4000, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    rows = [(i, t, s, 0, "e", 1.5) for i, t, s in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint, size string, score double")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _words(t):
    return (t or "").encode().split()


def test_urls(spark):
    pages = [(1, "http://Blog.Example.com/en/1?x"), (2, "https://www.example.com/en/2"), (3, "http://a.example.net/es/"), (4, None), (5, "no scheme"), (6, "ftp://x.org#f"), (6, "ftp://x.org#f"), (7, "http://bad.org/")]
    pages += [(100 + i, f"http://bad.org/{i}") for i in range(60)] + [(300 + i, f"http://good.org/{i}") for i in range(60)]
    labels = [(100 + i, 0, 0) for i in range(60)] + [(300 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (1, None, None), (2, 7, 0)]
    p = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = urls.filter_urls(p, lab, URL_RULES).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(pages)
    assert (by[1]["host"], by[1]["path"], by[1]["rule"], by[1]["verdict"]) == ("blog.example.com", "/en/1", "example.com/en/", "block")
    assert (by[2]["rule"], by[2]["verdict"]) == ("www.example.com/en/", "allow")
    assert (by[3]["rule"], by[3]["verdict"]) == ("net/es/", "block")
    assert by[4]["host"] == by[5]["host"] == by[5]["path"] == "" and by[6]["host"] == "x.org" and by[6]["path"] == ""
    assert by[7]["rule"] is None and by[7]["verdict"] == "block" and by[300]["verdict"] == "allow"
    assert urls.filter_urls(p.limit(0), lab.limit(0), URL_RULES).count() == 0


def test_beta_quantile_inverts_its_integral():
    a, b = np.array([0.5, 2.0, 30.0, 900.0]), np.array([0.5, 5.0, 3.0, 1100.0])
    assert np.allclose(urls.beta_cdf(urls.beta_quantile(0.05, a, b), a, b), 0.05, atol=1e-6)
    assert np.allclose(urls.beta_cdf(np.array([0.3]), np.array([1.0]), np.array([1.0])), 0.3)


def test_mixing_reaches_targets(spark, docs, empty):
    rows = [(i, "w " * (1 + (i * 37) % 400), f"s{i % 4}" if i % 9 else None) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_documents(table, carry=["doc_id"]).collect()
    again = mixing.mix_documents(table.repartition(5), carry=["doc_id"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(_words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest, free = sum(size.values()) - sum(3 * size[s] for s in full), [s for s in order if s not in full]
        target = {s: 3 * size[s] if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    taken = defaultdict(int)
    for r in got:
        s = rows[r["doc_id"]][2]
        taken[s] += r["taken"]
        assert r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s] and 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= max(10, 0.001 * target[s]) for s in order)
    edge = mixing.mix_documents(docs)
    assert edge.count() == len(ROWS) and "score" in edge.columns
    assert mixing.repeat_copies(edge, ["doc_id", "text"]).columns == ["doc_id", "text"]
    assert mixing.mix_documents(empty).count() == 0


def test_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "_SAME", 50)
    monkeypatch.setattr(mixing, "_IN_BUCKET", 50)
    rows = [(None, "same text here")] * 900 + [(None, f"null id {i}") for i in range(600)] + [(5, f"five {i}") for i in range(500)] + [(i, f"text {i}") for i in range(10, 400)]
    table = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string").repartition(4)
    at = fingerprints.deal(table).groupBy("__at.b").count().collect()
    assert max(r["count"] for r in at) <= 300
    got = Counter((r["doc_id"], r["text"], r["next_text"]) for r in fingerprints.with_next(table, ["text"]).collect())
    tie = {r["text"]: r["h"] for r in table.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    assert got == Counter((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True))
    keyed = table.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), F.floor(F.rand(1) * 1000).alias("salt"))
    assert max(r["count"] for r in mixing.in_buckets(keyed, len(rows)).groupBy(*mixing.BUCKET).count().collect()) <= 150
    mixed = [sorted((r["doc_id"] or 0, r["text"], r["copies"]) for r in mixing.mix_documents(t).collect()) for t in (table, table.repartition(7))]
    assert mixed[0] == mixed[1] and len(mixed[0]) == len(rows)


def test_fingerprints(docs, empty):
    usable = docs.where("doc_id is not null")
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(usable).collect()}
    rows = sorted({(i, t or "") for i, t, _ in ROWS if i})
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        if i == 6:
            continue  # two rows
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[3]["fingerprint"] == got[4]["fingerprint"] == "" and got[3]["near_next"] == 1.0
    assert 0.55 < got[1]["near_next"] < 0.85  # 46 of 66 shingles
    assert fingerprints.fingerprint_documents(docs).count() == len(ROWS)
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_repeated_windows(docs, empty):
    count = Counter()
    for _, t, _ in ROWS:
        w = _words(t)
        count.update(tuple(w[j : j + 35]) for j in range(len(w) - 34))
    want = Counter()
    for i, t, _ in ROWS:
        w = _words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 34):
            if count[tuple(w[j : j + 35])] > 1:
                gone[j : j + 35] = [True] * 35
        want[(i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())] += 1
    got = Counter(tuple(r) for r in substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect())
    assert got == want
    assert substrings.remove_repeats(empty).count() == 0


def test_spans_of_equal_rows_are_held_once(docs):
    rows = [(None, LONG)] * 40 + [(7, LONG)] * 40 + [(8, "other words")]
    table = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = substrings.spans_of_texts(table).collect()
    assert len(got) == 2 and all(len(r["spans"]) == len(set(r["spans"])) <= 2 * 60 for r in got)
    kept = Counter(tuple(r) for r in substrings.remove_repeats(table).select("doc_id", "n_words", "n_removed", "kept_text").collect())
    assert kept == Counter({(None, 60, 60, ""): 40, (7, 60, 60, ""): 40, (8, 2, 0, "other words"): 1})


def test_shards(docs, empty):
    got = sharding.shard_documents(docs, 4, block=3).collect()
    assert len(got) == len(ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["shard"]) for r in got if r["doc_id"] == 6}) == 1
    assert next(r for r in got if r["doc_id"] == 6)["text_crc32"] == zlib.crc32(b"x y")
    assert next(r for r in got if r["doc_id"] == 3)["size"] == 8
    assert sharding.shard_documents(empty, 4).count() == 0


def test_differencing_beats_the_largest_item():
    sums = np.zeros((200, 5), np.int64)
    sums[:, 0] = np.random.default_rng(1).integers(1, 10_000, 200)
    final, place = sharding.difference(sums)
    total = np.zeros(5, np.int64)
    for row, p in zip(sums, place, strict=True):
        total[p] += row
    assert (total == final).all() and final.max() - final.min() < 100
    assert (np.sort(place, axis=1) == np.arange(5)).all()


def test_search_is_exact(spark, docs):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(300, rows[5][1]), (301, rows[5][1]), (400, None), (500, [1.0, None]), (600, [float("nan")]), (None, [1.0]), (700, [0.5])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = defaultdict(list)
    for r in search.top_k(table, table.where("vec_id % 100 = 0")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    fit = {i: np.floor(np.pad(np.asarray(v, np.float32).astype(float), (0, 8 - len(v))) * 1024).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    assert set(got) == {i for i in fit if i % 100 == 0}
    for q, best in got.items():
        want = sorted((-int(fit[q] @ v), i) for i, v in fit.items() if i != q)[:10]
        assert sorted(best) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert search.top_k(table.limit(0), table.limit(0)).count() == 0


def test_search_keeps_every_row_of_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 30, [float(x) for x in rng.standard_normal(6)]) for i in range(90)]
    rows += [rows[0]] * 3 + [rows[7]] * 15 + [(10, [0.0, 1.0]), (10, [-0.0, 1.0]), (10, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search.top_k(table, table.where("vec_id % 10 = 0")).collect())
    fit = [(i, np.floor(np.pad(v, (0, 6 - len(v))) * 1024).astype(int)) for i, v in rows]
    want = Counter()
    for q, (i, v) in enumerate(fit):
        if i % 10 == 0:
            best = sorted((-int(v @ w), j) for d, (j, w) in enumerate(fit) if d != q)[:10]
            want.update((i, n + 1, j, -s) for n, (s, j) in enumerate(best))
    assert got == want


def test_near_duplicates(spark, docs, empty):
    base = [f"t{i}" for i in range(100)]
    rows = list(ROWS)
    for k in range(80):
        w = list(base)
        for q in range(k % 4):
            w[(k * 13 + q * 29) % 100] = f"edit{k}_{q}"
        rows.append((100 + k, " ".join(w), None))
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    sets = [neardup.shingle_weights((t or "").encode()) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (not sets[i] and not sets[j]) or neardup.probability_jaccard(sets[i], sets[j]) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = defaultdict(list)
    for g, (i, _, _) in zip(group, rows, strict=True):
        want[g].append(-1 if i is None else i)
    got = defaultdict(list)
    for r in neardup.duplicate_classes(table).collect():
        got[r["class_id"]].append(-1 if r["doc_id"] is None else r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert neardup.keep_one(table).count() == len(want)
    assert neardup.duplicate_classes(empty).count() == 0


def test_near_duplicates_with_null_and_repeated_ids(spark, docs):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(None, one), (None, one + " end"), (None, two), (None, three), (5, "p " + one[::-1]), (5, "q " + two[::-1]), (None, None), (None, ""), (6, three), (6, three)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.duplicate_classes(table).collect()
    classes = Counter((r["root"], r["class_id"], r["class_size"]) for r in got)
    assert sorted(((i is None, i or 0), n) for _, i, n in classes) == sorted([((True, 0), 2), ((True, 0), 1), ((True, 0), 2), ((False, 5), 1), ((False, 5), 1), ((False, 6), 3)])
    assert all(n == size for (_, _, size), n in classes.items())
    kept = Counter((r["doc_id"], r["text"] or "") for r in neardup.keep_one(table).collect())
    small = min(one, one + " end", key=lambda t: hashlib.md5(t.encode()).digest())
    assert kept == Counter([(None, small), (None, two), (5, rows[4][1]), (5, rows[5][1]), (None, ""), (6, three)])


def test_registers_estimate_the_weighted_similarity():
    a = {i: 1.0 + (i % 3) for i in range(200)}
    b = {i: 1.0 + (i % 2) for i in range(40, 240)}
    doc = np.repeat([0, 1], [len(a), len(b)])
    element = np.array([*a, *b], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    regs = neardup.prob_minhash(doc, element, np.array([*a.values(), *b.values()]), 2, 4000)
    assert abs((regs[0] == regs[1]).mean() - neardup.probability_jaccard(a, b)) < 0.04


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    got = packing.pack_documents(docs, word_tokenizer(), 256).collect()
    want = Counter()
    for i, t, _ in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            want[(i, k // 256, k, len(ids[k : k + 256]), zlib.crc32(np.asarray(ids[k : k + 256], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(empty, word_tokenizer()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 513, 4000)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    bins = packing.plan_bins(dict(counts), 512, 64)
    ranks = defaultdict(list)
    for b in bins:
        assert sum(length for length, _ in b.places) <= 512
        for length, rank in b.places:
            ranks[length] += range(rank, rank + b.count)
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in counts.items())
    assert sum(b.count for b in bins) <= -(-int(lengths.sum()) // 512) * 1.03 + 2


def _labelled(spark, good, bad, n=240):
    rows = [(i, good(i) if i % 4 else bad(i)) for i in range(n)] + [(None, good(1)), (n, None), (n + 1, "")]
    labels = [(i, int(i % 4 > 0), int(i % 4 == 0)) for i in range(n)] + [(None, 1, 1), (n, None, None), (0, 0, 1)]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash")),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        len(rows),
    )


def test_quality_on_held_out_documents(spark):
    table, labels, n = _labelled(spark, lambda i: f"A plain text, number {i}, that ends well and says some things.", lambda i: " ".join(f"JUNK{i}!!%%" for _ in range(20)))
    got = quality.rank_quality(table, labels).collect()
    assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 240]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert {r["score"] for r in quality.rank_quality(table, labels.limit(0)).collect()} == {0.5}
    assert quality.rank_quality(table.limit(0), labels).count() == 0


def test_toxicity_on_held_out_documents(spark):
    filler = [f"word{k}" for k in range(40)]
    text = lambda i: " ".join(filler[(i * 7 + k * 3) % 40] for k in range(20 + i % 60))
    table, labels, n = _labelled(spark, text, lambda i: text(i) + " vileword " + text(i + 1), 300)
    got = toxicity.score_toxicity(table, labels).collect()
    assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    right = np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held])
    assert right >= 0.9
    assert {r["score"] for r in toxicity.score_toxicity(table, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(table.limit(0), labels.limit(0)).count() == 0


def test_toxicity_learns_from_documents_of_all_lengths(spark):
    rows = [(i, "word " * (2000 if i % 3 == 0 else 20)) for i in range(60)] + [(0, "shorter"), (None, "no id"), (4, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    drawn = toxicity.draw(table, labels, 3, 1).collect()
    want = {i: len(t) for i, t in rows[:60] if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {r["doc_id"]: len(r["text"]) for r in drawn} == want and max(want.values()) > 6000
    assert all(r["label"] == r["doc_id"] % 2 for r in drawn)
    less = toxicity.draw(table, labels, 3, 1, most_bytes=25_000).collect()
    per = Counter()
    for r in less:
        per[r["label"]] += len(r["text"])
    # a long text that does not fit does not end the draw
    assert 10_000 < max(per.values()) <= 25_000 and sum(len(r["text"]) < 6000 for r in less) == sum(n < 6000 for n in want.values())
    assert toxicity.draw(table, labels.where("toxic = 1"), 3, 1) is None


def _random_network(seed=0):
    rng = np.random.default_rng(seed)
    h, d = toxicity.HIDDEN, 2 * toxicity.DIM
    p = {"att": rng.standard_normal(2 * h), "out": rng.standard_normal(2 * h), "bias": rng.standard_normal(1)}
    for s in "fb":
        p |= {f"w{s}": rng.standard_normal((d, 3 * h)) / 2, f"u{s}": rng.standard_normal((h, 3 * h)) / 2, f"b{s}": rng.standard_normal(3 * h) / 2}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    return toxicity.Model(*(rng.standard_normal((toxicity.HASHES, toxicity.DIM)).astype(np.float32) for _ in range(2)), p)


def test_toxicity_scores_every_window(monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", 25)
    n_words = [90, 0, 2, 32, 31, 33, 200, 0, 1]
    texts = [" ".join(f"a{(7 * i + k) % 61}" for i in range(n)) for k, n in enumerate(n_words)]
    for part in (texts, texts[1:3], texts[:1], texts[:0]):
        for c in toxicity.chunks(toxicity.pa.array(part, "string")):
            m = _random_network()
            every = toxicity.batch_of(c, 1)
            score = toxicity.logits(m, every)
            assert np.bincount(every.doc).tolist() == [max(1, len(t.split()) - 31) for t in part]
            assert np.allclose(toxicity.highest(m, c), [score[every.doc == i].max() for i in range(len(part))], atol=1e-4)


def test_toxicity_score_equals_a_scalar_recomputation():
    m, text = _random_network(3), "Some words, REPEATED words and others é " * 6
    c = next(iter(toxicity.chunks(toxicity.pa.array([text], "string"))))
    b, number, _ = toxicity._words_of(c)
    x, p, h = toxicity.inputs(m, b).astype(float), m.params, toxicity.HIDDEN
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def states(seq, s):
        state, out = [0.0] * h, []
        for word in seq:
            pre = [sum(x[word][i] * p[f"w{s}"][i][j] for i in range(x.shape[1])) + p[f"b{s}"][j] for j in range(3 * h)]
            z, r = ([sigmoid(pre[o + j] + sum(state[i] * p[f"u{s}"][i][o + j] for i in range(h))) for j in range(h)] for o in (0, h))
            new = [np.tanh(pre[2 * h + j] + sum(r[i] * state[i] * p[f"u{s}"][i][2 * h + j] for i in range(h))) for j in range(h)]
            state = [state[j] + z[j] * (new[j] - state[j]) for j in range(h)]
            out.append(state)
        return out

    scores = []
    for at in range(len(number) - 1 - toxicity.WINDOW + 1):
        seq = number[at : at + toxicity.WINDOW].tolist()
        both = [f + g for f, g in zip(states(seq, "f"), states(seq[::-1], "b")[::-1], strict=True)]
        weight = np.exp([sum(a * v for a, v in zip(p["att"], st, strict=True)) for st in both])
        scores.append(sum(w * sum(o * v for o, v in zip(p["out"], st, strict=True)) for w, st in zip(weight, both, strict=True)) / weight.sum() + p["bias"][0])
    assert np.isclose(toxicity.highest(m, c)[0], max(scores), atol=1e-3)


def test_recurrent_gradients_match_differences():
    rng = np.random.default_rng(0)
    scale = lambda *s: rng.standard_normal(s) * 0.4
    h, d = toxicity.HIDDEN, 2 * toxicity.DIM
    p = {"att": scale(2 * h), "out": scale(2 * h), "bias": np.zeros(1)}
    for s in "fb":
        p |= {f"w{s}": scale(d, 3 * h), f"u{s}": scale(h, 3 * h), f"b{s}": np.zeros(3 * h)}
    m = toxicity.Model(np.zeros((1, 1)), np.zeros((1, 1)), p)
    x = scale(6, d)
    window = rng.integers(0, 6, (3, toxicity.WINDOW))
    y = np.array([1.0, 0.0, 1.0])
    _, grads, _ = toxicity.gradients(m, x, window, 5, y)
    for name, at in (("uf", (1, 3)), ("wb", (0, 20)), ("att", (2,)), ("out", (4,)), ("ub", (2, 17))):
        kept, loss = p[name][at], []
        for e in (1e-3, -1e-3):
            p[name][at] = kept + e
            loss.append(toxicity.gradients(m, x, window, 5, y)[0])
        p[name][at] = kept
        assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, rel=0.05, abs=2e-4)
