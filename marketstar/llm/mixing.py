"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Every source gets a token target; documents of a source get a rate of copies
``r(size) = cap / (1 + (cap - 1) * exp(-lambda * size / mean size))``: the
exponential tilt (of the odds of ``r`` against the cap) that changes the base
rate of one copy least in entropy while the source's expected tokens meet its
target and no document passes ``cap`` copies.  The dual has one convex
equation per source; distributed Newton steps solve all of them at once over
a histogram (source, size, count), which holds the same sums as the documents.

Rates become whole copies per (source, size) cell: ``floor(n * r + u)`` with
``u`` a hash of the cell, then a bounded set of cells per source (eight in each
power-of-two size class) absorbs what is left of the target, largest sizes
first.  A cell's copies are spread evenly over its documents by rank.  All
sums are of integers, so reruns give the same rows.

Defined cases: null text counts 0 words; texts without words keep one copy
and take nothing; null source is a source of its own, after all others; an
empty table gives an empty result; repeated rows count as documents of their
own, and rows of one size and source, which are ties, get their copies in the
order of id and text; words of texts of any length count.  A carried input
column named like an output column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstar.llm.common import beside, checkpointed, staged, word_count

OUTPUTS = ("size", "source_size", "target", "rate", "copies", "taken")
_KEY = ["src", "no_src"]
BUCKET = ["bucket", "alike", "part"]
_IN_BUCKET = 2048
_SCALE = 256.0
_REPS = 8


def source_targets(sources: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Adds ``target``: weights repeat over the sources in code point order (null last) and share ``share`` of all
    sizes; a target stops at ``cap`` times its source's size and the excess goes to the others by weight.

    ``sources`` has one row per source (a bounded dimension of the corpus), so its windows run over that.
    """
    order = Window.orderBy("no_src", "src")
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * F.lit(float(cap))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "no_src", "src").rowsBetween(Window.unboundedPreceding, -1)
    done = lambda c: F.coalesce(F.sum(c).over(by_ratio), F.lit(0.0))
    return (
        sources.withColumn("w", w)
        .withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("w"))
        .withColumn("level", F.try_divide(F.sum("source_size").over(every) * F.lit(float(share)) - done("limit"), F.sum("w").over(every) - done("w")))
        # the capped sources are a prefix by ratio; the first source behind them sees the final level
        .withColumn("capped", F.min(F.coalesce(F.col("limit") < F.col("w") * F.col("level"), F.lit(True))).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("final", F.min(F.when(~F.col("capped"), F.struct("ratio", "no_src", "src", "level"))).over(every)["level"])
        .withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(F.least("limit", F.col("w") * F.col("final"))))
        .select(*_KEY, "source_size", "n_docs", "target")
    )


def _rate(lam: Column, x: Column, cap: float) -> Column:
    return F.lit(cap) / (1.0 + F.lit(cap - 1.0) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * x))))


def balance(hist: DataFrame, targets: DataFrame, cap: float, max_steps: int = 200) -> DataFrame:
    """Solves every source's dual by safeguarded Newton steps; ``lam`` is null where the target is the cap itself."""
    state = targets.withColumns(
        {
            "mean": F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1.0)),
            "lam": F.when(F.col("target") < F.col("source_size") * (cap * (1 - 1e-9)), F.lit(0.0)),
            "lo": F.lit(None).cast("double"),
            "hi": F.lit(None).cast("double"),
            "miss": F.lit(1e300),
        }
    )
    state = checkpointed(state)
    x = F.col("size") / F.col("mean")
    long = lambda c: F.sum(F.round(c * _SCALE).cast("long")) / _SCALE  # noqa: E731  integer sums do not depend on order
    for _ in range(max_steps):
        tilt = F.col("n") * F.col("size") * F.col("rate")
        sums = (
            hist.join(state, _KEY)
            .where("lam is not null and size > 0")
            .withColumn("x", x)
            .withColumn("rate", _rate(F.col("lam"), F.col("x"), cap))
            .groupBy(*_KEY)
            .agg(long(tilt).alias("f"), long(tilt * F.col("x") * (1.0 - F.col("rate") / cap)).alias("g"))
        )
        err = F.col("f") - F.col("target")
        step = F.col("lam") - F.try_divide(err, F.col("g"))
        lo = F.when(err < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(err > 0, F.col("lam")).otherwise(F.col("hi"))
        bounded = F.greatest(F.col("lam") - 4.0, F.least(F.col("lam") + 4.0, F.coalesce(step, F.col("lam") - 4.0 * F.signum(err))))
        inside = F.coalesce(bounded > F.col("lo2"), F.lit(True)) & F.coalesce(bounded < F.col("hi2"), F.lit(True))
        nxt = F.when(inside, bounded).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        done = F.abs(err) <= F.greatest(F.lit(0.5), F.col("target") * 1e-7)
        state = checkpointed(
            state.join(sums, _KEY, "left")
            .withColumns({"lo2": lo, "hi2": hi, "stop": F.coalesce(done, F.lit(True))})
            .withColumns({"lam": F.when(F.col("stop"), F.col("lam")).otherwise(nxt), "miss": F.when(F.col("stop"), 0.0).otherwise(F.abs(err))})
            .select(*_KEY, "source_size", "n_docs", "target", "mean", "lam", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "miss")
        )
        if not (state.agg(F.max("miss").alias("m")).first()["m"] or 0) > 0:
            return state
    raise RuntimeError(f"the dual is not solved after {max_steps} steps")


def cell_copies(hist: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """Whole copies ``m`` for every (source, size) cell; each source's words come within a few of its target."""
    x = F.col("size") / F.col("mean")
    rate = F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(_rate(F.col("lam"), x, float(cap)))
    u = F.pmod(F.xxhash64("src", "no_src", "size"), F.lit(1 << 20)) / float(1 << 20)
    most = F.col("n") * cap
    cells = (
        hist.join(state.select(*_KEY, "source_size", "target", "mean", "lam"), _KEY)
        .withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate))
        .withColumn("m0", F.greatest(F.lit(0), F.least(most, F.when(F.col("size") == 0, F.col("n")).otherwise(F.floor(F.col("n") * F.col("rate") + u)))).cast("long"))
        .select(*_KEY, "size", "n", "source_size", "target", "rate", "m0")
    )
    left = cells.groupBy(*_KEY).agg((F.round(F.first("target")).cast("long") - F.sum(F.col("m0") * F.col("size"))).alias("left"))
    reps = (
        cells.where("size > 0")
        .groupBy(*_KEY, F.floor(F.log2("size")).alias("cls"), F.pmod(F.xxhash64("size"), F.lit(_REPS)).alias("sub"))
        .agg(F.max(F.struct("n", "size", "m0")).alias("c"))
        .groupBy(*_KEY)
        .agg(F.reverse(F.array_sort(F.collect_list(F.struct("c.size", "c.n", "c.m0")))).alias("reps"))
    )

    def take(acc, c):
        k = F.greatest(-c["m0"], F.least(c["n"] * cap - c["m0"], (acc["left"] / c["size"]).cast("long")))
        return F.struct((acc["left"] - k * c["size"]).alias("left"), F.concat(acc["out"], F.array(F.struct(c["size"].alias("size"), k.alias("k")))).alias("out"))

    start = F.struct(F.col("left").alias("left"), F.expr("cast(array() as array<struct<size:bigint,k:bigint>>)").alias("out"))
    fixes = (
        reps.join(left, _KEY)
        .select(*_KEY, F.inline(F.aggregate("reps", start, take)["out"]))
        .where("k <> 0")
    )
    return cells.join(fixes, [*_KEY, "size"], "left").withColumn("m", F.col("m0") + F.coalesce("k", F.lit(0))).drop("m0", "k")


def in_buckets(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (id, text_key, salt) with the columns of ``BUCKET``: about ``_IN_BUCKET`` rows share them.

    More rows of one id and text than that are alike; they come after all others, in parts of their own by salt.
    """
    buckets = max(16, -(-total // _IN_BUCKET))
    key = F.xxhash64("id", "text_key")
    plain = {"bucket": F.pmod(key, F.lit(buckets)), "alike": F.lit(0).cast("long"), "part": F.lit(0).cast("long")}
    rows = rows.withColumn("key", key)
    many = beside(rows.groupBy("key").agg(F.count("*").alias("same")).where(F.col("same") > _IN_BUCKET))
    if many is None:
        return rows.withColumns(plain).drop("key", "salt")
    part = F.pmod("salt", F.ceil(F.col("same") / F.lit(_IN_BUCKET))).cast("long")
    hot = {"bucket": F.lit(buckets), "alike": F.col("key"), "part": part}
    mixed = {c: F.when(F.col("same").isNotNull(), hot[c]).otherwise(plain[c]).cast("long") for c in BUCKET}
    return rows.join(many, "key", "left").withColumns(mixed).drop("key", "salt", "same")


def mix_documents(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    share: float = 1.0,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every document with its ``copies`` (0 to ``cap``) in the mix and what they take.

    Returns the ``carry`` columns (default: all) plus ``size`` (words), ``source_size``, ``target``, ``rate``,
    ``copies`` and ``taken`` (= copies * size).
    """
    carry = list(carry if carry is not None else docs.columns)
    # one pass over the texts; later passes read the written columns they need
    rows = staged(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
            F.coalesce("source", F.lit("")).alias("src"),
            F.col("source").isNull().alias("no_src"),
            word_count(F.col("text")).alias("size"),
            F.col("doc_id").alias("id"),
            F.xxhash64("text").alias("text_key"),
            F.floor(F.rand(7) * (1 << 30)).alias("salt"),  # written, so all later passes see the same
        ),
        "mix_rows",
    )
    hist = staged(rows.groupBy(*_KEY, "size").agg(F.count("*").alias("n")), "mix_hist")
    sources = hist.groupBy(*_KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    targets = source_targets(sources, weights, cap, share)
    cells = cell_copies(hist, balance(hist, targets, float(cap)), cap)

    total = hist.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = in_buckets(rows, total)
    before = Window.partitionBy(*_KEY, "size").orderBy(*BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*_KEY, "size", *BUCKET)
        .agg(F.count("*").alias("in_bucket"))
        .withColumn("offset", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
        .join(cells, [*_KEY, "size"])
        .drop("in_bucket")
    )
    rank = F.col("offset") + F.row_number().over(Window.partitionBy(*_KEY, "size", *BUCKET).orderBy("id", "text_key"))
    out = (
        rows.join(offsets, [*_KEY, "size", *BUCKET])
        .withColumn("rank", rank)
        .withColumn("copies", F.expr("(rank * m) div n - ((rank - 1) * m) div n").cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c not in OUTPUTS], *OUTPUTS)


def repeat_copies(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every document as many times as it has copies."""
    return mixed.select(*columns, F.explode(F.expr("array_repeat(0, cast(copies as int))")).alias("__copy")).drop("__copy")
