"""Document fingerprints by one-permutation MinHash (DataFrame functions only).

Every five-word shingle is hashed once.  The hash's top bits choose one of
``BINS`` bins, the bin keeps its least hash.  An empty bin takes the value of
a non-empty one by optimal densification: it tries bins in its own fixed
pseudo-random order, the same for every document, so two documents borrow
alike.  The low four bits of every bin are kept, one hex digit each.  Two
fingerprints agree by chance in one of 16 digits, which the likeness
``(share of equal digits - 1/16) / (15/16)`` corrects for.

Defined cases: null text is empty; a text without words has the empty
fingerprint, which is like another empty one (1.0) and unlike any other (0.0);
a text of one to four words has one shingle, all of its words; null ids come
before all others; rows with one id are ordered by their texts; the only row
of a table is its own successor; equal rows, which are ties, follow each other;
texts of any length are read whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import itertools
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstar.llm.common import beside, let

BINS = 256
BITS = 4
SHINGLE = 5
_PROBES = 8
_BIN_BITS = BINS.bit_length() - 1
_REST = (1 << (64 - _BIN_BITS)) - 1  # the hash below its bin
_MAX_BUCKETS = 16_384
_SAME = 5000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _order_of(b: int) -> tuple[int, int]:
    """Start and odd stride of the order in which empty bin ``b`` tries the bins; it visits all of them."""
    x = (b + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
    x ^= x >> 31
    return x % BINS, (x >> 20) % BINS | 1


def _ints(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words of a text (with repeats); the empty array for a text without words."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(parts, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(h) >= SHINGLE, each).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.expr("cast(array() as array<bigint>)"))

    return let(hashes, runs)


def digits(hashes: Column) -> Column:
    """The fingerprint's digits (array<tinyint> of BINS values under 16); empty for no shingles."""
    guards = F.array(*[F.lit(_signed((b << (64 - _BIN_BITS)) | _REST)) for b in range(BINS)])  # one value above all others of each bin
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - _BIN_BITS)
    taken = lambda x: x.bitwiseAND(F.lit(_REST)) != _REST

    def least(s: Column) -> Column:  # sorted: each bin's first value is its least
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    start_stride = [_order_of(b) for b in range(BINS)]
    tries = _ints((a + t * s) % BINS for a, s in start_stride for t in range(_PROBES))
    starts = _ints(a for a, _ in start_stride)
    undo = _ints(pow(s, -1, BINS) for _, s in start_stride)

    def densify(v: Column) -> Column:
        def first_taken(i: Column) -> Column:
            """The first non-empty bin in the order of bin ``i``."""
            def probe(t: int) -> Column:
                x = F.get(v, F.get(tries, i * _PROBES + t))
                return F.when(taken(x), x)

            place = lambda j: F.pmod((j - F.get(starts, i)) * F.get(undo, i), F.lit(BINS)) * BINS + j
            others = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: taken(F.get(v, j)))
            return F.coalesce(*[probe(t) for t in range(_PROBES)], F.get(v, F.array_min(F.transform(others, place)) % BINS))

        # a borrowed value is hashed with the bin, or one shingle would decide all digits of a short text
        return F.transform(v, lambda x, i: F.when(taken(x), x).otherwise(F.xxhash64(first_taken(i), i)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("tinyint"))

    def of(h: Column) -> Column:
        filled = let(let(F.sort_array(F.concat(h, guards)), least), densify)
        return F.when(F.size(h) > 0, filled).otherwise(F.expr("cast(array() as array<tinyint>)"))

    return let(hashes, of)


def fingerprint(ds: Column) -> Column:
    hexes = F.array(*[F.lit(c) for c in "0123456789abcdef"])
    return F.array_join(F.transform(ds, lambda d: F.get(hexes, d.cast("int"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two documents' shingle sets from their digits."""
    chance = 1.0 / (1 << BITS)
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / float(BINS)
    corrected = F.greatest(F.lit(0.0), (equal - chance) / (1.0 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(corrected)


def deal(rows: DataFrame, bytes_per_bucket: int = 1_000_000) -> DataFrame:
    """Every row with its place in a range (``__at``: range ``b``, ``guest``) and its order there, ``__ord`` and ``__tie``.

    Ranges of (id, text hash) hold about equally many rows; each also gets the first row of the next one as a guest.
    Equal rows beyond ``_SAME`` are successors of each other and lie in ranges below 0, in any order.
    """
    low, high = -(1 << 63), (1 << 63) - 1
    rows = rows.withColumns({"__ord": F.coalesce(F.col("doc_id").cast("long"), F.lit(low)), "__tie": F.xxhash64("text")})
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).first()
    count = min(_MAX_BUCKETS, max(1, (size["n"] or 0) // bytes_per_bucket, -(-size["rows"] // _SAME)))
    slices = {low: 1}
    if count > 1:
        cut = rows.agg(F.percentile_approx("__ord", [i / count for i in range(1, count)], 10 * count).alias("c")).first()["c"]
        often = Counter(int(x) for x in cut or [])
        slices |= {x: n + 1 if n > 1 else 1 for x, n in often.items()}
        # an id that fills several ranges has them to itself, by text hash
        for x, n in often.items():
            if n > 1 and x < high:
                slices.setdefault(x + 1, 1)
    bounds = sorted(slices)
    bound, steps = F.array(*[F.lit(x) for x in bounds]), range(len(bounds).bit_length(), -1, -1)

    def narrow(at: Column, step: Column) -> Column:
        up = at + step
        return F.when((up < len(bounds)) & (F.get(bound, up) <= F.col("__ord")), up).otherwise(at)

    rows = rows.withColumn("__bucket", F.aggregate(F.array(*[F.lit(1 << s) for s in steps]), F.lit(0), narrow))
    if max(slices.values()) > 1:
        each = [slices[x] for x in bounds]
        base = _ints(itertools.accumulate(each, initial=0))
        share = F.get(_ints(each), F.col("__bucket"))
        part = F.least(F.floor((F.col("__tie") / F.lit(2.0**64) + 0.5) * share).cast("int"), share - 1)
        rows = rows.withColumn("__bucket", F.get(base, F.col("__bucket")) + part)
    by_bucket = Window.orderBy("__bucket")
    first = (
        rows.groupBy("__bucket")
        .agg(F.min(F.struct("__ord", "__tie")).alias("f"))
        .withColumn("__before", F.coalesce(F.lag("__bucket").over(by_bucket), F.max("__bucket").over(Window.partitionBy(F.lit(0)))))
        .select("__bucket", F.col("f.__ord").alias("__f_ord"), F.col("f.__tie").alias("__f_tie"), "__before")
    )
    # at most 3 * _MAX_BUCKETS rows of four numbers
    rows = rows.join(F.broadcast(first), "__bucket")
    is_first = (F.col("__ord") == F.col("__f_ord")) & (F.col("__tie") == F.col("__f_tie"))
    here = F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest"))
    there = F.struct(F.col("__before").alias("b"), F.lit(True).alias("guest"))
    places = F.when(is_first, F.array(here, there)).otherwise(F.array(here))
    same = beside(rows.groupBy("__ord", "__tie").agg(F.count("*").alias("__same")).where(F.col("__same") > _SAME))
    if same is not None:
        # about _SAME copies stay in the order, the last of them before the next row
        rows = rows.join(same, ["__ord", "__tie"], "left").withColumn("__spare", F.coalesce(F.rand(5) * F.col("__same") > _SAME, F.lit(False)))
        aside = F.struct((-1 - F.floor(F.rand(6) * count)).cast("int").alias("b"), F.lit(False).alias("guest"))
        places = F.when(F.col("__spare"), F.array(aside)).otherwise(places)
        rows = rows.drop("__same")
    else:
        rows = rows.withColumn("__spare", F.lit(False))
    return rows.withColumn("__at", F.explode(places)).drop("__bucket", "__f_ord", "__f_tie", "__before", "__spare")


def with_next(rows: DataFrame, fields: list[str], bytes_per_bucket: int = 1_000_000) -> DataFrame:
    """Every row with ``fields`` of its successor by doc_id and text (after the last: the first) as ``next_<field>``.

    Rows are dealt to ranges (``deal``), so one shuffle serves all; ``fields`` are functions of doc_id and text.
    """
    dealt = deal(rows, bytes_per_bucket)
    order = Window.partitionBy("__at.b").orderBy("__at.guest", "__ord", "__tie")
    following = {f"next_{f}": F.when(F.col("__at.b") < 0, F.col(f)).otherwise(F.lead(f).over(order)) for f in fields}
    return dealt.withColumns(following).where(~F.col("__at.guest")).drop("__ord", "__tie", "__at")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text: the second half of its code points replaced by the first
    as many (or all) of the next document's.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("digits", digits(shingles(F.col("text")))), ["text", "digits"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "digits", "next_digits", edited.alias("edited"))
    rows = rows.select("*", digits(shingles(F.col("edited"))).alias("edited_digits"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("digits")).alias("fingerprint"),
        fingerprint(F.col("edited_digits")).alias("edited_fingerprint"),
        likeness(F.col("digits"), F.col("edited_digits")).alias("near_edited"),
        likeness(F.col("digits"), F.col("next_digits")).alias("near_next"),
    )
