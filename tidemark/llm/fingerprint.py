"""Document fingerprints from closed syncmers (native: no Python on the executors).

A k-mer of ``K`` characters (code points) is an anchor when the least hash
among its inner substrings of ``S`` characters lies at its first or its last
place.  That depends on the k-mer's own characters alone, so an edit touches
only anchors within ``K`` characters of it, in spaced and unspaced scripts
alike, and every run of ``2 * K - S - 1`` characters that two texts share
gives at least one common anchor.

A fingerprint lists every distinct anchor, by hash: 39 bits of its hash, how
often it occurs (as a power of two, rounded down) and its first place (modulo
2^18), in one long.  Nothing else decides which: neither the length of the
text nor its other anchors.  So texts that share a run of that length have an
anchor in common, and a phrase repeated a thousand times is a few entries that
weigh a thousand.

Likeness of two fingerprints: of the weight of all anchors (of those in both
the larger one) the share that is in both (the lesser one); anchors whose
first places do not agree with the median shift to within ``SLACK``
characters (a phrase that moved) count one half.  Without a common anchor it
is 0.0; two different texts can only seem to have one if 39 bits of two
hashes are equal.

Nulls count as empty.  A text without an anchor (always, below ``K``
characters) has one, the whole text; an empty text has an empty fingerprint,
which is like another empty one (1.0) and unlike anything else (0.0).
Repeated rows of an id follow one another by a hash of their texts; null ids
come last.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import only

K, S = 28, 4
SPAN = K - S + 1  # inner substrings of a k-mer
SLACK = 48
TOP = (1 << 63) - 1
#: An entry of a fingerprint: hash << 24 | log2(count) << 19 | place << 1 | side (0; 1 while two are compared).
HASH, COUNT, PLACE = 24, 19, (1 << 18) - 1
#: Documents a bucket of neighbouring ids holds at most about; more than this many buckets are never made.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 20_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column) -> Column:
    """array<struct<h bigint, p int>>: every anchor of the text (39-bit hash of the k-mer, place), in text order; empty below ``K`` characters."""
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{S}}}))."), F.lit(1))
    hashes = F.transform(grams, lambda g: F.xxhash64(g))

    lower = lambda a, by: F.zip_with(a, F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0))), lambda x, y: F.least(x, y))

    def closed(s: Column, least8: Column) -> Column:
        n = F.greatest(F.size(s) - (SPAN - 1), F.lit(0))
        edges = F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(SPAN), n), lambda x, y: F.least(x, y))

        def anchor(edge: Column, i: Column) -> Column:
            # ``least8`` is the least of eight neighbours; three of them cover all but the last place, and most k-mers fail at the first.
            least = (edge <= F.get(least8, i + 8)) & (edge <= F.get(least8, i + 16)) & (edge <= F.get(least8, i))
            whole = F.xxhash64(*[F.get(s, i + j) for j in range(0, K, S)])
            return F.when(least, F.struct(F.shiftrightunsigned(whole, HASH + 1).alias("h"), i.cast("int").alias("p")))

        return F.array_compact(F.transform(edges, anchor))

    # Each step is bound before the next one, which names it more than once.
    return let(hashes, lambda s: let(lower(s, 1), lambda a: let(lower(a, 2), lambda b: let(lower(b, 4), lambda least8: closed(s, least8)))))


def entry(h: Column, p: Column) -> Column:
    return F.shiftleft(h, HASH) + F.shiftleft(p.bitwiseAND(F.lit(PLACE)), 1)


def hash_of(x: Column) -> Column:
    return F.shiftright(x, HASH)


def entries(found: Column, by: Column | int = 0) -> Column:
    """Anchors as entries, moved by some places."""
    return F.transform(found, lambda x: entry(x["h"], (x["p"] + by).cast("long")))


def distinct(found: Column, text: Column, n_chars: Column) -> Column:
    """The fingerprint out of all anchors' entries: one per hash, at its first place, by hash; without any anchor, the whole text.

    Entries come in any order and sort as longs.  Among equal hashes the least place modulo 2^18
    comes first, which is the first place in texts of up to that length.
    """
    whole = F.array(entry(F.shiftrightunsigned(F.xxhash64(text), HASH + 1), F.lit(0).cast("long")))
    starts = lambda c: F.array_compact(F.transform(c, lambda x, i: F.when((i == 0) | (hash_of(F.get(c, i - 1)) != hash_of(x)), i)))
    times = lambda n: F.when(n == 1, F.lit(0)).otherwise(F.floor(F.log2(n.cast("double")))).cast("long")
    counted = lambda c, f: F.transform(f, lambda i, j: F.get(c, i) + F.shiftleft(times(F.coalesce(F.get(f, j + 1), F.size(c)) - i), COUNT))
    some = let(F.array_sort(found), lambda c: let(starts(c), lambda f: counted(c, f)))
    return F.when(n_chars == 0, F.array().cast("array<bigint>")).when(F.size(found) == 0, whole).otherwise(some)


def as_text(a: Column) -> Column:
    """Entries in hexadecimal, comma-joined."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.hex(x)), ","))


def likeness(a: Column, b: Column) -> Column:
    """Share of the weight of two fingerprints that they have in common (0 to 1), anchors at disagreeing places by half.

    Both are in order of hash, so sorting them together is a merge; a hash in
    both meets as neighbours.
    """
    weight = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, COUNT).bitwiseAND(F.lit(31)).cast("int"))
    place = lambda x: F.shiftright(x, 1).bitwiseAND(F.lit(PLACE))
    total = lambda xs, of: F.aggregate(xs, F.lit(0).cast("long"), lambda t, x: t + of(x))
    # The shift from the first text to the second, modulo 2^18, around 0.
    ahead = lambda x, y: F.pmod(F.when(x.bitwiseAND(F.lit(1)) == 0, place(y) - place(x)).otherwise(place(x) - place(y)) + (PLACE >> 1), F.lit(PLACE + 1)) - (PLACE >> 1)

    def score(c: Column) -> Column:
        pair = lambda x, y: F.struct(ahead(x, y).alias("s"), F.least(weight(x), weight(y)).alias("m"))
        met = F.array_sort(F.array_compact(F.transform(c, lambda x, i: F.when(hash_of(F.get(c, i + 1)) == hash_of(x), pair(x, F.get(c, i + 1))))))

        def agreed(d: Column) -> Column:
            mid = F.get(d, F.floor(F.size(d) / 2).cast("int"))["s"]
            twice = total(d, lambda x: F.when(F.abs(x["s"] - mid) <= SLACK, x["m"] * 2).otherwise(x["m"]))
            share = twice / 2 / (total(c, weight) - total(d, lambda x: x["m"]))
            return F.when(F.size(d) == 0, F.lit(0.0)).otherwise(share)

        return let(met, agreed)

    both = F.array_sort(F.concat(a, F.transform(b, lambda x: x + 1)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(let(both, score))


def array_of(values: list, kind: str) -> Column:
    """A small driver-side list as an array literal."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def bounds_of(cuts: list[int]) -> list[tuple[int, int]]:
    """Inclusive upper ends (id, tie) of buckets; an id that fills several buckets is cut by its rows' ties."""
    out = []
    for key in sorted(set(cuts)):
        times = cuts.count(key)
        out += [(key, -(1 << 63) + j * ((1 << 64) // times)) for j in range(1, times)] + [(key, TOP)]
    return out


def bucketed(rows: DataFrame) -> DataFrame:
    """Adds ``_key`` (the id, null as the least), ``tie`` and ``_bucket``: ascending runs of about ``BUCKET_ROWS`` (id, tie) places."""
    spark = rows.sparkSession
    rows = rows.withColumns({"_key": F.coalesce("doc_id", F.lit(-(1 << 63))), "tie": F.xxhash64("text")})
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    want = max(1, min(MOST_BUCKETS, max(3 * shuffles, n // BUCKET_ROWS)))
    shares = [i / want for i in range(1, want)]
    cuts = (rows.agg(F.percentile_approx("_key", shares, max(10_000, 10 * want)).alias("c")).first()["c"] or []) if shares else []
    bounds = bounds_of(list(cuts))
    step = max(1, int(len(bounds) ** 0.5))  # two short look-ups in place of a long one
    kind = "array<struct<k:bigint,t:bigint>>"
    as_rows = [{"k": k, "t": t} for k, t in bounds]
    tops, all_ = array_of(as_rows[step - 1 :: step], kind), array_of(as_rows, kind)
    row = F.struct(F.col("_key").alias("k"), F.col("tie").alias("t"))
    below = lambda xs: F.size(F.filter(xs, lambda b: b < row))
    rows = rows.withColumn("_group", below(tops)) if bounds else rows.withColumn("_group", F.lit(0))
    inner = below(F.slice(all_, F.col("_group") * step + 1, F.lit(step))) if bounds else F.lit(0)
    return rows.withColumn("_bucket", F.col("_group") * step + inner).drop("_group")


def with_next(rows: DataFrame, make: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """``make(rows)`` plus ``next``: the struct of ``columns`` of the next row by descending id, the first after the last.

    One shuffle of the texts, by buckets of neighbouring ids; a bucket's first
    row also goes, as a guest, to the bucket before it.  ``make`` runs after
    the shuffle, so what it adds is never shuffled.  Only one (id, tie) per
    bucket comes to the driver.
    """
    rows = bucketed(rows)
    heads = {r["_bucket"]: (r["h"]["k"], r["h"]["t"]) for r in rows.groupBy("_bucket").agg(F.max(F.struct(F.col("_key").alias("k"), F.col("tie").alias("t"))).alias("h")).collect()}
    have = sorted(heads)
    size = (have[-1] if have else 0) + 1
    before = {b: have[(i + 1) % len(have)] for i, b in enumerate(have)}  # the bucket of the next larger ids; the largest ids' head follows the least
    head = array_of([{"k": heads[b][0], "t": heads[b][1]} if b in heads else None for b in range(size)], "array<struct<k:bigint,t:bigint>>")
    to = array_of([before.get(b) for b in range(size)], "array<int>")
    is_head = F.get(head, F.col("_bucket")) == F.struct(F.col("_key").alias("k"), F.col("tie").alias("t"))
    here, guest = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("g")), F.struct(F.get(to, F.col("_bucket")).alias("b"), F.lit(1).alias("g"))
    rows = rows.withColumn("_in", F.explode(F.when(is_head, F.array(here, guest)).otherwise(F.array(here))))
    rows = rows.withColumns({"_b": F.col("_in")["b"], "_guest": F.col("_in")["g"]}).drop("_in", "_bucket")
    order = [F.asc("_guest"), F.desc("_key"), F.desc("tie")]
    rows = make(rows.repartition("_b").sortWithinPartitions("_b", *order))
    rows = rows.withColumn("next", F.lead(F.struct(*columns)).over(Window.partitionBy("_b").orderBy(*order)))
    return rows.where("_guest = 0").drop("_key", "tie", "_b", "_guest")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with likenesses.

    The edited text keeps the first part of the text and appends the head of
    the next one.  Anchors are context-free, so its anchors are those inside
    either part, plus the few across the joint.
    """
    own = only(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(own, lambda r: r.withColumns({"found": anchors(F.col("text")), "n": F.length("text")}).withColumn("fp", distinct(entries(F.col("found")), F.col("text"), F.col("n"))), ["text", "found", "n", "fp"])
    half = F.floor(F.col("n") / 2).cast("int")
    rows = rows.withColumns({"keep": F.col("n") - half, "take": F.least(half, F.col("next")["n"])})
    text, after = F.col("text"), F.col("next")["text"]
    rows = rows.withColumn("edited", F.concat(F.substring(text, F.lit(1), F.col("keep")), F.substring(after, F.lit(1), F.col("take"))))
    inside = lambda a, end: F.filter(a, lambda x: x["p"] <= end - K)
    from_ = F.greatest(F.col("keep") - (K - 1), F.lit(0))
    joint = F.concat(F.substring(text, from_ + 1, F.col("keep") - from_), F.substring(after, F.lit(1), F.least(F.col("take"), F.lit(K - 1))))
    rows = rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fp",
        F.col("next")["fp"].alias("next_fp"),
        distinct(F.concat(entries(inside(F.col("found"), F.col("keep"))), entries(anchors(joint), from_), entries(inside(F.col("next")["found"], F.col("take")), F.col("keep"))), F.col("edited"), F.col("keep") + F.col("take")).alias("edited_fp"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
