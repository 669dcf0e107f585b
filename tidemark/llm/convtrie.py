"""Prefix trie of conversations: who shares which first turns, and what that saves.

Every conversation is rebuilt from the first turns of its base and its own
later turns; each distinct sequence of first turns is a node.

How it is found:

1. *Prefix digests.*  A turn's place and content are hashed to 128 bits and
   summed along the conversation, so the digest of the first d turns is a
   running sum: it is added up per stretch of ``STRETCH`` turns and carried
   from stretch to stretch, and no conversation has to fit in one task.
2. *Minima.*  Digests are grouped to nodes with their least member, the owner.
   A conversation that owns a node owns every deeper one of its own, so its
   owned nodes form a chain that begins at its first owned depth.
3. *Binary search.*  All conversations look for that depth together: round k,
   from high to low, probes depth (last depth not owned) + 2^k against the
   minima.  Such depths have exactly k trailing zero bits, so a round reads
   only the rows of its ``level``, and all rounds together each row once.  The
   last probe that failed names the node the chain hangs from.
4. *Aggregates.*  Chains hang from chains: leaf counts and savings of a chain
   go to the chain above, reach doubled each round, and then run up along each
   chain, again by stretches.

Turns are ordered by ``turn`` (null first), then by content digest.  Null role
or text counts as empty, rows with a null ``conv_id`` belong to nobody.
Repeated turns are turns of their own.  Only ids, digests and lengths move;
texts never do.  Digests are 128 bits wide and equal ones are taken as equal
turns.  A node's list of ending members is hashed in order, which one task does
for one node: it streams through in pieces of ``PIECE`` ids and is never held.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialize, only
from tidemark.llm.ordering import ranked

STRETCH, PIECE = 1024, 4096
#: SHA-256 of nothing.
NO_ENDS = hashlib.sha256(b"").hexdigest()


def running(rows: DataFrame, key: str, place: str, sums: dict[str, str], down: bool = False) -> DataFrame:
    """Adds ``sums`` (column: name of its running sum) along ``place`` within ``key``; ``down``: from the last place back.

    Added up within stretches of ``STRETCH`` places and carried between them,
    so that a key of any size is spread over tasks.
    """
    order = F.desc if down else F.asc
    cut = rows.withColumn("_cut", F.floor(F.col(place) / STRETCH))
    inner = Window.partitionBy(key, "_cut").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy(order("_cut")).rowsBetween(Window.unboundedPreceding, -1)
    whole = cut.groupBy(key, "_cut").agg(*[F.sum(c).alias(f"_w{i}") for i, c in enumerate(sums)])
    carried = whole.select(key, "_cut", *[F.sum(f"_w{i}").over(earlier).alias(f"_w{i}") for i in range(len(sums))]).where("_w0 is not null")
    out = cut.withColumns({name: F.sum(c).over(inner) for c, name in sums.items()}).join(carried, [key, "_cut"], "left")
    return out.withColumns({name: F.col(name) + F.coalesce(f"_w{i}", F.lit(0)) for i, name in enumerate(sums.values())}).drop("_cut", *[f"_w{i}" for i in range(len(sums))])


def numbered(turns: DataFrame) -> DataFrame:
    """``c, pos`` (from 1 in order of turn), ``x, y`` (digest of the content), ``len``, one row per turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = only(turns, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(1), role, text).alias("y"), F.length(text).cast("long").alias("len")
    )
    rows = rows.withColumn("n", F.monotonically_increasing_id())  # equal turns in great number still spread
    first = ranked(rows, [F.col("c"), F.asc_nulls_first("turn"), F.col("x"), F.col("y"), F.col("n")], "trie-turns")
    parts = first.groupBy("c", "_pid").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select("c", "_pid", F.sum("n").over(Window.partitionBy("c").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("before")).where("before is not null")
    here = F.row_number().over(Window.partitionBy("c", "_pid").orderBy("_idx"))
    # A conversation enters a partition with rows before it only as that partition's first: one row per partition at most.
    placed = first.withColumn("here", here).join(F.broadcast(before), ["c", "_pid"], "left")
    return materialize(placed.select("c", (F.col("here") + F.coalesce("before", F.lit(0))).alias("pos"), "x", "y", "len"), "trie-numbered")


def rebuilt(turns: DataFrame, base: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (``c``, ``n`` turns) and their turns (``c, d, n, x, y, len``) after their heads come from their base."""
    taken = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(heads)).cast("long")
    sizes = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own")).withColumns({"h": taken, "p": F.col("c") - F.col("c") % base})
    above = sizes.select(F.col("c").alias("p"), F.col("own").alias("given"))
    plan = sizes.join(above, "p", "left").withColumn("b", F.least("h", F.coalesce("given", F.lit(0))))
    plan = plan.select("c", "p", "h", "b", (F.col("b") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    plan = materialize(plan, "trie-plan")
    own = turns.where(F.col("pos") > taken).join(plan.select("c", "h", "b", "n"), "c").select("c", (F.col("pos") - F.col("h") + F.col("b")).alias("d"), "n", "x", "y", "len")
    head = turns.where((F.col("c") % base == 0) & (F.col("pos") < heads)).withColumnRenamed("c", "p")
    lent = plan.where("b > 0").join(head, "p").where("pos <= b").select("c", F.col("pos").alias("d"), "n", "x", "y", "len")
    return plan.select("c", "n"), own.unionByName(lent)


def level(depth: str) -> Column:
    """Trailing zero bits of a depth of 1 or more."""
    low = F.col(depth).bitwiseAND(-F.col(depth))
    return F.round(F.log2(low.cast("double"))).cast("int")


def prefixes(rows: DataFrame) -> DataFrame:
    """``c, d, n, len`` and the digest ``k, l`` of the first d turns; sorted by level so that a filter on it skips row groups."""
    wide = "decimal(38,0)"
    salted = rows.withColumns({"sx": F.xxhash64("d", "x", "y").cast(wide), "sy": F.xxhash64(F.lit(3), "d", "x", "y").cast(wide)})
    summed = running(salted, "c", "d", {"sx": "px", "sy": "py"})
    out = summed.select("c", "d", "n", "len", F.xxhash64("px").alias("k"), F.xxhash64(F.lit(5), "py").alias("l"), level("d").alias("level"))
    return materialize(out.sortWithinPartitions("level"), "trie-prefixes")


def first_owned(convs: DataFrame, prefix: DataFrame, minima: DataFrame, least: int, deepest: int) -> DataFrame:
    """``c, n, u, up``: the last depth that ``c`` does not own, and who owns that node."""
    state = convs.select("c", "n", F.lit(0).cast("long").alias("u"), F.lit(least).cast("long").alias("up"))
    for k in reversed(range(deepest.bit_length())):
        probes = prefix.where(F.col("level") == k).select("c", "d", "k", "l").join(state.where(F.col("n") >= 1 << k).select("c", "u"), "c").where(F.col("d") == F.col("u") + (1 << k))
        known = minima.where(F.col("level") == k).select("d", "k", "l", "owner")
        failed = probes.join(known, ["d", "k", "l"]).where("owner <> c").select("c", F.col("d").alias("nu"), F.col("owner").alias("nup"))
        state = state.join(failed, "c", "left").select("c", "n", F.coalesce("nu", "u").alias("u"), F.coalesce("nup", "up").alias("up"))
        state = materialize(state, f"trie-search{k}")
    return state


def totals(chains: DataFrame, least: int) -> DataFrame:
    """``c, leaves, saved``, summed over the chain and all that hang below it; ``chains``: c, up, leaves, saved."""
    tab = chains.select("c", F.when(F.col("c") != least, F.col("up")).alias("up"), "leaves", "saved")
    tab, turn = materialize(tab, "trie-chains0"), 0
    while not tab.where("up is not null").isEmpty():
        turn += 1
        below = tab.where("up is not null").groupBy(F.col("up").alias("c")).agg(F.sum("leaves").alias("l2"), F.sum("saved").alias("s2"))
        nxt = tab.where("up is not null").select(F.col("c").alias("up"), F.col("up").alias("up2"))
        # Who points at the topmost chain points at nothing next: the one pointer that most may share needs no join.
        going = tab.withColumn("up", F.when(F.col("up") != least, F.col("up"))).join(nxt, "up", "left").select("c", F.col("up2").alias("up"), "leaves", "saved")
        tab = going.join(below, "c", "left").select("c", "up", (F.col("leaves") + F.coalesce("l2", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s2", F.lit(0))).alias("saved"))
        tab = materialize(tab, f"trie-chains{turn}")
    return tab.select("c", "leaves", "saved")


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ascending ids, joined by commas; ``ends``: conv_id, depth (the node), c."""
    order = ranked(ends, [F.col("conv_id"), F.col("depth"), F.col("c")], "trie-ends")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",")
    pieces = order.groupBy("conv_id", "depth", "_pid", F.floor(F.col("_idx") / PIECE).alias("piece")).agg(ids.alias("ids"))
    pieces = pieces.repartition(F.col("conv_id"), F.col("depth")).sortWithinPartitions("conv_id", "depth", "_pid", "piece")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sha = None, None
        for batch in batches:
            done = []
            for c, d, ids in zip(batch["conv_id"].tolist(), batch["depth"].tolist(), batch["ids"].tolist()):
                if at == (c, d):
                    sha.update(b",")
                else:
                    if at is not None:
                        done.append((*at, sha.hexdigest()))
                    at, sha = (c, d), hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(done, columns=["conv_id", "depth", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, sha.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])

    return pieces.select("conv_id", "depth", "ids").mapInPandas(run, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: int = 100, heads: int = 6) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Conversation c takes its first h turns from conversation c - c % base,
    h being the CRC-32 of its decimal id modulo ``heads``.
    """
    convs, rows = rebuilt(numbered(conversations), base, heads)
    stat = convs.agg(F.min("c").alias("least"), F.count(F.lit(1)).alias("n"), F.max("n").alias("deepest")).first()
    least, deepest = stat["least"] or 0, stat["deepest"] or 0
    prefix = prefixes(rows)
    minima = prefix.groupBy("d", "k", "l").agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("len").alias("len"), F.first("level").alias("level"))
    minima = materialize(minima.sortWithinPartitions("level"), "trie-minima")
    found = first_owned(convs, prefix, minima, least, deepest)
    # The least conversation's chain begins at the root.
    chains = found.where((F.col("u") < F.col("n")) | (F.col("c") == least)).withColumn("top", F.when(F.col("c") == least, 0).otherwise(F.col("u") + 1))
    root = convs.where(F.col("c") == least).select(F.col("c").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(stat["n"]).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("cost"))
    nodes = minima.select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "n_convs", ((F.col("n_convs") - 1) * F.col("len")).alias("cost")).unionByName(root)

    hung = chains.where(F.col("c") != least).select(F.col("up").alias("conv_id"), F.col("u").alias("depth"), "c")
    bottoms = hung.groupBy("conv_id", "depth").agg(F.lit(0).alias("none"))
    costs = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("cost").alias("saved"))
    weighed = chains.join(costs, "c").join(bottoms.select(F.col("conv_id").alias("c"), F.col("depth").alias("n"), "none"), ["c", "n"], "left")
    below = totals(weighed.select("c", "up", F.when(F.col("none").isNull(), 1).otherwise(0).cast("long").alias("leaves"), "saved"), least)
    sums = hung.join(below, "c").groupBy("conv_id", "depth").agg(F.count(F.lit(1)).alias("hung"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    own = nodes.join(chains.select(F.col("c").alias("conv_id"), "n", "top", "up"), "conv_id").join(sums, ["conv_id", "depth"], "left")
    own = own.select(
        "conv_id", "depth", "n_convs",
        F.when(F.col("depth") == 0, None).when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"),
        (F.coalesce("hung", F.lit(0)) + F.when(F.col("depth") < F.col("n"), 1).otherwise(0)).cast("long").alias("n_children"),
        (F.coalesce("leaves", F.lit(0)) + F.when((F.col("depth") == F.col("n")) & F.col("hung").isNull(), 1).otherwise(0)).alias("own_leaves"),
        (F.col("cost") + F.coalesce("saved", F.lit(0))).alias("own_saved"),
    )
    own = running(own, "conv_id", "depth", {"own_leaves": "n_leaves", "own_saved": "saved_tokens"}, down=True)

    last = prefix.where("d = n").select("d", "k", "l", "c").join(minima.select("d", "k", "l", "owner"), ["d", "k", "l"]).select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "c")
    ended = ends_digests(last.unionByName(convs.where("n = 0").select(F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), "c")))
    return own.join(ended, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    )
