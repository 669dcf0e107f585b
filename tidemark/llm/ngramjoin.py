"""N-gram Jaccard join: T-occurrence search with DivideSkip inside candidate blocks.

1. Every whole text becomes its set of distinct hashed word shingles; equal
   sets collapse into one node (a 128-bit hash of the set), so copies cost
   nothing more.
2. Shingles that repeat within a task are counted over all tasks; the most
   frequent (at most ``MOST_HEAVY``, a fixed-size broadcast) go to the end of
   one global shingle order.  Two sets that can link share a shingle among the
   first ``n - ceil(J * n) + 1`` of each in that order, so sets sharing such a
   shingle form candidate blocks (connected components: a block loses no link).
3. Each block is searched with an inverted index: for a set, lists of its
   shingles are divided into short ones, heap-merged, and the longest ones,
   probed by binary search for the sets that the merge leaves able to reach
   the required overlap T.  Overlaps are exact counts.
4. A block too large for one task is cut by size class (sizes of linked sets
   differ by one class at most) and hash into chunks that all hold a few pivot
   sets; after that pass only sets outside the block's largest component still
   meet the other chunks of their own and the neighbouring classes.  Links
   found are a spanning forest of each cell, never all pairs; components of
   all links give the result.

Texts are never shuffled.  Candidates are marked in a bitmap of ``BITMAP_BITS``
(a broadcast of 8 MB at every size); a second pass over the texts makes the
sets of marked rows only, and those alone move.  A row marked by chance costs
its set's shuffle and goes at the join.  Cells are bounded by the bytes of
their sets, not by rows.

Null and empty texts, and texts without words, have no set and link with
nothing.  Null ids: such rows link by their texts as others do; the component
id is the least id in reach, null if there is none.  Repeated ids: rows are
told apart by their sets.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, materialize, only, row_chunks
from tidemark.llm.components import connected_components

MOST_HEAVY, HEAVY_FROM = 200_000, 16
PIVOTS = 4
#: Shingles below this hash (a quarter) are the pool whose document frequencies are counted.
POOL = np.uint64(1 << 62)
#: Bits of the candidates' bitmap (8 MB).
BITMAP_BITS = 1 << 26
#: A chunk's sets hold at most about so many shingles (8 bytes each), and at least ``LEAST_WEIGHT`` where a block is cut; a set weighs ``SET_WEIGHT`` more.
CHUNK_WEIGHT, LEAST_WEIGHT, SET_WEIGHT = 2_000_000, 50_000, 64
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    if not isinstance(text, str) or not text:
        return np.zeros(0, dtype=np.uint64)
    words = text.encode().lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=n)
    k = min(width, n)
    s = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        s = (s ^ (s >> np.uint64(29))) * MIX[i % 4] + h[i : n - k + 1 + i]
    s = (s ^ (s >> np.uint64(32))) * MIX[3]
    return np.unique(s)


def least_overlap(n: int, num: int, den: int) -> int:
    return (num * n + den - 1) // den


def choose(s: np.ndarray, heavy: np.ndarray, num: int, den: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Prefix length of a set, its pool (order level 0), and what follows the pool where that is too short.

    One global order: infrequent shingles of low hash (the pool, ordered by
    document frequency), then other infrequent ones, then frequent ones, both
    by hash.
    """
    n = len(s)
    p = n - least_overlap(n, num, den) + 1
    often = np.zeros(n, dtype=bool)
    if len(heavy):
        often = heavy[np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)] == s
    rare = s[~often]
    cut = int(np.searchsorted(rare, POOL))
    pool = rare[:cut]
    more = np.concatenate([rare[cut:], s[often]])[: p - cut] if cut < p else rare[:0]
    return p, pool, more


class Forest:
    """Union-find over local indexes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def merge_counts(lists: list[np.ndarray], low: int, high: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Members in ``low .. high - 1`` of at least ``least`` of the ascending lists, and how many: a heap merge of the lists."""
    cand, count = [], []
    last, seen = -1, 0
    for x in heapq.merge(*[part.tolist() for r in lists if len(part := r[np.searchsorted(r, low) : np.searchsorted(r, high)])]):
        if x == last:
            seen += 1
            continue
        if seen >= least and seen:
            cand.append(last)
            count.append(seen)
        last, seen = x, 1
    if seen >= least and seen:
        cand.append(last)
        count.append(seen)
    return np.array(cand, dtype=np.int64), np.array(count, dtype=np.int64)


def search_links(sets: list[np.ndarray], num: int, den: int, groups: list[int] | None = None, queries: list[bool] | None = None) -> list[tuple[int, int]]:
    """Spanning links among sets with ``den * overlap >= num * union``.

    ``groups``: sets of one group are known to be connected already.
    ``queries``: only pairs with a query among them matter.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size = size[order]
    lens = size.tolist()
    flat = np.concatenate([sets[i] for i in order]) if m else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(m), size)
    by = np.argsort(flat, kind="stable")  # owners ascend within a shingle
    posted = owner[by]
    ranked = flat[by]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    list_no = np.cumsum(new) - 1
    starts = np.concatenate([np.flatnonzero(new), [len(ranked)]])
    of_set = np.empty(len(flat), dtype=np.int64)
    of_set[by] = list_no
    firsts = np.concatenate([[0], np.cumsum(size)])
    forest = Forest(m)
    if groups is not None:
        seen: dict[int, int] = {}
        for i in range(m):
            g = groups[order[i]]
            if g in seen:
                forest.join(seen[g], i)
            else:
                seen[g] = i
    asks = None if queries is None else np.array(queries)[order]
    length = np.diff(starts)
    links = []
    for q in range(1, m):
        n = lens[q]
        if not n:
            continue
        # Sets before q are no larger; below the least partner size none can link.
        low = int(np.searchsorted(size, least_overlap(n, num, den)))
        if low >= q:
            continue
        s_min = lens[low]
        need = least_overlap(n + s_min, num, num + den)
        lists = of_set[firsts[q] : firsts[q + 1]]
        lists = lists[length[lists] > 1]
        if len(lists) < need:
            continue
        lists = lists[np.argsort(length[lists], kind="stable")]
        longest = int(length[lists[-1]])
        n_long = min(need - 1, int(need / (0.01 * np.log2(longest + 1) + 1)), len(lists) - 1)
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        cand, count = merge_counts([posted[starts[k] : starts[k + 1]] for k in short.tolist()], low, q, need - n_long)
        if asks is not None and not asks[q]:
            ok = asks[cand]
            cand, count = cand[ok], count[ok]
        if groups is not None or m > 64:
            root = forest.find(q)
            fresh = np.array([forest.find(c) != root for c in cand.tolist()], dtype=bool)
            cand, count = cand[fresh], count[fresh]
        left = n_long
        for k in long.tolist():
            if not len(cand):
                break
            rows = posted[starts[k] : starts[k + 1]]
            at = np.searchsorted(rows, cand)
            count = count + (rows[np.minimum(at, len(rows) - 1)] == cand)
            left -= 1
            if left & 15 == 0:
                able = count + left >= need
                cand, count = cand[able], count[able]
        for c, o in zip(cand.tolist(), count.tolist()):
            if (num + den) * o >= num * (n + lens[c]) and forest.join(q, c):
                links.append((int(order[q]), int(order[c])))
    return links


def heavy_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """The most frequent shingles among those that repeat within a task; at most ``MOST_HEAVY``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold(("n-gram join",), dict)
        held, size = [], 0

        def flush() -> pd.DataFrame:
            u, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pd.DataFrame({"s": u[keep].view(np.int64), "n": n[keep]})

        for pdf in row_chunks(batches, 3_000_000):
            seen = set()
            for t in pdf["text"].array:
                if isinstance(t, str) and (key := hash(t)) not in seen:
                    seen.add(key)
                    s = shingle_set(t, width)
                    held.append(s)
                    size += len(s)
            if size > 1_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = only(docs, "text").mapInPandas(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY_FROM)
    rows = counts.orderBy(F.desc("n"), "s").limit(MOST_HEAVY).select("s").toPandas()
    return np.sort(rows["s"].to_numpy(dtype=np.int64).view(np.uint64))


def row_key(doc, text: str | None) -> int:
    """64-bit hash of an id (or none) and its text."""
    seed = 0 if doc is None or doc is pd.NA or doc != doc else (int(doc) * 2 + 1) & 0xFFFFFFFFFFFFFFFF
    return xxhash.xxh3_64_intdigest(text.encode() if isinstance(text, str) else b"", seed) - (1 << 63)


def nodes_of(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``doc_id, n, node`` (128-bit hash of the set; null without one), ``key`` of the row, ``p, pool, more`` of every row."""
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_shingles(docs, width))  # at most 8 * MOST_HEAVY bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = heavy.value
        for pdf in row_chunks(batches, 3_000_000):
            out = {"n": [], "node": [], "key": [], "p": [], "pool": [], "more": []}
            for d, t in zip(pdf["doc_id"].array, pdf["text"].array):
                s = shingle_set(t, width)
                p, pool, more = choose(s, often, num, den) if len(s) else (0, s, s)
                for k, v in zip(out, (len(s), node_id(s), row_key(d, t), p, pool.view(np.int64), more.view(np.int64))):
                    out[k].append(v)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].array, **out})

    return only(docs, "doc_id", "text").mapInPandas(run, "doc_id long, n long, node binary, key long, p int, pool array<long>, more array<long>")


def node_id(s: np.ndarray) -> bytes | None:
    """128-bit hash of a set; null for none."""
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def short_id(node: Column) -> Column:
    """64 bits of a node's id: candidate blocks may use it, since a collision only joins two blocks."""
    return F.xxhash64(node)


def candidate_edges(own: DataFrame) -> DataFrame:
    """``u, v``: each node (short id) with the least node of every prefix shingle it shares."""
    pooled = own.select("v", F.explode("pool").alias("s"))
    counts = pooled.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counted = pooled.join(counts, "s")  # a hot shingle is one pre-aggregated row on one side; AQE splits the other
    shared = counted.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("shared"))  # at most the node's own pool
    picked = own.select("v", "p", F.size("pool").alias("k")).join(shared, "v")
    room = F.col("p") - F.col("k") + F.size("shared")  # the pool's unshared shingles come first and meet nobody
    picked = picked.where(room > 0).select("v", F.explode(F.slice("shared", F.lit(1), room)).alias("x")).select("v", F.col("x")["s"].alias("s"))
    posts = materialize(picked.unionByName(own.select("v", F.explode("more").alias("s"))), "join-postings")
    firsts = posts.groupBy("s").agg(F.min("v").alias("u"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    return posts.join(firsts, "s").where("v <> u").select("u", "v")


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bitmap of 64-bit keys: as many words as ``BITMAP_BITS / 64`` come to the driver at most, whatever the number of keys."""
    bit = F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(BITMAP_BITS))
    words = keys.select(F.shiftright(bit, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int")).alias("m"))
    got = words.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(BITMAP_BITS >> 6, dtype=np.int64)
    out[got["w"].to_numpy()] = got["m"].to_numpy()
    return out.view(np.uint64)


def marked_sets(docs: DataFrame, candidates: DataFrame, width: int) -> DataFrame:
    """``node, set`` of the candidates (``node, key``), made from the texts of marked rows; texts stay where they are."""
    spark = docs.sparkSession
    marked = spark.sparkContext.broadcast(bitmap_of(candidates.select("key")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = marked.value
        seen: set[bytes] = set()
        for pdf in row_chunks(batches, 3_000_000):
            key = np.array([row_key(d, t) for d, t in zip(pdf["doc_id"].array, pdf["text"].array)], dtype=np.int64)
            at = spark_hash(key)
            node, sets = [], []
            for i in np.flatnonzero(bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).tolist():
                s = shingle_set(pdf["text"].iat[i], width)
                if len(s) and (x := node_id(s)) not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    seen.add(x)
                    node.append(x)
                    sets.append(s.tobytes())
            yield pd.DataFrame({"node": node, "set": sets})

    return only(docs, "doc_id", "text").mapInPandas(run, "node binary, set binary")


def spark_hash(keys: np.ndarray) -> np.ndarray:
    """Bit numbers of keys, as ``bitmap_of`` computes them."""
    seed = xxhash.xxh64_intdigest((9).to_bytes(4, "little"), 42)
    h = np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in map(int.to_bytes, (keys.view(np.uint64)).tolist(), [8] * len(keys), ["little"] * len(keys))), dtype=np.uint64, count=len(keys))
    return h & np.uint64(BITMAP_BITS - 1)


def size_class(n: Column, num: int, den: int) -> Column:
    """Linked sets differ by one class at most (a class spans a factor of den / num, and a little more against rounding)."""
    if num >= den:
        return F.lit(0)
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(den / num) * (1 + 1e-9))).cast("int")


def jaccard_components(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for links with ``den * overlap >= num * union``."""
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = materialize(nodes_of(docs, width, num, den), "join-nodes")
    one = F.min_by(F.struct("p", "pool", "more", "n"), "key").alias("r")
    heads = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("head"), F.min("key").alias("key"), one)
    heads = materialize(heads.select("node", short_id(F.col("node")).alias("v"), "head", "key", "r.*"), "join-heads")
    blocks = connected_components(candidate_edges(heads.select("v", "p", "pool", "more")), "join-blocks").select(F.col("node").alias("v"), F.col("component").alias("block"))
    narrow = heads.select("node", "v", "key", "n", (F.col("n") + SET_WEIGHT).alias("weight"))
    placed = materialize(narrow.join(blocks, "v").drop("v").withColumn("cls", size_class(F.col("n"), num, den)), "join-placed")
    total = placed.agg(F.sum("weight").alias("w")).first()["w"] or 0
    limit = min(CHUNK_WEIGHT, max(LEAST_WEIGHT, total // (2 * shuffles)))
    chunks = F.ceil(F.sum("weight") / limit).cast("int")
    large = placed.groupBy("block").agg(chunks.alias("c")).where("c > 1").select("block", F.lit(True).alias("large"))
    placed = materialize(placed.join(large, "block", "left").withColumn("large", F.col("large").isNotNull()), "join-sized")
    sets = marked_sets(docs, placed, width)
    found = materialize(placed.select("node", "block", "cls", "large").join(sets.dropDuplicates(["node"]), "node"), "join-sets")

    def cell_links(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = [], []
        if "ask" in pdf:
            pdf = pdf.sort_values("ask", ascending=False, kind="stable")
        for _, part in pdf.groupby("block", sort=True):
            part = part.drop_duplicates("node").sort_values("node", ignore_index=True)
            names = part["node"].tolist()
            known = (part["group"].tolist(), part["ask"].tolist()) if "ask" in part else (None, None)
            got = search_links([np.frombuffer(b, dtype=np.uint64) for b in part["set"]], num, den, *known)
            u += [names[a] for a, _ in got]
            v += [names[b] for _, b in got]
        return pd.DataFrame({"u": u, "v": v})

    LINKS = "u binary, v binary"
    # Whole small blocks, many to a cell of about half a chunk.
    cells = max(4 * shuffles, 2 * total // CHUNK_WEIGHT)
    small = found.where("not large").withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)))
    links = small.groupBy("cell").applyInPandas(cell_links, LINKS)
    many = placed.where("large").select("node", "block", "cls", "weight")
    if not many.isEmpty():
        # Chunks of a size class of a large block, each with the block's pivots: the nodes of least hash.
        counts = materialize(many.groupBy("block", "cls").agg(chunks.alias("chunks")), "join-chunks")
        big = found.where("large").select("node", "block", "cls", "set").join(counts, ["block", "cls"]).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
        h = F.xxhash64(F.lit(2), "node")
        pivots = many.groupBy("block", F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(PIVOTS)).alias("slot")).agg(F.min_by("node", h).alias("node")).select("node")
        lead = big.select("node", "block", "set").join(pivots, "node").join(counts, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        cell = ["node", "block", "cls", "chunk", "set"]
        chunk_links = big.select(*cell).unionByName(lead.select(*cell)).groupBy("block", "cls", "chunk").applyInPandas(cell_links, LINKS)
        first = materialize(links.unionByName(chunk_links), "join-links")
        comps = connected_components(first, "join-first")
        known = materialize(many.join(comps, "node", "left").select("node", "block", "cls", "weight", F.coalesce("component", "node").alias("group")), "join-known")
        sums = known.groupBy("block", "group").agg(F.count(F.lit(1)).alias("c"))
        main = sums.groupBy("block").agg(F.max_by("group", F.struct("c", "group")).alias("main"))
        asked = materialize(known.join(main, "block").select("node", "block", "cls", "weight", "group", (F.col("group") != F.col("main")).alias("ask")), "join-asked")
        # Nodes outside the largest component, a chunk's worth at a time, meet the chunks of their own and the neighbouring classes.
        asks = asked.where("ask").groupBy("block", F.col("cls").alias("qcls")).agg(chunks.alias("qchunks"))
        full = big.join(asked.select("node", "group", "ask"), "node")
        near = F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1))
        key = ["block", "cls", "chunk", "qcls", "qchunk"]
        out = ["node", "set", "group", "ask", *key]
        targets = full.withColumn("ask", F.lit(False)).withColumn("qcls", near).join(asks, ["block", "qcls"]).withColumn("qchunk", F.explode(F.sequence(F.lit(0), F.col("qchunks") - 1)))
        queries = full.where("ask").withColumnRenamed("cls", "qcls").drop("chunks", "chunk").join(asks, ["block", "qcls"]).withColumn("qchunk", F.pmod(F.xxhash64(F.lit(3), "node"), "qchunks").cast("int"))
        queries = queries.withColumn("cls", F.explode(F.array(F.col("qcls") - 1, F.col("qcls"), F.col("qcls") + 1))).join(counts, ["block", "cls"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        links = first.unionByName(targets.select(*out).unionByName(queries.select(*out)).groupBy(*key).applyInPandas(cell_links, LINKS))
    comps = connected_components(links, "join-final")
    least = comps.join(heads.select("node", "head"), "node").groupBy("component").agg(F.min("head").alias("component_id"))
    labels = comps.join(least, "component").select("node", "component_id")
    labels = materialize(heads.select("node", "head").join(labels, "node", "left").select("node", F.coalesce("component_id", "head").alias("component_id")), "join-labels")
    out = base.select("doc_id", "n", "node").join(labels, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
