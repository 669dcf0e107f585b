"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

The table is cut into blocks and each block is indexed once by posting
segments: per dimension the rows in order of value, cut into ``LEVELS`` runs.
A query weighs each segment by the largest impact (above the dimension's
least) a row in it can have and processes segments by descending quantised
impact, adding to accumulators.  What is left unprocessed bounds every row's
final score, so a row whose accumulator plus that bound is below the k-th best
known score is proven out; processing stops only when few rows are left, and
those are rescored exactly with integers.  The k-th best of a task's earlier
blocks already counts, so later blocks often stop at once.

Queries are broadcast in chunks of at most ``CHUNK_VALUES`` components; every
block of a task is searched for the whole chunk, so the vectors are shuffled
once, whatever the number of queries, and a task returns at most ``k`` rows a
query.

Vectors that are null or hold null or non-finite components, also once scaled, take no part;
shorter vectors count as padded with zeros (rows of similar length share an
index, so one long vector widens no other).  Ties go to the smaller id.
Repeated ids are separate candidates, equal rows too; a query skips every row
with its own id.  Equal query rows are one query; an id with several vectors
is one query for each, told apart by nothing in the result.  Null ids take no
part.  Integers of any size are exact within a task; a score beyond a long is
given as the nearest long, and such scores of different tasks are ranked as
floating-point numbers.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialize, only

LEVELS, QUANTA = 8, 255
LONG = (1 << 63) - 1
#: Most components of an indexed block (with its postings some 100 MB), most rows of a block, and most components of a broadcast query chunk (32 MB).
BLOCK_VALUES, BLOCK_ROWS, CHUNK_VALUES = 1 << 22, 1 << 16, 1 << 22


class ImpactIndex:
    """Posting segments of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        cuts = np.unique(np.linspace(0, n, LEVELS + 1).astype(np.int64))
        self.segments = []  # (dim, rows, values)
        low, high = [], []
        for d in range(dims if vectors.dtype != object else 0):
            order = np.argsort(vectors[:, d], kind="stable")
            col = vectors[order, d].astype(np.float64)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                self.segments.append((d, order[lo:hi], col[lo:hi]))
                low.append(col[lo])
                high.append(col[hi - 1])
        self.dim = np.array([s[0] for s in self.segments], dtype=np.int64)
        self.low, self.high = np.array(low), np.array(high)
        self.starts = np.arange(0, len(low), len(cuts) - 1)

    def scan(self, query: np.ndarray, k: int, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every row scored in Python integers: floats bound nothing once 53 bits do not hold the products."""
        rest = np.setdiff1d(np.arange(len(self.ids)), same)
        exact = np.array([sum(int(a) * int(b) for a, b in zip(row, query)) for row in self.vectors[rest]] + [None], dtype=object)[:-1]
        best = best_of(self.ids[rest], exact, k)
        return self.ids[rest[best]], exact[best]

    def search(self, query: np.ndarray, k: int, own: int, known: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best ``k`` rows that have another id than ``own`` and may score ``known`` or more."""
        n, dims = self.vectors.shape
        same = np.flatnonzero(self.ids == own)
        want = min(k, n - len(same))
        if want <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if query.dtype == object or self.vectors.dtype == object:
            return self.scan(query, k, same)
        w = query.astype(np.float64)[self.dim]
        a, b = w * self.low, w * self.high
        base = np.minimum.reduceat(np.minimum(a, b), self.starts) if dims else np.zeros(0)
        impact = np.maximum(a, b) - base[self.dim]
        total = float(base.sum())
        known = known - total  # accumulators count from the base
        left = np.maximum.reduceat(impact, self.starts) if dims else np.zeros(0)
        rest = float(left.sum())
        if rest < known - 1e-6 * (1.0 + abs(known)):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        peak = impact.max(initial=0.0)
        quantised = np.ceil(impact * (QUANTA / peak)) if peak > 0 else np.zeros_like(impact)
        order = np.argsort(-quantised, kind="stable")
        order = order[quantised[order] > 0]
        acc = np.zeros(n)
        acc[same] = -np.inf
        # Largest impact left in a dimension after each of its segments.
        suffix: list[list[float]] = [[] for _ in range(dims)]
        for s in order[::-1].tolist():
            x = suffix[self.dim[s]]
            x.append(max(impact[s], x[-1]) if x else impact[s])
        step = max(1, len(order) // 8)
        few = max(4 * want, n // 64)
        alive = np.arange(n)
        for at, s in enumerate(order.tolist(), 1):
            d, rows, values = self.segments[s]
            acc[rows] += query[d] * values - base[d]
            x = suffix[d]
            rest -= x.pop()
            rest += x[-1] if x else 0.0
            if at % step == 0:
                floor = max(known, np.partition(acc, n - want)[n - want])
                alive = np.flatnonzero(acc + rest >= floor - 1e-6 * (1.0 + abs(floor)))
                if len(alive) <= few:
                    break
        else:
            floor = max(known, np.partition(acc, n - want)[n - want])
            alive = np.flatnonzero(acc >= floor - 1e-6 * (1.0 + abs(floor)))
        alive = alive[self.ids[alive] != own]
        exact = self.vectors[alive] @ query
        best = best_of(self.ids[alive], exact, k)
        return self.ids[alive[best]], exact[best]


def as_float(score: int) -> float:
    """The nearest floating-point number, never in another order than the scores."""
    try:
        return float(score)
    except OverflowError:
        return math.inf if score > 0 else -math.inf


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: score descending, then id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    return np.lexsort((ids, -scores))[:k]


def to_integers(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the given ragged rows, padded with zeros; Python integers where 64 bits could overflow."""
    length = np.diff(offsets)[rows]
    out = np.zeros((len(rows), dims))
    if dims:
        at = np.arange(dims)
        mask = at < length[:, None]
        out[mask] = values[(offsets[:-1][rows][:, None] + at)[mask]]
    out = np.floor(scale * out)
    if out.size and float(np.abs(out).max()) * math.sqrt(max(dims, 1)) >= 2.0**26.5:  # a product of 53 bits
        return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)
    return out.astype(np.int64)


def ragged(batch: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, component values and row offsets of an Arrow batch of ``id, v``."""
    v = batch["v"].combine_chunks() if isinstance(batch, pa.Table) else batch["v"]
    ids = batch["id"].to_numpy() if isinstance(batch, pa.Table) else batch["id"].to_numpy(zero_copy_only=False)
    offsets = v.offsets.to_numpy().astype(np.int64)
    return ids, v.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def length_classes(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Rows whose lengths round up to one power of two, and the longest among them."""
    length = np.diff(offsets)
    cls = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    for c in np.unique(cls):
        rows = np.flatnonzero(cls == c)
        yield rows, int(length[rows].max())


def fit_length(query: np.ndarray, dims: int) -> np.ndarray:
    return query[:dims] if len(query) >= dims else np.concatenate([query, np.zeros(dims - len(query), dtype=query.dtype)])


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best partners of each row whose id ``every`` divides, against all rows."""
    spark = vectors.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf"))
    rows = only(vectors, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad))
    queries = rows.where(F.col("id") % every == 0).distinct()
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v").cast("long")).alias("size")).first()
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v").cast("long")).alias("size")).first()
    if not asked["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stat["n"] // BLOCK_ROWS), -(-(stat["size"] or 0) // BLOCK_VALUES))
    spread = rows.repartition(tasks, F.xxhash64("id", "v"))
    chunks = max(1, -(-(asked["size"] or 0) // CHUNK_VALUES))
    if chunks > 1:
        spread = materialize(spread, "top-vectors")

    def searcher(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q_ids, q_vectors = sent.value
            found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q_ids)
            floor = [-np.inf] * len(q_ids)

            def search_block(held: list[pa.RecordBatch]) -> None:
                ids, values, offsets = ragged(pa.Table.from_batches(held))
                for part, dims in length_classes(offsets):
                    index = ImpactIndex(ids[part], to_integers(values, offsets, part, dims, scale))
                    for q, own in enumerate(q_ids.tolist()):
                        got, scores = index.search(fit_length(q_vectors[q], dims), k, own, floor[q])
                        if len(got):
                            a, b = np.concatenate([found[q][0], got]), np.concatenate([found[q][1], scores])
                            best = best_of(a, b, k)
                            found[q] = a[best], b[best]
                            if len(best) == k:
                                floor[q] = as_float(int(b[best[-1]]))

            held, n, size = [], 0, 0
            for batch in batches:
                held.append(batch)
                n, size = n + batch.num_rows, size + len(batch["v"].flatten())
                if n >= BLOCK_ROWS or size >= BLOCK_VALUES:
                    search_block(held)
                    held, n, size = [], 0, 0
            if n:
                search_block(held)
            counts = [len(f[0]) for f in found]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(q_ids)), counts)), pa.array(np.repeat(q_ids, counts)), pa.array(np.concatenate([f[0] for f in found])), pa.array([min(max(int(x), -LONG - 1), LONG) for f in found for x in f[1]], pa.int64()), pa.array([as_float(int(x)) for f in found for x in f[1]])],
                    names=["q", "query_id", "vec_id", "score", "near"],
                )

        return run

    parts = []
    for c in range(chunks):
        some = queries if chunks == 1 else queries.where(F.pmod(F.xxhash64(F.lit(5), "id", "v"), F.lit(chunks)) == c)
        ids, values, offsets = ragged(some.toArrow())
        order = np.lexsort((np.diff(offsets), ids))
        made = [to_integers(values, offsets, order[i : i + 1], int(np.diff(offsets)[order[i]]), scale)[0] for i in range(len(order))]
        sent = spark.sparkContext.broadcast((ids[order], made))  # about CHUNK_VALUES components
        part = spread.mapInArrow(searcher(sent), "q long, query_id long, vec_id long, score long, near double").withColumn("chunk", F.lit(c))
        parts.append(part if chunks == 1 else materialize(part, f"top-chunk{c}"))
    part = parts[0]
    for p in parts[1:]:
        part = part.unionByName(p)
    order = Window.partitionBy("chunk", "q", "query_id").orderBy(F.desc("near"), F.desc("score"), F.asc("vec_id"))
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
