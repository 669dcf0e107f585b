"""Vector code compression: integer codebooks per part, searched through vantage-point trees.

A vector is scaled to integers and cut into ``parts`` equal consecutive parts.
The codebook of each part position holds at most ``entries`` entries and is
refined for ``rounds`` rounds of nearest assignment and floored means.  An
assignment searches a vantage-point tree over the entries of the position: a
node's entry is a candidate itself, and its two children hold the entries
nearer and farther than its median.  Branch and bound is metric: a child's
entries lie between two rounded radii (down and up) of the node's entry, so
the triangle inequality bounds their distance from below; a child is visited
unless that bound is *greater* than the best distance so far (rounded up), so
ties still reach the entry of lower index.  What decides is always the integer
squared distance.

Each round is one pass over the rows: tasks sum their rows by part and entry,
Spark adds the sums, and what meets the driver is one codebook.  A batch walks
a tree together, so Python's cost is per node and not per row.

Null vectors and those with null or non-finite components take no part, nor
do those that are not finite any more once scaled.  Shorter vectors count as
padded with zeros to the longest, rounded up to a multiple of ``parts``.
Integers of any size are exact; an ``error`` or ``label_error`` beyond a long
is null.  Repeated ids are rows of their own; among equal ids the lesser
vector comes first in the starting codebook.  Null ids come last.  An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, only

LEAF, BATCH_VALUES, LIMB = 8, 1 << 21, 40
_isqrt = np.frompyfunc(math.isqrt, 1, 1)


def root(squares: np.ndarray) -> np.ndarray:
    """Square roots rounded down; adding one rounds them up or beyond."""
    if squares.dtype == object:
        return _isqrt(squares)
    return np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64)


class VantageTree:
    """Nearest entry of one codebook position for whole batches of parts.

    ``entries`` are 64-bit integers whose squared distances stay below 2^50,
    or Python integers of any size.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.top = self._grow(np.arange(len(entries)))

    def _grow(self, at: np.ndarray) -> tuple:
        if len(at) <= LEAF:
            return (at, ())
        pivot, rest = at[0], at[1:]
        away = self.squares(self.entries[rest], pivot)
        order = np.argsort(away, kind="stable")
        sides = []
        for side in (order[: len(order) // 2], order[len(order) // 2 :]):
            ends = root(np.array([away[side[0]], away[side[-1]]], dtype=away.dtype))
            sides.append((ends[0], ends[1] + 1, self._grow(np.sort(rest[side]))))
        return (np.array([pivot]), tuple(sides))

    def squares(self, points: np.ndarray, entry: int) -> np.ndarray:
        apart = points - self.entries[entry]
        if apart.shape[1] == 0:
            return np.zeros(len(points), dtype=np.int64)
        return (apart * apart).sum(axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower of equal ones) and the squared distance."""
        at = np.zeros(len(points), dtype=np.int64)
        best = self.squares(points, 0)
        self._visit(self.top, points, np.arange(len(points)), at, best, greedy=True)
        self._visit(self.top, points, np.arange(len(points)), at, best, greedy=False)
        return at, best

    def _visit(self, node: tuple, points: np.ndarray, rows: np.ndarray, at: np.ndarray, best: np.ndarray, greedy: bool) -> None:
        own, sides = node
        for entry in own.tolist():
            away = self.squares(points[rows], entry)
            known = best[rows]
            wins = (away < known) | ((away == known) & (entry < at[rows]))
            at[rows[wins]], best[rows[wins]] = entry, away[wins]
        if not sides:
            return
        low = root(away)
        gaps = [np.maximum(near - (low + 1), low - far) for near, far, _ in sides]
        inner = gaps[0] <= gaps[1]
        for side, gap, first in ((sides[0], gaps[0], inner), (sides[1], gaps[1], ~inner)):
            go = rows[first.astype(bool)] if greedy else rows[(gap <= root(best[rows]) + 1).astype(bool)]
            if len(go):
                self._visit(side[2], points, go, at, best, greedy)


def integers(column: pa.ListArray, dims: int, scale: int, small: bool) -> np.ndarray:
    """floor(scale * x) of every row, padded with zeros: 64-bit integers if ``small``, else Python's."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    length = np.diff(offsets)
    out = np.zeros((len(length), dims))
    if dims:
        out[np.arange(dims) < length[:, None]] = values
    out = np.floor(scale * out)
    return out.astype(np.int64) if small else np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """``value`` as (place, digit) to the base 2^40, the last digit signed: sums of digits fit a long."""
    place = 0
    while not -(1 << 50) < value < 1 << 50:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def part_sums(parts: list[np.ndarray], trees: list[VantageTree], sums: list, counts: list) -> None:
    """Add a batch to the sums and counts of every part and entry."""
    for p, points in enumerate(parts):
        at, _ = trees[p].nearest(points)
        order = np.argsort(at, kind="stable")
        used, first = np.unique(at[order], return_index=True)
        if points.shape[1]:
            sums[p][used] += np.add.reduceat(points[order], first, axis=0)
        counts[p] += np.bincount(at, minlength=len(counts[p]))


def slices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BATCH_VALUES // max(dims, 1))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def codebooks(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> tuple[list[np.ndarray], int, bool]:
    """Final entries by part, padded length, and whether 64-bit integers hold every squared distance; ``rows``: id, v."""
    spark = rows.sparkSession
    stat = rows.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    dims = -(-(stat["dims"] or 0) // parts) * parts
    width = dims // parts
    small = 2 * (scale * float(stat["most"] or 0) + 1) * math.sqrt(max(width, 1)) < 2.0**25
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow()["v"].combine_chunks()
    start = integers(first, dims, scale, small)
    books = [start[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    for _ in range(rounds if len(start) else 0):
        sent = spark.sparkContext.broadcast([VantageTree(b) for b in books])  # at most ``entries`` vectors

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = sent.value
            sums = [np.zeros(t.entries.shape, dtype=t.entries.dtype) for t in trees]
            counts = [np.zeros(len(t.entries), dtype=np.int64) for t in trees]
            for batch in slices(batches, dims):
                points = integers(batch["v"], dims, scale, small)
                part_sums([points[:, p * width : (p + 1) * width] for p in range(parts)], trees, sums, counts)
            found = [(p, e, -1, 0, int(counts[p][e])) for p in range(parts) for e in np.flatnonzero(counts[p]).tolist()]
            found += [(p, e, i, place, digit) for p, e, _, _, _ in list(found) for i in range(width) for place, digit in limbs(int(sums[p][e, i]))]
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns[:4]] + [pa.array(columns[4], pa.int64())], names=["part", "entry", "place", "limb", "x"])

        total = rows.select("v").mapInArrow(gather, "part int, entry int, place int, limb int, x long").groupBy("part", "entry", "place", "limb").agg(F.sum("x").alias("x"))
        count: dict = {}
        added: dict = {}
        for r in total.collect():  # one codebook: parts * entries * (width + 1) rows, more only for integers beyond 2^50
            if r["place"] < 0:
                count[r["part"], r["entry"]] = r["x"]
            else:
                at = (r["part"], r["entry"], r["place"])
                added[at] = added.get(at, 0) + (r["x"] << (LIMB * r["limb"]))
        for (p, e, i), x in added.items():
            books[p][e, i] = x // count[p, e]
        sent.unpersist()
    return books, dims, small


def books_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Code, error, error of the label and digest of the codebooks, one row per vector that takes part."""
    spark = vectors.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf"))
    rows = only(vectors, id_col, vec_col, label_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    rows = rows.where(F.col("v").isNotNull() & ~F.exists("v", bad))
    books, dims, small = codebooks(rows.select("id", "v"), parts, entries, rounds, scale)
    width = dims // parts
    sent = spark.sparkContext.broadcast([VantageTree(b) for b in books] if len(books[0]) else [])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, dims):
            points = integers(batch["v"], dims, scale, small)
            code = np.zeros((len(points), parts), dtype=np.uint8 if entries <= 256 else np.dtype(">u2"))
            error = np.zeros(len(points), dtype=object)
            for p, tree in enumerate(sent.value):
                at, away = tree.nearest(points[:, p * width : (p + 1) * width])
                code[:, p] = at
                error += away.astype(object)
            digits = 2 * code.itemsize * parts
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([text[i : i + digits] for i in range(0, len(text), digits)]), pa.array([int(x) if x < 1 << 63 else None for x in error], pa.int64()), batch["label"]],
                names=["vec_id", "code", "error", "label"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    coded = materialize(rows.mapInArrow(encode, f"vec_id long, code string, error long, label {kind}"), "codes")
    whole = F.count("error") == F.count(F.lit(1))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.when(whole, F.sum(F.col("error").cast("decimal(38,0)"))).alias("s")).select("of", F.expr("try_cast(s as bigint)").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"), "label")
