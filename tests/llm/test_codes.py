"""Vector codes against plain nearest entries in Python integers, and trees against full scans."""

import hashlib
import math

import numpy as np
import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm import codes  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, code string, LABEL string"


def brute(rows, parts=4, entries=256, rounds=4):
    """Rows of (id, vector, label) by the definition, in Python integers."""
    fit = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(1024 * x) for x in v)]
    dims = -(-max((len(v) for _, v, _ in fit), default=0) // parts) * parts
    ints = [[math.floor(1024 * x) for x in v] + [0] * (dims - len(v)) for _, v, _ in fit]
    w = dims // parts
    order = sorted(range(len(fit)), key=lambda j: (fit[j][0] is None, fit[j][0] or 0, fit[j][1]))
    out = [[0, ""] for _ in fit]
    books = []
    for p in range(parts):
        cut = [x[p * w : (p + 1) * w] for x in ints]
        book = [list(cut[j]) for j in order[:entries]]
        near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))  # noqa: E731, B023
        for _ in range(rounds):
            at = [near(q)[1] for q in cut]
            for k in set(at):
                mine = [q for q, a in zip(cut, at) if a == k]
                book[k] = [sum(c) // len(mine) for c in zip(*mine)]
        for o, q in zip(out, cut):
            d, k = near(q)
            o[0] += d
            o[1] += f"{k:02x}"
        books += [x for e in book for x in e]
    by_label: dict = {}
    for (e, _), (_, _, lab) in zip(out, fit):
        by_label[lab] = by_label.get(lab, 0) + e
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    long = lambda x: x if x < 1 << 63 else None
    return sorted([(i, c, long(e), long(by_label[lab]) if all(o[0] < 1 << 63 for o, f in zip(out, fit) if f[2] == lab) else None, sha) for (i, _, lab), (e, c) in zip(fit, out)], key=repr)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA)
    return sorted([(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in codes.compress(df.repartition(3), **kw).collect()], key=repr)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    near = rng.normal(size=(12, 8))
    rows = [(int(i), (near[i % 12] + rng.normal(scale=0.05, size=8)).tolist(), [None, 1, 2][i % 3]) for i in range(400)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (900, None, 1), (901, [0.1] * 7 + [None], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (904, [1e308] * 8, 1)]
    assert got(spark, rows) == brute(rows)


def test_integers_beyond_64_bits_and_ragged_rows(spark):
    rows = [(i, [float(10 ** (i % 20)), -float(i), 0.5, 3.0, 1e30 if i == 5 else 0.0][: 5 - i % 2], i % 2) for i in range(30)]
    assert got(spark, rows) == brute(rows)


def test_ties_go_to_the_lower_index_and_empty_tables(spark):
    rows = [(i, [1.0, 1.0, 0.0, 0.0], None) for i in range(9)]
    assert {r[1] for r in got(spark, rows)} == {"00000000"}
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []
    assert got(spark, [(1, [], 1)]) == brute([(1, [], 1)])


@pytest.mark.parametrize("big", [False, True])
def test_tree_equals_full_scan(big):
    rng = np.random.default_rng(3)
    entries = rng.integers(-40, 40, size=(256, 3))
    points = rng.integers(-60, 60, size=(500, 3))
    if big:
        entries, points = entries.astype(object) * 10**20, points.astype(object) * 10**20
    at, best = codes.VantageTree(entries).nearest(points)
    for q, a, b in zip(points, at, best):
        all_ = [sum(int(x) ** 2 for x in q - e) for e in entries]
        assert int(b) == min(all_) and int(a) == all_.index(min(all_))


def test_limbs():
    for x in (0, -1, 5 << 60, -(7 << 200), (1 << 1034) + 3):
        assert sum(d << (codes.LIMB * p) for p, d in codes.limbs(x)) == x
