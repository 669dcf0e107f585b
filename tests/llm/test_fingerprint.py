"""Fingerprints against a plain-Python twin of syncmers, sketch and likeness."""

import hashlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tidemark.llm")

import xxhash  # noqa: E402

from tidemark.llm import fingerprint  # noqa: E402
from tidemark.llm.fingerprint import COUNT, HASH, PLACE, SLACK, K, S  # noqa: E402

M64 = (1 << 64) - 1


def spark_hash(*values):
    """Spark's xxhash64: each value is hashed with the hash so far as its seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else (v & M64).to_bytes(8, "little"), seed)
    return seed


def twin_anchors(text):
    s = [(h := spark_hash(text[i : i + S])) - (h >> 63 << 64) for i in range(len(text) - S + 1)]
    out = []
    for i in range(len(text) - K + 1):
        inner = s[i : i + K - S + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append((spark_hash(*inner[::S]) >> HASH + 1, i))
    return out


def twin(text):
    """All anchors: each hash once, with its first place and the power of two below its count."""
    if not text:
        return []
    found = twin_anchors(text)
    times, first = Counter(h for h, _ in found), {}
    for h, p in found:
        first[h] = min(first.get(h, PLACE), p & PLACE)
    return sorted((h, p, times[h].bit_length() - 1) for h, p in first.items()) or [(spark_hash(text) >> HASH + 1, 0, 0)]


def twin_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    x, y = {h: (p, 1 << n) for h, p, n in a}, {h: (p, 1 << n) for h, p, n in b}
    half = PLACE >> 1
    met = sorted(((y[h][0] - x[h][0] + half) % (PLACE + 1) - half, min(x[h][1], y[h][1])) for h in x if h in y)
    if not met:
        return 0.0
    mid, common = met[len(met) // 2][0], sum(m for _, m in met)
    return sum(m if abs(s - mid) <= SLACK else m / 2 for s, m in met) / (sum(n for d in (x, y) for _, n in d.values()) - common)


def as_text(a):
    return ",".join(f"{h << HASH | n << COUNT | p << 1:x}" for h, p, n in a)


def texts():
    r = np.random.default_rng(3)
    khmer = "".join(chr(c) for c in r.integers(0x1780, 0x17B4, 3000))
    long = " ".join("".join(r.choice(list("abcdefghij"), r.integers(2, 9))) for _ in range(2500))
    return ["", None, "a", "short text", "x" * 11, "exactly 12ch", "x" * 700, "😀" * 40 + "é日本", "line\none\ttwo " * 60, khmer, khmer[:1500] + "!" + khmer[1500:], long, long[:9000] + "other tail " * 40, long, "same again, same again"]


def test_equals_plain_python(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, found int")
    got = {r["doc_id"]: r for r in fingerprint.fingerprint(df).collect()}
    order = sorted((i for i, _ in rows), reverse=True)
    for at, i in enumerate(order):
        t, nxt = (rows[j][1] or "" for j in (i, order[(at + 1) % len(order)]))
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == as_text(twin(t)), i
        assert r["edited_fingerprint"] == as_text(twin(edited)), i
        assert r["near_edited"] == pytest.approx(twin_likeness(twin(t), twin(edited))), i
        assert r["near_next"] == pytest.approx(twin_likeness(twin(t), twin(nxt))), i


@pytest.mark.parametrize("unit", [lambda c: c * 10_000, lambda c: (c + "xyz ") * 5000, lambda c: c * 600, lambda c: f"only {c} of these words " * 40])
def test_repetitive_texts_are_alike_by_common_anchors_alone(spark, unit):
    rows = [(i, unit(c)) for i, c in enumerate("abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in fingerprint.fingerprint(df).collect():
        assert r["fingerprint"] and r["near_next"] == 0.0 and 0.2 < r["near_edited"] < 1.0, r


def test_half_of_a_text_in_common(spark):
    r = np.random.default_rng(1)
    text = lambda n: " ".join("".join(r.choice(list("abcdefghij"), 5)) for _ in range(n))
    df = spark.createDataFrame([(i, text(n)) for i, n in enumerate((20, 40, 90, 300, 3000, 20, 40))], "doc_id long, text string")
    for row in fingerprint.fingerprint(df).collect():
        assert row["near_edited"] > 0.05 and row["near_next"] == 0.0, row["doc_id"]


def test_an_anchor_in_every_shared_run():
    r = np.random.default_rng(4)
    text = lambda n: "".join(r.choice(list("abcdefghij "), n))
    for n in (2 * K - S - 1, 50, 400):
        run = text(n)
        a, b = text(900) + run + text(700), text(5) + run + text(3000)
        assert {h for h, _, _ in twin(a)} & {h for h, _, _ in twin(b)}


def test_one_insertion_keeps_the_other_anchors():
    khmer, more = texts()[9:11]
    a, b = {h for h, _ in twin_anchors(khmer)}, {h for h, _ in twin_anchors(more)}
    assert len(a - b) <= 2 * K and len(a & b) > 0.9 * len(khmer) * 2 / (K - S + 1)  # closed syncmers are 2 of so many k-mers


def test_a_long_text_keeps_a_growing_sketch():
    t = texts()[11]
    assert len(twin(t * 4)) > len(twin(t)) > 64


def test_hot_and_null_ids_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 7)
    rows = [(5, f"hot text number {i} of many") for i in range(120)] + [(5, "same text twice here")] * 30 + [(i, f"other text {i} with words") for i in range(6, 60)] + [(None, "without an id at all")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert any(k == 5 for k, _ in fingerprint.bounds_of([5, 5, 5, 9]))
    got = [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in fingerprint.fingerprint(df).collect()]
    assert len(got) == len(rows)
    signed = lambda t: (x if (x := xxhash.xxh64_intdigest(t.encode(), 42)) < 1 << 63 else x - (1 << 64))
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], signed(r[1])), reverse=True)
    want = []
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        want.append((d, hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()))
    assert sorted(map(repr, ((d, s) for d, s, _ in got))) == sorted(map(repr, want))
    assert fingerprint.fingerprint(df.limit(0)).count() == 0


def test_a_million_characters(spark):
    df = spark.createDataFrame([(1, "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(1_000_000))), (2, "b")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fingerprint.fingerprint(df).select("doc_id", "n_chars", "near_edited").collect()}
    assert rows[1]["n_chars"] == 1_000_000 and rows[1]["near_edited"] > 0.4
