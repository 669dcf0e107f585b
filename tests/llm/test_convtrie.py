"""Prefix trie against a dictionary of prefixes in plain Python."""

import hashlib
import random
import zlib

import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm import convtrie  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, Turn_2 long, c string, d long"


def brute(rows, base=100, heads=6):
    own: dict = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % heads for c in own}
    full = {c: own.get(c - (abs(c) % base) * (1 if c >= 0 else -1), [])[: h[c]] + own[c][h[c] :] for c in own}
    nodes: dict = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids: dict = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[: len(n)] == n]
        ends = sorted(c for c in members if len(full[c]) == len(n))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids.get(n, [])), sum(m not in kids for m in below), sum((len(nodes[m]) - 1) * len(m[-1][1]) for m in below if m), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted([tuple(r[n] for n in names) for r in convtrie.prefix_trie(df.repartition(3), **kw).collect()], key=repr)


@pytest.fixture
def small_stretches(monkeypatch):
    """Conversations span stretches and lists of ends span pieces."""
    monkeypatch.setattr(convtrie, "STRETCH", 4)
    monkeypatch.setattr(convtrie, "PIECE", 3)


def test_equals_brute_force(spark, small_stretches):
    rng = random.Random(4)
    rows = []
    for c in [*range(-3, 40), *range(100, 130), *range(305, 320)]:
        for t in range(rng.choice([1, 2, 3, 7, 14])):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é😀", None]) if rng.random() < 0.8 else "xyz"))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 425) for t in range(9)]  # one conversation many times
    rows += [(425, t, "user", f"same {t}") for t in range(30)]  # and one that goes on
    rows += [(500, None, "user", "first"), (500, 3, None, None), (500, 3, None, None), (None, 1, "user", "nobody")]
    assert got(spark, rows) == brute(rows)


def test_turnless_and_empty(spark):
    # Conversation 1 takes its turns from 0, which is absent, and has too few of its own.
    lonely = [(c, 0, "user", "x") for c in range(1, 12)]
    assert got(spark, lonely) == brute(lonely)
    assert got(spark, []) == [] and got(spark, [(None, 1, "a", "b")]) == []


def test_a_chain_of_chains(spark, small_stretches):
    """Each conversation leaves the one before it one turn later: the tree of chains is as high as it can be."""
    rows = [(c * 100, t, "user", str(min(t, c) if t <= c else -c)) for c in range(1, 20) for t in range(c + 2)]
    assert got(spark, rows) == brute(rows)
