"""Repeated passages against counted windows in plain Python, and the index against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm import substrings  # noqa: E402

SCHEMA = "doc_id long, text string, K string, t long, spans string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, width):
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def got(spark, docs, width, **kw):
    df = spark.createDataFrame([(*d, "k", 3, "s") for d in docs], SCHEMA)
    rows = substrings.without_repeats(df.repartition(3), width, **kw).collect()
    for r in rows:
        assert r["n_removed"] == sum(s["hi"] - s["lo"] for s in r["spans"])
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows], key=repr)


def corpus(rng, n=60):
    """Few words, so that cores are hot and chance repeats abound; shared passages, copies and odd texts beside them."""
    word = lambda: rng.choice(["a", "b", "é", "日本", "x" * 5])
    passage = [word() for _ in range(60)]
    docs = [(i, "\t ".join(word() for _ in range(rng.randrange(0, 80)))) for i in range(n)]
    for i in range(n, n + 20):
        lo = rng.randrange(0, 40)
        docs.append((i, " ".join([*(f"u{i}-{j}" for j in range(rng.randrange(0, 30))), *passage[lo : lo + rng.randrange(5, 30)], *(f"v{i}-{j}" for j in range(5))])))
    docs += [(900, docs[3][1]), (901, docs[3][1]), (3, docs[3][1]), (902, None), (903, ""), (None, "w " * 50), (None, "w " * 50), (904, "w " * 300), (905, "a b   c\x1cd")]
    return docs


@pytest.mark.parametrize(("width", "hot"), [(12, 10_000), (12, 2), (9, 1), (3, 10_000)])
def test_equals_brute_force(spark, width, hot):
    docs = corpus(random.Random(width))
    assert got(spark, docs, width, hot=hot) == brute(docs, width)


def test_production_width_across_pieces_and_shards(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(substrings, "PIECE", 50)
    monkeypatch.setattr(substrings, "CHUNK", 300)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 100)
    shared = " ".join(f"p{i}" for i in range(52))
    docs = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))) + (f"  {shared}\n" if i % 3 else " ") + f"end{i}") for i in range(40)]
    docs.append((99, " ".join(f"p{i}" for i in range(34))))
    want = brute(docs, 35)
    assert got(spark, docs, 35) == want and sum(r[2] for r in want) == 52 * 26


def test_empty_and_very_long(spark):
    assert got(spark, [], 35) == []
    long = " ".join(map(str, range(120_000)))
    docs = [(1, long), (2, "x " + " ".join(map(str, range(500, 560))) + " y")]
    assert got(spark, docs, 35) == brute(docs, 35)


def test_saturated_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BITS", 64)
    docs = corpus(random.Random(8))
    assert got(spark, docs, 12) == brute(docs, 12)


def test_index_counts_as_plain_search():
    rng = np.random.default_rng(2)
    parts = [rng.integers(1, 5, size=rng.integers(3, 30)) for _ in range(40)]
    text = np.concatenate([np.append(p, 0) for p in parts])
    index = substrings.FMIndex(text, np.ones(len(text), dtype=np.int64), 31)
    for _ in range(200):
        p = parts[rng.integers(40)]
        lo = rng.integers(len(p))
        want = p[lo : lo + rng.integers(1, 9)]
        a, b = np.array([0]), np.array([index.n])
        for w in want[::-1]:
            a, b = index.extend(np.array([w]), a, b)
        assert int(b[0] - a[0]) == sum(np.array_equal(text[i : i + len(want)], want) for i in range(len(text)))


def test_ranks():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 37, size=1000)
    tree = substrings.WaveletMatrix(x, 6)
    for c in range(40):
        at = rng.integers(0, 1001, size=20)
        some = np.full(20, c)
        assert (tree.descend(some, at) - tree.descend(some, np.zeros(20, dtype=np.int64))).tolist() == [int((x[:i] == c).sum()) for i in at]
