"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document (good, bad, abstain).
Expectation-maximisation over the counts of vote patterns estimates each
labeller's accuracy per class; no true label is used.  The posterior of a
pattern is the soft label of a document, and a hashed linear scorer over words,
pairs of neighbouring words and word shapes is fitted to it on a bounded
sample: the ``max_train`` distinct texts of least hash, the same ones in every
run.  Then it scores every whole text.

Driver memory: one row per vote pattern that occurs (at most 3 ** labellers)
and the sample's hashed features (some 8 bytes a word and pair).  Null and empty texts have no words: every
labeller abstains and the score is the fitted prior.  An empty table gives no
rows.  Repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, hold, only, row_chunks, with_results

GOOD, BAD, NONE = 1, 0, 2
TOP = (1 << 63) - 1
BITS = 18
MASK = (1 << BITS) - 1
SYMBOLS = "#$%&*^~@=+<>{}[]|\\_"

#: (statistic, bad from, good to, least words); votes bad at or beyond "bad from", good at or below "good to".
LABELLERS = [
    ("symbols", 0.05, 0.01, 5),
    ("shouting", 0.5, 0.2, 5),
    ("stutter", 0.2, 0.05, 10),
    ("bars", 0.1, 0.02, 5),
    ("sameness", 0.75, 0.6, 40),
    ("exclaim", 0.3, 0.05, 5),
    ("odd_length", 0.6, 0.3, 20),
    ("no_stops", 0.995, 0.99, 60),
    ("non_letters", 0.25, 0.15, 5),
]


def statistics(text: str, words: list[str]) -> dict[str, float]:
    """Shares between 0 and 1, each higher for worse texts."""
    n = len(words)
    letters = sum(map(len, words)) or 1
    strip = text.translate(_DELETE)
    upper = sum(map(str.isupper, words))
    return {
        "symbols": (len(text) - len(strip)) / letters,
        "shouting": upper / n,
        "stutter": sum(map(str.__eq__, words, words[1:])) / n,
        "bars": text.count("|") / n,
        "sameness": 1 - len(set(words)) / n,
        "exclaim": text.count("!") / n,
        "odd_length": max(0.0, abs(letters / n - 6) / 10),
        "no_stops": 1 - text.count(".") / n,
        "non_letters": 1 - min(1.0, (len(strip) - text.count("!") - (len(text) - letters)) / letters),
    }


_DELETE = {ord(c): None for c in SYMBOLS}


def vote_pattern(text: str) -> int:
    """Votes of all labellers in base 3."""
    words = text.split()
    n, code = len(words), 0
    stats = statistics(text, words) if n else {}
    for name, bad, good, least in LABELLERS:
        vote = NONE if n < least else BAD if stats[name] >= bad else GOOD if stats[name] <= good else NONE
        code = 3 * code + vote
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """Votes (patterns x labellers) of coded patterns."""
    out = np.zeros((len(codes), len(LABELLERS)), dtype=np.int64)
    for j in range(len(LABELLERS) - 1, -1, -1):
        codes, out[:, j] = codes // 3, codes % 3
    return out


def fit_labellers(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> dict:
    """EM for two classes with class-conditional vote shares; start: bad votes are rare in good texts."""
    votes = unpack(codes)
    m = votes.shape[1]
    prior = np.array([0.1, 0.9])  # bad, good
    theta = np.zeros((2, m, 3))
    theta[0, :, [BAD, GOOD, NONE]] = np.array([0.3, 0.6, 0.1])[:, None]
    theta[1, :, [BAD, GOOD, NONE]] = np.array([0.01, 0.89, 0.1])[:, None]
    post = np.zeros((len(codes), 2))
    for _ in range(rounds):
        logp = np.log(prior)[None, :] + sum(np.log(theta[:, j, votes[:, j]]).T for j in range(m))
        post = np.exp(logp - logp.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        w = post * counts[:, None]
        total = w.sum(axis=0)
        prior = (total + [1.0, 9.0]) / (total.sum() + 10)
        for v in (BAD, GOOD, NONE):
            hit = (votes == v).astype(float)
            theta[:, :, v] = (w.T @ hit + (0.5 if v == BAD else 1.0)) / (total[:, None] + 2.5)
    return {"posterior": dict(zip(codes.tolist(), post[:, 1].tolist())), "prior": float(prior[1]), "theta": theta}


class Shapes:
    """Hashed features of a text: square roots of the shares of words, neighbouring pairs and word shapes, and a few binned shares."""

    def __init__(self, most: int = 100_000):
        self.known: dict[str, int] = {}
        self.most = most

    def codes(self, word: str) -> int:
        """Bucket of the word and, above it, of its shape (runs of character classes, whole)."""
        out, last = [], ""
        for ch in word:
            c = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
            if c != last:
                out.append(c)
                last = c
        shape = zlib.crc32("".join(out).encode(errors="replace"), 1) & MASK
        both = shape << BITS | zlib.crc32(word.lower().encode(errors="replace")) & MASK
        if len(self.known) >= self.most:
            self.known.clear()
        self.known[word] = both
        return both

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Bucket ids and values; one constant feature."""
        words = text.split()
        bias = zlib.crc32(b"bias") & MASK
        if not words:
            return np.array([bias], dtype=np.int32), np.ones(1, dtype=np.float32)
        n = len(words)
        get, miss = self.known.get, self.codes
        both = np.fromiter([g if (g := get(w)) is not None else miss(w) for w in words], dtype=np.int64, count=n)
        word, shape = both & MASK, both >> BITS
        pair = (word[:-1] * 31 + word[1:] * 17 + 7) & MASK
        bins = [("stutter", sum(map(str.__eq__, words, words[1:])) / n), ("same", 1 - len(set(words)) / n if n >= 40 else 0.0)]
        extra = [zlib.crc32(f"{k}:{int(10 * v)}".encode()) & MASK for k, v in bins]
        uniq, cnt = np.unique(np.concatenate([word, shape, pair]), return_counts=True)
        return np.concatenate([uniq, extra, [bias]]).astype(np.int32), np.concatenate([np.sqrt(cnt / n), np.ones(len(extra) + 1)]).astype(np.float32)


def fit_scorer(rows: list[tuple[float, np.ndarray, np.ndarray]], epochs: int = 12, rate: float = 0.5, seed: int = 7) -> np.ndarray:
    """Logistic weights for soft labels by Adagrad over shuffled rows."""
    w, g2 = np.zeros(1 << BITS), np.full(1 << BITS, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, ids, x = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[ids] @ x, -30, 30)))
            grad = (p - y) * x + 1e-5 * w[ids]
            g2[ids] += grad * grad
            w[ids] -= rate * grad / np.sqrt(g2[ids])  # a bucket that occurs twice takes its last step
    return w


def fit(docs: DataFrame, max_train: int = 2_500) -> dict:
    """Labeller accuracies over all documents, scorer weights from at most about ``max_train`` of them."""
    texts = only(docs, "text")

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold(("quality",), Shapes)
        for pdf in row_chunks(batches):
            codes = [vote_pattern(t if isinstance(t, str) else "") for t in pdf["text"].array]
            u, n = np.unique(np.array(codes, dtype=np.int64), return_counts=True)
            yield pd.DataFrame({"code": u, "n": n})

    found = texts.mapInPandas(votes, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    if not found:
        return {"weights": np.zeros(1 << BITS), "labellers": {"posterior": {}, "prior": 1.0}}
    codes, counts = np.array([r["code"] for r in found]), np.array([r["n"] for r in found], dtype=float)
    model = fit_labellers(codes, counts)
    post = model["posterior"]
    # Of the texts whose hash lies in a share of the 63-bit range that holds some ``2 * max_train`` rows, each distinct one once, least hash first.
    limit = min(TOP, int(TOP * min(1.0, 2 * max_train / counts.sum())))
    h = F.xxhash64(F.lit(11), "text").bitwiseAND(F.lit(TOP))
    sample = texts.withColumn("h", h).where(F.col("h") <= limit).groupBy("h", "text").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "text").limit(max_train).select("h", "text")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = hold(("quality",), Shapes)
        for pdf in row_chunks(batches):
            rows = [(t if isinstance(t, str) else "") for t in pdf["text"].array]
            made = [shapes.features(t) for t in rows]
            yield pd.DataFrame({"h": pdf["h"].array, "y": [post.get(vote_pattern(t), 1.0) for t in rows], "ids": [a.tobytes() for a, _ in made], "x": [b.tobytes() for _, b in made]})

    got = sample.mapInPandas(features, "h long, y double, ids binary, x binary").collect()  # at most ``max_train`` rows
    rows = [(r["y"], np.frombuffer(r["ids"], dtype=np.int32), np.frombuffer(r["x"], dtype=np.float32)) for r in sorted(got, key=lambda r: (r["h"], r["y"], bytes(r["ids"])))]
    weights = fit_scorer(rows)
    del rows, got
    give_back()  # the driver keeps what the fit used otherwise, beside all later stages
    return {"weights": weights, "labellers": model}


def scorer(docs: DataFrame, max_train: int, threshold: float | None):
    """Batch function that appends score and posterior, or (with a threshold) keeps the rows that reach it as they are."""
    model = fit(docs, max_train)
    weights = docs.sparkSession.sparkContext.broadcast(model["weights"].astype(np.float32))  # 1 MB
    post, prior = model["labellers"]["posterior"], model["labellers"]["prior"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes, w = hold(("quality",), Shapes), weights.value
        for pdf in row_chunks(batches):
            texts = [t if isinstance(t, str) else "" for t in pdf["text"].array]
            s = np.array([1 / (1 + np.exp(-np.clip(w[ids] @ x, -30, 30))) for ids, x in map(shapes.features, texts)], dtype=np.float64)
            yield pdf[s >= threshold] if threshold is not None else pdf.assign(_r0=s, _r1=[post.get(vote_pattern(t), prior) for t in texts])

    return run


def kept(docs: DataFrame, max_train: int = 2_500, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns as they are."""
    return with_results(docs, scorer(docs, max_train, threshold), "text", {})


def classify(docs: DataFrame, max_train: int = 2_500, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: better), ``weak_posterior`` (of its votes) and ``keep`` of every whole text."""
    out = with_results(only(docs, "doc_id", "text"), scorer(docs, max_train, None), "text", {"score": "double", "weak_posterior": "double"})
    return out.select("doc_id", "score", "weak_posterior", (F.col("score") >= threshold).cast("int").alias("keep"))
