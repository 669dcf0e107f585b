"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a word: a learned embedding of the (hashed) word, the mean of
learned embeddings of its (hashed) character 4- and 5-grams, and prior
features: how word and n-grams lean (log odds of document frequencies), the
least, mean and largest lean of its n-grams, and its length.  Every run of
characters without white space is read through a frame of ``PIECE`` characters
that moves by half of it, whatever its length and script: a run that fits is
one input, a word, and a longer one (scripts without spaces) has an input for
each place of the frame.  The network reads windows of
``WINDOW`` inputs that overlap by half, in both directions; attention pools
the states of a window.  A document's score is the calibrated score of its
strongest window; every window of every whole text is scored.

The leans are fitted on one part of the training labels, embeddings and
network, by back-propagation through time in numpy, on the other, so that the
network sees leans as they are on unseen text.  Words never seen in training
have zero embeddings.  The ``max_per_class`` labelled ids of each class of
least hash are used (a documented bound, the same ids in every run; an id with
several texts gives its least one), never those whose crc32 is divisible by 5.
Only the text enters a score.

Nulls count as empty; an empty text is one window of padding.  Without
training labels of both classes every score is 0.  Ties and repeated rows score alike.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, hold, only, row_chunks, with_results

WINDOW, STRIDE, HIDDEN, ATTEND = 24, 12, 6, 6
PRIORS, EMBED = 6, 4  # prior features; dimensions of each of the two embeddings
INPUTS = PRIORS + 2 * EMBED
WORD_BITS, GRAM_BITS = 17, 18
PIECE, PIECE_STRIDE = 16, 8
PUNCTUATION = ".,;:!?\"'()[]{}<>«»“”‘’…-–—*#$%&|"


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def steps(text: str) -> list[str]:
    """Words of a text; a run longer than the frame as pieces that overlap by half, so that every n-gram is inside a piece."""
    out = []
    for w in text.split():
        if len(w) > PIECE and len(core := w.strip(PUNCTUATION)) > PIECE:
            out += [core[i : i + PIECE] for i in range(0, len(core) - PIECE + PIECE_STRIDE, PIECE_STRIDE)]
        else:
            out.append(w)
    return out


def grams(word: bytes) -> list[int]:
    """Hashed character 4- and 5-grams of a marked word."""
    w = b"^" + word + b"$"
    n, mask, crc = len(w), (1 << GRAM_BITS) - 1, zlib.crc32
    return [crc(w[i : i + k]) & mask for k in (4, 5) for i in range(n - k + 1)] or [crc(w) & mask]


class Leans:
    """Word and n-gram tables: log odds, and embeddings (zero until learned)."""

    def __init__(self, word: np.ndarray, gram: np.ndarray, word_vec: np.ndarray | None = None, gram_vec: np.ndarray | None = None):
        self.word, self.gram = word, gram
        self.word_vec = np.zeros((1 << WORD_BITS, EMBED), dtype=np.float32) if word_vec is None else word_vec
        self.gram_vec = np.zeros((1 << GRAM_BITS, EMBED), dtype=np.float32) if gram_vec is None else gram_vec

    @staticmethod
    def fit(docs: list[set[str]], labels: np.ndarray) -> Leans:
        counts = {y: (np.zeros(1 << WORD_BITS), np.zeros(1 << GRAM_BITS)) for y in (0, 1)}
        known: dict[str, tuple[int, np.ndarray]] = {}
        for words, y in zip(docs, labels.tolist()):
            w_ids, g_ids = [], []
            for w in words:
                got = known.get(w)
                if got is None:
                    b = w.encode(errors="replace")
                    got = known[w] = (zlib.crc32(b) & ((1 << WORD_BITS) - 1), np.array(grams(b), dtype=np.int32))
                w_ids.append(got[0])
                g_ids.append(got[1])
            if w_ids:
                counts[y][0][np.unique(w_ids)] += 1
                counts[y][1][np.unique(np.concatenate(g_ids))] += 1
        n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))

        def lean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            pa, pb = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
            out = np.log(pa / pb) * ((a + b) / (a + b + 4.0))
            out[a + b < 3] = 0
            return np.clip(out / 2, -3, 3).astype(np.float32)

        return Leans(*(lean(counts[1][i], counts[0][i]) for i in (0, 1)))

    @staticmethod
    def hashed(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Word buckets and each word's n-gram buckets."""
        raw = [w.encode(errors="replace") for w in words]
        return np.fromiter((zlib.crc32(b) & ((1 << WORD_BITS) - 1) for b in raw), dtype=np.int64, count=len(raw)), [np.array(grams(b), dtype=np.int64) for b in raw]

    def inputs(self, ids: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
        """Input rows (words x INPUTS) of ``hashed`` words."""
        if not len(ids):
            return np.zeros((0, INPUTS), dtype=np.float32)
        g, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        at = np.cumsum(sizes) - sizes
        v = self.gram[g]
        out = np.empty((len(ids), INPUTS), dtype=np.float32)
        out[:, 0] = self.word[ids]
        out[:, 1] = np.maximum.reduceat(v, at)
        out[:, 2] = np.minimum.reduceat(v, at)
        out[:, 3] = np.add.reduceat(v, at) / sizes
        out[:, 4] = np.add.reduceat((v > 0.75).astype(np.float32), at) / 4
        out[:, 5] = np.minimum(sizes, 60) / 60
        out[:, PRIORS : PRIORS + EMBED] = self.word_vec[ids]
        out[:, PRIORS + EMBED :] = np.add.reduceat(self.gram_vec[g], at) / sizes[:, None]
        return out

    def learn(self, ids: np.ndarray, parts: list[np.ndarray], slope: np.ndarray, rate: float, seen: tuple[np.ndarray, np.ndarray]) -> None:
        """Adagrad step of the embeddings of ``hashed`` words against the slope of the loss in their input rows."""
        g, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        of_word, of_gram = slope[:, PRIORS : PRIORS + EMBED], slope[:, PRIORS + EMBED :] / sizes[:, None]
        for table, total, rows, grad in ((self.word_vec, seen[0], ids, of_word), (self.gram_vec, seen[1], g, np.repeat(of_gram, sizes, axis=0))):
            hit, back = np.unique(rows, return_inverse=True)
            sums = np.stack([np.bincount(back, weights=grad[:, j], minlength=len(hit)) for j in range(EMBED)], axis=1) + 1e-4 * table[hit]
            total[hit] += (sums * sums).sum(axis=1)
            table[hit] -= (rate * sums / np.sqrt(total[hit] + 1e-6)[:, None]).astype(np.float32)


class WordRows:
    """Input rows of words, computed once a worker while they fit."""

    def __init__(self, leans: Leans, most: int = 300_000):
        self.leans, self.most = leans, most
        self.known: dict[str, int] = {}  # as written
        self.plain: dict[str, int] = {}  # lower-cased, without punctuation at the ends
        self.rows = np.zeros((1, INPUTS), dtype=np.float32)

    def place(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of the words and the matrix they refer to."""
        if len(self.known) > self.most:
            self.known, self.plain = {}, {}
        known, plain = self.known, self.plain
        get = known.get
        ids = [get(w, -1) for w in words]
        if -1 in ids:
            new = {w: w.lower().strip(PUNCTUATION) for w, i in zip(words, ids) if i < 0}
            fresh = [p for p in dict.fromkeys(new.values()) if p not in plain]
            used = len(plain)
            need = used + len(fresh)
            if need > len(self.rows):
                grown = np.zeros((max(need, 2 * len(self.rows)), INPUTS), dtype=np.float32)
                grown[:used] = self.rows[:used]
                self.rows = grown
            if fresh:
                self.rows[used:need] = self.leans.inputs(*self.leans.hashed(fresh))
                plain.update(zip(fresh, range(used, need)))
            known.update((w, plain[p]) for w, p in new.items())
            ids = [known[w] for w in words]
        return np.array(ids, dtype=np.int64), self.rows


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows of a text of n words."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Bidirectional GRU, attention pooling and a linear output; float32 parameters in a dict."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @staticmethod
    def start(seed: int = 3) -> Network:
        r = np.random.default_rng(seed)
        h, p = HIDDEN, {}
        for d in "fb":
            p["W" + d] = r.normal(0, 0.4, (INPUTS, 3 * h))
            p["U" + d] = r.normal(0, 0.3, (h, 3 * h))
            p["c" + d] = np.zeros(3 * h)
        p |= {"A": r.normal(0, 0.4, (2 * h, ATTEND)), "a": np.zeros(ATTEND), "v": r.normal(0, 0.4, ATTEND), "w": r.normal(0, 0.4, 2 * h), "o": np.zeros(1)}
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def read(self, pre: np.ndarray, index: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, tape: list | None = None) -> np.ndarray:
        """States (T x B x H) from projected inputs ``pre[index[:, t]]``."""
        h = HIDDEN
        b, t_len = index.shape
        state = np.zeros((b, h), dtype=np.float32)
        out = np.empty((t_len, b, h), dtype=np.float32)
        for t in range(t_len - 1, -1, -1) if back else range(t_len):
            x = pre[index[:, t]]
            g = state @ u
            rz = sigmoid(x[:, : 2 * h] + g[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            n = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
            m = mask[:, t : t + 1]
            new = state + m * (1 - z) * (n - state)
            if tape is not None:
                tape.append((t, state, g, r, z, n, m))
            out[t] = state = new
        return out

    def forward(self, rows: np.ndarray, index: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logit of each window; ``index`` (B x T) refers to ``rows``."""
        p = self.p
        tf, tb = ([], []) if tape is not None else (None, None)
        hf = self.read(rows @ p["Wf"] + p["cf"], index, mask, p["Uf"], False, tf)
        hb = self.read(rows @ p["Wb"] + p["cb"], index, mask, p["Ub"], True, tb)
        hs = np.concatenate([hf, hb], axis=2)  # T x B x 2H
        e = np.tanh(hs @ p["A"] + p["a"])
        s = e @ p["v"] + (mask.T - 1) * 1e4
        s = np.exp(s - s.max(axis=0))
        alpha = s / s.sum(axis=0)
        c = (alpha[:, :, None] * hs).sum(axis=0)
        if tape is not None:
            tape |= {"f": tf, "b": tb, "hs": hs, "e": e, "alpha": alpha, "c": c, "x": rows[index]}
        return c @ p["w"] + p["o"][0]

    def gradients(self, tape: dict, dlogit: np.ndarray) -> dict[str, np.ndarray]:
        p, h = self.p, HIDDEN
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"], g["o"][0] = tape["c"].T @ dlogit, dlogit.sum()
        dc = dlogit[:, None] * p["w"]
        hs, alpha, e = tape["hs"], tape["alpha"], tape["e"]
        dalpha = (hs * dc).sum(axis=2)
        ds = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["v"] = np.einsum("tb,tbk->k", ds, e)
        de = ds[:, :, None] * p["v"] * (1 - e * e)
        g["A"], g["a"] = np.einsum("tbh,tbk->hk", hs, de), de.sum(axis=(0, 1))
        dhs = alpha[:, :, None] * dc + de @ p["A"].T
        self.input_slope = np.zeros_like(tape["x"])
        for d, part in (("f", dhs[:, :, :h]), ("b", dhs[:, :, h:])):
            dh = np.zeros_like(part[0])
            u = p["U" + d]
            for t, state, gg, r, z, n, m in reversed(tape[d]):
                dh = dh + part[t]
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (state - n) * z * (1 - z)
                dr = dn * gg[:, 2 * h :] * r * (1 - r)
                dx = np.concatenate([dr, dz, dn], axis=1)
                dg = np.concatenate([dr, dz, dn * r], axis=1)
                g["W" + d] += tape["x"][:, t].T @ dx
                g["c" + d] += dx.sum(axis=0)
                self.input_slope[:, t] += dx @ p["W" + d].T
                g["U" + d] += state.T @ dg
                dh = dh * (1 - m * (1 - z)) + dg @ u.T
        return g


def lay_out(lengths: list[int], first: list[int], padding: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window index (B x T, ``padding`` beyond a text's end), mask, and document of each window."""
    starts, limits, owner = [], [], []
    for d, (n, lo) in enumerate(zip(lengths, first)):
        for s in windows(n):
            starts.append(lo + s)
            limits.append(lo + n)
            owner.append(d)
    index = np.array(starts, dtype=np.int64)[:, None] + np.arange(WINDOW)
    mask = index < np.array(limits, dtype=np.int64)[:, None]
    return np.where(mask, index, padding), mask.astype(np.float32), np.array(owner, dtype=np.int64)


def strongest(net: Network, words: WordRows, texts: list[str], pick: bool = False):
    """Largest window logit of each text; with ``pick`` also its window's rows."""
    split = [steps(t) for t in texts]
    ids, rows = words.place([w for s in split for w in s])
    lengths = [len(s) for s in split]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64).tolist() if lengths else []
    x = np.concatenate([rows[ids], np.zeros((1, INPUTS), dtype=np.float32)])
    index, mask, owner = lay_out(lengths, first, len(x) - 1)
    logit = net.forward(x, index, mask)
    at = np.searchsorted(owner, np.arange(len(texts)))
    best = np.maximum.reduceat(logit, at)
    if not pick:
        return best
    return best, logit, x, index, mask, owner


def train(texts: list[str], labels: np.ndarray, rounds: int = 3, epochs: int = 6, seed: int = 5) -> dict | None:
    """Tables, network and calibration from labelled texts; None without both classes."""
    rng = np.random.default_rng(seed)
    fold = np.array([zlib.crc32(t.encode(errors="replace")) % 5 < 3 for t in texts])
    y = labels.astype(np.int64)
    if len(y) < 8 or min(y[fold].sum(), (1 - y[fold]).sum(), y[~fold].sum(), (1 - y[~fold]).sum()) < 1:
        return None
    sets = [{w.lower().strip(PUNCTUATION) for w in steps(t)} - {""} for t, f in zip(texts, fold) if f]
    leans = Leans.fit(sets, y[fold])
    del sets
    words = WordRows(leans)
    other = [t for t, f in zip(texts, fold) if not f]
    oy = y[~fold]
    net = Network.start()
    seen = (np.zeros(1 << WORD_BITS), np.zeros(1 << GRAM_BITS))
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for turn in range(rounds):
        chosen, ms, ys = [], [], []
        words = WordRows(leans)  # the embeddings have moved
        for lo in range(0, len(other), 200):
            _, logit, x, index, mask, owner = strongest(net, words, other[lo : lo + 200], pick=True)
            flat = [w.lower().strip(PUNCTUATION) for t in other[lo : lo + 200] for w in steps(t)] + [""]
            if turn == 0:  # before the network knows anything: the strongest leans
                logit = x[:, :2].sum(axis=1)[index].max(axis=1)
            order = np.lexsort((-logit, owner))
            rank = np.arange(len(order)) - np.searchsorted(owner, owner[order])
            for i, k in zip(order.tolist(), rank.tolist()):
                label = oy[lo + owner[i]]
                if k == 0 or (label == 0 and (k == 1 or rng.random() < 0.05)):
                    chosen.append([flat[j] for j in index[i].tolist()])
                    ms.append(mask[i])
                    ys.append(label)
        names = sorted({w for ws in chosen for w in ws})
        number = {w: i for i, w in enumerate(names)}
        xs = np.array([[number[w] for w in ws] for ws in chosen])
        buckets, parts = leans.hashed(names)
        known = leans.inputs(buckets, parts)
        ms, ys = np.stack(ms), np.array(ys, dtype=np.float32)
        weight = np.where(ys == 1, 0.5 / max(ys.mean(), 1e-6), 0.5 / max(1 - ys.mean(), 1e-6)).astype(np.float32)
        for _ in range(max(epochs, min(20, 6000 // max(1, len(ys) // 128 + 1) // 4))):
            perm = rng.permutation(len(ys))
            for lo in range(0, len(perm), 128):
                pick = perm[lo : lo + 128]
                b = len(pick)
                here, index = np.unique(xs[pick], return_inverse=True)
                index = index.reshape(b, WINDOW)
                rows = known[here]
                tape: dict = {}
                logit = net.forward(rows, index, ms[pick], tape)
                grads = net.gradients(tape, (weight[pick] * (sigmoid(logit) - ys[pick]) / b).astype(np.float32))
                step += 1
                for k, gr in grads.items():
                    m1, m2 = adam[k]
                    m1 += 0.1 * (gr - m1)
                    m2 += 0.001 * (gr * gr - m2)
                    net.p[k] -= (0.01 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                if step % 8 == 0:  # embeddings follow at an eighth of the steps
                    slope = np.stack([np.bincount(index.reshape(-1), weights=net.input_slope[:, :, j].reshape(-1), minlength=len(here)) for j in range(INPUTS)], axis=1)
                    some = buckets[here], [parts[i] for i in here.tolist()]
                    leans.learn(*some, slope, 0.05, seen)
                    known[here] = leans.inputs(*some)
    words = WordRows(leans)
    best = np.concatenate([strongest(net, words, other[lo : lo + 200]) for lo in range(0, len(other), 200)])
    return {"tables": (leans.word, leans.gram, leans.word_vec, leans.gram_vec), "net": net.p, "logits": best, "y": oy}


def calibrate(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit (Newton steps with a small ridge)."""
    x = np.stack([logits.astype(float), np.ones(len(logits))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(np.clip(x @ beta, -30, 30))
        grad = x.T @ (weight * (p - y)) + 1e-2 * (beta - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = 2_000) -> dict | None:
    """Model from the ``max_per_class`` labelled training ids of each class of least hash; texts are not shuffled."""
    marked = only(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    least = lambda c: marked.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(23), "doc_id"), "doc_id").limit(max_per_class)
    chosen = least(0).unionByName(least(1))  # at most 2 * max_per_class rows
    texts = only(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    y = np.array([r["toxic"] for r in rows], dtype=np.int64)
    model = train([r["text"] for r in rows], y)
    del rows
    give_back()  # the driver keeps what the training used otherwise, beside all later stages
    if model is None:
        return None
    oy = model.pop("y")
    weight = np.where(oy == 1, counts[1] / max(1, (oy == 1).sum()), counts[0] / max(1, (oy == 0).sum()))
    weight = weight * len(oy) / weight.sum()
    model["slope"], model["offset"] = calibrate(model.pop("logits"), oy, weight)
    return model


def loaded(key: str, m: dict) -> tuple[Network, WordRows]:
    """The worker's network and word rows of this model."""
    return hold(("toxicity", key), lambda: (Network(m["net"]), WordRows(Leans(*m["tables"]))))


def scorer(docs: DataFrame, labels: DataFrame, max_per_class: int, below: float | None):
    """Batch function that appends the score, or (with a limit) keeps the rows that score below it as they are."""
    model = fit(docs, labels, max_per_class)
    key = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: the tables (8 MB) and the network

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in row_chunks(batches, 1_500_000):
            if m is None:
                s = np.zeros(len(pdf))
            else:
                net, words = loaded(key, m)
                texts = [t if isinstance(t, str) else "" for t in pdf["text"].array]
                s = sigmoid(np.clip(m["slope"] * strongest(net, words, texts).astype(float) + m["offset"], -30, 30))
            yield pdf[s < below] if below is not None else pdf.assign(_r0=s)

    return run


def kept(docs: DataFrame, labels: DataFrame, max_per_class: int = 2_000, below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the limit, with all their columns as they are."""
    return with_results(docs, scorer(docs, labels, max_per_class, below), "text", {})


def classify(docs: DataFrame, labels: DataFrame, max_per_class: int = 2_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""
    out = with_results(only(docs, "doc_id", "text"), scorer(docs, labels, max_per_class, None), "text", {"score": "double"})
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
