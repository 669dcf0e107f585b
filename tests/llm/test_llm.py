"""Training-data operators against brute force, the libraries they must equal, and hostile tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tidemark.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import bpe, components, fingerprint, ngramjoin, packing, quality, sharding, tokenfile, topk, toxicity, urlfilter  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, seq string, _pid int"
ODD = ["", None, " ", "a", "Don't  stop <|endoftext|> x", "ΑΣ É é İ ﬁ 日本語 ٣٤ 😀 \x1c z", "same text " * 30, "same text " * 30, "x" * 3000, "line\n\n two\t three "]


def docs_of(spark, texts=ODD, start=0):
    rows = [(start + i, t, "en", None if i % 4 == 0 else f"s{i % 2}", 0, 0.5, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    if not os.path.isdir(SF):
        pytest.skip("no driver tables")
    return spark.read.parquet(f"{SF}/documents.parquet")


def as_dict(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_bpe_equals_library(spark, corpus):
    tok = Tokenizer.from_file(WORD)
    for df in (docs_of(spark), corpus.limit(60)):
        got = as_dict(bpe.encode_digests(df, WORD), "n_tokens", "ids_sha256", "decoded_sha256")
        for r in df.collect():
            ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
            want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            assert got[r["doc_id"]] == want, r["text"]
    assert bpe.encode_digests(docs_of(spark).limit(0), WORD).count() == 0


def test_rank_and_backtracking_encoders_agree(corpus):
    a, b = bpe.BacktrackingBPE(WORD), packing.RankBPE(WORD)
    for t in [*ODD, *[r["text"] for r in corpus.limit(40).collect()]]:
        assert a.encode(t).tolist() == b.encode(t).tolist()


def test_packing_is_whole_gapless_and_tight(spark, corpus):
    tok = Tokenizer.from_file(WORD)
    for df in (docs_of(spark).repartition(3), corpus.repartition(5), docs_of(spark).limit(0)):
        rows = packing.pack(df, WORD, 256, 0).collect()
        ids = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in df.collect()}
        seen: dict = {}
        bins: dict = {}
        for r in rows:
            part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and r["start"] == 256 * r["piece"]
            assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
            seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert seen == {k: len(v) for k, v in ids.items()}
        for parts in bins.values():
            at = 0
            for off, n in sorted(parts):
                assert off == at
                at += n
            assert at <= 256
        total = sum(map(len, ids.values()))
        assert len(bins) <= 1.25 * -(-total // 256) + 1


def test_best_fit_prefers_the_tightest_bin():
    bins, offsets, fill = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and fill.tolist() == [10, 10]


def test_token_files(spark, corpus):
    tok = Tokenizer.from_file(BYTE)
    for df in (docs_of(spark), corpus, docs_of(spark).limit(0)):
        got = as_dict(tokenfile.write_and_read(df, BYTE, 2), "start", "n_tokens", "ids_crc32")
        at = 0
        for r in sorted(df.collect(), key=lambda r: r["doc_id"]):
            ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]
            assert got[r["doc_id"]] == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
            at += len(ids)


@pytest.mark.parametrize("n", [0, 1, 5, 700, 5000])
def test_range_coder_round_trip_and_damage(n):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, 50257, n), np.minimum(r.geometric(0.02, n), 50000), np.tile(r.integers(0, 300, 50), n // 50 + 1)[:n], np.zeros(n)):
        ids = ids.astype("<u2")
        data = tokenfile.write_file(np.array([4]), np.array([n]), ids)
        d, lengths, back = tokenfile.read_file(data)
        assert (back == ids).all() and d.tolist() == [4] and lengths.tolist() == [n]
        block = tokenfile.BLOCK
        for k in range(-(-n // block)):
            assert (tokenfile.read_block(data, k) == ids[k * block : (k + 1) * block]).all()
        for at in (10, len(data) // 2, len(data) - 1):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises((ValueError, zlib.error)):
                tokenfile.read_file(bytes(bad))


def test_token_files_beat_zlib(corpus):
    enc = tokenfile.ByteBPE(BYTE)
    ids = np.frombuffer(b"".join(enc.encode(r["text"] or "") for r in corpus.collect()), dtype="<u2")
    size = len(tokenfile.write_file(np.array([0]), np.array([len(ids)]), ids))
    assert size < 0.95 * len(zlib.compress(ids.tobytes(), 9))


def test_a_damaged_block_harms_no_other():
    ids = np.random.default_rng(1).integers(0, 90, 5 * tokenfile.BLOCK).astype("<u2")
    data = bytearray(tokenfile.write_file(np.array([4]), np.array([len(ids)]), ids))
    data[-1] ^= 1  # in the last block
    assert (tokenfile.read_block(bytes(data), 2) == ids[2 * tokenfile.BLOCK : 3 * tokenfile.BLOCK]).all()
    with pytest.raises(ValueError, match="damaged block 4"):
        tokenfile.read_block(bytes(data), 4)


def brute_components(rows, width, num, den):
    sets = []
    for d, t in rows:
        w = bytes(t or "", "utf-8").lower().split()
        w = [x.decode() for x in w]
        sets.append((d, frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    f = ngramjoin.Forest(len(sets))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and den * len(a & b) >= num * len(a | b):
                f.join(i, j)
    least: dict = {}
    for i, (d, _) in enumerate(sets):
        r = f.find(i)
        least[r] = min(least.get(r, d), d)
    return {d: (len(s), least[f.find(i)]) for i, (d, s) in enumerate(sets)}


def near_copies(n, words, edits, seed):
    r = np.random.default_rng(seed)
    base = [f"w{x}" for x in r.integers(0, 5000, words)]
    out = []
    for _ in range(n):
        t = list(base)
        for k in r.integers(0, words, r.integers(0, edits + 1)):
            t[k] = f"v{r.integers(0, 10**6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("chunk", [None, 96])
def test_ngram_join_equals_brute_force(spark, corpus, chunk, monkeypatch):
    texts = near_copies(130 if chunk is None else 260, 80, 4, 1) + near_copies(6, 30, 1, 2) + ["A b c", "a B\tc", "a b", *ODD]
    df = docs_of(spark, texts).unionByName(corpus.withColumn("doc_id", F.col("doc_id") + 10_000).limit(80), allowMissingColumns=True)
    got = as_dict(ngramjoin.jaccard_components(df), "n_shingles", "component_id")
    assert got == brute_components([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], 4, 85, 100)
    assert ngramjoin.jaccard_components(docs_of(spark).limit(0)).count() == 0


def test_search_links_equals_pairs():
    texts = near_copies(60, 60, 5, 3) + near_copies(20, 90, 3, 4)
    sets = [ngramjoin.shingle_set(t, 4) for t in texts]
    f, g = ngramjoin.Forest(len(sets)), ngramjoin.Forest(len(sets))
    for a, b in ngramjoin.search_links(sets, 85, 100):
        o = len(np.intersect1d(sets[a], sets[b]))
        assert 185 * o >= 85 * (len(sets[a]) + len(sets[b]))
        f.join(a, b)
    for i in range(len(sets)):
        for j in range(i):
            if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j])):
                g.join(i, j)
    assert [f.find(i) for i in range(len(sets))] == [g.find(i) for i in range(len(sets))]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 9), (4, 4)], "u long, v long")
    assert {r["node"]: r["component"] for r in components.connected_components(edges).collect()} == {1: 1, 2: 1, 3: 1, **dict.fromkeys((5, 6, 7, 8, 9), 5)}
    assert components.connected_components(edges.limit(0)).count() == 0


def test_sharding(spark, corpus):
    big = corpus.unionByName(corpus.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(docs_of(spark, start=5000).select(corpus.columns))
    rows = sharding.shard_rows(big, 24).collect()
    n = big.count()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in big.select("doc_id").collect())
    counts = np.bincount([r["shard"] for r in rows], minlength=24)
    assert counts.max() - counts.min() <= 1 and counts.sum() == n
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    totals: dict = {}
    for r in rows:
        totals.setdefault(r["source"], []).append(r["shard"])
    for got in totals.values():  # each source is spread evenly
        per = np.bincount(got, minlength=24)
        assert per.max() - per.min() <= 2
    assert sharding.shard_rows(docs_of(spark).limit(0)).count() == 0


def test_url_rules_and_scores(spark):
    rows = [(0, "http://A.example.COM/en/7x?q", "<a href='/x'>"), (1, "https://b.com/en/1", None), (2, "https://b.com/fr", "<a href=\"http://c.net/de/1\">"), (3, "http://c.net/de/9", ""), (4, "http://xcom/en/1", ""), (5, None, "x"), (6, "no scheme", ""), (7, "http://example.net/de/8/1#f", ""), (8, "ftp://org/es/?a", "")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert got[1] == ("b.com", "/en/1", "com/en/", "block")
    assert got[2][2:] == (None, "block") and got[3] == ("c.net", "/de/9", "net/de/", "allow")
    assert got[4][2:] == (None, "allow") and got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7] == ("example.net", "/de/8/1", "example.net/de/8", "block") and got[8] == ("org", "/es/", "org/es/", "block")
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_trust_spreads_as_in_numpy(spark):
    rows = [(0, "http://a.net/de/1", '<a href="http://b.xyz/">'), (1, "http://b.xyz/", '<a href="http://c.xyz/"><a href="http://c.xyz/2">'), (2, "http://c.xyz/", ""), (3, "http://d.xyz/", '<a href="http://e.com/">'), (4, "http://e.com/en/1", "")]
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urlfilter.host_scores(spark.createDataFrame(rows, "page_id long, url string, html string"), urlfilter.RULES).collect()}
    hosts = ["a.net", "b.xyz", "c.xyz", "d.xyz", "e.com"]
    w = np.eye(5)
    w[0, 1] += 1
    w[1, 2] += 2
    w[3, 4] += 1
    t, d = np.array([1.0, 0, 0, 0, 0]), np.array([0.0, 0, 0, 0, 1])
    t0, d0 = t, d
    for _ in range(urlfilter.ITERATIONS):
        t = 0.15 * t0 + 0.85 * (t / w.sum(1)) @ w
        d = 0.15 * d0 + 0.85 * w @ (d / w.sum(0))
    for i, h in enumerate(hosts):
        assert got[h] == pytest.approx((t[i], d[i]))


def test_a_link_is_read_from_its_own_start(spark):
    html = "".join(f'<a href="{h}">' for h in ("/go?u=http://evil.com/", "mailto:a@b.com", "#x", "//c.org/1", "HTTPS://D.org?x", "page.html", "page.html", "javascript:f('http://evil.com')"))
    df = spark.createDataFrame([(1, "http://a.net/p", html), (2, None, html), (3, "http://a.net/q", None)], "page_id long, url string, html string")
    assert {(r["src"], r["dst"]): r["n"] for r in urlfilter.host_edges(df).collect()} == {("a.net", "a.net"): 3.0, ("a.net", "c.org"): 1.0, ("a.net", "d.org"): 1.0}


def test_distrust_reaches_any_distance(spark):
    n = 20  # each host links to the next; the last is blocked
    rows = [(i, f"http://h{i}.xyz/", f'<a href="http://h{i + 1}.xyz/">') for i in range(n)] + [(n, f"http://h{n}.xyz/en/1", "")]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), [("block", "xyz/en/")]).collect()
    assert all(r["verdict"] == "block" and r["distrust"] > 0 for r in got) and sum(r["distrust"] for r in got) == pytest.approx(1)


@pytest.mark.parametrize(("dims", "small"), [(1, False), (8, False), (8, True)])
def test_top_k_equals_brute_force(spark, dims, small, monkeypatch):
    if small:  # several blocks a task, several query chunks
        monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
        monkeypatch.setattr(topk, "CHUNK_VALUES", 16)
    r = np.random.default_rng(dims)
    vec = [(i, [float(x) for x in np.round(r.normal(0, 1, dims), 1)], 0) for i in range(450)] + [(450, None, 0), (500, [float("nan")] * dims, 0), (501, [None] * dims, 0), (502, [], 0), (503, [9.0] * 3000, 0), (None, [1.0] * dims, 0)]
    vec += [(7, [5.0] * dims, 1)] * 3 + [(7, [4.5] * dims, 1)]  # a repeated id, equal rows among them
    df = spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int").withColumnRenamed("label", "id")
    got = {}
    for row in topk.top_k(df).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    ok = [(i, np.pad(np.floor(1024 * np.float32(v).astype(float)), (0, 3000 - len(v)))) for i, v, _ in vec if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert set(got) == {i for i, _ in ok if i % 100 == 0}
    for q, rows in got.items():
        x = next(v for i, v in ok if i == q)
        want = sorted((-int(x @ v), i) for i, v in ok if i != q)[:10]
        assert sorted(rows) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert topk.top_k(df.limit(0)).count() == 0


def labelled(n=160, seed=0):
    r = np.random.default_rng(seed)
    words = ["".join(r.choice(list("abcdefghij"), 6)) for _ in range(300)]
    out = []
    for i in range(n):
        t = [words[k] for k in r.integers(0, 300, 60)]
        toxic = i % 3 == 0
        if toxic:
            for k in r.integers(0, 60, 3):
                t[k] = "zorgle" + words[r.integers(0, 300)][:2]
        out.append((" ".join(t), int(toxic)))
    return out


def test_top_k_of_huge_components(spark):
    """Finite components of any size: integers stay exact, scores beyond a long are the nearest one."""
    top = (1 << 63) - 1
    rows = [(0, [1e308]), (100, [1e10, 1.0]), (1, [1e10, 0.0]), (2, [-1e10, 0.0]), (3, [1e11, 0.0]), (4, [2.0, 1.0]), (5, [3e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(df).orderBy("rank").collect()]
    assert got == [(5, top), (3, top), (1, top), (4, 1024 * 10**10 * 2048 + 1024 * 1024), (2, -top - 1)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_toxicity_finds_unseen_forms(spark):
    data = labelled()
    df = docs_of(spark, [t for t, _ in data] + ODD)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(data)] + [(9999, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(df, labels).collect()
    assert len(rows) == len(data) + len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < len(data)]
    assert np.mean([r["predicted"] == data[r["doc_id"]][1] for r in held]) >= 0.9
    assert {r["score"] for r in toxicity.classify(df, labels.limit(0)).collect()} == {0.0}


def test_toxicity_reads_whole_unspaced_runs(spark):
    text = "".join(chr(0x4E00 + i) for i in range(333))
    got = toxicity.steps(f"one {text} two")
    assert got[0] == "one" and got[-1] == "two" and all(len(p) <= toxicity.PIECE for p in got[1:-1])
    assert all(any(text[i : i + 5] in p for p in got) for i in range(len(text) - 4))
    # One frame for every run: no length at which a run is read otherwise.
    assert toxicity.steps("a " + "b" * 16 + " " + "-" * 100) == ["a", "b" * 16, "-" * 100]
    assert [len(toxicity.steps("b" * n)) for n in (16, 17, 24, 25, 64, 65)] == [1, 2, 2, 3, 7, 8]
    data = labelled()
    clean = [t.replace(" ", "_") for t, y in data if not y][:10]
    late = [t + "_" + "_".join(["zorglehij"] * 3) for t in clean]
    df = docs_of(spark, [t for t, _ in data] + clean + late)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(data)], "doc_id long, quality int, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.classify(df, labels).collect()}
    n = len(data)
    assert all(score[n + 10 + i] > max(0.5, score[n + i]) for i in range(10))


def test_toxicity_reacts_in_unspaced_scripts_of_any_length(spark):
    """A toxic tail of ideographs after 12 to 10,000 others: each length reacts, none without it does."""
    import random

    r = random.Random(3)
    han = lambda k: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(k))
    bad = "".join(chr(0x9000 + i) for i in (7, 400, 33, 90, 250, 61, 5, 800))
    data = [(han(r.randrange(8, 60)) + (bad if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(240)]
    sizes = (12, 13, 20, 21, 22, 40, 64, 65, 300, 10_000)
    df = docs_of(spark, [t for t, _ in data] + [han(k) + bad for k in sizes] + [han(k) for k in sizes])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(data)], "doc_id long, quality int, toxic int")
    score = {r_["doc_id"]: r_["score"] for r_ in toxicity.classify(df, labels).collect()}
    n, k = len(data), len(sizes)
    assert [score[n + i] > 0.5 for i in range(k)] == [True] * k and [score[n + k + i] > 0.5 for i in range(k)] == [False] * k


def plain_gru(net, x):
    """Bidirectional network over the rows of one window, word by word, in plain Python."""
    import math

    p = {k: v.astype(float) for k, v in net.p.items()}
    sig = lambda v: 1 / (1 + math.exp(-v))
    h = toxicity.HIDDEN
    states = {}
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        s = [0.0] * h
        for t in order:
            a = [sum(x[t][i] * p["W" + d][i][j] for i in range(len(x[t]))) + p["c" + d][j] for j in range(3 * h)]
            g = [sum(s[i] * p["U" + d][i][j] for i in range(h)) for j in range(3 * h)]
            r, z = [sig(a[j] + g[j]) for j in range(h)], [sig(a[h + j] + g[h + j]) for j in range(h)]
            n = [math.tanh(a[2 * h + j] + r[j] * g[2 * h + j]) for j in range(h)]
            s = [s[j] + (1 - z[j]) * (n[j] - s[j]) for j in range(h)]
            states[d, t] = s
    both = [states["f", t] + states["b", t] for t in range(len(x))]
    e = [sum(math.tanh(sum(v[i] * p["A"][i][k] for i in range(2 * h)) + p["a"][k]) * p["v"][k] for k in range(toxicity.ATTEND)) for v in both]
    w = [math.exp(v - max(e)) for v in e]
    return sum(w[t] / sum(w) * sum(both[t][i] * p["w"][i] for i in range(2 * h)) for t in range(len(x))) + p["o"][0]


def test_windows_and_network_equal_plain_loops():
    r = np.random.default_rng(4)
    net = toxicity.Network.start()
    leans = toxicity.Leans(*(r.normal(0, 1, 1 << b).astype(np.float32) for b in (toxicity.WORD_BITS, toxicity.GRAM_BITS)))
    leans.word_vec[:] = r.normal(0, 1, leans.word_vec.shape)
    leans.gram_vec[:] = r.normal(0, 1, leans.gram_vec.shape)
    text = " ".join(f"w{i * i % 37}" for i in range(61))
    rows = leans.inputs(*leans.hashed(toxicity.steps(text)))
    size, jump = toxicity.WINDOW, toxicity.STRIDE
    starts = sorted({*range(0, 61 - size, jump), 61 - size})
    want = max(plain_gru(net, rows[a : a + size].tolist()) for a in starts)
    got = toxicity.strongest(net, toxicity.WordRows(leans), [text, "", "one"])
    assert got[0] == pytest.approx(want, abs=1e-4)
    one = leans.inputs(*leans.hashed(["one"]))
    assert got[2] == pytest.approx(plain_gru(net, one.tolist()), abs=1e-4)


def test_embeddings_are_learned():
    data = labelled()
    m = toxicity.train([t for t, _ in data], np.array([y for _, y in data]))
    assert (m["tables"][2] != 0).any() and (m["tables"][3] != 0).any()


def test_gradients_match_differences():
    r = np.random.default_rng(1)
    net = toxicity.Network.start()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows, index = r.normal(0, 1, (12, toxicity.INPUTS)), np.arange(12).reshape(2, 6)
    mask = np.ones((2, 6))
    mask[1, 4:] = 0

    def loss():
        return np.log1p(np.exp(-net.forward(rows, index, mask) * [1, -1])).sum()

    tape: dict = {}
    z = net.forward(rows, index, mask, tape)
    grads = net.gradients(tape, 1 / (1 + np.exp(-z)) - [1, 0])
    for k, g in grads.items():
        flat = net.p[k].reshape(-1)
        for i in (0, flat.size - 1):
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert g.reshape(-1)[i] == pytest.approx((up - down) / 2e-4, abs=2e-3)


def test_labellers_equal_plain_expectation_maximisation():
    r = np.random.default_rng(5)
    codes = np.unique(r.integers(0, 3 ** len(quality.LABELLERS), 40))
    counts = r.integers(1, 50, len(codes)).astype(float)
    got = quality.fit_labellers(codes, counts, rounds=7)
    m = len(quality.LABELLERS)
    votes = [[c // 3 ** (m - 1 - j) % 3 for j in range(m)] for c in codes.tolist()]
    prior = [0.1, 0.9]
    theta = [[{0: 0.3, 1: 0.6, 2: 0.1} for _ in range(m)], [{0: 0.01, 1: 0.89, 2: 0.1} for _ in range(m)]]
    for _ in range(7):
        post = []
        for v in votes:
            p = [prior[k] * np.prod([theta[k][j][v[j]] for j in range(m)]) for k in (0, 1)]
            post.append([x / sum(p) for x in p])
        total = [sum(post[i][k] * counts[i] for i in range(len(votes))) for k in (0, 1)]
        prior = [(total[0] + 1) / (sum(total) + 10), (total[1] + 9) / (sum(total) + 10)]
        theta = [[{x: (sum(post[i][k] * counts[i] for i in range(len(votes)) if votes[i][j] == x) + (0.5 if x == 0 else 1.0)) / (total[k] + 2.5) for x in (0, 1, 2)} for j in range(m)] for k in (0, 1)]
    for c, p in zip(codes.tolist(), post):
        assert got["posterior"][c] == pytest.approx(p[1])


def test_scorer_reads_words_and_pairs():
    f = quality.Shapes().features
    ids = [set(f(t)[0].tolist()) for t in ("hello world", "zorgle world", "world hello", "hello world")]
    assert ids[0] != ids[1] and ids[0] != ids[2] and ids[0] == ids[3]
    assert set(f("a1b2c3d4 " * 3)[0].tolist()) != set(f("a1b2c3z9x " * 3)[0].tolist())  # runs beyond the sixth count


def test_scorer_equals_plain_gradient_steps():
    rows = [(y, *quality.Shapes().features(t)) for t, y in (("good plain words", 1.0), ("bad ### words", 0.0), ("", 0.9))]
    got = quality.fit_scorer(rows, epochs=2)
    w, g2 = {}, {}
    rng = np.random.default_rng(7)
    for _ in range(2):
        for i in rng.permutation(len(rows)):
            y, ids, x = rows[i]
            z = sum(w.get(k, 0.0) * float(v) for k, v in zip(ids.tolist(), x))
            p = 1 / (1 + np.exp(-z))
            for k, v in zip(ids.tolist(), x):
                grad = (p - y) * float(v) + 1e-5 * w.get(k, 0.0)
                g2[k] = g2.get(k, 1e-2) + grad * grad
                w[k] = w.get(k, 0.0) - 0.5 * grad / np.sqrt(g2[k])
    for k, v in w.items():
        assert got[k] == pytest.approx(v, rel=1e-6)


def test_quality(spark, corpus):
    good = [t for t, _ in labelled(120)]
    good = [" ".join(f"{w}." if k % 9 == 8 else w for k, w in enumerate(t.split())) for t in good]
    bad = [t.upper().replace(" ", "!! ") for t in good[:8]] + [t.replace(" ", "### ") for t in good[8:16]] + [" ".join(w for w in t.split()[:8] for _ in range(8)) for t in good[16:24]]
    rows = sorted(quality.classify(docs_of(spark, good + bad + ODD)).collect(), key=lambda r: r["doc_id"])
    assert [r["keep"] for r in rows[: len(good)]] == [1] * len(good)
    assert np.mean([r["keep"] for r in rows[len(good) : len(good) + len(bad)]]) <= 0.1
    assert quality.classify(docs_of(spark).limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    if not os.path.isdir(SF):
        pytest.skip("no driver tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        assert 0 < out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    import corpus_pipeline

    texts = near_copies(10, 120, 1, 9) + [" ".join(f"u{i}x{k}" for k in range(40)) for i in range(5)] + [None, ""]
    df = docs_of(spark, texts).select(*corpus_pipeline.COLUMNS)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, df, SF).collect())
    want = {c for _, c in brute_components([(r["doc_id"], r["text"]) for r in df.collect()], 5, 80, 100).values()}
    assert got == sorted(want)


def test_near_duplicate_stage_decides_by_row(spark):
    import corpus_pipeline

    text = lambda a, n=60: " ".join(f"{a}{k}" for k in range(n))
    rows = [(None, text("a")), (None, text("b")), (None, text("b") + " more"), (2, text("c")), (2, text("c")), (3, text("d")), (4, text("d") + " more"), (4, text("e")), (5, None), (5, None), (None, ""), (1, text("f")), (None, text("f"))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, df, SF).collect()]
    sure = [(None, text("a")), (2, text("c")), (3, text("d")), (4, text("e")), (5, None), (5, None), (None, ""), (1, text("f"))]
    either = [r for r in got if r not in sure]
    assert len(either) == 1 and either[0] in rows[1:3]
    assert sorted(map(repr, got)) == sorted(map(repr, sure + either))


def test_near_duplicate_and_packing_stages_take_columns_by_place(spark):
    """Names that clash with each other, with the stage's own and with its key; maps and repeated rows."""
    import corpus_pipeline

    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "kept", 5, {"a": 1}), (1, text, "also", 6, {"b": 2}), (2, text + " more", "gone", 7, None), (3, "other words here", "own", 8, {}), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, _key long, key map<string,int>")
    got = corpus_pipeline.near_duplicate_stage(spark, df, SF)
    assert got.columns == df.columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, (rows[1], rows[3], rows[4])))  # of equal rows the one whose other columns come first
    assert corpus_pipeline.packing_stage(spark, df, SF).count() == len(rows)


def test_columns_that_differ_in_case_alone(spark):
    df = spark.createDataFrame([(1, "one two three four five", 7, "x", "keep me", 2.5)], "doc_id long, text string, DOC_ID int, TEXT string, quality_score string, toxicity double")
    labels = spark.createDataFrame([(1, 1, 1, 0)], "doc_id long, quality int, toxic int, TOXIC int")
    assert quality.classify(df).first()["doc_id"] == 1 and toxicity.classify(df, labels).first()["doc_id"] == 1
    assert bpe.encode_digests(df, WORD).count() == fingerprint.fingerprint(df).count() == packing.pack(df, WORD).count() == 1
    assert tokenfile.write_and_read(df, BYTE, 2).count() == 1 and ngramjoin.jaccard_components(df).first()["component_id"] == 1
    for out in (quality.kept(df), toxicity.kept(df, labels)):
        assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [tuple(r) for r in df.collect()]
    pages = spark.createDataFrame([(1, "http://a.com/", "", "z", 1)], "page_id long, url string, html string, URL string, n int")
    assert urlfilter.judge_urls(pages).first()["host"] == "a.com"
    vec = spark.createDataFrame([(100, [1.0], 5), (1, [2.0], 5)], "vec_id long, embedding array<float>, EMBEDDING int")
    assert topk.top_k(vec).first()["vec_id"] == 1


def test_stages_bear_nulls_and_empty_tables(spark):
    import corpus_pipeline

    df = docs_of(spark).select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame([(None,) * 5], "doc_id long, text string, lang string, source string, n_chars long"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, SF).count() > 0
        assert stage(spark, df.limit(0), SF).count() == 0


def test_null_ids_and_clashing_columns_do_not_crash(spark):
    rows = [(None, "one two three four five", "en", "s", None, 0.1, "q", 1), (3, None, None, None, 4, None, None, None), (None, None, None, None, None, None, None, None), (7, "one two three four five", "en", "s", 1, 0.1, "q", 1), (7, "one two three four six", "en", None, 1, 0.1, "q", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("seq", "node")
    n = len(rows)
    labels = spark.createDataFrame([(7, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    assert quality.classify(df).count() == n and toxicity.classify(df, labels).count() == n
    assert bpe.encode_digests(df, WORD).count() == n and tokenfile.write_and_read(df, BYTE, 2).count() == n
    assert fingerprint.fingerprint(df).count() == n and sharding.shard_rows(df, 3).count() == n
    assert packing.pack(df, WORD).count() == n
    got = [(r["doc_id"], r["component_id"]) for r in ngramjoin.jaccard_components(df).collect()]
    assert len(got) == n and (7, 7) in got
