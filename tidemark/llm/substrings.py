"""Exact removal of passages of ``width`` or more words that occur elsewhere.

A window is ``width`` consecutive words of one document.  A window whose words
also start anywhere else, in the same document or another, is repeated; every
word that a repeated window covers goes.  Windows are judged on the input.

How it is found:

1. *Contexts.*  Of a window's ``SEED``-word sequences the one of least hash (the
   leftmost of equal ones) is its core: what a window says decides, wherever
   it stands.  Neighbouring windows share cores, so a document is cut into
   contexts: the words of all windows of one core.  Equal windows have equal
   cores, so only contexts of one core need to meet, and each distinct context
   needs to come once, with its count.  Cores that occur once go first.
2. *Shards.*  Contexts are dealt out by core and each shard of about
   ``SHARD_WORDS`` words becomes a compressed FM-index: suffixes of the words,
   their Burrows-Wheeler transform in a wavelet matrix of packed bits with
   rank counts, and sums of the context counts along the suffix order.
3. *Matching.*  The shard's contexts are streamed against it by backward
   search, all in step.  A match lives while the suffixes it fits count two or
   more.  Its windows all hold the core, so what a context loses is one
   interval, from its first repeated window to the end of its last.
4. *Hot cores.*  A core with more than ``HOT`` distinct contexts is split:
   each context is cut by the place of the core within the window, and the
   words that all windows of a cut share, a longer core, deal it out anew;
   in the last step a cut is one window.  No group is ever larger, none is
   sampled or capped.

What moves is hashes and word places, each distinct context once, and the
texts of documents that hold a context's first copy or lose words; which those
are is read off a bitmap of fixed size, beyond whose capacity more texts move.
Cores and contexts are told apart by 128 bits together and rows by 128 bits of
id and text; the words of contexts themselves are compared as they are.

Null text has no words.  Documents shorter than a window lose nothing.  Rows
equal in id and text are copies of each other and lose their windows.  Null
ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, materialize, only

SEED, HOT, SHARD_WORDS = 8, 2000, 1 << 20
#: Bytes of text hashed at once, bytes of the texts of a chunk, and bits of the bitmap (a broadcast of at most 2^20 rows of two longs).
PIECE, CHUNK, BITS = 1 << 21, 1 << 22, 1 << 26
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _ODD) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, worked out in pieces of about ``PIECE`` bytes."""
    found, lo = [], 0
    while lo < len(text):
        gap = _GAP.search(text, lo + PIECE)
        hi = gap.start() if gap else len(text)
        bytes_ = np.frombuffer(text, dtype=np.uint8, count=hi - lo, offset=lo)
        solid = ~_IS_GAP[bytes_]
        first = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
        if len(first):
            end = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + 1
            length = end - first
            begin = np.concatenate([[0], np.cumsum(length)[:-1]])
            place = np.arange(int(length.sum())) - np.repeat(begin, length)
            terms = (bytes_[solid].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place]
            found.append(mixed(np.add.reduceat(terms, begin) + length.astype(np.uint64)))
        lo = hi
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the least value (leftmost of equal ones) of every ``span`` neighbours."""
    at, best, wide = np.arange(len(values)), values, 1
    while wide < span:
        step = min(wide, span - wide)
        less = best[step:] < best[:-step]
        at, best = np.where(less, at[step:], at[:-step]), np.where(less, best[step:], best[:-step])
        wide += step
    return at


def contexts_of(texts: list[bytes | None], width: int) -> dict[str, np.ndarray]:
    """Contexts of a list of texts: ``row, lo, n`` (words), ``off`` (place of the core), ``core, ctx`` (hashes)."""
    each = [word_hashes(t) if t else np.zeros(0, dtype=np.uint64) for t in texts]
    size = np.array([len(h) for h in each], dtype=np.int64)
    h = np.concatenate(each) if each else np.zeros(0, dtype=np.uint64)
    names = ("row", "lo", "n", "off", "core", "ctx")
    if len(h) < width:
        return {k: np.zeros(0, dtype=np.int64) for k in names}
    seed = min(SEED, width)
    row = np.repeat(np.arange(len(size)), size)
    grams = np.zeros(len(h) - seed + 1, dtype=np.uint64)
    for i in range(seed):
        grams = grams * _ODD + h[i : len(grams) + i]
    grams = mixed(grams)
    at = least_places(grams, width - seed + 1)
    valid = row[: len(at)] == row[width - 1 :]
    new = valid & np.concatenate([[True], (at[1:] != at[:-1]) | ~valid[:-1]])
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]]))
    n = last - first + width
    # Running sums of hash * odd^place; dividing by odd^first leaves what the words say.
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.add.accumulate(h * powers(len(h)))])
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    ctx = mixed((sums[last + width] - sums[first]) * powers(len(h), inverse)[first] + n.astype(np.uint64))
    start = (np.cumsum(size) - size)[row[first]]
    return dict(zip(names, (row[first], first - start, n, at[first] - first, grams[at[first]].view(np.int64), ctx.view(np.int64))))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches whose texts have about ``CHUNK`` bytes, or one text that has more."""
    for batch in batches:
        texts = batch[column].cast(pa.binary())
        lo = 0
        while lo < batch.num_rows:
            hi, held = lo, []
            size = 0
            while hi < batch.num_rows and size < CHUNK:
                held.append(texts[hi].as_py())
                size += len(held[-1] or b"")
                hi += 1
            yield batch.slice(lo, hi - lo), held
            lo = hi
    give_back()


class WaveletMatrix:
    """Ranks of symbols in an array of non-negative integers: a packed bit vector with block counts a level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        n = len(symbols)
        for b in reversed(range(bits)):
            bit = (symbols >> b) & 1
            packed = np.zeros(n // 64 + 1, dtype=np.uint64)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = n - int(ones[-1])
            self.levels.append((b, packed, ones, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where the first ``place`` entries end among those of ``symbol``, counted from a start fixed for the symbol."""
        for b, packed, ones, zeros in self.levels:
            block = places >> 6
            mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[block] + np.bitwise_count(packed[block] & mask)
            places = np.where((symbols >> b) & 1 == 1, zeros + rank, places - rank)
        return places


class FMIndex:
    """Backward search over contexts, each with a count; ``symbols``: their words as 1, 2, ..., each context followed by 0."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray, depth: int):
        n, most = len(symbols), int(symbols.max(initial=0))
        rank, known = symbols.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while known < depth:  # suffixes in order of their first ``known`` words
            follow = np.concatenate([rank[known:] + 1, np.zeros(min(known, n), dtype=np.int64)])[:n]
            key = rank * (n + most + 2) + follow
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
            known *= 2
            if n and rank[order[-1]] == n - 1:
                break
        self.n = n
        before = symbols[order - 1]  # the transform
        self.tree = WaveletMatrix(before, max(1, most.bit_length()))
        self.weight = np.concatenate([[0], np.cumsum(counts[order])])
        every = np.arange(most + 1)
        lower = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=most + 1))])[:-1]
        self.base = lower - self.tree.descend(every, np.zeros(most + 1, dtype=np.int64))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the matches with one more word in front."""
        both = self.base[np.concatenate([symbol, symbol])] + self.tree.descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return both[: len(lo)], both[len(lo) :]


def repeated_intervals(index: FMIndex, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of the first and end of the last repeated window of each context; -1 where there is none.

    Each context is matched from its end; then from the end of the first
    window that may still be repeated, which jumps past the word that ended the
    match; then from ever earlier ends until the last repeated window shows.
    """
    k = len(start)
    left, right = np.full(k, -1, dtype=np.int64), np.full(k, -1, dtype=np.int64)
    fallback = np.full(k, -1, dtype=np.int64)
    phase, goal = np.zeros(k, dtype=np.int8), np.zeros(k, dtype=np.int64)
    end = length - 1
    at, lo, hi = end.copy(), np.zeros(k, dtype=np.int64), np.full(k, index.n, dtype=np.int64)
    live = np.arange(k)
    while len(live):
        a, b = index.extend(symbols[start[live] + at[live]], lo[live], hi[live])
        lo[live], hi[live] = a, b
        holds = index.weight[b] - index.weight[a] >= 2
        done = holds & (at[live] == goal[live])
        at[live[holds & ~done]] -= 1
        anew = np.zeros(len(live), dtype=bool)
        over = np.zeros(len(live), dtype=bool)
        now = phase[live]
        for what in (0, 1, 2):
            ok, no = done & (now == what), ~holds & (now == what)
            won, lost = live[ok], live[no]
            if what == 0:
                left[won], right[won] = 0, length[won]
                over |= ok
                tail = length[lost] - 1 - at[lost] >= width
                right[lost[tail]], fallback[lost[tail]] = length[lost[tail]], at[lost[tail]] + 1
                phase[lost], goal[lost], end[lost] = 1, 0, width - 1
                anew |= no
            elif what == 1:
                left[won] = goal[won]
                known = right[won] >= 0
                phase[won[~known]], end[won[~known]] = 2, length[won[~known]] - 2
                goal[lost] = at[lost] + 1
                end[lost] = goal[lost] + width - 1
                known_lost = fallback[lost] >= 0
                out = np.where(known_lost, goal[lost] >= fallback[lost], end[lost] >= length[lost])
                left[lost[out & known_lost]] = fallback[lost[out & known_lost]]
                over[np.flatnonzero(ok)[known]] = True
                over[np.flatnonzero(no)[out]] = True
                anew |= ok | no
            else:
                right[won] = end[won] + 1
                over |= ok
                end[lost] -= 1
                anew |= no
        # The first repeated window itself needs no second match.
        two = (phase[live] == 2) & anew & ~over
        same = two & (end[live] <= left[live] + width - 1)
        right[live[same]] = left[live[same]] + width
        over |= same
        rest = live[anew & ~over]
        goal[rest] = np.where(phase[rest] == 2, end[rest] - width + 1, goal[rest])
        at[rest], lo[rest], hi[rest] = end[rest], 0, index.n
        live = live[~over]
    return left, right


def match_shard(held: list[tuple], width: int) -> Iterator[tuple]:
    """``core, ctx, a, b`` of the contexts (``core, ctx, m, words``) of one shard that lose words."""
    seen: dict[bytes, int] = {}
    codes = [[seen.setdefault(w, len(seen) + 1) for w in words.split(b" ")] for _, _, _, words in held]
    length = np.array([len(c) for c in codes], dtype=np.int64)
    start = np.cumsum(length + 1) - length - 1
    symbols = np.zeros(int(length.sum()) + len(codes), dtype=np.int64)
    counts = np.zeros(len(symbols), dtype=np.int64)
    for s, c, (_, _, m, _) in zip(start.tolist(), codes, held):
        symbols[s : s + len(c)] = c
        counts[s : s + len(c)] = m
    index = FMIndex(symbols, counts, int(length.max()) + 1)
    left, right = repeated_intervals(index, symbols, start, length, width)
    for i in np.flatnonzero(left >= 0).tolist():
        yield held[i][0], held[i][1], int(left[i]), int(right[i])


def matched(contexts: DataFrame, width: int) -> DataFrame:
    """``core, ctx, a, b``: words a to b of a context are covered by repeated windows; ``contexts``: core, ctx, m, n, words."""
    words = contexts.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    tasks = max(int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words // SHARD_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(held: list[tuple]) -> pa.RecordBatch:
            found = list(zip(*match_shard(held, width))) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int32()), pa.array(found[3], pa.int32())], names=["core", "ctx", "a", "b"])

        held, n = [], 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("core", "ctx", "m", "n")] + [batch["words"].cast(pa.binary()).to_pylist()]
            for core, ctx, m, size, text in zip(*columns):
                if n >= SHARD_WORDS and held[-1][0] != core:
                    yield results(held)
                    held, n = [], 0
                held.append((core, ctx, m, text))
                n += size
        if held:
            yield results(held)
        give_back()

    dealt = contexts.select("core", "ctx", "m", "n", "words").repartition(tasks, F.col("core")).sortWithinPartitions("core", "ctx")
    return dealt.mapInArrow(run, "core long, ctx long, a int, b int")


def digest(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "little", signed=True)


def cut_contexts(batches: Iterator[pa.RecordBatch], width: int, step: int) -> Iterator[pa.RecordBatch]:
    """Each context cut by the place of its core within the window, ``step`` places a cut."""
    names = ["core", "ctx", "m", "off", "n", "words", "core1", "ctx1", "shift"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    for batch in batches:
        out = []
        for core, ctx, m, off, text in zip(*[batch[c].to_pylist() for c in ("core", "ctx", "m", "off")], batch["words"].cast(pa.binary()).to_pylist()):
            words = text.split(b" ")
            starts = range(len(words) - width + 1)
            for cell in sorted({(off - s) // step for s in starts}):
                own = [s for s in starts if (off - s) // step == cell]
                lo, hi = own[0], own[-1] + width
                shared = words[max(off - cell * step, 0) : off - cell * step - step + 1 + width]
                some = b" ".join(words[lo:hi])
                out.append((digest(b"%d" % core, b"%d" % cell, *shared), digest(some), m, off - lo, hi - lo, some, core, ctx, lo))
        columns = list(zip(*out)) or [()] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[5] = arrays[5].cast(pa.string())
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def decided(contexts: DataFrame, width: int, steps: list[int], hot: int) -> DataFrame:
    """``core, ctx, a, b`` of all contexts: matched by shard, those of hot cores after cutting them."""
    many = contexts.groupBy("core").agg(F.count(F.lit(1)).alias("g")).where(F.col("g") > hot).select("core")
    if not steps or many.isEmpty():
        return matched(contexts, width)
    many = materialize(many, "repeats-hot")
    kinds = "core long, ctx long, m long, off int, n int, words string, core1 long, ctx1 long, shift int"
    step = steps[0]
    cut = materialize(contexts.join(many, "core", "left_semi").select("core", "ctx", "m", "off", "words").mapInArrow(lambda b: cut_contexts(b, width, step), kinds), "repeats-cut")
    finer = cut.groupBy("core", "ctx").agg(F.sum("m").alias("m"), F.first("off").alias("off"), F.first("n").alias("n"), F.first("words").alias("words"))
    finer = materialize(finer, "repeats-finer")
    finer = materialize(finer.join(finer.groupBy("core").agg(F.sum("m").alias("t")).where("t > 1"), "core").drop("t"), "repeats-finer")
    found = decided(finer, width, steps[1:], hot)
    back = cut.select("core", "ctx", "core1", "ctx1", "shift").join(found, ["core", "ctx"])
    back = back.groupBy(F.col("core1").alias("core"), F.col("ctx1").alias("ctx")).agg(F.min(F.col("a") + F.col("shift")).alias("a"), F.max(F.col("b") + F.col("shift")).alias("b"))
    return matched(contexts.join(many, "core", "left_anti"), width).unionByName(back)


def likely(rows: DataFrame, keys: DataFrame, *columns: str, others: bool = False) -> DataFrame:
    """The ``rows`` that a bitmap of ``BITS`` bits over ``keys`` marks: all that have a partner and some by chance (``others``: the rest)."""
    bit = F.pmod(F.xxhash64(F.lit(9), *columns), F.lit(BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    words = keys.select(F.shiftright(bit, 6).alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    hit = F.coalesce(F.col("_mask").bitwiseAND(mask) != 0, F.lit(False))
    marked = rows.withColumn("_word", F.shiftright(bit, 6)).join(F.broadcast(words), "_word", "left")
    return marked.where(~hit if others else hit).drop("_word", "_mask")


def lost_words(keyed: DataFrame, width: int, hot: int) -> DataFrame:
    """``k, t`` and ``spans``: word ranges covered by repeated windows, of the rows that have any; ``keyed``: k, t, text."""

    def count_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            core, n = np.unique(contexts_of(texts, width)["core"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(n)], names=["core", "n"])

    def list_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            c = contexts_of(texts, width)
            row = pa.array(c["row"])
            yield pa.RecordBatch.from_arrays(
                [batch["k"].take(row), batch["t"].take(row), pa.array(c["core"]), pa.array(c["ctx"])] + [pa.array(c[x].astype(np.int32)) for x in ("lo", "n", "off")], names=["k", "t", "core", "ctx", "lo", "n", "off"]
            )

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            out = []
            for text, wanted in zip(texts, batch["wanted"].to_pylist()):
                words = text.split()
                out += [(w["core"], w["ctx"], w["m"], w["off"], w["n"], b" ".join(words[w["lo"] : w["lo"] + w["n"]])) for w in wanted]
            columns = list(zip(*out)) or [()] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))]
            arrays[5] = arrays[5].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=["core", "ctx", "m", "off", "n", "words"])

    cores = keyed.select("text").mapInArrow(count_cores, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core")
    cores = materialize(cores, "repeats-cores")
    places = keyed.select("k", "t", "text").mapInArrow(list_contexts, "k long, t long, core long, ctx long, lo int, n int, off int")
    places = materialize(likely(places, cores, "core"), "repeats-places")
    distinct = places.groupBy("core", "ctx").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("k", "t", "lo", "n", "off")).alias("r"))
    distinct = materialize(distinct.select("core", "ctx", "m", "r.*"), "repeats-contexts")
    alike = distinct.groupBy("core").agg(F.sum("m").alias("s")).where("s > 1").select("core")
    firsts = materialize(distinct.join(alike, "core").groupBy("k", "t").agg(F.collect_list(F.struct("core", "ctx", "m", "lo", "n", "off")).alias("wanted")), "repeats-firsts")
    texts = likely(keyed, firsts.select("k", "t"), "k", "t").groupBy("k", "t").agg(F.first("text").alias("text"))
    contexts = materialize(texts.join(firsts, ["k", "t"]).select("text", "wanted").mapInArrow(cut_texts, "core long, ctx long, m long, off int, n int, words string"), "repeats-words")
    found = materialize(decided(contexts, width, [7, 1], hot), "repeats-found")
    spans = places.join(found, ["core", "ctx"]).select("k", "t", (F.col("lo") + F.col("a")).alias("lo"), (F.col("lo") + F.col("b")).alias("hi"))
    return materialize(spans.groupBy("k", "t").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans")), "repeats-spans")


def without_repeats(docs: DataFrame, width: int = 35, hot: int = HOT) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space) and ``spans`` (merged word ranges removed)."""
    rows = only(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select("doc_id", "text", F.xxhash64("doc_id").alias("k"), F.xxhash64(F.col("doc_id").isNull(), F.col("text").isNull(), "text").alias("t"))
    lost = lost_words(keyed.select("k", "t", "text"), width, hot)
    touched = likely(keyed, lost.select("k", "t"), "k", "t").join(lost, ["k", "t"], "left").select("doc_id", "text", "spans")
    whole = likely(keyed, lost.select("k", "t"), "k", "t", others=True).select("doc_id", "text", F.lit(None).cast("array<struct<lo:int,hi:int>>").alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            n, gone, kept, merged = [], [], [], []
            for text, spans in zip(texts, batch["spans"].to_pylist()):
                words = (text or b"").split()
                joined: list[dict] = []
                for s in spans or ():
                    if joined and s["lo"] <= joined[-1]["hi"]:
                        joined[-1]["hi"] = max(joined[-1]["hi"], s["hi"])
                    else:
                        joined.append(s)
                n.append(len(words))
                for s in reversed(joined):
                    del words[s["lo"] : s["hi"]]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
                merged.append(joined)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(merged, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                names=["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    return whole.unionByName(touched).mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept string, spans array<struct<lo:int,hi:int>>")
