"""Token-id files: a context-mixing range coder over independent blocks.

File layout (little-endian): ``TMCM``, version, block length, token and
document counts, four section lengths and the header's crc32; a section of
the ids that occur (class and share within the class); a section of the
contexts' predictions; a document index (ids and token counts); a section of
block records (payload words, payload crc32, ids crc32); then the payloads.

A block starts from the file's fresh state, so any block can be decoded
(``read_block``) or replaced alone.  Coding of one id:

* order-2 (hashed) and order-1 contexts each predict one id: the commonest
  successor in the file, stated there with its confidence.  The tables are of
  one size for all blocks and stay in a core's cache.  The two confidences and
  the order-0 weight of the predicted id are mixed in the logistic domain by
  weights and a bias that learn online in every block;
* an id that neither predicts is coded by order 0: an adaptive distribution
  over ``CLASSES`` classes times the share within the class.  Classes are
  bands of frequency inside ``TOPICS`` topics (ids that occur together, found
  by the encoder and stated in the file), so order 0 follows the language or
  subject within a few ids;
* the resulting interval narrows a range coder that puts out 16-bit words and
  adds carries to words already out.

The model is in integers; the only floats are quotients of integers small
enough for the floor to be exact in IEEE arithmetic.  The blocks of a file are
coded in lockstep, one numpy lane per block.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, materialize, only, row_chunks
from tidemark.llm.ordering import partition_starts, partitions, start_column

MAGIC, VERSION = b"TMCM", 2
HEAD = struct.Struct("<4sHIQQIIIII")
CLASSES, TOPICS = 16, 4
A_BITS, B_BITS = 15, 16
WORD_BITS = 16
FIRST, LEAST = 1 << 52, 1 << 36  # range of a new block, least range between ids; the code's other 12 bits make carries rare
BLOCK, MOST_TOKENS = 1024, 12_000_000
#: A context is stated when its commonest successor follows so often; a fixed value (a statement takes some 4 bytes).
LEAST_SEEN = 8
#: Topics are looked for in windows of so many ids, by so many of the most frequent ids, on at most so many windows.
TOPIC_WINDOW, TOPIC_IDS, TOPIC_WINDOWS = 256, 512, 4096


def logistic_tables() -> tuple[np.ndarray, np.ndarray]:
    """``squash`` (4096 entries for -2048..2047, 12-bit probabilities) and its inverse ``stretch``, in integers."""
    one = 1 << 30
    half_step, value = [], one
    for _ in range(2049):  # e ** (-k / 256) by repeated multiplication with a fixed 30-bit constant
        half_step.append(value)
        value = value * 1_069_555_790 >> 30
    squash = np.array([(4096 * one // (one + half_step[x])) if x >= 0 else 4096 - 4096 * one // (one + half_step[-x]) for x in range(-2048, 2048)], dtype=np.int32)
    squash = np.clip(squash, 1, 4095)
    stretch = np.clip(np.searchsorted(squash, np.arange(4096)), 0, 4095).astype(np.int32) - 2048
    return squash, stretch


SQUASH, STRETCH = logistic_tables()
#: Confidences are kept in 256 steps of the logistic domain; chance (12 bits) of each.
CHANCE = SQUASH[::16].copy()
#: Shifts by which the weights of order 2, 1 and 0 and the bias learn from an error (fixed values).
RATES = (10, 10, 12, 3)


class Lanes:
    """Model and coder state of all blocks of a file."""

    def __init__(self, n: int, class_of: np.ndarray, start_b: np.ndarray, share_b: np.ndarray, order1: np.ndarray | None = None, order2: np.ndarray | None = None):
        self.n = n
        self.class_of, self.start_b, self.share_b = class_of, start_b, share_b
        none = np.zeros(1 << 16, dtype=np.int32)
        self.order1, self.order2 = none if order1 is None else order1, none if order2 is None else order2
        self.base = np.arange(n)
        self.weight2 = np.full(n, 1 << 15, dtype=np.int32)
        self.weight1 = np.full(n, 1 << 13, dtype=np.int32)
        self.weight0 = np.zeros(n, dtype=np.int32)
        self.bias = np.zeros(n, dtype=np.int32)
        self.cum = np.repeat(np.arange(CLASSES + 1, dtype=np.int8)[:, None], n, axis=1)  # halved every 32 steps: below 80
        self.cum_flat = self.cum.reshape(-1)
        self.ends = np.arange(CLASSES, dtype=np.int8)[:, None]
        self.at1 = np.zeros(n, dtype=np.int64)
        self.at2 = np.zeros(n, dtype=np.int64)
        self.before = np.zeros(n, dtype=np.int64)  # hash of the id before the last
        self.range = np.full(n, FIRST, dtype=np.int64)
        self.steps = 0

    def predict(self) -> None:
        """Shares (of ``1 << A_BITS``) of the two predicted ids, and the rest."""
        e1, e2 = self.order1.take(self.at1), self.order2.take(self.at2)
        self.p1, self.p2 = e1 >> 13, e2 >> 13
        agree = self.p1 == self.p2
        c1 = (e1 >> 5) & 255
        self.s1 = ((c1 << 4) - 2048) * agree
        self.s2 = ((e2 >> 1) & 4080) - 2048
        self.s0 = (e2 & 31) * np.int32(-177)  # 256 ln 2 for each halving of the id's share
        x = self.weight2 * self.s2
        x += self.weight1 * self.s1
        x += self.weight0 * self.s0
        x >>= 15
        x += self.bias >> 6
        x += 2048
        self.m2 = SQUASH.take(x, mode="clip")
        a2 = np.minimum(self.m2, 3300)
        a1 = np.minimum(CHANCE.take(c1) * (4096 - a2) >> 12, 3500 - a2)
        a1 *= ~agree
        self.f2, self.f1 = a2 << 3, a1 << 3
        self.hits = self.f2 + self.f1
        self.rest = ((1 << A_BITS) - self.hits).astype(np.float32)
        self.total = self.cum[CLASSES].astype(np.float32)

    def bounds(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the classes' shares.  ``count * rest`` is below 2 ** 22 and ``total`` below 80, so floats give the floor exactly."""
        at = cls * self.n
        at += self.base
        lo = self.cum_flat.take(at).astype(np.float32)
        at += self.n
        hi = self.cum_flat.take(at).astype(np.float32)
        for x in (lo, hi):
            x *= self.rest
            x /= self.total
        lo = lo.astype(np.int32)
        return lo + self.hits, hi.astype(np.int32) - lo

    def intervals(self, ids: np.ndarray, s: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids' intervals (of ``1 << (A_BITS + B_BITS)``); sets which context hit."""
        start = self.start_b.take(ids)
        start *= f
        start += s << B_BITS
        size = self.share_b.take(ids)
        size *= f
        self.hit1, self.hit2 = ids == self.p1, ids == self.p2
        first = self.hit1 & (self.f1 > 0)
        high2 = self.f2 << B_BITS
        np.copyto(start, high2, where=first)
        np.copyto(size, self.f1 << B_BITS, where=first)
        np.copyto(start, 0, where=self.hit2)
        np.copyto(size, high2, where=self.hit2)
        return start, size

    def locate(self, t: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids whose intervals hold ``t``, their classes and the classes' shares."""
        a = (t >> B_BITS).astype(np.int32)
        inside = a - self.hits
        hit = inside < 0
        # The class begins at the last count c with c * rest // total <= inside: c <= ((inside + 1) * total - 1) // rest.
        most = np.maximum(inside, 0).astype(np.float32)
        most += 1
        most *= self.total
        most -= 1
        most /= self.rest
        cls = np.add.reduce((self.cum[1:CLASSES] <= most.astype(np.int8)).view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        s, f = self.bounds(cls)
        b = ((t - (s.astype(np.int64) << B_BITS)) / np.maximum(f, 1)).astype(np.int64)
        b += cls << B_BITS
        ids = named.take(b, mode="clip").astype(np.int64)
        np.copyto(ids, np.where(a < self.f2, self.p2, self.p1), where=hit)
        return ids, self.class_of.take(ids), s, f

    def learn(self, ids: np.ndarray, cls: np.ndarray) -> None:
        err = self.hit2.astype(np.int32) << 12
        err -= self.m2
        self.weight2 += (self.s2 * err) >> RATES[0]
        self.weight1 += (self.s1 * err) >> RATES[1]
        self.weight0 += (self.s0 * err) >> RATES[2]
        self.bias += err >> RATES[3]
        self.cum[1:] += (self.ends >= cls.astype(np.int8)).view(np.int8)
        self.steps += 1
        if self.steps & 31 == 0:
            counts = (np.diff(self.cum, axis=0) + 1) >> 1
            np.cumsum(counts, axis=0, dtype=np.int8, out=self.cum[1:])
        self.at1 = ids
        self.at2 = ids ^ self.before
        self.before = pair_hash(ids)


def pair_hash(ids: np.ndarray) -> np.ndarray:
    """Of the id before the last, in 16 bits; the order-2 context is this ``^`` the last id."""
    return (ids * 40503) & 0xFFFF


def successors(context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (16 bits) whose commonest successor is seen often enough, that successor, and its confidence."""
    key = context.astype(np.uint32)
    key <<= np.uint32(16)
    key |= ids
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    count, key = np.diff(at, append=len(key)), key[at].astype(np.int64)
    of = key >> 16
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else at
    if not len(first):
        return first.astype(np.uint16), first.astype(np.uint16), first.astype(np.uint8)
    best = np.maximum.reduceat(count << 16 | (key & 0xFFFF), first)
    seen, total = best >> 16, np.add.reduceat(count, first)
    keep = seen >= LEAST_SEEN
    seen, total = seen[keep], total[keep]
    confidence = STRETCH.take(4096 * seen // (total + 1)) + 2048 >> 4
    return of[first][keep].astype(np.uint16), (best[keep] & 0xFFFF).astype(np.uint16), confidence.astype(np.uint8)


def predictions(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """``successors`` of the order-1 and the order-2 contexts of a file."""
    hashed = pair_hash(ids[:-2].astype(np.uint32)).astype(np.uint16) ^ ids[1:-1]
    return *successors(ids[:-1], ids[1:]), *successors(hashed, ids[2:])


def entries(context: np.ndarray, ids: np.ndarray, confidence: np.ndarray, share_b: np.ndarray) -> np.ndarray:
    """Predicted id (16 bits), confidence (8) and halvings of its share (5) by context."""
    halvings = B_BITS + 1 - np.frexp(share_b.astype(np.float64))[1]
    out = np.zeros(1 << 16, dtype=np.int32)
    out[context] = ids.astype(np.int32) << 13 | confidence.astype(np.int32) << 5 | halvings.take(ids, mode="clip").astype(np.int32)
    return out


def pack_predictions(parts: tuple[np.ndarray, ...]) -> bytes:
    """Contexts are stored as differences, which compress well."""
    body = [np.diff(p, prepend=p.dtype.type(0)) if k % 3 == 0 else p for k, p in enumerate(parts)]
    return zlib.compress(struct.pack("<II", len(parts[0]), len(parts[3])) + b"".join(np.ascontiguousarray(p, dtype=p.dtype.newbyteorder("<")).tobytes() for p in body), 1)


def unpack_predictions(data: bytes) -> tuple[np.ndarray, ...]:
    data, at, out = zlib.decompress(data), 8, []
    for n in struct.unpack_from("<II", data):
        for kind in ("<u2", "<u2", "<u1"):
            out.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
            at += out[-1].nbytes
        out[-3] = np.cumsum(out[-3], dtype=np.uint16)
    return tuple(out)


def carry(words: np.ndarray, at: np.ndarray) -> None:
    """Add one to the (different) words at these places, on to the words before where one overflows."""
    while len(at):
        words[at] += np.uint16(1)
        at = at[words[at] == 0] - 1


def topics(ids: np.ndarray, place: np.ndarray, n_names: int) -> np.ndarray:
    """Topic of each id (by its place in falling order of count): spherical k-means over windows, then the topic an id is commonest in."""
    if not n_names:
        return np.zeros(0, dtype=np.int64)
    n = -(-len(ids) // TOPIC_WINDOW)
    jump = -(-n // TOPIC_WINDOWS)
    whole = len(ids) // TOPIC_WINDOW
    if whole:
        some = ids[: whole * TOPIC_WINDOW].reshape(whole, TOPIC_WINDOW)[::jump]
    else:
        some = ids[None, :]
    r = place[some]
    window = np.repeat(np.arange(len(some)), some.shape[1])
    r = r.reshape(-1)
    width = min(TOPIC_IDS, n_names)
    use = r < width
    x = np.bincount(window[use] * width + r[use], minlength=len(some) * width).reshape(-1, width)
    x = np.sqrt(x)
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    near, centres = x @ x.mean(axis=0), []
    for _ in range(TOPICS):  # the window least like those chosen so far
        pick = x[int(near.argmin())]
        near = x @ pick if not centres else np.maximum(near, x @ pick)
        centres.append(pick)
    c = np.stack(centres)
    for _ in range(8):
        label = (x @ c.T).argmax(axis=1)
        for k in np.unique(label):
            mean = x[label == k].mean(axis=0)
            c[k] = mean / (np.linalg.norm(mean) + 1e-9)
    label = (x @ c.T).argmax(axis=1)
    of = label[window]
    seen = np.bincount(r * TOPICS + of, minlength=n_names * TOPICS).reshape(-1, TOPICS)
    return (seen / (np.bincount(of, minlength=TOPICS) + 1.0)).argmax(axis=1)


def share_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids that occur by topic and falling count, their class, and their share (of ``1 << B_BITS``) within it."""
    count = np.bincount(ids)
    names = np.flatnonzero(count)
    names = names[np.argsort(-count[names], kind="stable")]
    place = np.zeros(len(count), dtype=np.int64)
    place[names] = np.arange(len(names))
    topic = topics(ids, place, len(names))
    order = np.argsort(topic, kind="stable")
    names, topic = names[order], topic[order]
    n = count[names]
    bands = CLASSES // TOPICS
    cls = np.zeros(len(n), dtype=np.int64)
    for k in np.unique(topic):
        i = np.flatnonzero(topic == k)
        before = np.cumsum(n[i]) - n[i]
        cls[i] = k * bands + np.minimum(before * bands // max(1, int(n[i].sum())), bands - 1)
    return names, cls, shares(cls, n)


def shares(cls: np.ndarray, n: np.ndarray) -> np.ndarray:
    size, mass = np.bincount(cls, minlength=CLASSES), np.bincount(cls, weights=n, minlength=CLASSES).astype(np.int64)
    f = 1 + n * ((1 << B_BITS) - size[cls]) // mass[cls]
    got = np.bincount(cls, weights=f, minlength=CLASSES).astype(np.int64)
    first = np.unique(cls, return_index=True)[1]
    f[first] += (1 << B_BITS) - got[cls[first]]
    return f


def lookup(names: np.ndarray, cls: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, ...]:
    """Class, start and share by id."""
    first = np.searchsorted(cls, cls)  # classes are contiguous and ascending
    before = np.cumsum(f) - f
    start = before - before[first]
    top = int(names.max()) + 1 if len(names) else 1
    class_of, start_b, share_b = (np.zeros(top, dtype=np.int32) for _ in range(3))  # small, to stay in a core's cache
    class_of[names], start_b[names], share_b[names] = cls, start, f
    return class_of, start_b, share_b


def by_share(names: np.ndarray, cls: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Id at each place of each class's share."""
    out = np.zeros(CLASSES << B_BITS, dtype=np.uint16)
    for k in np.unique(cls):
        out[k << B_BITS : (k + 1) << B_BITS] = np.repeat(names[cls == k], f[cls == k])
    return out


def packed(a: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(a, dtype="<i8").tobytes(), 1)


def write_file(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file of whole documents' ids."""
    n = len(ids)
    block = int(min(BLOCK, max(n, 1)))
    count = -(-n // block)
    names, cls, f = share_table(ids.astype(np.int64))
    class_of, start_b, share_b = lookup(names, cls, f)
    payload, records = [], []
    predicted = predictions(ids)
    if n:
        grid = np.full(count * block, names[0], dtype=np.uint16)
        grid[:n] = ids
        grid = grid.reshape(count, block).T.copy()
        lanes = Lanes(count, class_of, start_b, share_b, *(entries(*predicted[k : k + 3], share_b) for k in (0, 3)))
        width = 2 * block + 4  # an id puts out two words at most
        words = np.zeros(count * width, dtype=np.uint16)
        first = lanes.base * width
        at = first.copy()
        low = np.zeros(count, dtype=np.uint64)
        for t in range(block):
            x = grid[t].astype(np.int64)
            k = class_of.take(x)
            lanes.predict()
            start, size = lanes.intervals(x, *lanes.bounds(k.astype(np.int64)))
            r = lanes.range >> (A_BITS + B_BITS)
            step = (r * start).view(np.uint64)
            lanes.range = r * size
            low += step
            over = low < step
            if over.any():
                carry(words, at[over] - 1)
            lanes.learn(x, k)
            i = np.flatnonzero(lanes.range < LEAST)
            while len(i):
                value, place = low[i], at[i]
                words[place] = value >> np.uint64(48)
                at[i] = place + 1
                low[i] = value << np.uint64(WORD_BITS)
                lanes.range[i] = wider = lanes.range[i] << WORD_BITS
                i = i[wider < LEAST]
        # Two words name a number inside the last interval, whose range is above 2 ** 32; zeros follow.
        last = low + np.uint64((1 << 32) - 1)
        carry(words, at[last < low] - 1)
        for shift in (48, 32):
            words[at] = (last >> np.uint64(shift)).astype(np.uint16)
            at += 1
        whole, used = ids.astype("<u2"), at - first
        words = words.astype("<u2", copy=False).reshape(count, width)
        for k in range(count):
            body = words[k, : used[k]].tobytes()
            payload.append(body)
            records.append((used[k], zlib.crc32(body), zlib.crc32(whole[k * block : (k + 1) * block].tobytes())))
    table = packed(np.stack([names, cls, f])) if n else b""
    context = pack_predictions(predicted)
    index = packed(np.concatenate([doc_ids, lengths]))
    record = np.array(records, dtype="<u4").tobytes()
    sections = table + context + index + record
    head = HEAD.pack(MAGIC, VERSION, block, n, len(doc_ids), len(table), len(context), len(index), len(record), 0)
    head = head[:-4] + struct.pack("<I", zlib.crc32(head[:-4] + sections))
    return head + sections + b"".join(payload)


class TokenFile:
    """A file's checked header and sections; its blocks are decoded on demand, each alone or many in lockstep."""

    def __init__(self, data: bytes):
        self.data = data
        magic, version, self.block, self.n, n_docs, n_table, n_context, n_index, n_record, crc = HEAD.unpack_from(data)
        at = HEAD.size
        sections = data[at : at + n_table + n_context + n_index + n_record]
        if magic != MAGIC or version != VERSION or zlib.crc32(data[: at - 4] + sections) != crc:
            raise ValueError("damaged header")
        n_tables = n_table + n_context
        index = np.frombuffer(zlib.decompress(sections[n_tables : n_tables + n_index]), dtype="<i8")
        self.doc_ids, self.lengths = index[:n_docs], index[n_docs:]
        self.records = np.frombuffer(sections[n_tables + n_index :], dtype="<u4").reshape(n_record // 12, 3)
        if self.n:
            names, cls, f = np.frombuffer(zlib.decompress(sections[:n_table]), dtype="<i8").reshape(3, -1)
            self.tables, self.named = lookup(names, cls, f), by_share(names, cls, f)
            predicted = unpack_predictions(sections[n_table:n_tables])
            self.tables += tuple(entries(*predicted[k : k + 3], self.tables[2]) for k in (0, 3))
        self.sizes = self.records[:, 0].astype(np.int64)
        self.ends = at + len(sections) + 2 * np.cumsum(self.sizes)

    def decode(self, which: np.ndarray) -> np.ndarray:
        """Ids of the given blocks one after another; raises ``ValueError`` on any damage in them."""
        count, block, sizes = len(which), self.block, self.sizes[which]
        width = int(sizes.max()) + 8
        words = np.zeros((count, width), dtype=np.uint16)
        for i, k in enumerate(which.tolist()):
            body = self.data[self.ends[k] - 2 * self.sizes[k] : self.ends[k]]
            if zlib.crc32(body) != self.records[k, 1]:
                raise ValueError(f"damaged block {k}")
            words[i, : sizes[i]] = np.frombuffer(body, dtype="<u2")
        lanes = Lanes(count, *self.tables)
        code = np.zeros(count, dtype=np.int64)  # the stream's next words less the interval's start
        for k in range(4):
            code = code << WORD_BITS | words[:, k]
        at, words = lanes.base * width + 4, words.reshape(-1)
        out = np.empty((block, count), dtype="<u2")
        for t in range(block):
            lanes.predict()
            r = lanes.range >> (A_BITS + B_BITS)
            value = (code / r).astype(np.int64)  # below 2 ** 52 and 2 ** 21: the floor is exact
            x, k, s, f = lanes.locate(np.minimum(value, (1 << (A_BITS + B_BITS)) - 1), self.named)
            start, size = lanes.intervals(x, s, f)
            code -= r * start
            lanes.range = r * size
            lanes.learn(x, k)
            out[t] = x
            i = np.flatnonzero(lanes.range < LEAST)
            while len(i):
                place = at[i]
                code[i] = code[i] << WORD_BITS | words.take(place, mode="clip")
                at[i] = place + 1
                lanes.range[i] = wider = lanes.range[i] << WORD_BITS
                i = i[wider < LEAST]
        parts = [out[: min(block, self.n - k * block), i] for i, k in enumerate(which.tolist())]
        for k, ids in zip(which.tolist(), parts):
            if zlib.crc32(np.ascontiguousarray(ids).tobytes()) != self.records[k, 2]:
                raise ValueError(f"block {k} decodes to other ids")
        return np.concatenate(parts)


def read_block(data: bytes, k: int) -> np.ndarray:
    """Ids of one block, decoded alone."""
    return TokenFile(data).decode(np.array([k]))


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids; raises ``ValueError`` on any damage."""
    f = TokenFile(data)
    return f.doc_ids, f.lengths, f.decode(np.arange(len(f.records))) if f.n else np.zeros(0, dtype="<u2")


class ByteBPE:
    """Byte-level BPE of a vocabulary in the ``tokenizers`` library's format, merged by tiktoken's compiled loop.

    Many texts are cut at spaces by Arrow; each distinct run between spaces is
    merged once and its ids are kept in flat arrays, as the pattern never looks
    across a single space between two other characters.
    """

    #: The pattern by which the library's byte-level pre-tokeniser cuts texts (a fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, most: int = 1_200_000, most_bytes: int = 64_000_000):
        import json

        from tidemark.llm.bpe import byte_alphabet

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {tok: i for tok, i in spec["model"]["vocab"].items() if tok not in self.special}
        ranks = {bytes(back[c] for c in tok): i for tok, i in raw.items()}
        self.core = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.spaced = np.zeros(1 << 16, dtype=bool)  # ids whose bytes begin with a space
        self.spaced[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.most, self.most_bytes = most, most_bytes
        self.forget()

    def forget(self) -> None:
        #: Runs known, and the start of each one's ids; the ids of run k end where those of k + 1 begin.
        self.known, self.starts, self.ids = pa.array([], pa.string()), np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u2")

    def plain(self, text: str) -> bytes:
        return array("H", self.core.encode_ordinary(text)).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 16-bit ids of a whole text."""
        if not text:
            return b""
        if self.special_re is not None and "<|" in text and self.special_re.search(text):
            parts, at = [], 0
            for m in self.special_re.finditer(text):
                parts += [self.plain(text[at : m.start()]) if m.start() > at else b"", array("H", [self.special[m[0]]]).tobytes()]
                at = m.end()
            return b"".join([*parts, self.plain(text[at:]) if at < len(text) else b""])
        return self.plain(text)

    def learn(self, runs: list[str]) -> None:
        """Merge runs that neither begin nor end with white space, each behind a space: so each one's ids begin at an id of a space."""
        ids = self.core.encode_to_numpy(" " + " ".join(runs)).astype("<u2") if runs else self.ids[:0]
        first = np.flatnonzero(self.spaced[ids])
        if len(first) != len(runs):
            raise ValueError("runs between spaces were cut elsewhere")
        self.starts = np.concatenate([self.starts[:-1], first + len(self.ids), [len(self.ids) + len(ids)]])
        self.known, self.ids = pa.concat_arrays([self.known, pa.array(runs, pa.string())]), np.concatenate([self.ids, ids])

    def encode_many(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, ``end`` behind it included, and all ids one after another."""
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        runs = cut.flatten().dictionary_encode()
        found = pc.index_in(runs.dictionary, value_set=self.known)
        fresh = pc.is_null(found)
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(fresh.to_numpy(zero_copy_only=False))
        new = runs.dictionary.filter(fresh).to_pylist()
        good = [bool(w) and not (w[0].isspace() or w[-1].isspace()) for w in new]
        place[at[good]] = len(self.known) + np.arange(sum(good))
        self.learn([w for w, g in zip(new, good) if g])
        word = place[runs.indices.to_numpy()]
        # The first run has no space before it; texts with special words or where the pattern looks across spaces are encoded whole.
        heads, last = bounds[:-1], bounds[1:]
        bad = word < 0
        bad[heads] = False
        whole = np.zeros(len(texts), dtype=bool)
        whole[np.searchsorted(bounds, np.flatnonzero(bad), side="right") - 1] = True
        singles = []
        for k, (text, n) in enumerate(zip(texts, (last - heads).tolist())):
            head = text.split(" ", 1)[0]
            if n > 1 and head and head[-1].isspace() or self.special_re is not None and "<|" in text and self.special_re.search(text):
                whole[k] = True
            singles.append(self.encode(text) if whole[k] else self.plain(head))
        single = np.array([len(x) // 2 for x in singles], dtype=np.int64)
        # Ids are taken from the known runs', the heads' or whole texts', and the end id.
        source = np.concatenate([self.ids, np.frombuffer(b"".join(singles), dtype="<u2"), np.array([end], dtype="<u2")])
        begin, size = self.starts[word], np.diff(self.starts, append=0)[word]
        for k in np.flatnonzero(whole).tolist():
            size[heads[k] : last[k]] = 0
        begin[heads], size[heads] = len(self.ids) + np.cumsum(single) - single, single
        begin, size = np.insert(begin, last, len(source) - 1), np.insert(size, last, 1)
        ends = np.cumsum(size)
        out = source[np.repeat((begin - ends + size).astype(np.int32), size) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        lengths = np.diff(ends[last + np.arange(len(texts))], prepend=0)
        if len(self.known) > self.most or self.known.nbytes + self.ids.nbytes > self.most_bytes:
            self.forget()
        return lengths, out


def byte_encoder(path: str) -> ByteBPE:
    return hold(("byte-bpe", path), lambda: ByteBPE(path))


def text_groups(batches: Iterator[pd.DataFrame], most_chars: int = 8_000_000) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Ids and texts of some ``most_chars`` characters at a time, so that a run between spaces is looked up once in many texts."""
    docs, texts, held = [], [], 0
    for pdf in batches:
        docs.append(pdf["doc_id"].to_numpy(dtype=np.int64))
        texts += pdf["text"].tolist()
        held += int(pdf["text"].str.len().sum())
        if held >= most_chars:
            yield np.concatenate(docs), texts
            docs, texts, held = [], [], 0
    if texts:
        yield np.concatenate(docs), texts


def write_table(docs: DataFrame, vocab_path: str, end_id: int, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """Files of all documents in ascending id order: ``_pid, seq, start`` (ids before it in the partition), ``n_tokens, data``.

    One shuffle, by ranges of the id, into half as many partitions as usual: a
    step costs the more a lane the fewer lanes a file has.  A task holds one
    file's ids.  Null texts
    count as empty; a null id sorts first and is written as the least integer.
    Repeated ids stay separate documents, ordered by their texts.
    """
    rows = only(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Texts are compared by the sort, not by the range cuts: equal ids stay together.
    rows = rows.repartitionByRange(max(1, partitions(docs) // 2), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, pid = byte_encoder(vocab_path), TaskContext.get().partitionId()
        doc_ids, sizes, parts, held, seq, start = [], [], [], 0, 0, 0

        def flush() -> pd.DataFrame:
            ids = np.concatenate(parts)
            data = write_file(np.concatenate(doc_ids), np.concatenate(sizes), ids)
            return pd.DataFrame({"_pid": [pid], "seq": [seq], "start": [start], "n_tokens": [len(ids)], "data": [data]})

        for docs, texts in text_groups(row_chunks(batches)):
            lengths, ids = enc.encode_many(texts, end_id)
            ends = np.cumsum(lengths)
            lo = at = 0
            while lo < len(docs):
                hi = min(int(np.searchsorted(ends, at + most_tokens - held)) + 1, len(docs))  # the first document to reach the limit ends the file
                doc_ids.append(docs[lo:hi])
                sizes.append(lengths[lo:hi])
                parts.append(ids[at : ends[hi - 1]])
                held += int(ends[hi - 1]) - at
                lo, at = hi, int(ends[hi - 1])
                if held >= most_tokens:
                    yield flush()
                    seq, start = seq + 1, start + held
                    doc_ids, sizes, parts, held = [], [], [], 0
        if doc_ids:
            yield flush()

    return materialize(rows.mapInPandas(run, "_pid int, seq int, start long, n_tokens long, data binary"), "token-files")


def read_table(files: DataFrame) -> DataFrame:
    """Documents as the files hold them: ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``."""
    starts = partition_starts(only(files, "_pid", "n_tokens"), F.col("n_tokens"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for pid, start, data in zip(pdf["_pid"], pdf["start"], pdf["data"].array):
                doc_ids, lengths, ids = read_file(bytes(data))
                wide = ids.astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(wide[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pd.DataFrame({"_pid": pid, "doc_id": doc_ids, "start": start + ends - lengths, "n_tokens": lengths, "ids_crc32": crc})

    rows = only(files, "_pid", "start", "data").mapInPandas(run, "_pid int, doc_id long, start long, n_tokens long, ids_crc32 long")
    doc = F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id"))
    return rows.select(doc.alias("doc_id"), (F.col("start") + start_column(starts)).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, vocab_path: str, end_id: int = 2) -> DataFrame:
    return read_table(write_table(docs, vocab_path, end_id))
