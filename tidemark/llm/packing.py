"""Best-fit packing of token pieces by hierarchical residual rounds.

Each task tokenises its documents, cuts those longer than a sequence, and
packs its pieces best-fit (longest first).  Sequences that no residual item
could still enter are emitted; the others go on as single items, a group of
``FAN_IN`` tasks' leftovers at a time, to the next best-fit round, until one
group is left.  A round moves one narrow row per underfull sequence; pieces
move only once, when the table is written.

Nulls count as empty texts: such a document is its end id alone.  Repeated
rows are packed as separate pieces.  An empty table packs into nothing.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import END_MARK, WORD_END, BacktrackingBPE
from tidemark.llm.common import hold, materialize, only, row_chunks

FAN_IN = 16
#: Largest table of moved sequences that is broadcast: 100,000 rows of 32 bytes.
BROADCAST_ROWS = 100_000


class RankBPE(BacktrackingBPE):
    """The same vocabulary with pieces merged by tiktoken's compiled loop: a byte no UTF-8 text has marks the word end."""

    def __init__(self, path: str):
        super().__init__(path)
        back = {c: b for b, c in enumerate(self.alphabet)}
        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        raw = {}
        for tok, i in self.vocab.items():
            end = tok.endswith(WORD_END) and len(tok) > len(WORD_END)
            body = tok[: -len(WORD_END)] if end else tok
            raw[bytes(back[c] for c in body) + (b"\xff" if end else b"")] = i
        made = {self.rank_of[t]: t for t in self.rank_of}
        ends = [b"%c\xff" % b for b in range(256) if b"%c\xff" % b in raw]
        for t in ends:
            ranks[t] = len(ids)
            ids.append(raw[t])
        for r in range(len(made)):
            t = made[r]
            b = bytes(back[c] for c in t.rstrip(END_MARK)) + (b"\xff" if t.endswith(END_MARK) else b"")
            if b not in ranks:
                ranks[b] = len(ids)
                ids.append(raw[b])
        for b in range(256):
            if bytes([b]) not in ranks:
                ranks[bytes([b])] = len(ids)
                ids.append(raw.get(bytes([b]), 0))
        self.automaton = self.split = self.joins = self.shorter = self.length = None  # only the backtracking encoder needs them
        self.core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.by_rank = ids

    def encode_piece(self, piece: str) -> list[int]:
        raise NotImplementedError

    def piece_ids(self, piece: str) -> bytes:
        by = self.by_rank
        return array("H", [by[r] for r in self.core.encode_single_piece(piece.encode() + b"\xff")]).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        words = self.words
        if chunk.isalpha():
            out = self.piece_ids(chunk)
        else:
            parts = []
            for piece in self.pieces.findall(chunk):
                known = words.get(piece)
                if known is None:
                    known = words[piece] = self.piece_ids(piece)
                parts.append(known)
            out = b"".join(parts)
        if len(words) >= self.cache_words:
            words.clear()
        words[chunk] = out
        return out


def rank_encoder(path: str) -> RankBPE:
    return hold(("rank-bpe", path), lambda: RankBPE(path))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin."""
    order = np.argsort(-sizes, kind="stable").tolist()
    size = sizes.tolist()
    bins, offsets, fill = [0] * len(size), [0] * len(size), []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has exactly r left
    for i in order:
        s = size[i]
        m = mask >> s
        if m:
            r = (m & -m).bit_length() - 1 + s
            b = stacks[r].pop()
            if not stacks[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += s
        r -= s
        if r:
            stacks[r].append(b)
            mask |= 1 << r
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(fill, np.int64)


def cut_pieces(docs: DataFrame, vocab_path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every whole document, packed within their task: ``seq``, ``offset``, ``fill`` of the sequence, ``task``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = rank_encoder(vocab_path)
        task = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u2").tobytes()
        ids_of, piece_of, start_of, len_of, crc_of = array("q"), array("q"), array("q"), array("q"), array("q")
        null_id: list[int] = []
        for pdf in row_chunks(batches):
            for doc, t in zip(pdf["doc_id"].array, pdf["text"].array):
                ids = np.frombuffer(enc.encode(t if isinstance(t, str) else "").tobytes() + end, dtype="<u2").astype("<u4")
                missing = doc is None or doc is pd.NA or doc != doc
                for p, lo in enumerate(range(0, len(ids), capacity)):
                    part = ids[lo : lo + capacity]
                    if missing:
                        null_id.append(len(ids_of))
                    ids_of.append(0 if missing else int(doc))
                    piece_of.append(p)
                    start_of.append(lo)
                    len_of.append(len(part))
                    crc_of.append(zlib.crc32(part.tobytes()))
        if not ids_of:
            return
        sizes = np.frombuffer(len_of, dtype=np.int64)
        bins, offsets, fill = best_fit(sizes, capacity)
        out = pd.DataFrame({"doc_id": pd.array(np.frombuffer(ids_of, dtype=np.int64), dtype="Int64"), "piece": np.frombuffer(piece_of, dtype=np.int64).astype(np.int32), "start": np.frombuffer(start_of, dtype=np.int64), "length": sizes, "ids_crc32": np.frombuffer(crc_of, dtype=np.int64), "seq": (task << 32) + bins, "offset": offsets, "fill": fill[bins], "task": task})
        if null_id:
            out.loc[null_id, "doc_id"] = pd.NA
        yield out

    return only(docs, "doc_id", "text").mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, seq long, offset long, fill long, task int")


def merge_round(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """Best fit of whole sequences within each group: ``seq`` goes to ``to`` at ``base``; ``fill`` is the new fill."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", ignore_index=True)
        bins, offsets, fill = best_fit(pdf["fill"].to_numpy(), capacity)
        first = np.full(len(fill), -1, dtype=np.int64)
        for i in np.flatnonzero(offsets == 0)[::-1]:
            first[bins[i]] = pdf["seq"].iloc[i]
        return pd.DataFrame({"seq": pdf["seq"], "to": first[bins], "base": offsets, "fill": fill[bins], "task": pdf["task"] // FAN_IN})

    return items.withColumn("g", F.floor(F.col("task") / FAN_IN)).groupBy("g").applyInPandas(run, "seq long, to long, base long, fill long, task int")


def pack(docs: DataFrame, vocab_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = materialize(cut_pieces(docs, vocab_path, capacity, end_id), "pack-pieces")
    heads = pieces.where("offset = 0").select("seq", "fill", "task")
    moved = None  # seq -> current sequence, base, fill
    level = 0
    while True:
        # A sequence is open only while the smallest of the others could enter it.
        least = heads.agg(F.min("fill").alias("m"), F.count(F.lit(1)).alias("n"), F.max("task").alias("t")).first()
        if not least["n"] or least["n"] == 1:
            break
        still = heads.where(F.col("fill") <= capacity - least["m"])
        merged = materialize(merge_round(still, capacity, level), f"pack-round{level}")
        level += 1
        done = least["t"] < FAN_IN
        step = merged.select("seq", "to", "base", F.col("fill").alias("new_fill"), F.col("task").alias("new_task"))
        if moved is None:
            moved = step.select("seq", F.col("to").alias("cur"), "base", F.col("new_fill").alias("fill"))
        else:
            later = step.select(F.col("seq").alias("cur"), "to", F.col("base").alias("more"), "new_fill")
            kept = moved.join(later, "cur", "left").select("seq", F.coalesce("to", "cur").alias("cur"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"), F.coalesce("new_fill", "fill").alias("fill"))
            moved = materialize(kept, f"pack-moved{level}")
        heads = merged.where("base = 0").select(F.col("to").alias("seq"), "fill", "task")
        if done:
            break
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moved is None:
        return pieces.select(*out, F.col("seq").alias("sequence_id"), "offset")
    moved = moved.where("seq <> cur or base <> 0").select("seq", "cur", "base")
    if moved.count() <= BROADCAST_ROWS:
        moved = F.broadcast(moved)
    return pieces.join(moved, "seq", "left").select(*out, F.coalesce("cur", "seq").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
