"""BPE encoding by backtracking over longest matches, decoding by an offset table.

A word's tokens are found left to right.  An Aho-Corasick pass lists the
longest vocabulary token at each position; a token is kept only when the
pair-compatibility table says that byte-pair merging would leave it beside
the token before it, otherwise the next shorter prefix token is tried, and
when none is left the last token is given up.  A bit per position marks ends
that cannot be continued, so every position is left at most once and the work
is linear in the word.  The result equals applying the merges in rank order.

Nulls are encoded as the empty text.  Empty texts have no tokens.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hold, only, row_chunks

WORD_END = "</w>"
#: A character outside the byte alphabet stands for the word end inside the automaton.
END_MARK = "\n"


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 byte values used by byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class BacktrackingBPE:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` library.

    Supports byte-level BPE whose normaliser lower-cases NFC text and whose
    pre-tokeniser keeps no white space (word ends marked by a suffix).
    """

    def __init__(self, path: str, cache_words: int = 700_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if suffix != WORD_END:
            raise ValueError("the vocabulary must mark word ends")
        self.cache_words = cache_words
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        pieces = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pieces)
        self.vocab: dict[str, int] = model["vocab"]
        vocab = self.vocab

        def inner(tok: str) -> str:
            return tok[: -len(WORD_END)] + END_MARK if tok.endswith(WORD_END) and len(tok) > len(WORD_END) else tok

        # Order of merging; base symbols come before every merged token.
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order: dict[str, int] = {}
        merged = {a + b for a, b in ((x, y) for x, y in pairs)}
        for tok in vocab:
            if tok not in merged:
                order[tok] = len(order)
        split: list[tuple[int, int]] = [(i, i) for i in range(len(order))]
        self.joins: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            tok = a + b
            if tok in order or a not in order or b not in order:
                continue
            order[tok] = len(split)
            self.joins[order[a], order[b]] = len(split)
            split.append((order[a], order[b]))
        self.split = split
        n = len(split)
        text = [""] * n
        self.ids = [0] * n
        for tok, r in order.items():
            text[r] = inner(tok)
            self.ids[r] = vocab[tok]
        self.length = [len(t) for t in text]
        rank_of = {t: r for r, t in enumerate(text)}
        self.rank_of = rank_of
        # Longest proper prefix that is itself a token.
        self.shorter = [-1] * n
        for r, t in enumerate(text):
            for k in range(len(t) - 1, 0, -1):
                if (p := rank_of.get(t[:k])) is not None:
                    self.shorter[r] = p
                    break
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(text):
            self.automaton.add_word(t, (len(t) - 1, r))
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.alphabet = byte_alphabet()
        self.latin = {ord(chr(b)): c for b, c in enumerate(self.alphabet)}
        self.words: dict[str, bytes] = {}
        # Offset table: token id -> slice of one buffer.
        size = max([*vocab.values(), *self.special.values()]) + 1
        names = [b""] * size
        for tok, i in [*vocab.items(), *self.special.items()]:
            names[i] = tok.encode()
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(x) for x in names], out=self.offsets[1:])
        self.buffer = b"".join(names)
        at = self.offsets.tolist()
        self.slices = [self.buffer[at[i] : at[i + 1]] for i in range(size)]
        self.decimal = [b"%d" % i for i in range(size)]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side when both texts meet.

        Merges are undone on the side that was made last; a join across the
        border that would have come earlier than what was undone forbids the pair.
        """
        key = (left, right)
        known = self.compatible.get(key)
        if known is not None:
            return known
        joins, split = self.joins, self.split
        a, b, limit = left, right, 1 << 60
        ok = True
        while True:
            j = joins.get((a, b))
            if j is not None and j < limit:
                ok = False
                break
            if a > b:
                nxt = split[a][1]
                if nxt != a:
                    limit, a = a, nxt
                    continue
                nxt = split[b][0]
                if nxt == b:
                    break
                limit, b = b + 1, nxt
            else:
                nxt = split[b][0]
                if nxt != b:
                    limit, b = b + 1, nxt
                    continue
                nxt = split[a][1]
                if nxt == a:
                    break
                limit, a = a, nxt
        if len(self.compatible) > 2_000_000:
            self.compatible.clear()
        self.compatible[key] = ok
        return ok

    def encode_piece(self, piece: str) -> list[int]:
        """Token ranks of one pre-tokenised piece."""
        word = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(self.latin)
        word += END_MARK
        whole = self.rank_of.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        longest = [-1] * n
        for end, (back, r) in self.automaton.iter(word):
            longest[end - back] = r
        length, shorter, fits = self.length, self.shorter, self.fits
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, tok = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            while tok >= 0:
                end = pos + length[tok]
                if not dead[end] and (last < 0 or fits(last, tok)):
                    break
                tok = shorter[tok]
            if tok >= 0:
                out.append(tok)
                pos = end
                if pos == n:
                    return out
                tok = longest[pos]
            elif out:
                dead[pos] = 1
                tok = out.pop()
                pos -= length[tok]
            else:
                raise ValueError(f"no tokens spell {piece!r}")

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids (little-endian unsigned 16-bit) of a lower-cased run without white space."""
        words, ids = self.words, self.ids
        if chunk.isalpha():
            out = array("H", [ids[r] for r in self.encode_piece(chunk)]).tobytes()
        else:
            parts = []
            for piece in self.pieces.findall(chunk):
                known = words.get(piece)
                if known is None:
                    known = array("H", [ids[r] for r in self.encode_piece(piece)]).tobytes()
                    words[piece] = known
                parts.append(known)
            out = b"".join(parts)
        if len(words) >= self.cache_words:
            words.clear()
        words[chunk] = out
        return out

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")  # lower-casing here looks at single characters
        text = text.lower()
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            chunks = regex.split(r"\s+", text)  # these four are no white space to the vocabulary's pattern
        else:
            chunks = text.split()
        get, miss = self.words.get, self.encode_chunk
        return b"".join([get(c) or miss(c) for c in chunks])

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text; null counts as empty."""
        if not text:
            return np.zeros(0, dtype="<u2")
        if self.special_re is not None and "<|" in text and self.special_re.search(text):
            parts, at = [], 0
            for m in self.special_re.finditer(text):
                parts += [self.encode_plain(text[at : m.start()]), np.array([self.special[m[0]]], dtype="<u2").tobytes()]
                at = m.end()
            parts.append(self.encode_plain(text[at:]))
            return np.frombuffer(b"".join(parts), dtype="<u2")
        return np.frombuffer(self.encode_plain(text), dtype="<u2")

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text: the file names no decoder, so token names are joined by spaces."""
        slices = self.slices
        return b" ".join([slices[i] for i in ids])


def encoder(path: str) -> BacktrackingBPE:
    """One encoder a worker process; its word cache lives as long as the operator is served."""
    return hold(("bpe", path), lambda: BacktrackingBPE(path))


def encode_table(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 16-bit) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocab_path)
        for pdf in row_chunks(batches):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [enc.encode(t if isinstance(t, str) else "").tobytes() for t in pdf["text"].array]})

    return only(docs, "doc_id", "text").mapInPandas(run, "doc_id long, ids binary")


def encode_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Encode and decode every whole text; counts and SHA-256 digests of both.

    Map-only: no shuffle, a task holds one batch of texts.  Repeated rows give
    repeated results; columns other than ``doc_id`` and ``text`` are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocab_path)
        decimal, sha = enc.decimal, hashlib.sha256
        for pdf in row_chunks(batches):
            n, a, b = [], [], []
            for t in pdf["text"].array:
                ids = enc.encode(t if isinstance(t, str) else "").tolist()
                n.append(len(ids))
                a.append(sha(b" ".join([decimal[i] for i in ids])).hexdigest())
                b.append(sha(enc.decode(ids)).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    return only(docs, "doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string").select(
        "doc_id", F.col("n_tokens").cast("long"), "ids_sha256", "decoded_sha256"
    )
