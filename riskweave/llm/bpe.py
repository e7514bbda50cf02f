"""Byte-level BPE, encoded by dynamic programming over prefixes.

BPE's result for a prefix ends in exactly one token, and the result for a longer string extends the result for some
prefix of it. So for each prefix, in order: an automaton yields the tokens that end there, longest first; the one that
is compatible with the last token of the prefix before it is the last token of this prefix. Two tokens are compatible
when merging their bytes together leaves them apart. Following the back-pointers from the end gives the ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import small_batches

#: The public split pattern of this family of byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces remembered per Python worker; longer pieces than KEPT_CHARS are encoded anew each time. When there are too
#: many, only those of SHORT_CHARS or fewer stay: they come back most often.
CACHE_PIECES, KEPT_CHARS, SHORT_CHARS = 200_000, 48, 7
#: Pairs of tokens whose compatibility is remembered per Python worker.
CACHE_PAIRS = 150_000
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in for each byte: itself where it is visible, else the next code point from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixEncoder:
    """Encoder and decoder for a ``tokenizers`` file of a byte-level BPE without normaliser and prefix space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["end_of_word_suffix"]:
            raise ValueError("not a plain byte-level BPE file")
        alphabet = byte_alphabet()
        ids = model["vocab"]
        self.bytes = {i: bytes(alphabet[c] for c in token) for token, i in ids.items()}
        self.rank: dict[int, int] = {}  # of a merge, by both ids in one number
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # rank of the merge that makes a token
        for rank, (left, right) in enumerate(model["merges"]):
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank.setdefault(pair[0] << 20 | pair[1], rank)
            if whole not in self.made:
                self.halves[whole], self.made[whole] = pair, rank
        self.edges = {i: (self._edge(i, 1), self._edge(i, 0)) for i in self.bytes}
        self.automaton = ahocorasick.Automaton()
        reachable = [i for i in self.bytes if i not in self.halves or self._whole(i)]
        for i in reachable:
            self.automaton.add_word(self.bytes[i].decode("latin-1"), (len(self.bytes[i]), i))
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(PATTERN)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.fits: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at an edge of ``token`` from outside in, each with the rank of the merge that ends it."""
        found, until = [], NEVER
        while True:
            found.append((token, until))
            if token not in self.halves:
                return found
            until, token = self.made[token], self.halves[token][side]

    def _whole(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        left, right = self.halves[token]
        return not self._crosses(left, right, self.made[token])

    def _crosses(self, left: int, right: int, before: int) -> bool:
        """Whether a merge across the border comes before what the two tokens need themselves.

        A token at the border exists until the merge that takes it in. A merge over the border of rank m happens if
        both its tokens are still there: equal ranks merge from left to right, so the left one must outlast m and the
        right one must not end before it.
        """
        rank, of_right = self.rank, self.edges[right][1]
        for a, a_until in self.edges[left][0]:
            for b, b_until in of_right:
                m = rank.get(a << 20 | b)
                if m is not None and m < a_until and m <= b_until and m < before:
                    return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        return not self._crosses(left, right, NEVER)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        last, back = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        if len(self.fits) > CACHE_PAIRS:
            self.fits.clear()
        fits, done = self.fits, 0
        for end, (length, token) in self.automaton.iter(data):
            if end < done:  # the last token of this prefix is known
                continue
            start = end + 1 - length
            if start:
                pair = last[start] << 20 | token
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.compatible(last[start], token)
                if not fit:
                    continue
            done = end + 1
            last[done], back[done] = token, start
        out, at = [], len(data)
        while at:
            out.append(last[at])
            at = back[at]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache, extend = self.cache, out.extend
        parts = self.split_special.split(text) if self.split_special else [text]
        for n, part in enumerate(parts):
            if n % 2:
                out.append(self.special[part])
                continue
            for piece in self.pieces.findall(part):
                ids = cache.get(piece)
                if ids is None:
                    ids = self.encode_piece(piece)
                    if len(piece) <= KEPT_CHARS:
                        if len(cache) >= CACHE_PIECES:
                            forget_long(cache, SHORT_CHARS, CACHE_PIECES // 2)
                        cache[piece] = ids
                extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def forget_long(cache: dict[str, object], short: int, most: int) -> None:
    """Drop the keys longer than ``short``, or all if more than ``most`` would stay."""
    kept = {k: v for k, v in cache.items() if len(k) <= short}
    cache.clear()
    if len(kept) <= most:
        cache.update(kept)


@lru_cache(2)
def encoder(path: str) -> PrefixEncoder:
    """One per Python worker."""
    return PrefixEncoder(path)


def bpe_round_trip(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256, with ``keep_ids`` also ids and decoded.

    Null and empty texts have no tokens; the digests are those of no bytes. Special tokens that stand in a text become
    their id, as in the library. Texts of any length are encoded whole. Rows are independent: repeated rows and null
    ids come out as they are, other columns are ignored. ``vocabulary`` is a path that every executor can open.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(vocabulary)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                ids = own.encode(text or "")
                decoded = own.decode(ids)
                row = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                rows.append(row + ((ids, decoded) if keep_ids else ()))
            names = [c.split()[0] for c in schema.split(", ")[1:]]
            yield pd.DataFrame({"doc_id": frame["doc_id"]} | {c: [r[i] for r in rows] for i, c in enumerate(names)})

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, schema)
