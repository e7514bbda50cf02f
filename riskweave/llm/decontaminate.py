"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are sequences of words; scripts without spaces give a word per character. A document holds an item when some stretch of it is within ``max_edit_share`` of the
item's length in word edits. Items of about the same length form a class; at every word of a document starts one
window per class.

1. A lossless count: ``k`` edits leave all but ``2k`` of an item's word pairs intact, so windows with fewer known pairs
   can't match and are left out.
2. The CGK random walk reads a window, moving on or staying by a random function of step and word; small edit distances
   become small Hamming distances between walks. Each table samples a few steps of a walk as a key; windows and items
   that share a key are candidates. Tables are added until randomly edited items are found again at the target rate.
3. Every candidate is verified by the edit distance between the item and the best stretch around the window.

Items of fewer than five words allow no edit; they are looked up exactly, at every word of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import small_batches, store

#: Steps sampled per key, keys taken from each walk.
KEY_STEPS, KEYS_PER_WALK = 2, 8
#: Lengths of the items of a class differ by this factor at most.
CLASS_FACTOR = 1.12
#: Items with fewer words are in no class but looked up exactly.
MIN_WORDS = 5
#: Words looked at together.
CHUNK_WORDS = 500_000
#: Items in one set of tables, which is broadcast; a larger benchmark is searched block by block, one after the other.
BLOCK_ITEMS = 20_000
_ASCII_BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


#: White space and punctuation beyond ASCII, the zero-width space, and characters of scripts without spaces.
_BREAKS = regex.compile(r"[\p{P}\p{Z}\x85\u200b]")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\u30fc]\p{M}*")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between white space and punctuation; each character of a script without spaces is a word."""
    text = (text or "").lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", _BREAKS.sub(" ", text))
    return text.encode("utf-8", "surrogatepass").translate(_ASCII_BREAKS).split()


def allowed_edits(n_words: int, share: float) -> int:
    return int(share * n_words + 1e-9)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt)) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class LengthClass:
    """Items with ``length`` words or up to CLASS_FACTOR times as many; windows have ``length`` words."""

    length: int
    items: np.ndarray
    edits: int
    walks: list[tuple[np.ndarray, list[np.ndarray]]] = field(default_factory=list)
    tables: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @property
    def pairs_needed(self) -> int:
        return max(1, self.length - 1 - 2 * self.edits)

    def add_walk(self, number: int) -> None:
        rng = np.random.default_rng([number, self.length])
        steps = rng.integers(0, 1 << 62, 3 * self.length, dtype=np.uint64)
        # the walk leaves the window after two steps a word or so; later steps see padding only
        self.walks.append((steps, [np.sort(rng.choice(2 * self.length, min(KEY_STEPS, 2 * self.length), replace=False)) for _ in range(KEYS_PER_WALK)]))

    def keys(self, codes: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
        """One row per key of walk ``number``, one column per window."""
        steps, samples = self.walks[number]
        at = np.zeros(len(starts), np.int64)
        last = max(int(s[-1]) for s in samples)
        wanted: dict[int, list[int]] = {}
        for key, sample in enumerate(samples):
            for step in sample.tolist():
                wanted.setdefault(step, []).append(key)
        keys = np.zeros((len(samples), len(starts)), np.uint64)
        for step in range(last + 1):
            seen = np.where(at < self.length, codes[starts + np.minimum(at, self.length - 1)], 0).astype(np.uint64)
            for key in wanted.get(step, ()):
                keys[key] = _mix(keys[key] ^ seen, step + 1)
            at += (((seen * _MIX + steps[step]) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)).astype(np.int64)
        return keys


class Finder:
    """Tables for one block of items: words and the ids that share them."""

    def __init__(self, items: dict[tuple[bytes, ...], list[int | None]], share: float, target: float, short_inside: bool = False):
        self.share = share
        self.short_inside = short_inside
        self.ids = list(items.values())
        texts = list(items)
        self.code: dict[bytes, int] = {}
        for text in texts:
            for word in text:
                self.code.setdefault(word, len(self.code) + 1)
        self.items = [np.array([self.code[w] for w in text], np.int64) for text in texts]
        self.short = {text: n for n, text in enumerate(texts) if len(text) < MIN_WORDS}
        self.short_sizes = sorted({len(text) for text in self.short})
        self.short_heads = {text[0] for text in self.short}
        self.allowed = np.array([allowed_edits(len(t), share) for t in texts], np.int64)
        self.lengths = lengths = np.array([len(t) for t in texts], np.int64)
        self.classes: list[LengthClass] = []
        for n in np.argsort(lengths, kind="stable").tolist():
            if lengths[n] < MIN_WORDS:
                continue
            if not self.classes or lengths[n] > CLASS_FACTOR * self.classes[-1].length:
                self.classes.append(LengthClass(int(lengths[n]), np.array([], np.int64), 0))
            own = self.classes[-1]
            own.items = np.append(own.items, n)
            own.edits = max(own.edits, int(self.allowed[n]))
        self.longest = int(lengths.max(initial=0))
        self.gap = self.longest + 5 * int(self.allowed.max(initial=0)) + 2
        bits = max(20, (16 * int(lengths.sum()) + 1).bit_length())
        self.pair_shift = np.uint64(64 - bits)
        self.known_pairs = np.zeros(1 << bits, np.uint8)
        for item in self.items:
            self.known_pairs[self._pair(item[:-1], item[1:])] = 1
        #: row per item: which words, by code modulo the width, it has
        self.has = np.zeros((len(self.items), 1024), bool)
        for n, item in enumerate(self.items):
            self.has[n, item % 1024] = True
        for own in self.classes:
            self._fill(own, target)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (((left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) * _MIX) >> self.pair_shift).astype(np.int64)

    def _fill(self, own: LengthClass, target: float) -> None:
        """Add walks until edited copies of up to 200 items of the class share a key with their item often enough, however many that takes."""
        rng = np.random.default_rng(own.length)
        starts = np.arange(len(own.items)) * self.gap
        codes = self._laid_out([self.items[n] for n in own.items])
        some = rng.choice(len(own.items), 200)
        edited = self._laid_out([self._edited(self.items[own.items[n]], own.edits, rng) for n in some])
        missed = np.ones(len(some), bool)
        while missed.mean() > 1 - target:
            own.add_walk(len(own.walks))
            keys = own.keys(codes, starts, len(own.walks) - 1)
            for row, trial in zip(keys, own.keys(edited, np.arange(len(some)) * self.gap, len(own.walks) - 1)):
                order = np.argsort(row, kind="stable")
                own.tables.append((row[order], own.items[order]))
                missed &= row[some] != trial

    def _laid_out(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(texts) * self.gap + self.gap, np.int64)
        for n, text in enumerate(texts):
            out[n * self.gap: n * self.gap + min(len(text), self.gap)] = text[: self.gap]
        return out

    def _edited(self, item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
        out = item.tolist()
        for kind in rng.integers(0, 3, edits).tolist():
            at = int(rng.integers(0, len(out)))
            if kind == 0:
                out[at] = 0
            elif kind == 1:
                out.insert(at, 0)
            elif len(out) > 1:
                del out[at]
        return np.array(out, np.int64)

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """Per text, (item, edits, words up to its end) of each item it holds, the best stretch of each."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        held: list[np.ndarray] = []
        owners: list[int] = []
        size = 0
        for n, text in enumerate(texts):
            words = words_of(text)
            if self.short and self.short_inside:
                found[n] += self._short_inside(words)
            elif self.short and len(words) < MIN_WORDS and tuple(words) in self.short:
                found[n].append((self.short[tuple(words)], 0, len(words)))
            if not self.classes or not words:
                continue
            codes = np.fromiter(map(self.code.get, words, repeat(0)), np.int64, len(words))
            held += [codes, np.zeros(self.gap, np.int64)]
            owners.append(n)
            size += len(words) + self.gap
            if size > CHUNK_WORDS:
                self._search(held, owners, found)
                held, owners, size = [], [], 0
        if owners:
            self._search(held, owners, found)
        return found

    def _short_inside(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """The short items among the words of a text, each where it ends first."""
        ends: dict[int, int] = {}
        for at, word in enumerate(words):
            if word in self.short_heads:
                for size in self.short_sizes:
                    item = self.short.get(tuple(words[at: at + size]))
                    if item is not None and at + size <= len(words):
                        ends.setdefault(item, at + size)
        return [(item, 0, end) for item, end in ends.items()]

    def _search(self, held: list[np.ndarray], owners: list[int], found: list[list[tuple[int, int, int]]]) -> None:
        codes = np.concatenate([np.zeros(self.gap, np.int64), *held])
        firsts = self.gap + np.concatenate([[0], np.cumsum([len(h) for h in held])[1:-1:2]]).astype(np.int64)
        both = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
        hits = np.zeros(len(codes) + 1, np.int64)
        hits[both[self.known_pairs[self._pair(codes[both], codes[both + 1])] > 0] + 1] = 1
        sums = np.cumsum(hits)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for own in self.classes:
            counts = sums[own.length - 1: len(codes) - self.gap] - sums[: len(codes) - self.gap - own.length + 1]
            starts = np.flatnonzero(counts >= own.pairs_needed)
            for at in range(0, len(starts), 50_000):
                windows, items = self._candidates(own, codes, starts[at: at + 50_000])
                for part in range(0, len(windows), 4_000):
                    w, i = windows[part: part + 4_000], items[part: part + 4_000]
                    likely = self._shared_words(codes, w, i, own) >= self.lengths[i] - self.allowed[i]
                    w, i = w[likely], i[likely]
                    edits, ends = self._distance(codes, w, i, own)
                    fits = edits <= self.allowed[i]
                    docs = np.searchsorted(firsts, ends[fits] - 1, "right") - 1
                    for doc, item, edit, end in zip(docs.tolist(), i[fits].tolist(), edits[fits].tolist(), (ends[fits] - firsts[docs]).tolist()):
                        best[doc, item] = min(best.get((doc, item), (edit, end)), (edit, end))
        for (doc, item), (edit, end) in best.items():
            found[owners[doc]].append((item, edit, end))

    def _candidates(self, own: LengthClass, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = [np.zeros(0, np.int64)]
        for number in range(len(own.walks)):
            for row, (sorted_keys, items) in zip(own.keys(codes, starts, number), own.tables[number * KEYS_PER_WALK:]):
                low, high = np.searchsorted(sorted_keys, row, "left"), np.searchsorted(sorted_keys, row, "right")
                many = high - low
                window = np.repeat(np.arange(len(starts)), many)
                place = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
                pairs.append(np.unique(window * len(self.items) + items[place]))
            if len(pairs) > 64:
                pairs = [np.unique(np.concatenate(pairs))]
        pairs = np.unique(np.concatenate(pairs))
        windows, items = starts[pairs // len(self.items)], pairs % len(self.items)
        # windows of an item that stand closely together are verified as one
        steps = windows // (own.edits + 1)
        _, first = np.unique(steps * len(self.items) + items, return_index=True)
        return windows[first], items[first]

    def _around(self, codes: np.ndarray, windows: np.ndarray, items: np.ndarray, own: LengthClass) -> np.ndarray:
        """The words around each window in which a stretch that matches must lie."""
        span = int(self.lengths[items].max(initial=0)) + 4 * own.edits
        return codes[np.minimum((windows - own.edits)[:, None] + np.arange(span)[None, :], len(codes) - 1)]

    def _shared_words(self, codes: np.ndarray, windows: np.ndarray, items: np.ndarray, own: LengthClass) -> np.ndarray:
        """At least as many as the words that edits leave intact; a lossless bound that spares most verifications."""
        text = self._around(codes, windows, items, own)
        return (self.has[items[:, None], text % 1024] & (text > 0)).sum(axis=1)

    def _distance(self, codes: np.ndarray, windows: np.ndarray, items: np.ndarray, own: LengthClass) -> tuple[np.ndarray, np.ndarray]:
        """Word edits between each item and the best stretch around its window, and where the stretch ends (Sellers' recurrence)."""
        lengths = self.lengths[items]
        longest = int(lengths.max(initial=0))
        patterns = np.full((len(items), longest), -1, np.int64)
        for row, n in enumerate(items.tolist()):
            patterns[row, : lengths[row]] = self.items[n]
        text = self._around(codes, windows, items, own)
        places = np.arange(text.shape[1] + 1)
        row = np.zeros((len(items), text.shape[1] + 1), np.int64)
        result, ends = np.full(len(items), 1 << 30, np.int64), np.zeros(len(items), np.int64)
        for n in range(longest):
            new = np.empty_like(row)
            new[:, 0] = n + 1
            new[:, 1:] = np.minimum(row[:, :-1] + (text != patterns[:, n: n + 1]), row[:, 1:] + 1)
            row = np.minimum.accumulate(new - places, axis=1) + places
            done = lengths == n + 1
            if done.any():
                result[done], ends[done] = row[done].min(axis=1), row[done].argmin(axis=1)
        return result, windows - own.edits + ends


def _finders(benchmark: DataFrame, share: float, target: float, short_inside: bool) -> Iterator[tuple[Finder, bool]]:
    """One block of items after the other, and whether it is the last; the driver and the workers hold one at a time."""
    if not 0 < target < 1:
        raise ValueError(f"A target recall of {target} is not between 0 and 1.")
    texts = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    blocks = max(1, -(-texts.count() // BLOCK_ITEMS))
    for block in range(blocks):
        items: dict[tuple[bytes, ...], list[int | None]] = {}
        for row in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect():
            if words := tuple(words_of(row["text"])):
                items.setdefault(words, []).append(row["item_id"])
        yield Finder(items, share, target, short_inside), block == blocks - 1


def _search(shared: Broadcast):
    """Not deterministic for the optimiser's eyes, so that no filter on the result runs the search a second time."""
    @F.pandas_udf("array<struct<item_id:long,edits:int,n_words:int,end_word:int>>")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for series in texts:
            yield pd.Series([
                [{"item_id": i, "edits": edits, "n_words": len(own.items[item]), "end_word": end}
                 for item, edits, end in found for i in own.ids[item]] for found in own.find(series.tolist())], dtype=object)

    return search.asNondeterministic()


def contaminated(docs: DataFrame, benchmark: DataFrame, max_edit_share: float = 0.2, target_recall: float = 0.97,
                 short_inside: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) that it holds.

    ``target_recall`` below 1 is that of the candidate search; each class of item lengths gets as many walks as reach it.
    Columns doc_id, item_id, edits, n_words (of the item), similarity (1 - edits / n_words), end_word (words of
    the document up to the end of the best stretch). Null and wordless texts hold nothing; null and wordless items are in nothing. Items with the same
    words are reported each; repeated documents are reported each. Items with fewer than five words match
    wherever a document has just these words in a row, if ``short_inside``; else only documents without other words. Other columns are ignored; empty tables give an empty result.
    """
    parts = []
    for finder, last in _finders(benchmark, max_edit_share, target_recall, short_inside):
        shared = docs.sparkSession.sparkContext.broadcast(finder)
        found = small_batches(docs).select(F.col("doc_id").cast("long"), F.explode(_search(shared)(F.col("text").cast("string"))).alias("of")).select(
            "doc_id", "of.item_id", "of.edits", "of.n_words", (1 - F.col("of.edits") / F.col("of.n_words")).alias("similarity"), "of.end_word")
        parts.append(found if last else store(found, "matches"))
        if not last:
            shared.destroy()
    return reduce(DataFrame.union, parts)


def decontaminated(docs: DataFrame, benchmark: DataFrame, max_edit_share: float = 0.2, target_recall: float = 0.97,
                   short_inside: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of ``benchmark``; ``short_inside`` as in contaminated."""
    name = "_found" + "_" * sum(c.startswith("_found") for c in docs.columns)
    for finder, last in _finders(benchmark, max_edit_share, target_recall, short_inside):
        shared = docs.sparkSession.sparkContext.broadcast(finder)
        docs = small_batches(docs).withColumn(name, _search(shared)(F.col("text").cast("string"))).where(F.size(f"`{name}`") == 0).drop(name)
        if not last:
            docs = store(docs, "clean")
            shared.destroy()
    return docs
