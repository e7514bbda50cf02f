"""Best-two-fit packing of token pieces into sequences of a fixed length.

Every document is encoded, ended by an id, and cut into pieces only where it is longer than a sequence. What a packing
needs of the pieces is how many there are of each length, at most as many numbers as a sequence has places. On these
counts bins are filled greedily, the longest piece that fits first; then a bin's shortest piece is replaced by the two
unpacked pieces that fill its place and the gap best, if they fill more than it did, until none do. A filled bin is a
pattern that is used as often as the counts allow, so the plan is bounded by the sequence length, not by the data. The
pieces themselves are numbered within their length on Spark, and a number and a length name a place in the plan.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import small_batches, store
from riskweave.llm.word_encoder import word_encoder
from riskweave.operators.scan import positions

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, limit: int = 2048, ids: bool = True) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32 and, if wanted, ids (4 bytes each).

    A document is its ids and ``end_id``; null and empty texts are that id alone. Only documents of more than ``limit``
    ids are cut, into pieces of ``limit`` and a last one of what is left. Repeated rows and null ids give pieces each;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(vocabulary)
        for rows in batches:
            found, borders = own.encode(rows.column("text"))
            n = len(borders) - 1
            data = np.insert(found, borders[1:], end_id).astype("<u4")
            ends = borders[1:] + np.arange(1, n + 1)
            sizes = np.diff(borders) + 1
            parts = -(-sizes // limit)
            of = np.repeat(np.arange(n), parts)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * limit
            length = np.minimum(limit, sizes[of] - start)
            at = ((ends - sizes)[of] + start)
            raw = [data[a: a + size].tobytes() for a, size in zip(at.tolist(), length.tolist())]
            columns = {"doc_id": rows.column("doc_id").take(pa.array(of)), "piece": pa.array(piece, pa.int32()), "start": start,
                       "length": length, "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(raw, pa.binary())} if ids else {}))

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, PIECES + (", ids binary" if ids else ""))


# --- the plan --------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Pattern:
    """A filled bin: its pieces' lengths, longest first, and how often it is used."""

    lengths: tuple[int, ...]
    times: int


def _fill(lengths: list[int], counts: dict[int, int], taken: Counter, room: int) -> int:
    """Takes the longest pieces that fit, and gives back the room that is left."""
    while room:
        k = bisect.bisect_right(lengths, room) - 1
        while k >= 0 and taken[lengths[k]] >= counts[lengths[k]]:
            k -= 1
        if k < 0:
            return room
        size = lengths[k]
        more = min(counts[size] - taken[size], room // size)
        taken[size] += more
        room -= more * size
    return 0


def _best_two(lengths: list[int], counts: dict[int, int], taken: Counter, room: int, least: int) -> tuple[int, int] | None:
    """The two unpacked pieces of the largest sum that is above ``least`` and at most ``room``; the longer one longest on a tie."""
    free = [n for n in lengths[:bisect.bisect_left(lengths, room)] if counts[n] > taken[n]]
    best, low, high = None, 0, len(free) - 1
    while low <= high:
        total = free[low] + free[high]
        if total > room:
            high -= 1
            continue
        if total > least and (low < high or counts[free[low]] - taken[free[low]] > 1):
            best, least = (free[low], free[high]), total
            if total == room:
                return best
        low += 1
    return best


def plan(counts: dict[int, int], limit: int) -> list[Pattern]:
    """Patterns that use every piece counted by its length exactly once."""
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= limit for n in left):
        raise ValueError(f"pieces have 1 to {limit} places")
    lengths, patterns = sorted(left), []
    while lengths:
        taken: Counter = Counter()
        room = _fill(lengths, left, taken, limit)
        while room:
            shortest = min(n for n, c in taken.items() if c)
            taken[shortest] -= 1
            pair = _best_two(lengths, left, taken, room + shortest, shortest)
            # nothing unpacked fits the gap alone, so neither of the two is the piece that goes, and it doesn't fit again
            if pair is None:
                taken[shortest] += 1
                break
            taken.update(pair)
            room += shortest - sum(pair)
        used = {n: c for n, c in taken.items() if c}
        times = min(left[n] // c for n, c in used.items())
        patterns.append(Pattern(tuple(n for n in sorted(used, reverse=True) for _ in range(used[n])), times))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                del lengths[bisect.bisect_left(lengths, n)]
    return patterns


@dataclass(frozen=True)
class Places:
    """Which numbers of a length stand where: runs sorted by (length, first), one per pattern and length."""

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Places:
        rows, done, sequence = [], Counter(), 0
        for pattern in patterns:
            offset = 0
            for n, copies in sorted(Counter(pattern.lengths).items(), reverse=True):
                rows.append((n, done[n], copies, sequence, offset))
                done[n] += copies * pattern.times
                offset += n * copies
            sequence += pattern.times
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by their length and number within it."""
        own = np.empty(len(length), np.int64)
        for n in np.unique(length):
            a, b = np.searchsorted(self.length, n, "left"), np.searchsorted(self.length, n, "right")
            rows = length == n
            own[rows] = a + np.searchsorted(self.first[a:b], number[rows], "right") - 1
        turn = number - self.first[own]
        return self.sequence[own] + turn // self.copies[own], self.offset[own] + turn % self.copies[own] * length


# --- on Spark --------------------------------------------------------------------------------------------------------
def pack(pieces: DataFrame, limit: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (length and others) with sequence_id and offset, its place there; sequences have no gaps.

    ``pieces`` is read several times: give a stored table. Equal pieces are packed each; a null length or one outside
    1 to ``limit`` raises. At most ``limit`` counts reach the driver, and places of at most a few patterns per length
    (`plan`) go to the tasks.
    """
    counted = pieces.groupBy(F.coalesce(F.col("length"), F.lit(0)).alias("length")).count()
    wrong = counted.where(~F.col("length").between(1, limit)).limit(1).count()
    if wrong:
        raise ValueError(f"pieces have 1 to {limit} places")
    places = Places.of(plan({r["length"]: r["count"] for r in counted.collect()}, limit))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    columns = [F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    numbered = positions(pieces.select(*columns), ["length"], list(order), "_number")
    return numbered.withColumn("_place", placed("length", "_number")).select(*columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, n_tokens and ids of each sequence of ``packed``, a table with ids; a group has at most as
    many rows as a sequence has places."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_pieces", "n_tokens",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, limit: int = 2048) -> DataFrame:
    """Places of all pieces of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(store(token_pieces(docs, vocabulary, end_id, limit, ids=False), "pieces"), limit)
