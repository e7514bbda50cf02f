"""Ranked lexical search over an index of segments, by accumulators for short lists and skipping in long ones.

`build_index` turns documents into segments: some thousand documents each, numbered in the order of doc_id, with a list
of (document, occurrences) for every term, cut into blocks that know their most occurrences and their shortest
document. `search` takes the lists of the asked terms to their segments. In a segment the short lists of a query are
read term at a time, summed into accumulators and then treated as one list with a bound; that list and the long lists
are walked document at a time, range by range: lists whose bounds cannot reach the score of the last of the best so far
only complete candidates of the others, ranges that cannot reach it are skipped, candidates are given up as soon as
what is left cannot lift them. All arithmetic is exact, so the skipping never changes the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.batches import bounds, whole_groups
from riskweave.llm.scratch import new_folder, small_batches

#: A segment is closed at so many documents or bytes of text, whichever comes first.
SEGMENT_DOCS, SEGMENT_BYTES = 8192, 8 << 20
#: Postings per block of a list, and documents per range of a segment.
BLOCK, RANGE = 64, 512
#: Terms of queries that are looked up in one pass over the index; more queries are taken in blocks.
BLOCK_TERMS = 1_000_000
INDEX = "segment long, term binary, n_docs long, n_terms long, docs binary, counts binary"
#: Bytes that end a term become blanks, A-Z become lower case; bytes from 128 on are parts of terms.
TABLE = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split(b" ")


# --- the index -------------------------------------------------------------------------------------------------------
def _segment(number: int, ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
    """Rows of a segment: one with term null for its documents, one for each term."""
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k] or 0))
    split = pc.split_pattern(pa.array([texts[k].translate(TABLE) for k in order], pa.large_binary()), " ")
    sizes = np.diff(np.asarray(split.offsets, np.int64))
    tokens = split.flatten().dictionary_encode()
    term, doc = np.asarray(tokens.indices, np.int64), np.repeat(np.arange(len(split)), sizes)
    kinds = tokens.dictionary.to_pylist()
    if b"" in kinds:  # between two separators
        real = term != kinds.index(b"")
        term, doc = term[real], doc[real]
    del split, tokens
    n_rows = len(order)
    lengths = np.bincount(doc, minlength=n_rows)
    pairs, counts = np.unique(term * n_rows + doc, return_counts=True)
    term, doc = pairs // n_rows, (pairs % n_rows).astype("<u4")
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.append(starts[1:], len(term))
    packed_docs, packed_counts = doc.tobytes(), counts.astype("<u4").tobytes()
    known = np.array([i is not None for i in ids])[order]
    rows = {"segment": [number], "term": [None], "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())],
            "docs": [np.array([ids[k] or 0 for k in order], "<i8").tobytes() + known.tobytes()], "counts": [lengths.astype("<i8").tobytes()]}
    rows["segment"] += [number] * len(starts)
    rows["term"] += [kinds[k] for k in term[starts].tolist()]
    rows["n_docs"] += (ends - starts).tolist()
    rows["n_terms"] += np.add.reduceat(counts, starts).tolist() if len(starts) else []
    spans = list(zip((starts * 4).tolist(), (ends * 4).tolist()))
    rows["docs"] += [packed_docs[a:b] for a, b in spans]
    rows["counts"] += [packed_counts[a:b] for a, b in spans]
    types = {"segment": pa.int64(), "term": pa.binary(), "n_docs": pa.int64(), "n_terms": pa.int64(), "docs": pa.binary(), "counts": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in rows.items()})


def build_index(docs: DataFrame, folder: str | None = None, segment_docs: int = SEGMENT_DOCS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index of every row of ``docs`` (doc_id, text) over whole texts, written to ``folder`` (by default a new one of the shared store).

    Rows are indexed where they are read, without a shuffle. Null texts have no terms; repeated rows and null ids are
    documents of their own; other columns are ignored.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(key)
                texts.append(text or b"")
                size += len(texts[-1])
                if len(ids) >= segment_docs or size >= segment_bytes:
                    yield _segment(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _segment(number, ids, texts)

    folder = folder or new_folder(docs.sparkSession, "index")
    small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        run, INDEX).write.parquet(folder)
    return docs.sparkSession.read.schema(INDEX).parquet(folder)


# --- a query in a segment --------------------------------------------------------------------------------------------
@dataclass
class Postings:
    """A list in a segment: documents, what each scores, and bounds of its blocks by document number."""

    docs: np.ndarray
    scores: np.ndarray

    def __post_init__(self):
        self.best = int(self.scores.max(initial=0))
        starts = np.arange(0, len(self.docs), BLOCK)
        self.block_first = self.docs[starts]
        self.block_last = self.docs[np.minimum(starts + BLOCK, len(self.docs)) - 1]
        self.block_best = np.maximum.reduceat(self.scores, starts) if len(starts) else self.scores

    def bound(self, first: int, last: int) -> int:
        """The most that a document from ``first`` to ``last`` may get from this list."""
        a, b = np.searchsorted(self.block_last, first), np.searchsorted(self.block_first, last, "right")
        return int(self.block_best[a:b].max()) if a < b else 0

    def within(self, first: int, last: int) -> slice:
        return slice(*np.searchsorted(self.docs, [first, last + 1]).tolist())

    def of(self, docs: np.ndarray) -> np.ndarray:
        """The scores of ``docs``, found by search."""
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.scores[at], 0)


class Top:
    """The best so far: score descending, then number ascending."""

    def __init__(self, size: int, floor: int = 1):
        self.size, self.floor = size, floor
        self.docs, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        order = np.lexsort([docs, -scores])[:self.size]
        self.docs, self.scores = docs[order], scores[order]
        if len(order) == self.size:
            self.floor = max(self.floor, int(self.scores[-1]))


def accumulate(lists: list[Postings]) -> Postings | None:
    """Term at a time: the sum of short lists as one list."""
    if not lists:
        return None
    docs = np.concatenate([p.docs for p in lists])
    found, place = np.unique(docs, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, place, np.concatenate([p.scores for p in lists]))
    return Postings(found, sums)


def best_documents(lists: list[Postings], n_docs: int, k: int, floor: int = 1, short: int | None = None, span: int = RANGE) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of a segment with a score of ``floor`` or more, and their scores.

    Lists of up to ``short`` postings (by default a sixteenth of the documents) are summed beforehand.
    """
    short = max(BLOCK, n_docs // 16) if short is None else short
    heap = Top(k, max(1, floor))
    few = accumulate([p for p in lists if len(p.docs) <= short])
    long = [p for p in lists if len(p.docs) > short] + ([few] if few is not None else [])
    if sum(p.best for p in long) < heap.floor:
        return heap.docs, heap.scores
    for first in range(0, n_docs, span):
        last = min(first + span, n_docs) - 1
        bounds = [p.bound(first, last) for p in long]
        if sum(bounds) < heap.floor:
            continue
        order = sorted((b, n) for n, b in enumerate(bounds) if b)
        # the weakest lists that together can't reach the floor bring no candidates
        passive, reach = 0, 0
        while passive < len(order) and reach + order[passive][0] < heap.floor:
            reach += order[passive][0]
            passive += 1
        active = [long[n] for _, n in order[passive:]]
        found = accumulate([Postings(p.docs[s], p.scores[s]) for p in active if (s := p.within(first, last)).start < s.stop])
        if found is None:
            continue
        docs, scores = found.docs, found.scores
        for bound, n in reversed(order[:passive]):
            alive = scores + reach >= heap.floor
            docs, scores = docs[alive], scores[alive]
            if not len(docs):
                break
            scores = scores + long[n].of(docs)
            reach -= bound
        alive = scores >= heap.floor
        heap.add(docs[alive], scores[alive])
    return heap.docs, heap.scores


# --- search on Spark -------------------------------------------------------------------------------------------------
@dataclass
class Query:
    number: int
    item: object
    weights: dict[bytes, int]


def _impacts(docs: np.ndarray, counts: np.ndarray, norms: np.ndarray, weight: int) -> np.ndarray:
    tf = counts.astype(np.int64)
    return weight * (1_000_000_000 * tf // (1000 * tf + 12 * norms[docs]))


def _search_block(index: DataFrame, block: list[tuple[int, object, dict[bytes, int]]], n_docs: int, n_terms: int, k: int, item_type: str) -> DataFrame:
    """Best documents of each segment for a block of queries (number, item, occurrences of terms)."""
    spark = index.sparkSession
    asked = sorted({t for _, _, terms in block for t in terms})
    wanted = spark.createDataFrame([(t,) for t in asked], "term binary")
    lists = index.join(F.broadcast(wanted), "term")  # at most BLOCK_TERMS and the terms of one query
    held = {bytes(r["term"]): r["df"] for r in lists.groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    worth = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in held.items()}
    queries = [Query(n, item, {t: c * worth[t] for t, c in terms.items() if worth.get(t, 0) > 0}) for n, item, terms in block]
    queries = [q for q in queries if q.weights]
    if not queries:
        return spark.createDataFrame([], f"number long, item_id {item_type}, doc_id long, score long")
    shared = spark.sparkContext.broadcast(queries)

    def segments_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for several in whole_groups(frames, ["segment"]):
            at = bounds(several, ["segment"]).tolist()
            yield from (several.iloc[a:b] for a, b in zip(at, at[1:]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floors: dict[int, int] = {}
        for frame in segments_of(frames):
            own = frame["term"].isna()
            head = frame[own].iloc[0]
            lengths = np.frombuffer(head["counts"], "<i8")
            ids, known = np.frombuffer(head["docs"], "<i8", len(lengths)), np.frombuffer(head["docs"], bool, offset=8 * len(lengths))
            norms = 75 + 25 * lengths * n_docs // n_terms
            found = {bytes(t): (np.frombuffer(d, "<u4").astype(np.int64), np.frombuffer(c, "<u4")) for t, d, c in
                     zip(frame.loc[~own, "term"], frame.loc[~own, "docs"], frame.loc[~own, "counts"])}
            numbers, items, docs, scores = [], [], [], []
            for q in shared.value:
                lists = [Postings(found[t][0], _impacts(*found[t], norms, w)) for t, w in q.weights.items() if t in found]
                if not lists:
                    continue
                top, sums = best_documents(lists, len(lengths), k, floors.get(q.number, 1))
                # what k documents of this segment reach, others must reach too
                if len(top) == k:
                    floors[q.number] = max(floors.get(q.number, 1), int(sums[-1]))
                numbers += [q.number] * len(top)
                items += [q.item] * len(top)
                docs.append(top)
                scores.append(sums)
            if numbers:
                at = np.concatenate(docs)
                yield pd.DataFrame({"number": numbers, "item_id": pd.Series(items, dtype=object),
                                    "doc_id": pd.Series(ids[at], dtype="Int64").mask(~known[at]), "score": np.concatenate(scores)})

    segments = lists.unionByName(index.where("term IS NULL"), allowMissingColumns=True).select("segment", "term", "docs", "counts")
    return segments.repartition("segment").sortWithinPartitions("segment").mapInPandas(
        run, f"number long, item_id {item_type}, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of ``index`` that score highest for each row of ``items`` (item_id, text).

    Equal scores rank by ascending doc_id, nulls first. Only scores above 0 count; items without a known term give no
    rows, repeated items are answered each. Items are taken in blocks of up to ``block_terms`` terms, a pass over the
    asked lists each; all documents are searched. An index without terms gives no rows.
    """
    spark = index.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    total = index.where("term IS NULL").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    parts: list[DataFrame] = []
    if total[1]:
        block, size = [], 0
        for n, row in enumerate(items.select("item_id", F.col("text").cast("string")).toLocalIterator()):
            terms: dict[bytes, int] = {}
            for t in filter(None, terms_of((row["text"] or "").encode())):
                terms[t] = terms.get(t, 0) + 1
            if block and size + len(terms) > block_terms:
                parts.append(_search_block(index, block, total[0], total[1], k, kind))
                block, size = [], 0
            block.append((n, row["item_id"], terms))
            size += len(terms)
        if size:
            parts.append(_search_block(index, block, total[0], total[1], k, kind))
    found = spark.createDataFrame([], f"number long, item_id {kind}, doc_id long, score long")
    for part in parts:
        found = found.unionByName(part)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
