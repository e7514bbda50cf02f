"""SimHash near-dedup by anchor points of a covering code.

Two fingerprints within ``max_distance`` bits differ in at most ``max_distance // parts`` bits of one of ``parts``
slices. Over each slice lie the words of a covering code, the anchors: a Hamming code on the first bits (no point is
farther than one bit from a code word), every value of the other bits. A fingerprint is at home at its nearest anchor
and visits all anchors within the covering radius plus the slice's share of the distance, so a pair within the
distance meets at the home of either. Homes are compared with visitors per anchor, and each anchor returns one spanning
set of links, not all pairs.

``parts=3, order=4`` (17 to 18 anchor bits, about 45 visits) suits up to some 10^8 different fingerprints;
``parts=2, order=5`` (27 anchor bits, about 330 visits) keeps anchors small beyond that. Both find every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.batches import bounds, whole_groups
from riskweave.llm.graph import connected_components
from riskweave.llm.scratch import small_batches, store

BITS = 64
SEED = 42
#: Rows compared with each other at once; anchors with more are cut into cells.
CELL_ROWS = 2_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned fingerprint of the shingles of a whole text, A-Z lower-cased; null and wordless texts give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED)
                  for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at: at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long), one row per row of ``docs``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = np.array([fingerprint(t, shingle) for t in frame["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": fps.view(np.int64)})

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, "doc_id long, fp long")


class Slice:
    """Anchors over ``width`` bits from bit ``low``: a Hamming code of the given order, then free bits."""

    def __init__(self, low: int, width: int, order: int, reach: int):
        coded = 2 ** order - 1
        assert coded <= width <= 32
        self.low, self.width = low, width
        #: column of each bit in the parity check; free bits have none
        self.columns = np.array([*range(1, coded + 1), *[0] * (width - coded)])
        masks: dict[int, list[int]] = {s: [] for s in range(coded + 1)}
        for n in range(reach + 2):  # the covering radius is 1
            for bits in combinations(range(width), n):
                masks[int(np.bitwise_xor.reduce(self.columns[list(bits)])) if bits else 0].append(sum(1 << b for b in bits))
        self.masks = {s: np.array(m, np.uint64) for s, m in masks.items()}
        self.nearest = np.array([0, *[1 << (s - 1) for s in range(1, coded + 1)]], np.uint64)

    def visits(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Fingerprints, anchors they visit, whether at home there."""
        value = (fps >> np.uint64(self.low)) & np.uint64((1 << self.width) - 1)
        syndrome = np.zeros(len(fps), np.int64)
        for bit in np.flatnonzero(self.columns):
            syndrome ^= np.where((value >> np.uint64(bit)) & np.uint64(1), self.columns[bit], 0)
        for s, masks in self.masks.items():
            own = syndrome == s
            anchors = (value[own][:, None] ^ masks[None, :]).ravel()
            yield np.repeat(fps[own], len(masks)), anchors, np.tile(masks == self.nearest[s], int(own.sum()))


def slices(parts: int, order: int, max_distance: int) -> list[Slice]:
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [Slice(a, b - a, order, max_distance // parts) for a, b in zip(edges, edges[1:])]


def _visits(fps: DataFrame, cover: list[Slice]) -> DataFrame:
    def run(frames):
        for frame in frames:
            values = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(values), 4096):
                for number, part in enumerate(cover):
                    for fp, anchor, home in part.visits(values[at: at + 4096]):
                        yield pd.DataFrame({"anchor": anchor.view(np.int64) + (number << 40), "fp": fp.view(np.int64), "home": home})

    return fps.select("fp").mapInPandas(run, "anchor long, fp long, home boolean")


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


def near_links(fps: DataFrame, max_distance: int = 4, parts: int = 3, order: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Different fingerprints (fp: long, distinct) to links a, b that connect all pairs within ``max_distance`` bits."""
    cover = slices(parts, order, max_distance)
    visits = _visits(fps, cover)
    crowded = store(visits.groupBy("anchor").count().where(F.col("count") > cell_rows).select(
        "anchor", F.ceil(F.col("count") / cell_rows).cast("int").alias("cuts")), "crowded")
    dealt = visits.join(crowded, "anchor", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    visitors = dealt.select("anchor", F.explode(every).alias("row"), own.alias("column"), "fp", F.lit(False).alias("home"))
    homes = dealt.where("home").select("anchor", own.alias("row"), F.explode(every).alias("column"), "fp", "home")
    keys = ["anchor", "row", "column"]

    def run(frames):
        for frame in whole_groups(frames, keys):
            at = bounds(frame, keys)
            fp, home = frame["fp"].to_numpy().view(np.uint64), frame["home"].to_numpy(bool)
            for start, end in zip(at, at[1:]):
                h = fp[start:end][home[start:end]]
                if not len(h) or end - start < 3:  # a home is a visitor as well
                    continue
                v = fp[start:end][~home[start:end]]
                i, j = np.nonzero(np.bitwise_count(h[:, None] ^ v[None, :]) <= max_distance)
                a, b = h[i], v[j]
                a, b = a[a != b], b[a != b]
                if len(a):
                    a, b = _spanning(a.view(np.int64), b.view(np.int64))
                    yield pd.DataFrame({"a": a, "b": b})

    return homes.union(visitors).repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long")


def _lookup(rows: DataFrame, max_distance: int, parts: int, order: int, cell_rows: int) -> DataFrame:
    """fp, component_id (smallest doc_id of the group), keeper (the fingerprint of the row that stands for the group)."""
    different = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    groups = connected_components(near_links(different, max_distance, parts, order, cell_rows)).withColumnRenamed("node", "fp")
    named = store(different.join(groups, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "named")
    lowest = F.min(F.struct(F.col("first").isNull(), "first", "fp"))
    names = store(named.groupBy("component").agg(lowest.alias("low")).select("component", "low.first", F.col("low.fp").alias("keeper")), "names")
    return store(named.select("fp", "component").join(names, "component").select("fp", F.col("first").alias("component_id"), "keeper"), "components")


def simhash_groups(docs: DataFrame, max_distance: int = 4, shingle: int = 4, parts: int = 3, order: int = 4,
                   cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), one row per row of ``docs``.

    Null, empty and wordless texts have fingerprint zero and are linked like any other; texts with fewer words than a
    shingle are one shingle. Rows with the same fingerprint are linked. Rows without doc_id belong to a group but
    never name it; a group of such rows has a null component_id. Repeated rows come out repeated. Columns of ``docs``
    beside doc_id and text are ignored. Empty tables give an empty result.
    """
    rows = store(fingerprints(docs, shingle), "fingerprints")
    lookup = _lookup(rows, max_distance, parts, order, cell_rows)
    return rows.join(lookup, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_distance: int = 4, shingle: int = 4, parts: int = 3, order: int = 4,
             cell_rows: int = CELL_ROWS) -> DataFrame:
    """The row with the smallest doc_id of each group of :func:`simhash_groups`, all columns of ``docs``.

    Of rows with this doc_id and its fingerprint one stays, and so it is with groups where no row has a doc_id. A
    doc_id that only one row has is enough to find that row; fingerprints are computed again, and rows shuffled to drop
    repeated ones, only for doc_ids that are null or stand in several rows.
    """
    rows = store(fingerprints(docs, shingle), "fingerprints")
    lookup = _lookup(rows, max_distance, parts, order, cell_rows)
    keepers = lookup.where("fp = keeper").select(F.col("component_id").alias("_id"), F.col("fp").alias("_fp"))
    several = store(rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_several")), "several")

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    single = keepers.join(several, keepers["_id"].eqNullSafe(several["_several"]), "left_anti")
    plain = docs.join(single, docs["doc_id"] == single["_id"], "left_semi")
    marked = docs.join(several, docs["doc_id"].eqNullSafe(several["_several"]), "left_semi").withColumn("_own_fp", fp(F.col("text").cast("string")))
    found = marked.join(keepers, marked["doc_id"].eqNullSafe(keepers["_id"]) & (marked["_own_fp"] == keepers["_fp"]), "left_semi")
    return plain.unionByName(found.dropDuplicates(["doc_id", "_own_fp"]).drop("_own_fp"))
