"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label are one node. A forest of random hyperplanes gives every node first neighbours from leaves of
bounded size; rounds of NN-descent then join each node's neighbours with each other and keep the best. Every pair over
the threshold that a leaf or a join compares is a link, also one that no list keeps (of the links of one comparison a
spanning forest is written, which connects the same nodes). Links make components. Each later pass takes a new forest
and keeps two lists per node, the best in and outside its component, so that lists full of links of a node's own group
don't hide links to others; passes follow until one joins no components. The number of links is then counted block by
block inside components. An audit compares a bounded sample of nodes with all nodes and measures the recall, by node
and by component; while it is below the target, passes with longer lists and more rounds follow. The audit's links
never enter the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.batches import bounds, whole_groups
from riskweave.llm.graph import connected_components
from riskweave.llm.scratch import small_batches, store

#: Nodes aimed at in a leaf, compared with each other at most; fuller leaves are cut.
LEAF_NODES, CELL_NODES = 48, 384
#: Hyperplanes of a tree at most.
MAX_BITS = 40
#: Neighbours (outside: of another component) and, where link is true, nodes that links connect.
PAIRS = "a long, b long, cosine double, outside boolean, link boolean"


class RecallError(RuntimeError):
    """The audit still misses links after all forests."""


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares of huge or tiny numbers stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _valid(vector: str, label: str):
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _forest(nodes: DataFrame, seed: int, trees: int) -> DataFrame:
    """grp, tree, leaf, node, vector: the leaf of each node in each tree."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for frame in frames:
            for size, part in frame.groupby(frame["vector"].map(len)):
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((trees, size, MAX_BITS))
                unit = _unit(part["vector"])
                used = np.arange(MAX_BITS)[None, :] < part["bits"].to_numpy()[:, None]
                for tree in range(trees):
                    signs = ((unit @ planes[size][tree]) > 0) & used
                    leaf = (signs.astype(np.int64) << np.arange(MAX_BITS)).sum(axis=1)
                    yield part[["grp", "node", "own", "vector"]].assign(tree=tree, leaf=leaf)[["grp", "tree", "leaf", "node", "own", "vector"]]

    sizes = store(nodes.groupBy("grp").count(), "groups")
    bits = F.least(F.lit(MAX_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / LEAF_NODES)))).cast("int")
    return nodes.join(sizes.select("grp", bits.alias("bits")), "grp").select("grp", "node", "own", "vector", "bits").mapInPandas(
        run, "grp string, tree int, leaf long, node long, own long, vector array<double>")


def _first_neighbours(nodes: DataFrame, seed: int, trees: int, k: int, threshold: float) -> DataFrame:
    """PAIRS: the best ``k`` of each node in and outside its component in each of its leaves, and links of the leaves."""
    keys = ["grp", "tree", "leaf", "cell"]
    forest = _forest(nodes, seed, trees)
    crowded = store(forest.groupBy("grp", "tree", "leaf").count().where(F.col("count") > CELL_NODES).select(
        "grp", "tree", "leaf", F.ceil(F.col("count") / CELL_NODES).cast("int").alias("cuts")), "crowded")
    cells = forest.join(crowded, ["grp", "tree", "leaf"], "left").withColumn(
        "cell", F.pmod(F.xxhash64("node", F.col("tree") + seed * trees), F.coalesce("cuts", F.lit(1))).cast("int")).select(*keys, "node", "own", "vector")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            at = bounds(frame, keys)
            ids, own = frame["node"].to_numpy(), frame["own"].to_numpy()
            for start, end in zip(at, at[1:]):
                if end - start > 1:
                    yield _compared(ids[start:end], own[start:end], _unit(frame["vector"].iloc[start:end]), k, threshold)

    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, PAIRS)


def _best(ids: np.ndarray, cosines: np.ndarray, k: int, outside: bool) -> pd.DataFrame:
    """The best ``k`` of each row; pairs that don't count have cosine -2."""
    k = min(k, len(ids) - 1)
    best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    found = np.take_along_axis(cosines, best, 1).ravel()
    counts = found > -2
    return pd.DataFrame({"a": np.repeat(ids, k)[counts], "b": ids[best.ravel()][counts], "cosine": found[counts], "outside": outside, "link": False})


def _spanned(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the smallest row that its links lead to."""
    reach = linked | np.eye(len(linked), dtype=bool)
    low = reach.argmax(axis=1)
    while True:
        lower = np.where(reach, low[None, :], len(low)).min(axis=1)
        lower = lower[lower]
        if (lower == low).all():
            return low
        low = lower


def _compared(ids: np.ndarray, own: np.ndarray, unit: np.ndarray, k: int, threshold: float) -> pd.DataFrame:
    """PAIRS of all nodes given: the best ``k`` per node in and outside its component, and what links connect."""
    cosines = unit @ unit.T
    linked = cosines >= threshold
    linked |= linked.T
    np.fill_diagonal(cosines, -2)
    same = own[:, None] == own[None, :]
    parts = [_best(ids, np.where(same, -2, cosines), k, True), _best(ids, np.where(same, cosines, -2), k, False)]
    if linked.sum() > len(ids):
        low = _spanned(linked)
        joined = low != np.arange(len(ids))
        parts.append(pd.DataFrame({"a": ids[joined], "b": ids[low[joined]], "cosine": 1.0, "outside": False, "link": True}))
    return pd.concat(parts, ignore_index=True)


def _lists(neighbours: DataFrame, k: int) -> DataFrame:
    """The best ``k`` neighbours of each node in and outside its component, of both directions."""
    directions = F.array(F.struct("a", "b", "cosine", "outside"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "cosine", "outside"))
    both = neighbours.select(F.inline(directions)).groupBy("a", "b", "outside").agg(F.max("cosine").alias("cosine"))
    best = Window.partitionBy("a", "outside").orderBy(F.desc("cosine"), "b")
    return store(both.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select("a", "b", "cosine", "outside"), "lists")


def _descend(lists: DataFrame, nodes: DataFrame, k: int, threshold: float, found: int = 3) -> tuple[DataFrame, DataFrame]:
    """One round: neighbours of a node are joined with each other; the lists with the best ``found`` of each, and links."""
    ends = lists.join(nodes.select(F.col("node").alias("b"), "own", "vector"), "b")
    joined = ends.groupBy("a").agg(F.collect_list(F.struct("b", "own", "vector")).alias("near"))  # 2k at most

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = [_compared(np.array([x["b"] for x in near]), np.array([x["own"] for x in near]), _unit(pd.Series([x["vector"] for x in near])), found, threshold)
                     for near in frame["near"] if len(near) > 1]
            if parts:
                yield pd.concat(parts, ignore_index=True)

    pairs = store(joined.select("near").mapInPandas(run, PAIRS).distinct(), "pairs")
    return _lists(lists.union(pairs.where("NOT link").select(*lists.columns)), k), _links(pairs)


def _links(pairs: DataFrame) -> DataFrame:
    return pairs.where("link").select("a", "b")


def _pass(nodes: DataFrame, components: DataFrame | None, lists: DataFrame | None, seed: int, trees: int, rounds: int, k: int,
          threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """Lists and links after one more forest and its rounds; nodes of one component (own) count as known to each other."""
    if components is None:
        marked = nodes.select("grp", "node", "vector", F.col("node").alias("own"))
    else:
        marked = store(nodes.join(components, "node", "left").select("grp", "node", "vector", F.coalesce("component", "node").alias("own")), "marked")
    pairs = store(_first_neighbours(marked, seed, trees, k, threshold), "pairs")
    seen, links = pairs.where("NOT link").select("a", "b", "cosine", "outside"), [_links(pairs)]
    if lists is not None:
        of_a, of_b = (marked.select(F.col("node").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab")
        seen = seen.union(lists.join(of_a, "a").join(of_b, "b").select("a", "b", "cosine", F.col("own_a") != F.col("own_b")))
    lists = _lists(seen, k)
    for _ in range(rounds):
        lists, found = _descend(lists, marked, k, threshold)
        links.append(found)
    return lists, links


def _audit(nodes: DataFrame, threshold: float, queries: int) -> DataFrame:
    """a, b: all links of a bounded sample of nodes, those with the smallest hash, by comparison with every node."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(queries).select("grp", "node", "vector").collect()
    by_group: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for grp in {r["grp"] for r in sample}:
        own = [r for r in sample if r["grp"] == grp]
        by_group[grp] = (np.array([r["node"] for r in own]), _unit(pd.Series([r["vector"] for r in own])))
    shared = nodes.sparkSession.sparkContext.broadcast(by_group)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for grp, part in frame.groupby("grp"):
                if grp not in shared.value:
                    continue
                ids, unit = shared.value[grp]
                all_ids = part["node"].to_numpy()
                i, j = np.nonzero(unit @ _unit(part["vector"]).T >= threshold)
                apart = ids[i] != all_ids[j]
                yield pd.DataFrame({"a": ids[i][apart], "b": all_ids[j][apart]})

    return store(nodes.select("grp", "node", "vector").mapInPandas(run, "a long, b long"), "audit")


def _recall(truth: DataFrame, components: DataFrame) -> float:
    """Share of links met per audited node: the mean over nodes or, if lower, over components, so that none outweighs the others."""
    of_a, of_b = (components.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    nodes = truth.join(of_a, "a", "left").join(of_b, "b", "left").groupBy("a", F.coalesce("of_a", "a").alias("own")).agg(
        (F.count_if(F.col("of_a") == F.col("of_b")) / F.count("*")).alias("met"))
    r = nodes.groupBy("own").agg(F.sum("met").alias("met"), F.count("*").alias("n")).agg(
        F.sum("n").alias("n"), (F.sum("met") / F.sum("n")).alias("by_node"), F.avg(F.col("met") / F.col("n")).alias("by_component")).first()
    return min(r["by_node"], r["by_component"]) if r["n"] else 1.0


def _parts(components: DataFrame) -> tuple[int, int]:
    """Nodes that have links, and components; as links are only added, both stay equal only if nothing was joined."""
    r = components.agg(F.count("*").alias("nodes"), F.count_distinct("component").alias("parts")).first()
    return r["nodes"], r["parts"]


def _links_inside(nodes: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """node, linked: rows of other nodes that each node of a component is linked with, by blocks of the component."""
    sizes = store(components.groupBy("component").count(), "sizes")
    packs = max(1, -(-components.count() // CELL_NODES))
    members = nodes.join(components, "node").join(sizes, "component").select(
        "node", "component", "size", "vector",
        F.when(F.col("count") <= CELL_NODES, F.concat(F.lit("pack "), F.pmod(F.xxhash64("component"), F.lit(packs)).cast("string")))
        .otherwise(F.col("component").cast("string")).alias("part"),
        F.ceil(F.col("count") / CELL_NODES).cast("int").alias("cuts"))
    own = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    values = ["node", "component", "size", "vector"]
    left = members.select("part", own.alias("row"), F.explode(every).alias("column"), F.lit(True).alias("left"), *values)
    right = members.select("part", F.explode(every).alias("row"), own.alias("column"), F.lit(False).alias("left"), *values)
    keys = ["part", "row", "column"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            at = bounds(frame, keys)
            for start, end in zip(at, at[1:]):
                cell = frame.iloc[start:end]
                for size, same in cell.groupby(cell["vector"].map(len)):  # packs may hold vectors of several lengths
                    a, b = same[same["left"]], same[~same["left"]]
                    if a.empty or b.empty:
                        continue
                    linked = _unit(a["vector"]) @ _unit(b["vector"]).T >= threshold
                    linked &= a["component"].to_numpy()[:, None] == b["component"].to_numpy()[None, :]
                    linked &= a["node"].to_numpy()[:, None] != b["node"].to_numpy()[None, :]
                    yield pd.DataFrame({"node": a["node"], "linked": linked @ b["size"].to_numpy()})

    return left.union(right).repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        run, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, k: int = 10, trees: int = 6, rounds: int = 2, queries: int = 1000,
                    target_recall: float = 0.98, forests: int = 4) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding, label).

    Rows are linked when their labels are equal and the cosine is ``threshold`` or more. Rows with a null label, and
    vectors that are null, empty, zero or hold null or non-finite numbers, are linked with nothing, nor are vectors of
    different length. Repeated rows are vectors like any other: equal ones are linked. component_id is the smallest
    vec_id reachable, itself included; rows without vec_id never name a component and aren't kept. Other columns are
    ignored; an empty table gives an empty result. Passes go on, without a bound, while they join components. Raises
    RecallError if ``forests`` forests or more miss the target.
    """
    rows = small_batches(vectors).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    rows = rows.withColumn("grp", F.when(_valid("vector", "label"), F.concat_ws("/", F.size("vector").cast("string"), F.col("label").cast("string"))))
    sound, rest = rows.where("grp IS NOT NULL"), rows.where("grp IS NULL")
    nodes = store(sound.groupBy("grp", "vector").agg(F.count("*").alias("size"), F.min("vec_id").alias("first")).select(
        F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    truth = _audit(nodes, threshold, queries)
    lists = components = links = None
    number, recall, joined = 0, 0.0, True
    while joined or recall < target_recall:
        if number >= forests and recall < target_recall:
            raise RecallError(f"recall {recall:.3f} after {number} forests")
        short = number > 0 and recall < target_recall
        k, rounds = (2 * k, rounds + 1) if short else (k, rounds)
        lists, found = _pass(nodes, components, lists, number, trees, rounds, k, threshold)
        for part in found:
            links = part if links is None else links.union(part)
        before = components
        components = store(connected_components(links), "components")
        joined = before is None or _parts(components) != _parts(before)
        recall = _recall(truth, components)
        links = components.select(F.col("node").alias("a"), F.col("component").alias("b"))  # connects what the links do
        number += 1
    linked = store(_links_inside(nodes, components, threshold), "linked")
    named = store(nodes.join(components, "node", "left").select(
        "node", "grp", "vector", "size", "first", F.coalesce("component", "node").alias("component")), "named")
    names = store(named.groupBy("component").agg(F.min("first").alias("component_id")), "names")
    result = store(named.join(names, "component").join(linked, "node", "left").select(
        "grp", "vector", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"), "result")
    whole = sound.join(result, ["grp", "vector"]).select("vec_id", "n_links", "component_id").union(
        rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
