"""Merkle manifest of a table by butterfly exchange.

Rows are leaves, a group's leaves in order make a binary tree, the groups' roots another one. Aligned blocks of leaves
are hashed in one task each. The blocks of a group then are the participants of a butterfly: in round r those that
differ only in the r-th digit of their number (digits of ``fanout``) swap the roots of the subtrees they have completed,
and each hashes the common ancestors for itself. After as many rounds as the numbers have digits every block holds the
root and, on the way, has met the siblings of all its ancestors; nothing is passed down again. A round is one exchange
of a short row per block, not per leaf.

H is the lowercase hex SHA-256 of the hex texts of its inputs. Two consecutive nodes of a level make a node of the next;
a last node without partner is hashed alone; a single node is the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.scratch import store
from riskweave.operators.scan import positions

#: Levels hashed inside a block (of 2**HEIGHT leaves), and levels per round of the butterfly (fanout 2**FAN).
HEIGHT, FAN = 10, 4


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def climb(nodes: list[str], levels: int) -> tuple[list[list[str]], str | None]:
    """Per node its siblings on ``levels`` levels ("" where it has none), and the node above all; ``nodes`` start at an
    aligned place and stand without gaps."""
    siblings: list[list[str]] = [[] for _ in nodes]
    level = nodes
    for k in range(levels):
        for n, own in enumerate(siblings):
            other = (n >> k) ^ 1
            own.append(level[other] if other < len(level) else "")
        level = [digest("".join(level[n: n + 2])) for n in range(0, len(level), 2)]
    return siblings, level[0] if level else None


def _levels(count: Column) -> Column:
    """Levels above the leaves of a tree: binary digits of the last leaf's number."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0)


def tree(leaves: DataFrame, group: Sequence[str], order: Sequence[str], leaf: str = "leaf", height: int = HEIGHT, fan: int = FAN) -> DataFrame:
    """``leaves`` with position (from 0) in its group, siblings level by level ("" for none) and root of the group.

    Null group values are a group. Rows equal in ``order`` are ordered by ``leaf``. ``leaves`` is read several times:
    give a stored table. Columns named position, siblings and root are replaced. A block and a swap are bounded by the
    parameters, so a group of any size is spread over its blocks.
    """
    group = list(group)
    names = [c for c in leaves.columns if c not in ("position", "siblings", "root")]
    kept = [F.col(f"`{c}`") for c in names]
    placed = positions(leaves.select(*kept), group, [*order, leaf], "position", "_n").withColumns({
        "_block": F.shiftright("position", height), "_levels": _levels(F.col("_n"))})
    schema = placed.select(*kept, "position", "_n", "_block", "_levels").schema.add("_own", T.ArrayType(T.StringType())).add("_root", T.StringType())

    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        own, root = climb(rows.column(leaf).to_pylist(), min(height, rows.column("_levels")[0].as_py()))
        return rows.append_column("_own", pa.array(own, pa.list_(pa.string()))).append_column("_root", pa.array([root] * len(rows), pa.string()))

    # at most 2**height rows in a group
    hashed = store(placed.groupBy(*group, "_block").applyInArrow(block, schema), "blocks")
    state = hashed.where(F.col("position") % (1 << height) == 0).select(
        *group, F.col("_block").alias("_p"), "_n", "_levels", F.col("_root").alias("_top"), F.array().cast("array<string>").alias("_upper"))
    most = hashed.agg(F.max("_levels")).first()[0] or 0
    rounds = max(0, -(-(most - height) // fan))
    if rounds:
        state = _butterfly(state, group, height, fan, rounds)
    state = state.select(*[F.col(f"`{c}`").alias(f"_g{n}") for n, c in enumerate(group)], F.col("_p").alias("_q"), F.col("_top").alias("root"), "_upper")
    same = F.col("_block") == F.col("_q")
    for n, c in enumerate(group):
        same = same & hashed[c].eqNullSafe(F.col(f"_g{n}"))
    return hashed.join(state, same).select(*kept, "position", F.concat("_own", "_upper").alias("siblings"), "root")


def _butterfly(state: DataFrame, group: list[str], height: int, fan: int, rounds: int) -> DataFrame:
    """The blocks of `state` with the root of their group as _top and the siblings of their ancestors as _upper.

    Numbers beyond the last block take part with nothing to give where a round needs their place, at most as many as
    there are blocks; they learn what they need in the rounds before.
    """
    blocks = F.ceil(F.col("_n") / (1 << height)).cast("long")
    digits = F.ceil((F.col("_levels") - height) / fan).cast("int")
    # the top digit needs no more than its own values
    step = F.when(digits > 1, F.call_function("shiftleft", F.lit(1).cast("long"), (digits - 1) * fan)).otherwise(F.lit(1).cast("long"))
    state = state.withColumns({"_blocks": blocks, "_filled": F.ceil(blocks / step).cast("long") * step})
    extra = state.where((F.col("_p") + F.col("_blocks") < F.col("_filled"))).withColumns({
        "_p": F.col("_p") + F.col("_blocks"), "_top": F.lit(None).cast("string")})
    state = state.unionByName(extra)

    @F.pandas_udf("top string, siblings array<string>")
    def ancestors(digit: pd.Series, levels: pd.Series, tops: pd.Series) -> pd.DataFrame:
        found = []
        for own, n, nodes in zip(digit, levels, tops):
            nodes = list(nodes)
            siblings, top = climb(nodes, n)
            # one that holds no node here has no ancestors to remember
            found.append((top, siblings[own] if own < len(nodes) else [""] * n))
        return pd.DataFrame(found, columns=["top", "siblings"])

    for r in range(rounds):
        digit = F.shiftright("_p", r * fan).bitwiseAND((1 << fan) - 1).cast("int")
        swap = Window.partitionBy(*group, F.shiftright("_p", (r + 1) * fan), F.col("_p") % (1 << (r * fan)))
        levels = F.least(F.lit(fan), F.greatest(F.lit(0), F.col("_levels") - height - r * fan)).cast("int")
        # null roots are left out: real subtrees stand without gaps, so places in the array are digits
        heard = F.transform(F.sort_array(F.collect_list(
            F.when(F.col("_top").isNotNull(), F.struct(digit.alias("d"), F.col("_top").alias("top")))).over(swap)), lambda x: x["top"])
        # a tree that is finished keeps its root: nobody differs in a digit above its own
        state = state.withColumns({"_digit": digit, "_n_up": levels, "_heard": heard}).withColumn(
            "_up", ancestors("_digit", "_n_up", "_heard")).withColumns({
                "_upper": F.concat("_upper", "_up.siblings"), "_top": F.col("_up.top")}).drop("_digit", "_n_up", "_heard", "_up")
    return state.where(F.col("_p") < F.col("_blocks"))


def folded(leaf: Column, siblings: Column, sides: Column) -> Column:
    """The root over ``leaf``: hashed level by level with the siblings, which stand left where ``sides`` is 1."""
    steps = F.zip_with(siblings, sides, lambda s, b: F.struct(s.alias("s"), b.alias("b")))
    return F.aggregate(steps, leaf, lambda done, x: F.sha2(F.when(x["b"] == 1, F.concat(x["s"], done)).otherwise(F.concat(done, x["s"])), 256))


def _sides(position: Column, siblings: Column) -> Column:
    """The binary digits of ``position``, one per level: 1 where the node is the right one of its pair."""
    return F.transform(siblings, lambda _, k: F.call_function("shiftright", position, k.cast("int")).bitwiseAND(1).cast("int"))


def row_leaf(columns: Sequence[Column]) -> Column:
    """H of a row's values: ``-`` for null, else UTF-8 bytes, a colon, the value as text."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def manifest(leaves: DataFrame, group: str = "lang", order: str = "doc_id", height: int = HEIGHT, fan: int = FAN) -> DataFrame:
    """``leaves`` (stored, with leaf) with subroot, root, siblings and sides of the whole path to the root.

    Leaves ascend by ``order`` in their group, nulls first, equal ones by leaf; groups ascend by value, null first, in
    the order of their bytes. An empty table gives an empty manifest. Proofs of a leaf: `folded`.
    """
    named = [F.col(f"`{c}`") for c in leaves.columns if c not in ("position", "siblings", "root", "subroot", "sides")]
    own = store(tree(leaves.select(*named), [group], [order], height=height, fan=fan), "subtrees")
    tops = store(own.where("position = 0").select(F.col(f"`{group}`").alias("_group"), F.col("root").alias("leaf")), "subroots")
    above = tree(tops, [], ["_group"], height=height, fan=fan).select(
        "_group", F.col("position").alias("_place"), F.col("siblings").alias("_above"), F.col("root").alias("_whole"))
    joined = own.join(above, own[group].eqNullSafe(above["_group"]))
    return joined.select(
        *named, F.col("root").alias("subroot"), F.col("_whole").alias("root"), F.concat("siblings", "_above").alias("siblings"),
        F.concat(_sides(F.col("position"), F.col("siblings")), _sides(F.col("_place"), F.col("_above"))).alias("sides"))


def document_manifest(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT, fan: int = FAN) -> DataFrame:
    """Manifest of documents and its check: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf holds doc_id, source, lang, n_chars and text; other columns are ignored. Where ``tampered`` holds, the check
    hashes a row whose n_chars has grown by 1 (null stays); everywhere it folds the row's leaf with its proof up to the
    root and compares. Texts are hashed where they are read and go no further.
    """
    tampered = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    whole = {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source"), "lang": F.col("lang").cast("string"),
             "n_chars": F.col("n_chars").cast("long"), "text": F.col("text")}
    changed = whole | {"n_chars": whole["n_chars"] + 1}
    leaves = docs.select(whole["doc_id"].alias("doc_id"), whole["lang"].alias("lang"), row_leaf(list(whole.values())).alias("leaf"),
                         F.when(tampered & whole["n_chars"].isNotNull(), row_leaf(list(changed.values()))).alias("read_leaf"))
    found = manifest(store(leaves, "leaves"), height=height, fan=fan)
    checked = found.withColumn("folded_root", folded(F.coalesce("read_leaf", "leaf"), F.col("siblings"), F.col("sides")))
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                          "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
