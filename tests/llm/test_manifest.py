import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from riskweave.llm import manifest
from riskweave.llm.queries import QUERIES
from riskweave.llm.scratch import store


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k: k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def path(all_levels, k):
    """(sibling, whether it stands left) or None per level."""
    steps = []
    for level in all_levels[:-1]:
        other = k ^ 1
        steps.append((level[other], other < k) if other < len(level) else None)
        k //= 2
    return steps


def fold(leaf, steps):
    for step in steps:
        leaf = H(leaf) if step is None else H(step[0], leaf) if step[1] else H(leaf, step[0])
    return leaf


def brute(rows, tampered):
    """doc_id, lang, source, n_chars, text -> what document_manifest returns, sorted."""
    def leaf(r, more=0):
        values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            steps = path(trees[g], k) + path(top, place)
            found = fold(leaf(r, 1) if tampered(r) else leaf(r), steps)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], H(*[s[0] for s in steps if s]), found, found == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


@pytest.mark.parametrize("height,fan,count", [(0, 1, 37), (1, 2, 90), (2, 1, 61), (10, 4, 50)])
def test_same_as_a_plain_tree(spark, height, fan, count):
    rng = random.Random(count)
    langs = ["en"] * 6 + ["de", "é", None, "", "fr-%d" % count]
    rows = [dict(doc_id=None if i % 19 == 0 else i // 2, text=None if i % 11 == 0 else "té " * (i % 4), lang=rng.choice(langs),
                 source="s", n_chars=None if i % 5 == 0 else i, root="clash", position="x") for i in range(count)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, root string, position string")
    found = manifest.document_manifest(df, df["doc_id"] % 3 == 0, height, fan)
    assert result(found) == brute(rows, lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)


@pytest.mark.parametrize("count", [1, 2, 3, 5, 9, 16, 17, 33, 64, 65, 100])
def test_butterfly_of_every_shape(spark, count):
    leaves = store(spark.createDataFrame([(i, H(str(i))) for i in range(count)], "k long, leaf string"), "t")
    want = levels([H(str(i)) for i in range(count)])
    for row in manifest.tree(leaves, [], ["k"], height=0, fan=2).collect():
        assert row["root"] == want[-1][0] and row["position"] == row["k"]
        assert row["siblings"] == [s[0] if s else "" for s in path(want, row["k"])]


def test_empty_and_one_row(spark, documents):
    assert manifest.document_manifest(documents([])).isEmpty()
    (row,) = manifest.document_manifest(documents([(7, "x")])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == H() and row["verified"]


def test_op13_on_the_whole_table(spark, folder):
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(QUERIES["op13_merkle_manifest"](spark, folder)) == brute(rows, lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0)
