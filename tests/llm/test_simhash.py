import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import simhash
from riskweave.llm.graph import connected_components


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """doc_id -> smallest doc_id reachable."""
    ids = sorted(fps)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprint_is_that_of_the_definition():
    rng = random.Random(1)
    for text in (None, "", " \t\n", "One", "one TWO three", "É b C d e f", *[" ".join(rng.choices("ab cd Ef g h\ti", k=n)) for n in range(1, 40)]):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_spark_hashes_shingles_alike(spark):
    assert spark.sql("SELECT xxhash64('a b c d') AS h").first().h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("parts,order", [(3, 4), (2, 5), (4, 3)])
def test_every_pair_within_the_distance_meets_at_a_home(parts, order):
    rng = np.random.default_rng(parts)
    cover = simhash.slices(parts, order, 4)
    for _ in range(60):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, 4, replace=False).tolist():
            b ^= 1 << bit
        homes, visits = set(), set()
        for n, part in enumerate(cover):
            for fps, anchors, home in part.visits(np.array([a, b], np.uint64)):
                for fp, anchor, at_home in zip(fps.tolist(), anchors.tolist(), home.tolist()):
                    visits.add((fp, n, anchor))
                    homes |= {(fp, n, anchor)} if at_home else set()
        assert sum(h[0] == a for h in homes) == parts
        assert any((b, n, anchor) in visits for fp, n, anchor in homes if fp == a)


@pytest.mark.parametrize("cell_rows", [2_000, 8])
def test_groups_are_those_of_all_pairs(spark, documents, cell_rows):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 60))) for _ in range(12)]
    rows = []
    for n in range(160):
        text = rng.choice(texts).split()
        if rng.random() < 0.7:
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((n, " ".join(text)))
    rows += [(200, None), (201, ""), (202, "  "), (203, rows[0][1]), (204, "x " * 30_000), (None, "alone"), (None, rows[0][1])]
    got = {r["doc_id"]: r for r in simhash.simhash_groups(documents(rows), cell_rows=cell_rows).collect() if r["doc_id"] is not None}
    fps = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    want = brute_components(fps)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert len(set(want.values())) > 5 and len(want) - len(set(want.values())) > 50


def test_one_row_of_each_group_stays(spark, documents):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text), (1, text), (1, text), (7, "other words stand here alone"), (None, "no id at all here"), (None, "no id at all here"), (9, None), (8, "")]
    kept = simhash.keep_one(documents(rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([
        (1, text), (7, "other words stand here alone"), (None, "no id at all here"), (8, "")], key=str)
    assert kept.columns == documents(rows).columns
    assert simhash.keep_one(documents([])).count() == 0 == simhash.simhash_groups(documents([])).count()


def test_kept_rows_are_those_of_the_groups(spark, documents):
    rng = random.Random(9)
    texts = [" ".join(f"t{n}w{i}" for i in range(40)) for n in range(30)]
    ids = [*range(100), *[5, 5, 17, 17, 17], None, None]
    rows = [(i, rng.choice(texts)) for i in ids] + [(40, texts[0]), (40, texts[1])]
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(text, []).append(i)
    want = sorted((min((i for i in own if i is not None), default=None), text) for text, own in groups.items())
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(documents(rows)).collect()) == want


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (1, 2), (2, 1), (None, 3)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for a, b in links if a is not None and a != b for x in (a, b)}
    for _ in range(len(label)):
        for a, b in links:
            if a is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark, folder):
    from riskweave.llm.queries import QUERIES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op8_simhash_groups"](spark, folder)
    want = brute_components({r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()})
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert got.where(F.length("fingerprint") != 16).count() == 0
