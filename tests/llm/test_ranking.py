import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import ranking
from riskweave.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) rows, sorted."""
    split = [(i, Counter(terms(t))) for i, t in docs]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    n_docs, n_terms = len(split), sum(s[2] for s in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in split:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def test_skipping_never_changes_the_best():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 8))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 7))):
            docs = np.flatnonzero(rng.random(n) < rng.choice([0.01, 0.2, 0.9]))
            if len(docs):
                scores = rng.integers(1, rng.choice([3, 50, 1000]), len(docs))
                lists.append(ranking.Postings(docs, scores))
                total[docs] += scores
        floor = int(rng.choice([1, 1, 40]))
        order = np.lexsort([np.arange(n), -total])
        want = [d for d in order.tolist() if total[d] >= floor][:k]
        docs, scores = ranking.best_documents(lists, n, k, floor, short=int(rng.integers(0, 60)), span=int(rng.integers(1, 100)))
        assert docs.tolist() == want and scores.tolist() == total[want].tolist()


def test_ranges_that_cannot_reach_the_best_are_not_scored(monkeypatch):
    scores = np.ones(4000, np.int64)
    scores[:30] = 100
    asked = []
    within = ranking.Postings.within
    monkeypatch.setattr(ranking.Postings, "within", lambda self, a, b: asked.append(a) or within(self, a, b))
    docs, _ = ranking.best_documents([ranking.Postings(np.arange(4000), scores)], 4000, 20)
    assert docs.tolist() == list(range(20)) and asked == [0]


@pytest.mark.parametrize("segment_docs", [1, 7, 1000])
def test_same_as_brute_force(spark, documents, segment_docs):
    rng = random.Random(segment_docs)
    words = ["the"] * 12 + ["of", "Zürich", "x9", "naïve", "RARE", "42"] + [f"w{n}" for n in range(30)]
    docs = [(i, "-".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    docs += [(None, "the rare"), (None, None), (5, docs[5][1]), (400, "rare " * 3000), (401, ""), (402, "?!")]
    items = [(1, "the RARE the w3"), (2, None), (3, "unknown"), (4, "Zürich of w1 w2 w3"), (4, "Zürich of w1 w2 w3"), (None, "x9")]
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, rank string")
    index = ranking.build_index(documents(docs), segment_docs=segment_docs)
    want = brute(docs, items)
    assert found(ranking.search(index, table)) == want
    assert found(ranking.search(index, table, block_terms=3)) == want
    assert found(ranking.search(index, table, k=3)) == brute(docs, items, 3)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranking.search(ranking.build_index(documents([])), items).isEmpty()
    assert ranking.search(ranking.build_index(documents([(1, None)])), items).isEmpty()
    assert ranking.search(ranking.build_index(documents([(1, "a")])), items.limit(0)).isEmpty()


def test_op11_on_the_whole_table(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert found(QUERIES["op11_lexical_search"](spark, folder)) == brute(docs, items)
