import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskweave.llm import packing
from riskweave.llm.queries import QUERIES, WORD_BPE
from riskweave.llm.scratch import store


def greedy(lengths, limit):
    """Bins of the longest piece that fits, bin by bin."""
    left, bins = sorted(lengths), 0
    while left:
        room, bins = limit, bins + 1
        while fits := [n for n in left if n <= room]:
            left.remove(fits[-1])
            room -= fits[-1]
    return bins


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for _ in range(200):
        limit = rng.choice([7, 20, 100])
        lengths = [rng.randint(1, limit) if rng.random() < 0.7 else rng.randint(limit // 3, limit // 2) for _ in range(rng.randint(0, 60))]
        patterns = packing.plan(Counter(lengths), limit)
        used = Counter()
        for p in patterns:
            assert sum(p.lengths) <= limit and p.times > 0
            used.update({n: c * p.times for n, c in Counter(p.lengths).items()})
        assert used == Counter(lengths)
        assert -(-sum(lengths) // limit) <= sum(p.times for p in patterns) <= greedy(lengths, limit) + 1
    with pytest.raises(ValueError):
        packing.plan({8: 1}, 7)


def test_two_replace_the_shortest_where_they_fit_tighter():
    # greedy: 6 + 3 leaves a gap of 1 that nothing fits; 2 + 2 fill it and the place of the 3
    patterns = packing.plan({6: 1, 3: 1, 2: 2}, 10)
    assert patterns[0].lengths == (6, 2, 2)


def test_patterns_are_bounded_by_the_limit():
    patterns = packing.plan({n: 10**9 * (600 - n) + n for n in range(1, 513)}, 512)
    assert len(patterns) < 512 * 8
    total = sum(n * p.times for p in patterns for n in p.lengths)
    assert sum(p.times for p in patterns) <= 1.001 * total / 512


def check_places(rows, limit):
    taken = defaultdict(list)
    for r in rows:
        taken[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in taken.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    return len(taken)


def test_hot_lengths_and_repeated_rows(spark):
    rows = [(i % 5 if i % 2 else None, 0, 3 if i % 3 == 0 else i % 8 + 1, "x") for i in range(3000)]
    df = store(spark.createDataFrame(rows, "doc_id long, piece int, length long, offset string"), "t")
    got = packing.pack(df, 8).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in got) == sorted((r[0] or -1, r[2]) for r in rows)
    # the eights alone, 7 + 1, 6 + 2, 5 + 3, 4 + 4, and two of the other threes each
    assert check_places(got, 8) == 1625
    assert packing.pack(df.limit(0), 8).isEmpty()
    with pytest.raises(ValueError):
        packing.pack(df.withColumn("length", F.lit(None).cast("long")), 8)


def test_sequences_hold_the_ids(spark, documents):
    docs = documents([(1, "one two three"), (2, None), (3, ""), (3, ""), (None, "word " * 30), (4, "four")])
    pieces = store(packing.token_pieces(docs, WORD_BPE, 0, 8), "t")
    packed = store(packing.pack(pieces, 8), "t")
    check_places(packed.collect(), 8)
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        own = np.frombuffer(r["ids"], "<u4")
        assert whole[r["sequence_id"]][r["offset"]: r["offset"] + r["length"]] == own.tolist() and zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_op12_on_the_whole_table(spark, folder):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    got = QUERIES["op12_best_fit_packing"](spark, folder).collect()
    want = {}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start: start + 2048], "<u4")
            want[d.doc_id, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    total = sum(v[1] for v in want.values())
    assert check_places(got, 2048) <= 1.02 * total / 2048 + 1
