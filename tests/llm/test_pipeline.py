import hashlib

import numpy as np

import corpus_pipeline as cp
from riskweave.llm import decontaminate, langid, simhash
from riskweave.llm.scratch import store


def test_run_is_the_stages_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.Classifier(langid.learn(docs))
    kept = {i: r.text for i, r in rows.items() if model.classify(r.text)[1] >= 0.001}
    prints = {i: simhash.fingerprint(t) for i, t in sorted(kept.items())}
    label = {i: i for i in prints}
    for _ in prints:
        before = dict(label)
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    space = lambda words: b" " + b" ".join(words) + b" "
    want = {i for i in label if label[i] == i and not any(space(t) in space(decontaminate.words_of(kept[i])) for t in items)}
    got = {r.doc_id: r for r in cp.run(spark, folder).collect()}
    assert set(got) == want and 20 < len(want) < len(rows)
    assert all(got[i].decoded_sha256 == hashlib.sha256(kept[i].encode()).hexdigest() for i in want)


def test_stages_take_odd_rows_and_empty_tables(spark, folder, documents):
    assert [n for n, _ in cp.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    whole = spark.read.parquet(f"{folder}/documents.parquet")
    odd = documents([(9001, None), (9002, ""), (None, "word " * 20_000), (9004, "12 34"), (9005, "a text"), (9005, "a text")], lang=None)
    for docs in (whole.limit(0), odd):
        docs = docs.unionByName(whole, allowMissingColumns=True) if docs is odd else docs
        for n, (_, stage) in enumerate(cp.STAGES):
            before, docs = docs, store(stage(spark, docs, folder), f"test{n}")
            assert docs.count() <= before.count()
            if n < 3:
                assert docs.columns == cp.COLUMNS
    assert docs.where("doc_id IN (9001, 9002, 9004)").count() == 0 and docs.where("doc_id = 9005").count() <= 1
    assert np.isfinite(docs.count())
