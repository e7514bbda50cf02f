import random

import numpy as np

from riskweave.llm import decontaminate as dc
from riskweave.llm.queries import QUERIES


def brute(doc, item):
    """Word edits between the item and the best stretch of the document."""
    row = [0] * (len(doc) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(doc):
            new.append(min(row[j] + (v != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute_matches(docs, items, share=0.2):
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = dc.words_of(text), dc.words_of(item)
            if len(b) < dc.MIN_WORDS:
                if b and a == b:
                    out[d, i] = 0
            elif (edits := brute(a, b)) <= int(share * len(b) + 1e-9):
                out[d, i] = edits
    return out


def planted(rng, items, words, count, most):
    docs = []
    for n in range(count):
        item = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, int(most * len(item)))):
            at = rng.randrange(len(item))
            kind = rng.randrange(3)
            if kind == 0:
                item[at] = rng.choice(words)
            elif kind == 1:
                item.insert(at, rng.choice(words))
            elif len(item) > 1:
                del item[at]
        text = rng.choices(words, k=rng.randint(0, 80))
        at = rng.randint(0, len(text))
        docs.append((n, " ".join(text[:at] + item + text[at:])))
    return docs


def test_recall_against_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(5, 60)))) for n in range(30)]
    items += [(100, items[0][1]), (101, "w1"), (102, "w1 w2 w3"), (103, None), (104, ""), (None, items[1][1])]
    docs = planted(rng, [i for i in items[:30]], words, 150, 0.25) + [(500, "W1, w2! w3"), (501, "w1"), (502, None), (503, ""), (504, "w1 w2 w3 w4")]
    docs += [(600, " ".join(rng.choices(words, k=40_000)) + " " + items[5][1])] * 2
    want = brute_matches(docs, items)
    found = dc.contaminated(
        spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, found string"),
        spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want) and len(want) > 100
    assert {i for d, i in got if d in (500, 501, 504)} == {101, 102}
    assert sum(r.doc_id == 600 and r.item_id == 5 for r in found) == 2


def test_blocks_give_what_one_set_of_tables_gives(spark, monkeypatch, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, dc.contaminated(docs, items).collect()))
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 9)
    assert sorted(map(tuple, dc.contaminated(docs, items).collect())) == whole
    held = {row[0] for row in whole}
    assert {r.doc_id for r in dc.decontaminated(docs, items).collect()} == {r.doc_id for r in docs.collect()} - held


def test_the_walk_keeps_close_texts_close():
    own = dc.LengthClass(40, np.array([0]), 8)
    own.add_walk(0)
    rng = np.random.default_rng(1)
    text = rng.integers(1, 500, 200)
    near, far = text.copy(), rng.integers(1, 500, 200)
    near[5] = 777
    same = [int((own.keys(text, np.array([0]), 0) == own.keys(other, np.array([0]), 0)).sum()) for other in (text, near, far)]
    assert same[0] == dc.KEYS_PER_WALK and same[0] >= same[1] > same[2]


def test_empty_tables_and_clean_rows(spark, documents):
    items = spark.createDataFrame([(1, "five words are in here")], "item_id long, text string")
    docs = documents([(1, "so five words are in here now"), (2, "nothing"), (None, None), (3, "nothing"), (3, "nothing")])
    assert dc.contaminated(docs, items.limit(0)).count() == 0 == dc.contaminated(docs.limit(0), items).count()
    kept = dc.decontaminated(docs, items)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 3, None] and kept.columns == docs.columns


def test_whole_table(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, folder).collect()}
    space = lambda t: b" " + b" ".join(dc.words_of(t)) + b" "
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if space(i.text) in space(d.text)}
    assert exact and got == exact  # the table holds passages unchanged


def test_short_items_unspaced_scripts_and_unicode_punctuation(spark, tmp_path):
    zh = "人工智能正在改变我们的生活方式和工作方式"
    th = "ภาษาไทยไม่มีช่องว่างระหว่างคำ"
    items = [(1, "capital of France"), (2, zh), (3, "one two three four five six"), (4, "Paris"), (5, "東京"), (6, th), (7, "w w")]
    docs = [(10, "what is the Capital of France?"), (11, f"他说：“{zh}。”然后离开了"), (12, "“one two three”—four five… six"), (13, "in Paris, paris"), (14, "私は東京へ行く"),
            (15, f"ดู{th}นะ"), (16, "capital of the France"), (17, zh[:9] + "X" + zh[10:]), (18, "w"), (19, None), (20, "京東")]
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = QUERIES["op7_decontaminate"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == {(10, 1, 0), (11, 2, 0), (12, 3, 0), (13, 4, 0), (14, 5, 0), (15, 6, 0), (17, 2, 1)}
    assert len(found) == 7 and {r.end_word for r in found if r.doc_id in (10, 13)} == {6, 2}
    assert dc.words_of("Don't “stop”—now") == [b"don", b"t", b"stop", b"now"]
