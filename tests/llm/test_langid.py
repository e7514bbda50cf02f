import zlib

from riskweave.llm import langid
from riskweave.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    import os
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        return
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op9_language_id"](spark, folder).collect()
    assert len(got) == len(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) > 0.96
    assert sum(r.rejected for r in got) / len(got) < 0.02


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(n, f"word{n} and more text {n}", "xx" if zlib.crc32(str(n).encode()) % 5 == 0 else "yy") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.learn(docs)) == {"yy"}


def test_nulls_ties_long_texts_and_clashing_columns(spark):
    learned = {"aa": b"alpha beta gamma delta epsilon zeta", "bb": b"uno dos tres cuatro cinco seis siete"}
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "Alpha, BETA! gamma delta epsilon", None), (None, "cuatro cinco seis siete", "x"),
            (5, "cuatro cinco seis " * 9000, "x"), (6, "q", "x"), (6, "q", "x")]
    docs = spark.createDataFrame([(*r, "was") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    got = langid.identify(docs, learned)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score", "lang_rejected"]
    found = {(r.doc_id, (r.text or "")[:3]): (r.lang_pred, r.lang_rejected) for r in got.collect()}
    assert found[1, ""] == found[2, ""] == found[3, "123"] == ("und", True)
    assert found[4, "Alp"] == ("aa", False) and found[None, "cua"] == ("bb", False) and found[5, "cua"] == ("bb", False)
    assert found[6, "q"] == ("aa", True) and got.count() == len(rows)  # equally large: narrow, first by name
    assert langid.learn(docs.limit(0)) == {} and langid.identify(docs.limit(0), learned).count() == 0
    assert langid.identify(docs, {}).where("lang_pred <> 'und'").count() == 0


def test_junk_and_unlearned_languages_are_rejected(spark, folder):
    import random
    rng = random.Random(1)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 300))) for _ in range(50)]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    learned = langid.learn(docs)
    margin = langid.learned_margin(learned)
    assert margin > 0.02
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(junk)], "doc_id long, text string")
    assert langid.identify(rows, learned, margin).where("NOT lang_rejected").count() <= 1
    without = {lang: text for lang, text in learned.items() if lang != "es"}
    spanish = langid.identify(docs.where("lang = 'es'"), without, langid.learned_margin(without))
    assert spanish.where("NOT lang_rejected").count() <= 0.1 * spanish.count()
    found = QUERIES["op9_language_id"](spark, folder).join(docs, "doc_id")
    assert found.where("lang_pred = lang AND rejected AND length(text) > 200").count() == 0
    assert langid.learned_margin({}) == langid.learned_margin({"aa": b"alpha"}) == langid.DEFAULT_MARGIN
