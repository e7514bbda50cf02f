import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import chat
from riskweave.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place string, segment int"


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    rows = []
    for conv in range(60):
        roles = (["system"] if conv % 4 == 0 else []) + ["user", "assistant"] * (1 + conv % 3)
        for turn, role in enumerate(roles):
            rows.append((conv, turn, role, ("long answer\n" * 20) if role == "assistant" else "short?" if role == "user" else "be brief", "x", 1))
    return chat.learn(spark.createDataFrame(rows, SCHEMA))


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_viterbi_is_the_best_of_all_paths(model):
    rng = np.random.default_rng(3)
    for n in range(1, 7):
        scores = rng.standard_normal((n, 3)) * 2
        score = lambda p: model.start[p[0]] + sum(scores[i, r] for i, r in enumerate(p)) + sum(model.step[a, b] for a, b in zip(p, p[1:]))
        assert tuple(model.decode(scores, model.start)) == max(itertools.product(range(3), repeat=n), key=score)
        best = model.reduce(scores)
        for first, last in itertools.product(range(3), repeat=2):
            paths = [p for p in itertools.product(range(3), repeat=n) if p[0] == first and p[-1] == last]
            want = max((score(p) - model.start[first] for p in paths), default=-np.inf)
            assert np.isclose(best[first, last], want) or (not paths and best[first, last] == -np.inf)


def test_segments_give_what_one_pass_gives(spark, model, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(1, n, None if rng.random() < 0.8 else "bot", "x" * int(rng.integers(0, 3000)) + "?" * int(rng.integers(0, 2))) for n in range(700)] + [(2, 0, None, "hi")]

    def total(found):
        ordered = chat._ordered(made(spark, rows)).where("conv_id = 1").orderBy("turn", "tie").collect()
        scores = model.scores(np.array([r.features for r in ordered]), np.array([r.given for r in ordered]))
        path = [chat.ROLES.index(found[r.turn]) for r in ordered]
        return model.start[path[0]] + sum(scores[i, r] for i, r in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:]))

    totals = []
    for size in (50, 10_000):
        monkeypatch.setattr(chat, "SEGMENT", size)
        totals.append(total({r.turn: r.role_found for r in chat.recover_roles(made(spark, rows), model).where("conv_id = 1").collect()}))
    assert np.isclose(*totals)


def test_markers_lines_and_neighbours_recover_roles(spark, model):
    rows = [(1, 0, None, "System: rules"), (1, 1, "?", "Human: hello"), (1, 2, None, "### Assistant:\nfine"), (2, 0, None, "what?"), (2, 1, None, "long answer\n" * 20),
            (3, 0, "Customer", "long answer\n" * 20), (3, 1, "BOT", "x?"), (4, None, None, None), (4, 1, None, ""), (None, 0, None, "AI: me"), (None, 0, None, "user: you"),
            (5, 0, None, "what?"), (5, 0, None, "what?"), (6, 0, None, "word " * 100_000)]
    got = chat.recover_roles(made(spark, rows), model)
    assert got.columns == ["conv_id", "turn", "role", "text", "role_found"] and got.count() == len(rows)
    found = {(r.conv_id, r.turn, (r.text or "")[:6]): r.role_found for r in got.collect()}
    assert [found[1, n, t] for n, t in ((0, "System"), (1, "Human:"), (2, "### As"))] == ["system", "user", "assistant"]
    assert found[2, 0, "what?"] == "user" and found[2, 1, "long a"] == "assistant"
    assert found[3, 0, "long a"] == "user" and found[3, 1, "x?"] == "assistant"  # given names stand
    assert found[None, 0, "AI: me"] == "assistant" and found[None, 0, "user: "] == "user"
    assert chat.recover_roles(made(spark, []), model).count() == 0
    assert np.isfinite(chat.learn(made(spark, [])).step).all()


def test_rendering(spark):
    rows = [("user", " User:  hi <|end|> "), ("assistant", None), ("system", "**System**: be\nkind")]
    got = spark.createDataFrame(rows, "role string, text string").select(chat.rendered(F.col("text"), F.col("role")).alias("r")).collect()
    assert [r.r for r in got] == ["<|user|>\nhi < |end|><|end|>\n", "<|assistant|>\n<|end|>\n", "<|system|>\nbe\nkind<|end|>\n"]


def test_raw_transcripts(model):
    text = "System: be nice\nUser: hi there\nhow are you?\n**Bot:** fine\n\nok\nHuman: bye"
    assert chat.parse_transcript(text, model) == [("system", "be nice"), ("user", "hi there\nhow are you?"), ("assistant", "fine\nok"), ("user", "bye")]
    assert chat.parse_transcript(None, model) == chat.parse_transcript(" \n", model) == []


def test_held_out_accuracy(spark, folder):
    true = {(r.conv_id, r.turn): r.role for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()}
    got = QUERIES["op3_chat_format"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(true)
    assert all(r.role == true[r.conv_id, r.turn] for r in got if not r.held_out)
    held = [r for r in got if r.held_out]
    assert sum(r.role == true[r.conv_id, r.turn] for r in held) / len(held) > 0.95


def test_the_query_never_sees_the_role_it_recovers(spark, tmp_path):
    rows = [(conv, turn, role, "long answer\n" * 20 if role == "assistant" else "short?") for conv in range(60) for turn, role in enumerate(["user", "assistant"] * 2)]
    rows += [(100, 0, "assistant", "short?"), (100, 1, "user", "long answer\n" * 20)] + [(None, 0, "assistant", "short?")]  # wrong on purpose
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op3_chat_format"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.held_out for r in got)
    assert all(r.role == ("assistant" if "long" in r.rendered else "user") for r in got)


def test_every_line_of_a_transcript_is_an_observation(spark, model):
    texts = [(1, "short?\nlong answer\nlong answer\n\nshort?\nlong answer", "x"), (2, "User: hi\nhow are you?\nAI: fine\nok", "x"), (None, "short?", "x"), (3, None, "x"), (4, " \n", "x")]
    got = chat.parse_transcripts(spark.createDataFrame(texts, "conv_id long, text string, role string"), model)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, 0, "user", "short?"), (1, 1, "assistant", "long answer\nlong answer"), (1, 2, "user", "short?"), (1, 3, "assistant", "long answer"),
        (2, 0, "user", "hi\nhow are you?"), (2, 1, "assistant", "fine\nok"), (None, 0, "user", "short?")], key=str)
