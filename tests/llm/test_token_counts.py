import random

import numpy as np
import pytest

from riskweave.llm import token_counts as tc
from riskweave.llm.queries import BYTE_RANKS, QUERIES


@pytest.fixture(scope="module")
def encoder():
    return tc.SpanEncoder(BYTE_RANKS)


def brute(values, encoder, rule):
    """Byte by byte: the owner of every byte, then the owner of every token."""
    parts = []
    for n, value in enumerate(values):
        if n:
            parts += [(-1, 0)] * len(tc.SEPARATOR)
        line = 0
        for byte in (value or "").encode():
            parts.append((n, line))
            line += byte == 10
    ids = encoder.encode(tc.SEPARATOR.join(v or "" for v in values))
    fields, lines, separators, crossing, at = [0] * len(values), {}, 0, 0, 0
    for i in ids:
        own = parts[at: at + int(encoder.size[i])]
        at += len(own)
        # two separators in a row are different spans only if a field stands between them
        crossing += len(set(own)) > 1
        owner = own[0] if rule == "start" else max(dict.fromkeys(own), key=own.count)
        if owner[0] < 0:
            separators += 1
        else:
            fields[owner[0]] += 1
            lines[owner] = lines.get(owner, 0) + 1
    return len(ids), separators, crossing, fields, lines


@pytest.mark.parametrize("rule", ["start", "most"])
def test_same_as_byte_by_byte(encoder, rule):
    rng = random.Random(9)
    for _ in range(300):
        values = [None if rng.random() < 0.05 else "x" + "".join(rng.choices("ab \n\n\n  é漢😀.", k=rng.randint(0, 40))) for _ in range(3)]
        if None in values:  # the brute force can't tell neighbouring separators apart
            continue
        total, separators, crossing, fields, sections = tc.attribute(values, encoder, rule)
        want = brute(values, encoder, rule)
        assert (total, separators, crossing, fields) == want[:4]
        assert {(f, n): c for f, own in enumerate(sections) for n, c in enumerate(own) if c} == want[4]
        assert total == separators + sum(fields) and fields == [sum(s) for s in sections]


def test_rules_differ_where_a_token_crosses():
    ends, spans = np.array([3, 7, 9, 12]), np.array([1, 8, 12])  # the first and the third token cross, the third evenly
    for rule, want in (("start", [0, 1, 1, 2]), ("most", [1, 1, 1, 2])):
        owner, crossing = tc.owners(ends, spans, rule)
        assert owner.tolist() == want and crossing.tolist() == [True, False, True, False]


def test_nulls_repeats_long_texts_and_clashing_columns(spark, encoder):
    rows = [(1, None, None, None), (2, "s", "en", ""), (3, "s", "en", "a b\nc"), (3, "s", "en", "a b\nc"), (None, "s", None, "<|endoftext|>"), (4, "s", "en", "word\n" * 30_000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, lang string, text string, n_tokens int")
    got = tc.token_counts(docs, BYTE_RANKS).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == r.separator_tokens + sum(r.field_tokens) and [sum(s) for s in r.section_tokens] == r.field_tokens
    by_id = {r.doc_id: r for r in got}
    assert len(by_id[4].section_tokens[2]) == 30_000 and by_id[1].field_tokens == [0, 0, 0] and by_id[None].field_tokens[2] > 1
    assert tc.token_counts(docs.limit(0), BYTE_RANKS).count() == 0
    with pytest.raises(ValueError):
        tc.token_counts(docs, BYTE_RANKS, rule="other")


def test_whole_table(spark, folder, encoder):
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = brute([d.source, d.lang, d.text], encoder, "start")
        r = got[d.doc_id]
        assert (r.n_tokens, r.separator_tokens, r.n_crossing, [r.source_tokens, r.lang_tokens, r.text_tokens]) == want[:4]


def test_spans_are_those_of_the_tokens(encoder):
    assert encoder.ends("héllo wörld")[-1] == len("héllo wörld".encode())


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "x" + "\n" * 2_000_000, "\t" * 2_000_000, "a" + " \n" * 1_000_000 + "b"])
def test_millions_of_blanks_line_ends_and_tabs(spark, encoder, text):
    from riskweave.llm.bpe import encoder as exact
    from riskweave.llm.queries import BYTE_BPE

    ids = encoder.encode(text)
    assert ids == exact(BYTE_BPE).encode(text)
    df = spark.createDataFrame([(1, "s", "en", text)], "doc_id long, source string, lang string, text string")
    assert tc.token_counts(df, BYTE_RANKS, ("text",)).first()["n_tokens"] == len(ids)


def test_runs_just_over_the_cut_equal_the_library(encoder):
    for run in (" " * 1000, "\n" * 1001, "\u2003" * 1000, " \x1c" * 600, "\u3000" * 999 + " "):
        for text in (run, run + "x", "x" + run, "x" + run + "'s y " + run + "1", run + "\n"):
            assert encoder.encode(text) == encoder.ordinary(text)
