import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskweave.llm import bpe, token_files
from riskweave.llm.queries import BYTE_BPE, QUERIES, WORD_BPE


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def texts():
    rng = random.Random(5)
    alphabets = ["ab", "the in er ", " \t\n'stre", "éüñ漢字😀á 123", "".join(map(chr, range(1, 700))), "a", " ", "Zz.,!? "]
    made = ["".join(rng.choices(a, k=rng.randint(0, 120))) for a in alphabets for _ in range(40)]
    return made + ["", "<|endoftext|>", "a<|endoftext|>b <|endoftext|", "x" * 3000, "don't we'll", "\x00\x1c\x85\xa0 y"]


def test_ids_and_decoding_are_those_of_the_library(library):
    own = bpe.PrefixEncoder(BYTE_BPE)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_compatible_pairs_are_those_that_stay_apart(library):
    own, rng = bpe.PrefixEncoder(BYTE_BPE), random.Random(6)
    tokens = [i for i, b in own.bytes.items() if b.isalpha() and b.isascii()]
    for _ in range(2000):
        pair = rng.choices(tokens, k=2)
        text = b"".join(own.bytes[i] for i in pair).decode()
        assert own.compatible(*pair) == (library.encode(text, add_special_tokens=False).ids == pair) or any(
            library.encode(own.bytes[i].decode(), add_special_tokens=False).ids != [i] for i in pair)


def test_nulls_repeats_and_empty_tables(spark, documents):
    rows = [(1, None), (2, ""), (3, "hello"), (3, "hello"), (None, "hello"), (5, "word " * 20_000)]
    got = bpe.bpe_round_trip(documents(rows), BYTE_BPE, keep_ids=True).collect()
    assert sorted([r.doc_id for r in got], key=str) == sorted([i for i, _ in rows], key=str)
    for r in got:
        assert r.decoded == {1: "", 2: "", 5: "word " * 20_000}.get(r.doc_id, "hello")
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.bpe_round_trip(documents([]), BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        bpe.PrefixEncoder(WORD_BPE)


def test_whole_table(spark, folder, library):
    got = {r.doc_id: r for r in QUERIES["op6_bpe_round_trip"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


# --- token files ---------------------------------------------------------------------------------------------------
def slow_crc32c(data):
    register = 0xFFFFFFFF
    for byte in data:
        register ^= byte
        for _ in range(8):
            register = (register >> 1) ^ (0x82F63B78 if register & 1 else 0)
    return register ^ 0xFFFFFFFF


def test_checksum_and_frames():
    rng = random.Random(7)
    messages = [b"123456789", *[rng.randbytes(n) for n in (0, 1, 255, 256, 257, 511, 513, 5000)], bytes(40)]
    assert token_files.crc32c()(messages) == [slow_crc32c(m) for m in messages]
    assert token_files.crc32c()([b"123456789"]) == [0xE3069283]  # the published check value
    records = token_files.framed(messages)
    assert token_files.unframe(records) == messages
    for at in (0, 9, 13, len(records[-1]) - 1):
        broken = bytearray(records[-1])
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.unframe([bytes(broken)])


def test_files_hold_documents_in_order(spark, documents, tmp_path):
    rows = [(5, "five five"), (1, None), (3, ""), (3, ""), (None, "none"), (9, "nine " * 9000), (7, "seven")]
    index = token_files.write_token_files(documents(rows), f"file://{tmp_path}/t", WORD_BPE)
    records = token_files.digest_token_files(index, f"file://{tmp_path}/t").collect()
    records.sort(key=lambda r: r.start)
    assert [r.doc_id for r in records] == [None, 1, 3, 3, 5, 7, 9]
    starts = [0]
    for r in records:
        starts.append(starts[-1] + r.n_tokens)
    assert [r.start for r in records] == starts[:-1]
    assert [r.n_tokens for r in records if r.doc_id in (1, 3)] == [1, 1, 1]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_tokens")]
    shuffled = token_files.read_token_files(index.orderBy("n_tokens"), f"file://{tmp_path}/t").collect()
    assert sorted(np.frombuffer(r.data, "<u2").tolist()[-1] for r in shuffled) == [1] * 7
    assert token_files.round_trip(documents([]), WORD_BPE).count() == 0


def test_token_files_of_the_whole_table(spark, folder):
    import zlib
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    got = {r.doc_id: r for r in QUERIES["op10_token_files"](spark, folder).collect()}
    start = 0
    for d in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = [*tokenizer.encode(d.text, add_special_tokens=False).ids, 1]
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
