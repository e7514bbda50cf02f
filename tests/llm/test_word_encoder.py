import random

import pyarrow as pa
import pytest

from riskweave.llm import word_encoder
from riskweave.llm.queries import WORD_BPE


@pytest.fixture(scope="module")
def encoder():
    return word_encoder.WordEncoder(WORD_BPE)


def same(encoder, texts):
    ids, borders = encoder.encode(pa.array(texts, pa.string()))
    want = encoder.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert len(borders) == len(texts) + 1
    return [t for t, w, a, b in zip(texts, want, borders, borders[1:]) if w.ids != ids[a:b].tolist()]


@pytest.mark.parametrize("pattern", ["X. x", "aX, b", "AXb5X'sX"])
def test_code_points_beside_stops_and_letters(encoder, pattern):
    points = [*range(0x2100), *range(0xFB00, 0xFE00), *range(0x0900, 0x0980), *range(0x10000, 0x10400)]
    assert same(encoder, [pattern.replace("X", chr(c)) for c in points]) == []


def test_contractions_digits_spaces_and_borders_of_texts(encoder):
    rng = random.Random(2)
    signs = "abstrevlmdABZ'''..,,  \n\t12!?-éÉßÇç×÷ªµº²¼«»¿\x00\x1f\x7f<|~€漢"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["don'", "t", "'", "s", "'s", "", None, "'r", "e", "<|startoftext|> <|endoftext|>x", "x" * 5000, "ΣΑΣ é", " " * 100_000]
    assert same(encoder, texts) == []


def test_slices_and_empty_batches(encoder):
    texts = pa.array(["one", "two é", None, "three"])
    ids, borders = encoder.encode(texts.slice(1, 2))
    assert ids[:borders[1]].tolist() == encoder.library.encode("two é", add_special_tokens=False).ids and borders[1] == borders[2]
    ids, borders = encoder.encode(texts.slice(0, 0))
    assert len(ids) == 0 and borders.tolist() == [0]


def test_cleared_memory_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(word_encoder, "CACHE_PIECES", 6)
    own = word_encoder.WordEncoder(WORD_BPE)
    for text in ("a b c d e f g h", "a b", "g h a longerthaneight", "漢 字 a", "字 b 漢 c", "longerthaneight a b c d e f g"):
        assert same(own, [text]) == []
