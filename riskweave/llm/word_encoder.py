"""The tokenizers library's ids of whole texts, a batch at a time, for the vocabulary that lower-cases and drops white space.

Texts of ASCII and Latin-1 characters are lower-cased and cut into the vocabulary's pieces (runs of letters, single
digits, runs of other signs, English contractions) by arrays over their bytes, equal pieces of a batch meet in a
dictionary, and only pieces not seen before reach the library, without its normaliser and splitter. For all other
texts the library works on their chunks between white space; texts with characters for which white space or lower case
depend on neighbours (`ODD`) go to it as a whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered per Python worker, and the longest that are; when there are too many, only short ones stay.
CACHE_PIECES, KEPT_BYTES, SHORT_BYTES = 300_000, 48, 8
#: White space, or what one side takes for it, that both sides may see differently, marks that combine with what stands
#: before them, letters whose lower case depends on their neighbours, and the start of a special token (fixed values).
ODD = re.compile("[%s]|<\\|" % "".join(
    f"{chr(a)}-{chr(b)}" for a, b in (
        (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x130, 0x130), (0x300, 0x36F), (0x3A3, 0x3A3), (0x1680, 0x1680), (0x180E, 0x180E),
        (0x2000, 0x200D), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x2060), (0x3000, 0x3000), (0xFEFF, 0xFEFF))))
SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
LOWER = bytes.maketrans(b"\t\n\v\f\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def _byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in byte-level vocabularies: visible Latin-1 for itself, others from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + n for n, b in enumerate(hidden)}


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of ASCII bytes, and of the second bytes after C2 and after C3."""
    ascii_ = np.full(256, OTHER, np.int8)
    ascii_[0x20] = SPACE
    ascii_[ord("a"): ord("z") + 1] = LETTER
    ascii_[ord("0"): ord("9") + 1] = DIGIT
    after = []
    for lead in (0x80, 0xC0):
        kinds = np.full(256, OTHER, np.int8)
        for k in range(0x80, 0xC0):
            c = chr(lead + k - 0x80)
            kinds[k] = LETTER if c.isalpha() else DIGIT if c.isnumeric() else OTHER
        after.append(kinds)
    return ascii_, after[0], after[1]


class WordEncoder:
    """`encode` gives ids and borders of a batch of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for own in (self.library, self.bare):
            own.no_truncation()
            own.no_padding()
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([])
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.letters = _byte_letters()
        self.kinds, self.after_c2, self.after_c3 = _classes()
        #: bytes that no text of ASCII and Latin-1 alone holds, and the separators that Python takes for white space
        self.foreign = np.zeros(256, bool)
        self.foreign[0xC0:] = self.foreign[0x1C:0x20] = True
        self.foreign[[0xC2, 0xC3]] = False
        self.pieces: dict[bytes, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    # --- what the library is asked for ---------------------------------------------------------------------------
    def _whole(self, text: str) -> bytes:
        return array(self.code, self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _by_chunks(self, text: str) -> bytes:
        """Ids of a text outside Latin-1."""
        if ODD.search(text):
            return self._whole(text)
        chunks = text.split()
        unknown = list({c for c in chunks if c not in self.chunks})
        coded = self.library.encode_batch_fast(unknown, add_special_tokens=False)
        fresh = {c: array(self.code, ids.ids).tobytes() for c, ids in zip(unknown, coded)}
        if len(self.chunks) + len(fresh) > CACHE_PIECES // 4:
            fresh.update((c, self.chunks[c]) for c in set(chunks) if c in self.chunks)
            self.chunks.clear()
        self.chunks.update((c, ids) for c, ids in fresh.items() if len(c) <= KEPT_BYTES)
        return b"".join([fresh[c] if c in fresh else self.chunks[c] for c in chunks])

    def _of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of distinct pieces."""
        known = self.pieces
        found = [known.get(p) for p in pieces]
        missing = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(missing), 5000):
            part = missing[at: at + 5000]
            asked = [pieces[k].decode("latin-1") if pieces[k].isascii() and pieces[k].isalpha()
                     else pieces[k].decode("latin-1").translate(self.letters) for k in part]
            for k, coded in zip(part, self.bare.encode_batch_fast(asked, add_special_tokens=False)):
                found[k] = array(self.code, coded.ids).tobytes()
        if len(known) + len(missing) > CACHE_PIECES:
            kept = [(p, ids) for p, ids in known.items() if len(p) <= SHORT_BYTES][-CACHE_PIECES // 2:]
            known.clear()
            known.update(kept)
        known.update((pieces[k], found[k]) for k in missing[:CACHE_PIECES // 2] if len(pieces[k]) <= KEPT_BYTES)
        return found

    # --- texts as arrays -----------------------------------------------------------------------------------------
    def _cut(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cases ``data`` in place; class of each byte, and where pieces begin. ``starts``: where texts begin."""
        kind = self.kinds[data]
        high = np.flatnonzero((data == 0xC2) | (data == 0xC3))
        if len(high):
            second = data[high + 1]
            latin = data[high] == 0xC3
            upper = latin & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
            data[high[upper] + 1] += 0x20
            own = np.where(latin, self.after_c3[second], self.after_c2[second])
            kind[high], kind[high + 1] = own, own
        begins = np.empty(len(data), bool)
        begins[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= (kind == DIGIT) & ((data < 0x80) | (data >= 0xC0))
        begins[starts] = True
        # an apostrophe that starts a run takes a contraction's letters with it
        marks = np.flatnonzero((data == 0x27) & begins)
        if len(marks):
            border = np.zeros(len(data) + 3, bool)
            border[starts] = True
            border[len(data):] = True
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            one, two = padded[marks + 1], padded[marks + 2]
            near = ~border[marks + 1]
            single = near & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            double = near & ~border[marks + 2] & (
                ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
            begins[marks[single | double] + 1] = False
            for chosen, size in ((single, 2), (double, 3)):
                after = marks[chosen] + size
                begins[after[after < len(data)]] = True
        return kind, begins

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), one after another, and len(texts) + 1 borders between texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        first, borders = int(offsets[0]), offsets - offsets[0]
        raw = texts.buffers()[2].slice(first, int(borders[-1])).to_pybytes() if borders[-1] else b""
        data = np.frombuffer(raw.translate(LOWER), np.uint8).copy()
        foreign = self.foreign[data]
        if len(data) > 1:
            foreign[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
            foreign[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        apart = np.unique(np.searchsorted(borders, np.flatnonzero(foreign), "right") - 1).tolist()
        for k in apart:  # blank here, and encoded below
            data[borders[k]: borders[k + 1]] = 0x20
        kind, begins = self._cut(data, borders[:-1][borders[:-1] < len(data)])
        shown = kind != SPACE
        places = np.flatnonzero(begins & shown)
        moved = np.concatenate([[0], np.cumsum(shown)])
        ends = np.append(moved[places], moved[-1]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(places), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[shown].tobytes())])
        coded = pieces.dictionary_encode()
        known = self._of_pieces(coded.dictionary.to_pylist())
        width = self.kind.itemsize
        parts = pa.array(known, pa.large_binary()).take(coded.indices)
        at = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, parts.offset * 8) if len(parts) else np.zeros(1, np.int64)
        counted = at[np.searchsorted(places, borders)] // width
        ids = np.frombuffer(parts.buffers()[2], self.kind, int(counted[-1])) if counted[-1] else np.empty(0, self.kind)
        if not apart:
            return ids, counted
        split = [ids[a:b] for a, b in zip(counted, counted[1:])]
        for k in apart:
            split[k] = np.frombuffer(self._by_chunks(texts[k].as_py()), self.kind)
        return np.concatenate(split), np.concatenate([[0], np.cumsum([len(s) for s in split])])


@lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
