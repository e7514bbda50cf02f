"""Token counts per field and section, from one encoding of the whole document.

The fields of a row are joined to one document and encoded once. Every token spans some bytes of it; the spans are
joined as intervals with those of the fields and of the sections (lines) inside them, both sorted and without gaps. A
token that crosses a border goes to one side by an explicit rule: ``start``, where its first byte lies, or ``most``,
where most of its bytes lie, the earlier side on a tie.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.bpe import PATTERN
from riskweave.llm.scratch import small_batches

SEPARATOR = "\n\n"
#: White space as the splitter knows it.
LONG_RUN = regex.compile(r"\p{White_Space}{1000,}")


class SpanEncoder:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.ordinary = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        #: for runs of white space, each one piece whatever its length
        self.run = tiktoken.Encoding("runs", pat_str=r"\s+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text. The library's splitter fails on runs of white space of some hundred thousand
        characters: long ones are cut off where it would, before the last one if more text follows."""
        ids, at = [], 0
        for run in LONG_RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.ordinary(text[at: run.start()])
            ids += self.run(text[run.start(): end])
            at = end
        return ids + self.ordinary(text[at:])

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes."""
        return np.cumsum(self.size[np.array(self.encode(text), np.int64)])


@lru_cache(2)
def span_encoder(path: str) -> SpanEncoder:
    return SpanEncoder(path)


def owners(token_ends: np.ndarray, span_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For each token the span that gets it, and whether it crosses a border. Spans are not empty."""
    token_starts = np.concatenate([[0], token_ends[:-1]]).astype(np.int64)
    first = np.searchsorted(span_ends, token_starts, "right")
    last = np.searchsorted(span_ends, token_ends - 1, "right")
    crossing = first != last
    if rule == "most":
        for n in np.flatnonzero(crossing).tolist():
            edges = np.concatenate([[token_starts[n]], span_ends[first[n]: last[n]], [token_ends[n]]])
            first[n] += int(np.argmax(np.diff(edges)))
    return first, crossing


def attribute(values: Sequence[str | None], encoder: SpanEncoder, rule: str) -> tuple[int, int, int, list[int], list[list[int]]]:
    """Tokens of the document, of separators, and that cross a border; per field; per line of each field."""
    document, span_ends, span_field = [], [], []
    done = 0
    for n, value in enumerate(values):
        if n:
            document.append(SEPARATOR)
            done += len(SEPARATOR)
            span_ends.append(done)
            span_field.append(-1)
        data = (value or "").encode("utf-8", "replace")
        lines = data.split(b"\n")
        lines = [line + b"\n" for line in lines[:-1]] + lines[-1:]
        for line in filter(None, lines):
            done += len(line)
            span_ends.append(done)
            span_field.append(n)
        document.append(data.decode())
    fields, sections = [0] * len(values), [[] for _ in values]
    if not span_ends:
        return 0, 0, 0, fields, sections
    ends = encoder.ends("".join(document))
    owner, crossing = owners(ends, np.array(span_ends, np.int64), rule)
    counts = np.bincount(owner, minlength=len(span_ends)).tolist()
    separators = 0
    for field, count in zip(span_field, counts):
        if field < 0:
            separators += count
        else:
            fields[field] += count
            sections[field].append(count)
    return len(ends), separators, int(crossing.sum()), fields, sections


def token_counts(docs: DataFrame, vocabulary: str, fields: Sequence[str] = ("source", "lang", "text"), rule: str = "start",
                 key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_tokens, n_crossing, separator_tokens, field_tokens and section_tokens.

    field_tokens holds a count per field, section_tokens per field the counts of its lines (each with its line end),
    both in the order given; with separator_tokens, the tokens of the empty lines between fields, they sum up to
    n_tokens. Null fields count as empty: no tokens and no lines. Strings of special tokens are ordinary text. Texts of
    any length are encoded whole; rows are independent, so repeated rows, null keys and empty tables pass through, and
    columns that are not named are ignored.
    """
    if rule not in ("start", "most"):
        raise ValueError("rule is start or most")
    inputs = [f"f{n}" for n in range(len(fields))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = span_encoder(vocabulary)
        for frame in frames:
            rows = [attribute(values, own, rule) for values in zip(*[frame[c] for c in inputs])]
            yield pd.DataFrame({key: frame["key"], "n_tokens": [r[0] for r in rows], "n_crossing": [r[2] for r in rows],
                                "separator_tokens": [r[1] for r in rows], "field_tokens": [r[3] for r in rows],
                                "section_tokens": [r[4] for r in rows]})

    return small_batches(docs).select(F.col(f"`{key}`").cast("long").alias("key"), *[
        F.col(f"`{f}`").cast("string").alias(c) for f, c in zip(fields, inputs)]).mapInPandas(
        run, f"`{key}` long, n_tokens long, n_crossing long, separator_tokens long, field_tokens array<long>, section_tokens array<array<long>>")
