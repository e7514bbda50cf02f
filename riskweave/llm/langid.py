"""Language identification by compression.

One zstandard raw-content dictionary per language is filled with text of that language. Texts are reduced to lower-case
words, cut into blocks, and every block is compressed with every dictionary; the language with the smallest sum is
chosen. A text is rejected when the runner-up is closer than a margin, or when there is no letter to judge. The margin
comes from excerpts of known language, judged by dictionaries that don't hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import small_batches

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}+")
#: Compressed together; long texts would outgrow the dictionary.
BLOCK_BYTES = 2048
LEVEL = 6
#: More values of lang than this are an error: they are no languages.
MAX_LANGUAGES = 1000
#: Margin where none was learned, share of the clean texts' margin that is learned, and excerpts it is learned from.
DEFAULT_MARGIN, MARGIN_SHARE, MARGIN_EXCERPTS = 0.001, 0.5, 20_000


def held_out(doc_id: Column) -> Column:
    """One fifth of the ids, by crc32; never learned from. False for null ids, which aren't learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def plain_words(text: str) -> bytes:
    """The words of a text in lower case, one space apart; empty without letters."""
    return " ".join(WORD.findall(text.lower())).encode()


def learn(docs: DataFrame, excerpts: int = 300, excerpt_chars: int = 400) -> dict[str, bytes]:
    """A dictionary per language from ``docs`` (doc_id, text, lang).

    The bounded sample: per language at most ``excerpts`` different rows, those with the smallest hash of doc_id among
    the rows that aren't held out, each giving ``excerpt_chars`` characters from its middle. Rows without text, lang or
    doc_id are not learned from. An empty table gives no dictionaries.
    """
    usable = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    if not sizes:
        return {}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 4 * excerpts / n))])
    start = F.greatest(F.lit(1), ((F.length("text") - excerpt_chars) / 2).cast("int"))
    rows = (usable.select("lang", "text", draw.alias("draw")).where(F.col("draw") < share[F.col("lang")])
            .select("lang", "draw", F.col("text").substr(start, F.lit(excerpt_chars)).alias("excerpt"))
            .orderBy("draw", "excerpt").limit(8 * excerpts * len(sizes)).collect())
    found: dict[str, dict[str, None]] = {}
    for row in rows:
        own = found.setdefault(row["lang"], {})
        if len(own) < excerpts:
            own[row["excerpt"]] = None
    return {lang: b"\n".join(map(plain_words, own)) for lang, own in sorted(found.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and margin to the runner-up (0 to 1). Equal sizes go to the language that sorts first."""
        data = plain_words(text or "") if self.languages else b""
        if not data:
            return UNKNOWN, 0.0
        blocks = [data[i: i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum([len(compress(block)) for block in blocks]) for compress in self.compressors]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        margin = 1.0 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0
        return self.languages[order[0]], margin


def learned_margin(dictionaries: dict[str, bytes], share: float = MARGIN_SHARE) -> float:
    """The margin below which texts are rejected, from the excerpts that ``dictionaries`` consist of.

    Each half of the excerpts is judged by dictionaries of the other half; ``share`` of the margin that all but one in a
    hundred of the rightly judged ones reach is taken. At most MARGIN_EXCERPTS excerpts in all, evenly of each language,
    are judged. With fewer than two languages there is no runner-up, and DEFAULT_MARGIN holds.
    """
    parts = {lang: [e for e in content.split(b"\n") if e] for lang, content in dictionaries.items()}
    margins = []
    for half in (0, 1):
        others = {lang: b"\n".join(own[1 - half::2]) for lang, own in parts.items() if own[1 - half::2]}
        if len(others) < 2:
            continue
        judge = Classifier(others)
        for lang in others:
            for excerpt in parts[lang][half::2][:max(1, MARGIN_EXCERPTS // (2 * len(others)))]:
                found, margin = judge.classify(excerpt.decode())
                if found == lang:
                    margins.append(margin)
    return max(DEFAULT_MARGIN, share * float(np.quantile(margins, 0.01))) if margins else DEFAULT_MARGIN


@lru_cache(2)
def _classifier(frozen: tuple) -> Classifier:
    return Classifier(dict(frozen))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.001) -> DataFrame:
    """All columns of ``docs`` and lang_pred, lang_score (the margin), lang_rejected.

    lang_pred is ``und`` for null texts and texts without a letter, and when nothing was learned; these are rejected,
    as are texts whose margin is below ``min_margin`` (see learned_margin). Only the text is looked at, whole. Columns of ``docs`` that
    have these three names are replaced. Rows are independent: null ids, repeated rows and empty tables pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries.items()))

    @F.pandas_udf("lang_pred string, lang_score double")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = _classifier(shared.value)
        for series in texts:
            yield pd.DataFrame([own.classify(t) for t in series], columns=["lang_pred", "lang_score"])

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "lang_score", "lang_rejected")]
    found = small_batches(docs).select(*[F.col(f"`{c}`") for c in kept], classify.asNondeterministic()(F.col("text").cast("string")).alias("_found"))  # so that filters don't run it again
    return found.select(*[F.col(f"`{c}`") for c in kept], "_found.*").withColumn(
        "lang_rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("lang_score") < min_margin))
