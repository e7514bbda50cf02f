"""The corpus pipeline: documents to counted, digested token ids, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a DataFrame; all
but the last return the columns of documents. Whoever runs the stages writes each result and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontaminate, langid, simhash
from riskweave.llm.queries import BYTE_BPE
from riskweave.llm.scratch import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; lang becomes the recognised one. Texts without letters and narrow margins go."""
    learned = langid.learn(docs)
    found = langid.identify(docs.select(*COLUMNS), learned, langid.learned_margin(learned)).where(~F.col("lang_rejected"))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies."""
    return simhash.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_inside=True)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of what they decode to."""
    return bpe.bpe_round_trip(docs, BYTE_BPE)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

#: SQL can express none of the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each result written to the shared store."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = store(docs, f"stage{n + 1}")
    return docs
