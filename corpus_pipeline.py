"""The corpus pipeline: documents to tokens in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``, extra
columns included.

In every stage null and empty texts, null ids, repeated rows, extra columns and
empty tables have the results that the operators' docstrings state: language
identification drops texts without a letter, of repeated rows one stays, texts
without words are never contaminated, and null texts have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import bpe, decontaminate, langid, neardup, pii
from reelrank.llm.common import cut, read


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compression classifier doesn't reject."""
    return langid.keep_identified(docs, langid.fit(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return neardup.keep_one(docs, by_file=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter benchmark passages are cut from the rest."""
    out = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return _sized(out, docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by surrogates."""
    out = pii.replace(docs, spark.conf.get("reelrank.pii.key", "reelrank"))
    return _sized(out, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document, digested, and the way back."""
    import public_tokenizers
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                             public_tokenizers.PATTERN)


def _sized(out: DataFrame, docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the changed text."""
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language ID", identified),
    ("MinHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("PII", without_pii),
    ("byte-level BPE", tokens),
]

#: SQL can't express compression, weighted sampling or merges by rank.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared
    work folder before the next one reads them."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = cut(stage(spark, docs, sf_dir), "pipeline/" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
