"""Language identification by compression.

For each language a zstandard raw-content dictionary is made of sampled training
texts. A text is cut into blocks, every block is compressed with each
language's dictionary, and the language with the smallest sum of sizes wins:
a dictionary saves the more, the more of the text's strings it holds. When the
two smallest sums are close, tails of the text are compressed as well; if the margin
stays narrow the text is rejected.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.llm.common import in_fold, kept, read, ship_package

#: Bounds of the training sample: distinct texts a language, characters a text, bytes
#: of a dictionary. Every language with a usable training row has a dictionary.
SAMPLE_ROWS, ROW_BYTES, DICT_BYTES = 96, 2048, 112 * 1024
BLOCK = 8192           # bytes of text that are compressed together
LEVEL = 3
MIN_MARGIN = 0.004     # (second - best) / second under this rejects
PARTS = 24             # tails of a text that settle a narrow margin
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> bytes:
    """Lower-case words with one space between; signs and digits tell no language."""
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary content per language from a bounded sample of labelled rows.

    The sample is the ``SAMPLE_ROWS`` distinct texts of each language with the smallest
    text hash, each with at most ``ROW_BYTES`` characters. Copies of a text count once:
    they are folded by partial aggregates before the texts are numbered, which is a
    partial top-k, so a language that holds most rows costs one short list per task.
    Rows with null text, no letter or null language are not used. Without
    any usable row the result is empty.
    """
    rows = train.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t")) \
        .filter("l is not null and t rlike '\\\\p{L}'")
    # copies are folded by hash alone, then only the chosen texts are fetched
    hashes = rows.select("l", F.xxhash64("t").alias("h")).distinct()
    best = hashes.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h"))) \
        .filter(F.col("k") <= SAMPLE_ROWS).select("l", "h")
    best = rows.select("l", F.xxhash64("t").alias("h"), F.substring("t", 1, ROW_BYTES).alias("t")) \
        .join(F.broadcast(best), ["l", "h"]).groupBy("l", "h").agg(F.min("t").alias("t"))
    by: dict[str, list] = {}
    for r in best.orderBy("l", "h").collect():
        by.setdefault(r["l"], []).append(r["t"])
    return {lang: folded("\n".join(ts))[:DICT_BYTES] for lang, ts in by.items()}


class Model:
    """Compressors of all languages, the alphabetically first one first."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.tools = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang],
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(
                dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False,
                write_dict_id=False).compress)

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0..1 and whether the text is rejected."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        raw = folded(text)
        sizes = [0] * len(self.langs)
        for at in range(0, len(raw), BLOCK):
            block = raw[at:at + BLOCK]
            for k, tool in enumerate(self.tools):
                sizes[k] += len(tool(block))
        best, margin = self._best(sizes)
        if margin < MIN_MARGIN:
            # sizes are whole bytes, which says little of short texts: add up those of parts
            step = max(1, raw.count(b" ") // PARTS)
            starts = [m.end() for m in re.finditer(b" ", raw)][::step]
            for at in starts:
                for k, tool in enumerate(self.tools):
                    sizes[k] += len(tool(raw[at:at + BLOCK]))
            best, margin = self._best(sizes)
        return self.langs[best], 0.5 + 0.5 * min(1.0, margin / 0.25), margin < MIN_MARGIN

    @staticmethod
    def _best(sizes: list[int]) -> tuple[int, float]:
        """The smallest, the first among equals, and how far the next one is above it."""
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        if len(order) == 1:
            return order[0], 1.0
        second = sizes[order[1]]
        return order[0], (second - sizes[order[0]]) / second


def _model(shared) -> Model:
    key, dictionaries = shared.value
    return kept(("langid", key), lambda: Model(dictionaries))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text"
             ) -> DataFrame:
    """Adds ``lang_id`` struct(lang, score, rejected) to every row.

    The whole text is compressed. Null texts and texts without a letter are
    ``und`` with score 0 and rejected, and so is everything under a model without
    languages; equal sums go to the alphabetically first language and are rejected. Rows are independent: repeats and other columns (one called
    ``lang_id`` is replaced) change nothing.
    The dictionaries are broadcast: at most DICT_BYTES (112 KB) a language.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, dictionaries))

    @F.pandas_udf("lang string, score double, rejected boolean")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(shared)
        for s in texts:
            yield pd.DataFrame([model.judge(t) for t in s],
                               columns=["lang", "score", "rejected"])

    return docs.withColumn("lang_id", judge(F.col(text_col)))


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], *,
                    text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, same columns."""
    cols = docs.columns
    marked = identify(docs.select(F.struct(*cols).alias("__row"), F.col(text_col).alias("__text")),
                      dictionaries, text_col="__text")
    return marked.filter(~F.col("lang_id.rejected")).select(
        *[F.col("__row")[c].alias(c) for c in cols])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.filter(~in_fold("doc_id", 3, 1)))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"),
                      F.col("lang_id.lang").alias("lang_pred"),
                      F.col("lang_id.score").alias("score"),
                      F.col("lang_id.rejected").alias("rejected"))
