"""Toxicity by multiple-instance learning.

Only documents are labelled, but it is sentences that offend. A sentence's
probability is logistic in hashed features of its words (the word, its
beginnings and its ending); a document is toxic if some sentence is, so its
probability is the noisy-or 1 - prod(1 - p). Training descends the document
likelihood through the noisy-or, which moves the blame for a toxic document to
the sentences that clean documents don't have. Weights stay at 0 or above: words
add evidence of offence and none takes it away, so padding a sentence with
harmless words doesn't hide it. The same sentence probabilities then locate
the offending sentences.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.llm.common import in_fold, kept, read, ship_package

#: Bounds of the training sample, for each label: documents and bytes of text.
SAMPLE_DOCS, SAMPLE_BYTES = 2500, 8_000_000
LONG = 100              # a document over this part of SAMPLE_BYTES gets what others leave
FEATURE_BITS = 18
MIN_DOCS = 3            # a feature must occur in so many sampled documents
STEPS, RATE, SHRINK = 200, 0.15, 1e-4   # descent steps, step size, pull of weights to 0
OFFENDING = 0.5
CACHE_WORDS = 400_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    parts = ["=" + word, *("^" + word[:n] for n in (4, 5, 6) if len(word) > n), "$" + word[-4:]]
    return [zlib.crc32(p.encode()) & ((1 << FEATURE_BITS) - 1) for p in parts]


def sentence_words(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of every sentence that has a word."""
    low = text.lower()
    if len(low) != len(text):         # a few capitals change length; offsets must hold
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    out = []
    for m in _SENTENCE.finditer(low):
        words = set(_WORD.findall(m.group()))
        if words:
            out.append((m.start(), m.end(), words))
    return out


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float] | None:
    """Feature weights and bias, or None unless both labels occur."""
    vocab: dict[str, int] = {}
    known: list[list[int]] = []
    words, per_sentence = array("i"), array("i")
    per_doc, y = [], []
    in_docs = np.zeros(1 << FEATURE_BITS, dtype=np.int32)
    for text, label in zip(texts, labels):
        sentences = sentence_words(text or "")
        if not sentences:
            continue
        seen: set[int] = set()
        for _, _, ws in sentences:
            for w in ws:
                k = vocab.setdefault(w, len(vocab))
                if k == len(known):
                    known.append(features(w))
                words.append(k)
                seen.update(known[k])
            per_sentence.append(len(ws))
        per_doc.append(len(sentences))
        y.append(bool(label))
        in_docs[list(seen)] += 1
    y = np.array(y, dtype=bool)
    if not len(y) or y.all() or not y.any():
        return None
    words, per_sentence = np.frombuffer(words, np.int32), np.frombuffer(per_sentence, np.int32)
    width = max(map(len, known))
    spare = 1 << FEATURE_BITS          # a feature of weight 0, for rare ones and as filler
    table = np.full((len(known), width), spare, dtype=np.int32)
    for row, fs in zip(table, known):
        row[:len(fs)] = fs
    table[(table < spare) & (in_docs[np.minimum(table, spare - 1)] < MIN_DOCS)] = spare
    del vocab, known
    at_sentence = np.r_[0, np.cumsum(per_sentence)[:-1]]
    at_doc = np.r_[0, np.cumsum(per_doc)[:-1]]
    # documents of either label weigh the same together
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    weight, bias = np.zeros(spare + 1), -5.0
    m, v = np.zeros(spare + 2), np.zeros(spare + 2)
    for step in range(1, STEPS + 1):
        per_word = weight[table].sum(axis=1)
        z = bias + np.add.reduceat(per_word[words], at_sentence)
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.add.reduceat(_softplus(z), at_doc))       # no sentence offends
        slope = np.where(y, -clean / np.maximum(1 - clean, 1e-9), 1.0) * share
        gz = p * np.repeat(slope, per_doc)
        gw = np.bincount(words, np.repeat(gz, per_sentence), len(table))
        g = np.bincount(table.ravel(), np.repeat(gw, width), spare + 1)
        g[:spare] += SHRINK
        g[spare] = 0
        g = np.r_[g, gz.sum()]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weight = np.maximum(weight - move[:-1], 0)
        bias -= move[-1]
    return weight[:spare].astype(np.float32), float(bias)


class Scorer:
    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias
        self.words: dict[str, float] = {}

    def word(self, w: str) -> float:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        x = self.words[w] = float(sum(self.weight[f] for f in features(w)))
        return x

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the document, and its offending sentences."""
        log_clean, bad = 0.0, []
        get, bias = self.words.get, self.bias
        for start, end, words in sentence_words(text) if text else ():
            z = bias
            for w in words:
                x = get(w)
                z += self.word(w) if x is None else x
            log_clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
            if z >= 0:
                bad.append((start, end, 1 / (1 + math.exp(-z))))
        return -math.expm1(log_clean), bad


def _scorer(shared) -> Scorer:
    key, model = shared.value
    return kept(("toxicity", key), lambda: Scorer(*model))


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded sample: for each label the documents with the smallest
    id hashes, at most SAMPLE_DOCS of them and SAMPLE_BYTES of text. A document that doesn't
    fit into what is left of the bytes is skipped, those after it are not, and documents of
    over 1 / LONG of the bytes are taken last, so long ones can't crowd out the others. A
    document that is labelled both ways counts as toxic; null ids, labels and texts are not
    used. If a label's documents are all too long, a ValueError says so."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")) \
        .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    first = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    ids = known.withColumn("k", first).filter(F.col("k") <= SAMPLE_DOCS)   # 2 * SAMPLE_DOCS rows at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter("t is not null")
    sizes = rows.join(F.broadcast(ids), "id").groupBy("id", "y", "k").agg(
        F.min(F.struct(F.octet_length("t").alias("size"), F.xxhash64("t").alias("h"))).alias("s")) \
        .select("id", "y", "k", "s.size", "s.h").collect()
    chosen, used = [], {}
    for r in sorted(sizes, key=lambda r: (r["size"] * LONG > SAMPLE_BYTES, r["k"])):
        total = used.setdefault(r["y"], 0) + r["size"]
        if total <= SAMPLE_BYTES:
            used[r["y"]] = total
            chosen.append((r["id"], r["h"], r["y"], r["k"]))
    lost = used.keys() - {y for *_, y, _ in chosen}
    if lost:
        raise ValueError(f"no document labelled {sorted(lost)} is under the sample's {SAMPLE_BYTES} bytes")
    if not chosen:
        return [], []
    id_type = ids.schema["id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(chosen, f"id {id_type}, h long, y int, k int")
    got = rows.join(F.broadcast(wanted), (rows["id"] == wanted["id"]) & (F.xxhash64("t") == F.col("h"))) \
        .select("t", "y", "k").dropDuplicates(["y", "k"]).collect()
    got.sort(key=lambda r: (r["y"], r["k"]))
    return [r["t"] for r in got], [r["y"] for r in got]


def judge(docs: DataFrame, model: tuple[np.ndarray, float] | None, *, text_col: str = "text") -> DataFrame:
    """Adds ``toxicity`` struct(score, offending) to each row, ``offending`` being the sentences
    of probability OFFENDING or more as (start, end, score) in characters.

    Whole texts are scored, row by row. Null and empty texts and texts without a word
    score 0 and have no offending sentence; without a model (labels of one kind
    only, or none) every score is 0. Repeated rows get equal scores. Other
    columns are kept; one called ``toxicity`` is replaced. The model is broadcast;
    its size is fixed by FEATURE_BITS (1 MB).
    """
    spark = docs.sparkSession
    ship_package(spark)
    if model is None:
        model = np.zeros(1 << FEATURE_BITS, np.float32), -math.inf
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model))

    @F.pandas_udf("score double, offending array<struct<start:int,end:int,score:double>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(shared)
        for s in texts:
            got = [scorer.score(t) for t in s]
            yield pd.DataFrame({"score": [x for x, _ in got], "offending": [
                [{"start": a, "end": b, "score": p} for a, b, p in bad] for _, bad in got]})

    return docs.withColumn("toxicity", run(F.col(text_col)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels")
    model = fit(*sample(docs, labels.filter(~in_fold("doc_id", 5, 0))))
    out = judge(docs, model)
    return out.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"),
                      F.col("toxicity.score").alias("score"),
                      (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
                      F.col("toxicity.offending").alias("offending"))
