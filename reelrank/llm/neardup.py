"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

1. Document frequency of every five-word shingle over all documents. A chunk of
   documents sends its distinct shingle hashes, packed and dealt by hash range, and
   gets their frequencies back, so no row per shingle is shuffled and no shingle
   is hotter than one entry per chunk.
2. Weights tf * idf. A text can only reach the similarity with another text if its
   shingles that occur in several documents hold that share of its weight; all
   others stand alone and go no further (exact: min over max can't exceed it).
3. Improved consistent weighted sampling (Ioffe, 2010): SAMPLES samples (shingle,
   level) that agree between two texts with probability equal to their weighted
   Jaccard similarity; ROWS of them make a band, BANDS bands make the buckets.
4. In each bucket every text is compared with one pivot. The links join classes, and
   within a class no pair needs a test.
5. Buckets that still hold several classes are gone through in cells of two bounded
   blocks of texts: a task compares the samples of texts of different classes and
   gives back one edge per text. Texts that such edges connect form a group, and its
   cells are compared exactly, most alike first, until their classes are joined or
   all pairs are refuted. No pairs of a group are emitted, only the links that join.
6. A pair is a link if the exact weighted Jaccard similarity reaches the threshold.

Texts with the same words are one text from step 4 on.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import (Scratch, chunked, connected_components, cut, file_place, has_file_rows, kept,
                                 read, row_key, ship_package, small_batches)
from reelrank.llm.decontaminate import words_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: idf = 1 + IDF_GAIN * ln(N / df) / ln N: rare shingles weigh up to this much more. Text that a
#: large group of near copies shares keeps most of its weight.
IDF_GAIN = 0.25
#: Pairs whose samples agree less than SIMILARITY by so much are ruled out: five standard
#: deviations of the estimate from BANDS * ROWS samples.
SLACK = 5 * math.sqrt(SIMILARITY * (1 - SIMILARITY) / (BANDS * ROWS))
#: Texts of a block when cells compare samples, and when they compare vectors.
SAMPLE_BLOCK, VECTOR_BLOCK = 1000, 400
#: A chunk's texts are worked on together: so many rows of a file, or bytes of text.
CHUNK_ROWS, CHUNK_BYTES = 512, 2_000_000
PART_SHINGLES = 2_000_000

_U = np.uint64
_STEP = np.random.default_rng(5).integers(1, 2 ** 63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_SEEDS = np.random.default_rng(6).integers(0, 2 ** 63, BANDS * ROWS, dtype=np.uint64)
_EXP = -np.log((np.arange(4096) + 0.5) / 4096).astype(np.float32)   # an exponential by 12 bits


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        x = self[word] = xxhash.xxh64_intdigest(word)
        return x


def shingles_of(texts) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Keys of equal word sequences; hashes and counts of each text's distinct shingles, one
    text after the other; and the number of them per text. Texts of one to four words
    have one shingle, texts without words none (their key is that of the raw text)."""
    known = _WordHashes()
    keys, hashes, counts, sizes = [], [], [], []
    for text in texts:
        words = words_of(text)
        if words:
            keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
        else:
            keys.append(hashlib.blake2b((text or "").encode(), digest_size=16, person=b"raw").digest())
            sizes.append(0)
            continue
        ids = np.zeros(max(SHINGLE, len(words)), dtype=np.uint64)
        ids[:len(words)] = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        h = ids[:len(ids) - SHINGLE + 1] * _STEP[0]
        for k in range(1, SHINGLE):
            h = h + ids[k:len(ids) - SHINGLE + 1 + k] * _STEP[k]
        h, n = np.unique(_mix(h), return_counts=True)
        hashes.append(h)
        counts.append(n)
        sizes.append(len(h))
    join = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    return keys, join(hashes, np.uint64), join(counts, np.int64), np.array(sizes, dtype=np.int64)


def _pack(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted 48-bit keys as their 16 high bits, which compress, and their 32 low bits."""
    return (keys >> _U(32)).astype("<u2").tobytes(), (keys & _U(0xFFFFFFFF)).astype("<u4").tobytes()


def _unpack(high: bytes, low: bytes) -> np.ndarray:
    return np.frombuffer(high, "<u2").astype(np.uint64) << _U(32) | np.frombuffer(low, "<u4").astype(np.uint64)


def document_frequencies(rows: DataFrame, parts: int) -> DataFrame:
    """(chunk, piece, part, df): for each chunk and hash range the document frequencies, over
    all rows, of the chunk's distinct shingles in the order of their keys (48 bits).
    ``piece`` is the place of its first row: a chunk that two tasks read has two."""
    edges = (np.arange(1, parts, dtype=np.float64) * (2.0 ** 48 / parts)).astype(np.uint64)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def asked(chunk, piece, texts) -> pd.DataFrame:
            _, h, _, _ = shingles_of(texts)
            keys, n = np.unique(h >> _U(16), return_counts=True)
            cells = np.split(np.arange(len(keys)), np.searchsorted(keys, edges))
            out = [(part, chunk, piece, *_pack(keys[at]), n[at].astype("<u4").tobytes())
                   for part, at in enumerate(cells) if len(at)]
            return pd.DataFrame(out, columns=["part", "chunk", "piece", "high", "low", "n"])

        kept("neardup")
        chunk, piece, texts = None, 0, []
        for pdf in batches:
            for c, at, t in zip(pdf["__chunk"], pdf["__at"], pdf["__text"]):
                if c != chunk:
                    if texts:
                        yield asked(chunk, piece, texts)
                    chunk, piece, texts = c, at, []
                texts.append(t)
        if texts:
            yield asked(chunk, piece, texts)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        kept("neardup")
        cells = [_unpack(a, b) for a, b in zip(pdf["high"], pdf["low"])]
        n = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["n"]])
        _, at = np.unique(np.concatenate(cells), return_inverse=True)
        df = np.bincount(at, n).astype("<u4")[at]
        ends = np.cumsum([len(c) for c in cells])
        return pd.DataFrame({"chunk": pdf["chunk"], "piece": pdf["piece"], "part": pdf["part"],
                             "df": [df[e - len(c):e].tobytes() for c, e in zip(cells, ends)]})

    asked = rows.mapInPandas(ask, "part int, chunk long, piece long, high binary, low binary, n binary")
    return asked.groupBy("part").applyInPandas(count, "chunk long, piece long, part int, df binary")


def samples_of(hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Consistent weighted samples: one row of BANDS * ROWS 64-bit codes per text. ``sizes``
    has no zero."""
    start = np.r_[0, np.cumsum(sizes)[:-1]]
    text = np.repeat(np.arange(len(sizes)), sizes)
    log_w = np.log(weights).astype(np.float32)
    out = np.empty((len(sizes), len(_SEEDS)), dtype=np.uint64)
    low = _U(4095)
    for k, seed in enumerate(_SEEDS):
        x = _mix(hashes ^ seed)
        r = _EXP[x & low] + _EXP[x >> _U(12) & low]              # Gamma(2, 1)
        c = _EXP[x >> _U(24) & low] + _EXP[x >> _U(36) & low]
        beta = (x >> _U(48)).astype(np.float32) * np.float32(2 ** -16)
        t = np.floor(log_w / r + beta)
        score = np.log(c) - r * (t - beta) - r
        best = np.minimum.reduceat(score, start)
        at = np.flatnonzero(score == best[text])
        at = at[np.r_[True, text[at[1:]] != text[at[:-1]]]]      # the first of each text
        out[:, k] = _mix(hashes[at] + _mix(t[at].astype(np.int64).astype(np.uint64) ^ seed))
    return out


def bands_of(samples: np.ndarray) -> np.ndarray:
    """One 64-bit code for each band of ROWS samples."""
    out = np.empty((len(samples), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        code = np.full(len(samples), b, dtype=np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            code = _mix(code ^ samples[:, k])
        out[:, b] = code
    return out.view(np.int64)


def weighted_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Sum of minima over sum of maxima, for sorted distinct hashes with weights."""
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = float(np.minimum(wa[i], wb[j]).sum(dtype=np.float64))
    return both / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - both)


def _describe(n_docs: int, similarity: float):
    """Texts and frequencies of a chunk -> the texts that may have a near duplicate."""
    log_n = math.log(max(2, n_docs))

    def per_chunk(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        kept("neardup")
        # answers come for the pieces of the chunk that tasks asked for, each in its own order
        pieces = np.unique(answers["piece"].to_numpy())
        of = np.maximum(np.searchsorted(pieces, texts["__at"].to_numpy(), "right") - 1, 0)
        made = [per_piece(part, answers[answers["piece"] == pieces[k]] if len(pieces) else answers)
                for k, part in texts.groupby(of)]
        return pd.concat(made, ignore_index=True)

    def per_piece(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        keys, h, tf, sizes = shingles_of(texts["__text"])
        _, at = np.unique(h >> _U(16), return_inverse=True)
        answers = answers.sort_values("part")
        df = np.concatenate([np.frombuffer(x, "<u4") for x in answers["df"]] or [np.zeros(0, "<u4")])
        if len(df) != at.max(initial=-1) + 1:
            raise ValueError("by_file needs rows straight from Parquet files, in their order")
        df = df[at]
        w = tf * (1 + IDF_GAIN * np.log(np.maximum(1.0, n_docs / df)) / log_n)
        ends = np.cumsum(sizes)
        total = lambda x: np.diff(np.r_[0, np.cumsum(x)][np.r_[0, ends]])
        share = total(np.where(df > 1, w, 0.0)) / np.maximum(total(w), 1e-12)
        rids, places = texts["__rid"].tolist(), list(zip(texts["__chunk"], texts["__at"], texts["__th"]))
        first: dict[bytes, int] = {}     # of the chunk's copies the one with the smallest id has a sketch
        rows = []
        for i, (rid, key) in enumerate(zip(rids, keys)):
            if sizes[i] and share[i] < similarity - 1e-9:
                continue
            if sizes[i] and (key not in first or rid < rids[first[key]]):
                first[key] = i
            rows.append((rid, key, *places[i], i))
        chosen = sorted(first.values())
        out = pd.DataFrame(rows, columns=["rid", "key", "chunk", "at", "th", "i"])
        pick = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in chosen]) if chosen \
            else np.zeros(0, np.int64)
        sk = samples_of(h[pick], w[pick], sizes[chosen]) if chosen else np.zeros((0, len(_SEEDS)), np.uint64)
        info = {i: (float(w[ends[i] - sizes[i]:ends[i]].sum()), b.tolist(), s.astype("<u2").tobytes(),
                    *_vector(h[ends[i] - sizes[i]:ends[i]], w[ends[i] - sizes[i]:ends[i]]))
                for i, b, s in zip(chosen, bands_of(sk), sk)}
        none = (None,) * 5
        made = pd.DataFrame([info.get(i, none) for i in out["i"]],
                            columns=["weight", "bands", "sketch", "hashes", "weights"])
        return pd.concat([out[["rid", "key", "chunk", "at", "th"]], made], axis=1)

    return per_chunk


def _vector(h: np.ndarray, w: np.ndarray) -> tuple[bytes, bytes]:
    """Shingle hashes cut to 32 bits, sorted, and their weights."""
    short, at = np.unique(h >> _U(32), return_inverse=True)
    return short.astype("<u4").tobytes(), np.bincount(at, w).astype("<f4").tobytes()


_DESCRIBED = ("rid long, key binary, chunk long, at long, th long, weight double, bands array<long>, sketch binary, "
              "hashes binary, weights binary")


def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal samples."""
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), "<u2").reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), "<u2").reshape(len(b), -1)
    return pd.Series((x == y).mean(axis=1))


def _similarity(ha: pd.Series, wa: pd.Series, hb: pd.Series, wb: pd.Series) -> pd.Series:
    return pd.Series([weighted_jaccard(np.frombuffer(a, "<u4"), np.frombuffer(b, "<f4"),
                                       np.frombuffer(c, "<u4"), np.frombuffer(d, "<f4"))
                      for a, b, c, d in zip(ha, wa, hb, wb)], dtype=float)


def _links(pairs: DataFrame, sketches: DataFrame, vectors: DataFrame, similarity: float,
           scratch: Scratch) -> DataFrame:
    """Those of distinct pairs (a, b) that are links; the samples rule most others out first."""
    agreement, similar = F.pandas_udf(_agreement, "double"), F.pandas_udf(_similarity, "double")
    side = lambda df, x, *cols: df.select(
        F.col("rep").alias(x), *[F.col(c).alias(c + "_" + x) for c in cols])
    likely = pairs.join(side(sketches, "a", "sketch"), "a").join(side(sketches, "b", "sketch"), "b") \
        .filter(agreement("sketch_a", "sketch_b") >= similarity - SLACK).select("a", "b")
    likely = scratch.cut(likely, "neardup_likely")
    cols = ("hashes", "weights")
    scored = likely.join(side(vectors, "a", *cols), "a").join(side(vectors, "b", *cols), "b") \
        .select("a", "b", similar("hashes_a", "weights_a", "hashes_b", "weights_b").alias("s"))
    return scratch.cut(scored.filter(F.col("s") >= similarity - 1e-6).select("a", "b"), "neardup_links")


def _classes(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, class) of the texts that have a link."""
    got = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return scratch.cut(got.withColumnsRenamed({"node": "rep", "component": "class"}), "neardup_classes")


def _cells(texts: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Texts (with ``size``, that of their group) dealt to the pairs of blocks of their group
    that they take part in: columns lo and hi name the cell, blk the text's own block."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = texts.withColumn("blk", F.pmod(F.xxhash64("rep"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cells = dealt.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other"))
    cells = cells.drop("size", "other")
    return cells.repartition(*keys, "lo", "hi").sortWithinPartitions(*keys, "lo", "hi")


def _each_cell(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The cells of sorted rows, whole ones only."""
    held = None
    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        k = pdf[keys].to_numpy()
        ends = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        at = 0
        for end in ends:
            yield pdf.iloc[at:end]
            at = end
        held = pdf.iloc[at:]
    if held is not None:
        yield held


def _joined(cell: pd.DataFrame, similarity: float, exact: bool) -> list[tuple[int, int]]:
    """Pairs that join the classes of a cell: with ``exact`` links, else pairs that the samples
    don't rule out. At most one for each text or class that is joined."""
    n = len(cell)
    rep, cls, weight = (cell[c].to_numpy() for c in ("rep", "class", "weight"))
    left = np.flatnonzero(cell["blk"].to_numpy() == cell["lo"].iloc[0])
    right = np.flatnonzero(cell["blk"].to_numpy() == cell["hi"].iloc[0])
    same = cell["lo"].iloc[0] == cell["hi"].iloc[0]
    samples = np.frombuffer(b"".join(cell["sketch"]), "<u2").reshape(n, -1)
    pairs = []
    for k, i in enumerate(left):
        js = right[k + 1:] if same else right
        js = js[(cls[js] != cls[i]) & (np.minimum(weight[js], weight[i])
                                       >= (similarity - 1e-6) * np.maximum(weight[js], weight[i]))]
        if len(js):
            agree = (samples[js] == samples[i]).mean(axis=1)
            keep = agree >= similarity - SLACK
            pairs += zip(agree[keep].tolist(), [i] * int(keep.sum()), js[keep].tolist())
    if not pairs:
        return []
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    name = cls if exact else rep
    vectors: dict = {}

    def vector(i):
        if i not in vectors:
            vectors[i] = (np.frombuffer(cell["hashes"].iat[i], "<u4"), np.frombuffer(cell["weights"].iat[i], "<f4"))
        return vectors[i]

    out = []
    for _, i, j in sorted(pairs, reverse=True):
        a, b = find(name[i]), find(name[j])
        if a != b and (not exact or weighted_jaccard(*vector(i), *vector(j)) >= similarity - 1e-6):
            up[a] = b
            out.append((int(rep[i]), int(rep[j])))
    return out


def _across(texts: DataFrame, keys: list[str], block: int, similarity: float, exact: bool) -> DataFrame:
    """(u, v) pairs that join classes, from all cells of all groups of texts."""
    names = [*keys, "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in _each_cell(batches, names):
            got = _joined(cell, similarity, exact)
            if got:
                yield pd.DataFrame(got, columns=["u", "v"])

    return _cells(texts, keys, block).mapInPandas(run, "u long, v long")


def _members(docs: DataFrame, id_col: str, text_col: str, by_file: bool, similarity: float
             ) -> tuple[DataFrame, DataFrame]:
    """All rows (__id, __rid, __th, ...), and the rows that may have a partner, written:
    (rid, th, chunk, at, class_id), ``th`` being the hash of the text."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    rows, asks = chunked(docs, id_col, text_col, by_file, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__th"),
                         chunk_rows=CHUNK_ROWS, chunk_bytes=CHUNK_BYTES)
    n_docs, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("__text").cast("long")), F.lit(0))).first()
    parts = max(1, -(-size // (6 * PART_SHINGLES)))
    frequencies = document_frequencies(asks.select("__chunk", "__at", "__text"), parts)
    described = rows.select("__chunk", "__at", "__rid", "__th", "__text").groupBy("__chunk").cogroup(
        frequencies.withColumnRenamed("chunk", "__chunk").groupBy("__chunk")).applyInPandas(
        _describe(n_docs, similarity), _DESCRIBED)
    with small_batches(spark):
        described = scratch.cut(described, "neardup_described").withColumn("id", F.col("rid"))

    # an id that is the smallest of several texts gets a name for each of them, under all ids
    named = scratch.cut(described.groupBy("key").agg(F.min("rid").alias("rid")), "neardup_reps")
    shared = named.groupBy("rid").agg(F.count("*").alias("n")).filter("n > 1").select("rid")
    renamed = scratch.cut(named.join(shared, "rid").select("key", "rid", (
        F.lit(-(1 << 62)) - F.pmod(F.xxhash64("key", "rid"), F.lit(1 << 61))).alias("name")), "neardup_names")
    if not renamed.isEmpty():
        described = described.join(renamed, ["key", "rid"], "left") \
            .withColumn("rid", F.coalesce("name", "rid")).drop("name")

    # texts of the same words: the smallest rid stands for them
    reps = scratch.cut(described.groupBy("key").agg(F.min("rid").alias("rep")), "neardup_reps")
    # (it has a sketch, being the smallest of its chunk, too; other copies' sketches go unused)
    texts = described.select("key", F.col("rid").alias("rep"), "weight", "bands", "sketch") \
        .filter("sketch is not null").join(reps, ["key", "rep"]).groupBy("rep").agg(
        F.any_value("weight").alias("weight"), F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch"))
    texts = scratch.cut(texts, "neardup_texts")
    vectors = described.filter("hashes is not null").select(F.col("rid").alias("rep"), "hashes", "weights")
    sketches = texts.select("rep", "sketch")
    buckets = scratch.cut(texts.select("rep", "weight", F.posexplode("bands").alias("band", "code")),
                     "neardup_buckets")

    # one pivot per bucket, the text with the smallest id
    pivots = scratch.cut(buckets.groupBy("band", "code").agg(
        F.min(F.struct("rep", "weight")).alias("p"), F.count("*").alias("size")).filter("size > 1")
        .select("band", "code", F.col("p.rep").alias("a"), F.col("p.weight").alias("other")), "neardup_pivots")
    # lighter over heavier weight bounds the similarity
    pairs = buckets.join(pivots, ["band", "code"]).filter(F.col("rep") != F.col("a")).filter(
        F.least("weight", "other") >= (similarity - 1e-6) * F.greatest("weight", "other")) \
        .select("a", F.col("rep").alias("b")).distinct()
    links = _links(scratch.cut(pairs, "neardup_pairs"), sketches, vectors, similarity, scratch)
    classes = _classes(links, scratch)

    # buckets of three texts or more that still hold several classes
    here = scratch.cut(buckets.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep")),
                       "neardup_here")
    mixed = scratch.cut(here.groupBy("band", "code").agg(
        F.count("*").alias("size"), (F.min("class") < F.max("class")).alias("several"))
        .filter("several and size > 2").drop("several"), "neardup_mixed")
    edges = scratch.cut(_across(here.join(mixed, ["band", "code"]).join(sketches, "rep"), ["band", "code"],
                                SAMPLE_BLOCK, similarity, exact=False), "neardup_edges")
    if not edges.isEmpty():
        groups = scratch.cut(connected_components(edges).withColumnsRenamed({"node": "rep", "component": "group"}),
                             "neardup_groups")
        sizes = scratch.cut(groups.groupBy("group").agg(F.count("*").alias("size")), "neardup_sizes")
        whole = groups.join(sizes, "group").join(classes, "rep", "left") \
            .withColumn("class", F.coalesce("class", "rep")) \
            .join(texts.select("rep", "weight", "sketch"), "rep").join(vectors, "rep")
        more = scratch.cut(_across(whole, ["group"], VECTOR_BLOCK, similarity, exact=True), "neardup_more")
        if not more.isEmpty():
            classes = _classes(links.union(more.select(F.col("u").alias("a"), F.col("v").alias("b"))), scratch)
    member = described.select("id", "th", "chunk", "at", "key").join(reps, "key").join(classes, "rep", "left")
    member, _ = cut(member.select(F.col("id").alias("rid"), "th", "chunk", "at",
                                  F.coalesce("class", "rep").alias("class_id")), "neardup_members")
    scratch.clear()
    return rows, member


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    by_file: bool = False, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: the id, ``rid`` (the id, or a hash of the text where it is null) and
    ``class_id``, the smallest rid among the texts that links connect.

    Texts of the same words are in one class, and so are all null and empty texts; other
    texts without a word are in the class of their exact copies. Repeated rows get
    the same class; rows of one id with different texts each get that of their text, and
    where such an id would name several classes, these get negative numbers of their own.
    Ids are numbers. Other columns are ignored; an empty table gives an empty result.
    ``by_file``: ``docs`` is read straight from Parquet files, so stretches of a file's
    rows can serve as chunks, which saves a shuffle; otherwise rows are dealt by hash.
    """
    rows, member = _members(docs, id_col, text_col, by_file, similarity)
    member = member.groupBy("rid", "th").agg(F.min("class_id").alias("class_id"))
    ids = rows.select(F.col("__id").alias(id_col), F.col("__rid").alias("rid"), F.col("__th").alias("th"))
    return ids.join(member, ["rid", "th"], "left").select(id_col, "rid", F.coalesce("class_id", "rid").alias("class_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", by_file: bool = False,
             similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, the one with the smallest id; same columns. Of repeated rows
    one stays; of rows of one id with different texts those stay that are no near duplicates.

    With ``by_file`` the dropped rows are named by file and row, 64 rows to a number, so that
    table is small (16 bytes for 64 rows that hold a dropped one): Spark broadcasts it by its size,
    and shuffles the texts once where it is too large for that."""
    by_file = by_file and has_file_rows(docs)
    _, member = _members(docs, id_col, text_col, by_file, similarity)
    if by_file:
        place = F.struct("rid", "chunk", "at")
        best = member.groupBy("class_id").agg(F.min(place).alias("best"))
        bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
        dropped, _ = cut(member.join(best, "class_id").filter(place != F.col("best"))
                         .groupBy(F.col("chunk").alias("__chunk"), F.floor(F.col("at") / 64).alias("__word"))
                         .agg(F.bit_or(bit).alias("__bits")), "neardup_dropped")
        chunk, at = file_place(CHUNK_ROWS)
        rows = docs.select("*", chunk.alias("__chunk"), at.alias("__at")).withColumn("__word", F.floor(F.col("__at") / 64))
        return rows.join(dropped, ["__chunk", "__word"], "left").filter(
            "__bits is null or getbit(__bits, cast(__at % 64 as int)) = 0").select(*docs.columns)
    rid = F.coalesce(row_key(id_col, text_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    keyed = docs.withColumn("__rid", rid).withColumn("__th", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    got = member.groupBy("class_id", "rid", "th").agg(F.count("*").alias("n"))
    best = got.groupBy("class_id").agg(F.min(F.struct("rid", "th")).alias("best"))
    got, _ = cut(got.join(best, "class_id").select(F.col("rid").alias("__rid"), F.col("th").alias("__th"), "n",
                                                   (F.struct("rid", "th") == F.col("best")).alias("first")), "neardup_kept")
    single = keyed.join(got.filter("not first or n > 1"), ["__rid", "__th"], "left_anti")
    several = keyed.join(got.filter("first and n > 1"), ["__rid", "__th"], "left_semi").dropDuplicates(["__rid", "__th"])
    return single.unionByName(several).select(*docs.columns)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return near_duplicates(docs, by_file=True).select("doc_id", "class_id")
