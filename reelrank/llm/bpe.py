"""Byte-level BPE: texts to token ids by rank, and back.

Each piece of the split pattern is merged on a segment tree over its byte
positions. A leaf holds the rank of the pair that starts at that position, a
node the leftmost minimum below it, so the root names the next merge; a merge
changes three leaves (the pair itself, its live left neighbour, the position
that went away) in O(log n). Pieces of any length, a megabyte of spaces
included, cost O(n log n).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import kept, read, ship_package

#: What a worker remembers: pieces of a generation (there are two), and the longest.
CACHE_PIECES, CACHE_CHARS = 300_000, 48
_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: the lowest-ranked pair first, the leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    bits = (n - 1).bit_length()
    size = 1 << bits
    mask = size - 1
    # leaf i: rank of the pair at byte i, then i itself, so that ties go to the left
    leaves = [_NONE] * size
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            leaves[i] = r << bits | i
    levels = [leaves]
    while len(leaves) > 1:
        leaves = list(map(min, leaves[::2], leaves[1::2]))
        levels.append(leaves)
    tree = [_NONE]
    for level in reversed(levels):
        tree += level
    end = list(range(1, n + 1))        # where the live part that starts here ends
    before = list(range(-1, n - 1))    # start of the live part before
    while tree[1] < _NONE:
        i = tree[1] & mask
        j = end[i]                     # the part at j is swallowed
        end[i] = k = end[j]
        a = h = before[i]
        c = size + j
        tree[c] = _NONE
        b = size + i
        if k < n:
            before[k] = i
            r = get(piece[i:end[k]])
            tree[b] = _NONE if r is None else r << bits | i
        else:
            tree[b] = _NONE
        if h >= 0:
            a = size + h
            r = get(piece[h:k])
            tree[a] = _NONE if r is None else r << bits | h
        else:
            a = b
        # three leaves changed: their paths to the root, each shared node once
        a, b, c = a >> 1, b >> 1, c >> 1
        while b:
            x, y = tree[2 * b], tree[2 * b + 1]
            tree[b] = x if x < y else y
            if c != b:
                x, y = tree[2 * c], tree[2 * c + 1]
                tree[c] = x if x < y else y
            if a != b:
                x, y = tree[2 * a], tree[2 * a + 1]
                tree[a] = x if x < y else y
            a, b, c = a >> 1, b >> 1, c >> 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder for one rank table. Short pieces are remembered in two
    generations: when the young one is full it becomes the old one, and old pieces
    that come up again move to the young one, so frequent ones stay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.young.get
        for p in self.split(text):
            ids = known(p)
            if ids is None:
                ids = self.old.get(p)
                if ids is None:
                    ids = tuple(merge_piece(p.encode(), self.ranks))
                if len(p) <= CACHE_CHARS:
                    if len(self.young) >= CACHE_PIECES:
                        self.young, self.old = {}, self.young
                        known = self.young.get
                    self.young[p] = ids
            out += ids
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _codec(shared) -> Codec:
    ranks, pattern, key = shared.value
    return kept(("bpe", key), lambda: Codec(ranks, pattern))


def _share(spark: SparkSession, rank_path: str, pattern: str):
    """The rank table as a broadcast. Its size is that of the vocabulary file, which
    doesn't depend on the data."""
    ship_package(spark)
    ranks = load_ranks(rank_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return spark.sparkContext.broadcast((ranks, pattern, key))


def encode(docs: DataFrame, rank_path: str, pattern: str, *, text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """Adds ``ids_col`` (array<int>), the tokens of the whole text of each row.

    A null or empty text has no tokens. Row order, repeats and other columns
    don't matter; a column that is called ``ids_col`` is replaced.
    """
    shared = _share(docs.sparkSession, rank_path, pattern)

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for s in texts:
            yield pd.Series([np.array(codec.encode(t), dtype="int32") if t else
                             np.zeros(0, "int32") for t in s])

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(tokens: DataFrame, rank_path: str, pattern: str, *, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col`` (binary), the bytes that the ids of each row stand for."""
    shared = _share(tokens.sparkSession, rank_path, pattern)

    @F.pandas_udf("binary")
    def back(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for s in ids:
            yield pd.Series([codec.decode(x.tolist()) if x is not None else b"" for x in s])

    return tokens.withColumn(out_col, back(F.col(ids_col)))


def round_trip(docs: DataFrame, rank_path: str, pattern: str, *, text_col: str = "text",
               out_col: str = "tokens") -> DataFrame:
    """Adds ``out_col`` struct(ids, decoded), both binary: the ids as little-endian unsigned
    32-bit integers and the bytes that they decode to, in one pass over the texts.
    Nulls and empty texts give empty values."""
    shared = _share(docs.sparkSession, rank_path, pattern)

    @F.pandas_udf("ids binary, decoded binary")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared)
        for s in texts:
            packed, back = [], []
            for t in s:
                ids = codec.encode(t) if t else []
                packed.append(np.array(ids, "<u4").tobytes())
                back.append(codec.decode(ids))
            yield pd.DataFrame({"ids": packed, "decoded": back})

    return docs.withColumn(out_col, both(F.col(text_col)))


def token_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    tokens = round_trip(docs.select("doc_id", "text"), rank_path, pattern)
    return tokens.select("doc_id", (F.octet_length("tokens.ids") / 4).cast("long").alias("n_tokens"),
                         F.sha2("tokens.ids", 256).alias("ids_sha256"),
                         F.sha2("tokens.decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_digests(read(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)
