"""BPE against the tiktoken library, and decoding back."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                        special_tokens={})
OWN = bpe.Codec(RANKS, public_tokenizers.PATTERN)


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_any_text_as_the_library(text):
    ids = OWN.encode(text)
    assert ids == LIB.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", "a" * 20_000, " " * 5_000 + "x", "éß漢字🙂" * 300,
                                  "ab" * 4_000, "1" * 3_001, "<|endoftext|>", "\x00\r\n\t"])
def test_odd_and_long_texts(text):
    assert OWN.encode(text) == LIB.encode_ordinary(text)


def test_query_equals_the_library(spark):
    import os
    from conftest import SF_SMALL
    got = {r["doc_id"]: r for r in bpe.op10_byte_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIB.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_encode_and_decode_columns(spark):
    df = spark.createDataFrame([(1, "Hello  wörld, it's 12!"), (2, None), (3, "")], "k int, text string")
    tok = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    got = {r["k"]: r for r in bpe.decode(tok, PATH, public_tokenizers.PATTERN).collect()}
    assert got[1]["ids"] == LIB.encode_ordinary("Hello  wörld, it's 12!")
    assert got[1]["decoded"].decode() == "Hello  wörld, it's 12!"
    assert got[2]["ids"] == got[3]["ids"] == [] and bytes(got[2]["decoded"]) == b""


def test_small_cache_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 2)
    own = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    text = "alphabetagamma deltaepsilonzeta etathetaiota kappalambdamu alphabetagamma " * 3
    assert own.encode(text) == LIB.encode_ordinary(text)


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [(1, None, 5), (1, "", 5), (None, "same text", 6), (None, "same text", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    out = bpe.token_digests(df, PATH, public_tokenizers.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r["n_tokens"] for r in out)) == [0, 0, *[len(LIB.encode_ordinary("same text"))] * 2]
    assert all(r["decoded_sha256"] == empty for r in out if r["n_tokens"] == 0)
    assert bpe.token_digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
