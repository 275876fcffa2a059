"""Alignment against a plain walk over the tokens of whole texts."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelrank.llm import alignment

A_PATH, B_PATH = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PLAIN)}


def tokens(text):
    """(id, bytes) of both tokenizers for a whole text; empty when bytes differ."""
    a = [(k, bytes(BYTE[c] for c in A.id_to_token(k))) for k in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(k, bytes([int(B.id_to_piece(k)[3:5], 16)]) if B.is_byte(k) else
          B.id_to_piece(k).replace("▁", " ").encode()) for k in B.encode(text)]
    whole = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == whole for side in (a, b))
    return (a, b) if text and same else ([], [])


def walk(texts):
    per, counts = [], Counter()
    for text in texts:
        a, b = tokens(text or "")
        ends = []
        for side in (a, b):
            at = 0
            ends.append([at := at + len(x) for _, x in side])
        links = [(k, m) for (k, x), e in zip(a, ends[0]) for (m, y), f in zip(b, ends[1])
                 if e - len(x) < f and f - len(y) < e]
        counts.update(links)
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append(",".join(str(k) for k, _ in a[i:i2]) + "|" + ",".join(str(k) for k, _ in b[j:j2]))
            i, j = i2, j2
        per.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, m), c in counts.items():
        most[m] = max(most.get(m, 0), c)
    return [(n, m, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), s)
            for n, m, g, links, s in per]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
ODD = [None, "", " ", "  ", "a ", " a", "a  b", "x▁y", "\n a", "a\n b", "<s> <unk> <|endoftext|>", "<0x41>",
       "漢字 🙂🙂 é́", " a 　b", "ﬁ Ⅷ \x00 \x1c z", "w" * 400, "word " * 900, "h​ i", "﻿q"]


@pytest.mark.parametrize("block", [4_000_000, 700])
def test_equals_the_walk(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    from conftest import SF_SMALL
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id")
                   .limit(40).collect()] + ["same text"] * 3
    texts = [t if t is None else t[:6000] for t in texts]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(df, A_PATH, B_PATH).collect()}
    want = walk(texts)
    assert {k: got[k] for k in got} == dict(enumerate(want))


OWN = alignment.Aligner(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())


@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "é", "漢", "🙂", "\n", "▁", " ", "'s", "1", "́",
                                 "ﬁ", "<s>", "\x1c", "!", "\x00"]), max_size=25).map("".join))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    if not text:
        return
    parts = OWN.parts_of(text)
    got = OWN.aligned(list(dict.fromkeys(parts)), [True] * len(set(parts)))
    got = dict(zip(dict.fromkeys(parts), got))
    want = walk([text])[0]
    if not all(got[p][0] for p in parts):
        assert want[0] == 0
        return
    n, m, g = (sum(got[p][k] for p in parts) for k in (1, 2, 3))
    assert (n, m, g, ";".join(got[p][4] for p in parts)) == (*want[:3], want[6])
    assert sum(len(got[p][5]) // 8 for p in parts) == want[3]


def test_query_digests_and_odd_tables(spark):
    rows = [(None, "a b", 1), (None, "a b", 2), (3, None, 3), (1 << 60, "▁", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block int")
    got = sorted(alignment.align(df, A_PATH, B_PATH).select("doc_id", *COLUMNS).collect(),
                 key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    want = dict(zip([0, 1, 2, 3], walk([r[1] for r in rows])))
    assert [tuple(r)[1:] for r in got] == [want[2], want[3], want[0], want[1]] and got[1]["doc_id"] == 1 << 60
    assert alignment.align(df.limit(0), A_PATH, B_PATH).count() == 0
    from conftest import SF_SMALL
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = alignment.op13_tokenizer_alignment(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out[:20]:
        a, b = tokens(docs[r["doc_id"]] or "")
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
        assert len(r["groups_sha256"]) == (64 if a else 0)
    one = next(r for r in out if r["n_a"])
    text = walk([docs[one["doc_id"]]])[0][6]
    assert one["groups_sha256"] == hashlib.sha256(text.encode()).hexdigest()
