"""The pipeline's stages in order, against the operators' brute-force rules."""

import hashlib
import os

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as cp
from conftest import SF_CHECK
from reelrank.llm import bpe, langid, pii
from reelrank.llm import decontaminate as dc
from test_neardup import brute_fast

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, __n int"


def step(spark, fn, docs, sf, tmp_dir, k):
    path = os.path.join(tmp_dir, str(k))
    fn(spark, docs, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_stages_do_what_their_operators_decide(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    frames, at = [docs], docs
    for k, (_, fn) in enumerate(cp.STAGES):
        at = step(spark, fn, at, SF_CHECK, tmp_dir, k)
        frames.append(at)
        if k < 4:
            assert at.columns == docs.columns and at.dtypes == docs.dtypes
    texts = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames[:5]]
    model = langid.Model(langid.fit(docs))
    assert set(texts[1]) == {i for i, t in texts[0].items() if not model.judge(t)[2]}
    assert len(texts[1]) > 0.97 * len(texts[0])
    groups = brute_fast(list(texts[1].items()))
    assert set(texts[2]) == {min(i for i, _ in g) for g in groups}
    items = [(str(r["item_id"]), dc.words_of(r["text"]))
             for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    windows = {}
    for i, ws in items:
        n = min(13, len(ws))
        for p in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(n, set()).add(tuple(ws[p:p + n]))
    for i, t in texts[2].items():
        ws, hit = dc.words_of(t), set()
        for n, wins in windows.items():
            for p in range(len(ws) - n + 1):
                if tuple(ws[p:p + n]) in wins:
                    hit.update(range(p, p + n))
        if hit and 20 * len(hit) >= len(ws):
            assert i not in texts[3]
        elif hit:
            assert dc.words_of(texts[3][i]) == [w for q, w in enumerate(ws) if q not in hit]
        else:
            assert texts[3][i] == t
    assert set(texts[4]) == set(texts[3])
    changed = {r["doc_id"]: r["n"] for r in pii.replace(frames[3], "reelrank", count_col="n").collect()}
    assert all((texts[4][i] != texts[3][i]) == (changed[i] > 0) for i in texts[3])
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    out = {r["doc_id"]: r for r in frames[5].collect()}
    assert set(out) == set(texts[4])
    for i, t in texts[4].items():
        ids = lib.encode_ordinary(t)
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    whole = {r["doc_id"]: r for r in cp.run(spark, SF_CHECK).collect()}
    assert whole == out


def test_odd_rows_through_every_stage(spark, tmp_dir):
    real = [r["text"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").limit(40).collect()]
    rows = [(k, t, "en", "s", len(t), 0.5, 1) for k, t in enumerate(real)]
    rows += [(100, None, None, None, None, None, None), (101, "", "en", None, 0, 0.0, 1),
             (None, real[0], "en", None, 5, 0.0, 1), (None, real[0], "en", None, 5, 0.0, 1),
             (3, real[3], "en", "s", len(real[3]), 0.5, 1), (102, real[5] + " a@bc.de " * 20_000, None, "s", 1, 0.1, 1)]
    for part in (rows, []):
        at = spark.createDataFrame(part, ODD)
        path = os.path.join(tmp_dir, f"in{len(part)}")
        at.write.parquet(path)
        at = spark.read.parquet(path)
        for k, (_, fn) in enumerate(cp.STAGES):
            at = step(spark, fn, at, SF_CHECK, tmp_dir, f"{len(part)}-{k}")
            if k < 4:
                assert at.columns == [c.split()[0] for c in ODD.split(", ")]
        n = at.count()
        assert n == 0 if not part else 30 < n <= 42
