"""Multiple-instance learning: held-out quality, located sentences, odd rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reelrank.llm import toxicity as tx

CLEAN = "the cat sat on a mat near old house with green door and many trees".split()
BAD = ["jerkface", "jerkhead", "vilething"]


def corpus(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        sentences = [" ".join(rnd.choices(CLEAN, k=8)) for _ in range(rnd.randint(1, 30))]
        y = int(rnd.random() < 0.3)
        if y:
            k = rnd.randrange(len(sentences))
            sentences[k] += " " + rnd.choice(BAD) + " the mat"
        out.append((i, ". ".join(sentences) + ".", y))
    return out


def test_held_out_and_located():
    train, test = corpus(400, 1), corpus(300, 2)
    model = tx.fit([t for _, t, _ in train], [y for *_, y in train])
    scorer = tx.Scorer(*model)
    for _, text, y in test:
        p, bad = scorer.score(text)
        assert 0 <= p <= 1 and (p >= 0.5) == bool(y)
        if y:
            assert len(bad) == 1 and any(w in text[bad[0][0]:bad[0][1]] for w in BAD)
        clean = 1.0
        for _, _, ws in tx.sentence_words(text):     # noisy-or by its definition
            z = scorer.bias + sum(float(scorer.weight[f]) for w in ws for f in tx.features(w))
            clean *= 1 - 1 / (1 + math.exp(-z))
        assert abs(p - (1 - clean)) < 1e-6


def test_query_on_tables(spark):
    sf = "/root/testdata/sf0.1"
    out = tx.op2_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    got = out.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    pos = [r["score"] for r in got if r["toxic"] == 1]
    neg = [r["score"] for r in got if r["toxic"] == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc > 0.95
    assert sum(r["predicted"] == r["toxic"] for r in got) > 0.96 * len(got)


def test_odd_rows(spark):
    train = corpus(200, 3)
    docs = spark.createDataFrame(
        [(i, t, 1, "z") for i, t, _ in train] + [(900, None, 1, "z"), (901, "", 1, "z"), (None, "x", 1, "z"),
         (0, train[0][1], 1, "z"), (902, "12 !?\n..", 1, "z"), (903, "İ. " + "the mat " * 50_000 + ". jerkface", 1, "z")],
        "doc_id long, text string, toxic int, y string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(900, 1), (901, 0), (None, 1), (5, None), (0, 0), (0, 1), (7, 9)],
                                   "doc_id long, toxic int")
    texts, ys = tx.sample(docs, labels)
    assert len(texts) == len(ys) and None not in texts and set(ys) == {0, 1}
    model = tx.fit(texts, ys)
    out = tx.judge(docs, model)
    assert out.columns == docs.columns + ["toxicity"] and out.count() == docs.count()
    by = {r["doc_id"]: r["toxicity"] for r in out.collect()}
    for k in (900, 901, 902):
        assert by[k]["score"] == 0.0 and by[k]["offending"] == []
    long = by[903]
    assert long["score"] > 0.5 and docs.filter("doc_id = 903").first()["text"][
        long["offending"][0]["start"]:long["offending"][0]["end"]].strip() == "jerkface"
    assert tx.fit(texts, [0] * len(texts)) is None and tx.fit([], []) is None and tx.fit(["", None], [0, 1]) is None
    assert tx.judge(docs, None).agg(F.max("toxicity.score")).first()[0] == 0.0
    assert tx.judge(docs.limit(0), model).count() == 0
    assert tx.sample(docs, labels.limit(0)) == ([], []) and tx.sample(docs.limit(0), labels) == ([], [])


def test_long_documents_take_no_others_from_the_sample(spark, monkeypatch):
    monkeypatch.setattr(tx, "SAMPLE_BYTES", 2000)
    ids = spark.range(40).orderBy(F.xxhash64("id")).collect()
    long = {ids[0]["id"], next(r["id"] for r in ids if r["id"] % 2 != ids[0]["id"] % 2)}   # first of each label
    rows = [(i, ("x" * 5000 if i in long else f"text {i}"), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts, ys = tx.sample(df, df)
    assert sorted(zip(texts, ys)) == sorted((t, y) for i, t, y in rows if i not in long)
    # three of 900 bytes come first and two of them fit, after all the short ones
    rows = [(r["id"], "y" * 900 if k < 6 else f"text {r['id']}", k % 2) for k, r in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts, ys = tx.sample(df, df)
    assert sorted(ys) == [0] * 19 + [1] * 19 and sum(len(t) == 900 for t in texts) == 4


def test_a_lost_label_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(tx, "SAMPLE_BYTES", 2000)
    df = spark.createDataFrame([(i, "x" * (5000 if i % 2 else 10), i % 2) for i in range(10)],
                               "doc_id long, text string, toxic int")
    with pytest.raises(ValueError, match="labelled"):
        tx.sample(df, df)
