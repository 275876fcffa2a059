"""Exact search against all scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reelrank.llm import topk


def brute(rows, k, asks, scale=256):
    vecs = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(scale * x) for x in v]
        vecs[i] = min(vecs.get(i, ints), ints)
    out = set()
    for q, qv in vecs.items():
        if asks(q):
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in vecs.items() if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])}
    return out


@pytest.mark.parametrize("seed,slices", [(0, 2), (1, 3), (2, 1)])
def test_equals_brute_force(spark, seed, slices):
    rnd = random.Random(seed)
    base = [[rnd.gauss(0, 1) for _ in range(9)] for _ in range(40)]
    rows = [(i, rnd.choice(base) if rnd.random() < 0.6 else [rnd.gauss(0, 1) for _ in range(9)])
            for i in range(300)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 9), (403, [float("inf")] * 9),
             (None, base[0]), (500, []), (550, [2.0, -1.0]), (0, rows[0][1]), (50, base[3]), (600, [3e5] * 9)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<double>, rank int, gid string")
    out = topk.search(df, 4, is_query=F.col("vec_id") % 50 == 0, slices=slices, query_block=3, row_block=37)
    got = out.collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute(rows, 4, lambda i: i % 50 == 0)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [-5.0, 0.0]), (2, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.search(df, 5).collect()} == brute(rows, 5, lambda i: True)
    assert topk.search(df.limit(0), 5).count() == 0
    assert topk.search(df.filter("vec_id = 0"), 5).count() == 0
    assert topk.search(df, 5, is_query=F.col("vec_id") > 9).count() == 0
