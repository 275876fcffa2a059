"""Targets by hand, words taken against them, and what a rerun gives."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reelrank.llm import mixing


def water_level(words, weights, share=1.5, most=2.0):
    """Targets one source at a time."""
    total, targets = share * sum(words), [0.0] * len(words)
    free = set(range(len(words)))
    while free:
        level = (total - sum(targets[i] for i in range(len(words)) if i not in free)) / sum(weights[i] for i in free)
        full = {i for i in free if most * words[i] <= level * weights[i]}
        for i in full or free:
            targets[i] = most * words[i] if full else level * weights[i]
        free -= full or free
    return targets


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def check(rows, docs):
    """The contract, for any result: every row once, whole copies, targets met."""
    n_words = lambda t: len((t or "").encode().split())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == \
        Counter((i, s, n_words(t)) for i, t, s in docs)
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += n_words(t)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(order, water_level([size[s] for s in order],
                                       [mixing.WEIGHTS[k % 3] for k in range(len(order))])))
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r["copies"] <= 2 and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
    for s in order:
        largest = max(n_words(t) for _, t, x in docs if x == s)
        assert abs(taken[s] - want[s]) <= largest + 1e-6
    return taken, want


def test_mix_of_generated_documents(spark, monkeypatch):
    from conftest import SF_SMALL
    docs = [(r["doc_id"], r["text"], r["source"]) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    monkeypatch.setattr(mixing, "LEAF", 8)               # several levels of the tree
    got = mixing.mix(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    check(got, docs)
    again = mixing.mix(frame(spark, docs).repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mine = {r["doc_id"]: r for r in mixing.op12_source_mixing(spark, SF_SMALL).collect()}
    assert len(mine) == len(docs) and all(r["taken"] <= 2 * r["size"] for r in mine.values())


def test_many_sources_and_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 16)
    docs = [(k, "w " * (1 + k * k % 37), None if k % 11 == 0 else f"s{k % 23:02d}é" if k % 3 else f"S{k % 5}")
            for k in range(2500)]
    docs += [(10_000 + k, "w " * (1 + k % 9), "hot") for k in range(1500)]
    taken, want = check(mixing.mix(frame(spark, docs)).collect(), docs)
    # after many documents little is open: far nearer than a whole document
    assert abs(taken["hot"] - want["hot"]) <= 9


def test_meeting_keeps_words_and_expectations():
    """One group of documents, met many times with new coins, in batches of any size."""
    rng = np.random.default_rng(1)
    size = np.array([500.0, 90, 50, 20, 7, 7, 3, 1])
    part = np.array([0.3, 0.5, 0.7, 0.25, 0.5, 0.1, 0.9, 0.4])
    total = np.zeros(8)
    for turn in range(4000):
        rows = pa.RecordBatch.from_pydict({"id": list(range(8)), "source": ["a"] * 8, "leaf": [0] * 8,
                                           "weight": size, "x": part, "coin": rng.random(8)})
        cuts = sorted({0, 8, *rng.integers(0, 9, 2).tolist()})
        got = pa.Table.from_batches(mixing._meet(iter(rows.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))))
        x = np.array(got.sort_by("id")["x"].to_pylist())
        assert len(x) == 8 and x @ size == pytest.approx(part @ size)
        assert ((x > 0) & (x < 1)).sum() <= 1 and (x >= 0).all() and (x <= 1).all()
        total += x
    assert np.abs(total / 4000 - part).max() < 0.04


def test_groups_dont_meet():
    rows = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4], "source": ["a", "a", None, None], "leaf": [0, 1, 1, 1],
                                       "weight": [5.0] * 4, "x": [0.5] * 4, "coin": [0.2] * 4})
    got = {r["id"]: r["x"] for b in mixing._meet(iter([rows])) for r in b.to_pylist()}
    assert got[1] == got[2] == 0.5 and sorted((got[3], got[4])) == [0, 1]


def test_copies_of_one_row_are_one_bundle(spark):
    docs = [(1, "a b c", "x")] * 1000 + [(2, "d e", "y")] * 1000 + [(None, "f", "z")] * 500
    rows = mixing.mix(frame(spark, docs)).collect()
    check(rows, docs)


def test_odd_rows(spark):
    docs = [(1, None, "a"), (1, "", "a"), (None, " \t", None), (2, "one", None), (2, "one", None)]
    check(mixing.mix(frame(spark, docs)).collect(), docs)
    assert all(r["copies"] * r["size"] == 0 for r in mixing.mix(frame(spark, docs[:3])).collect())
    assert mixing.mix(frame(spark, []).limit(0)).count() == 0
    clash = frame(spark, docs).selectExpr("*", "1 as id", "2 as m", "3 as x", "4 as size", "5 as leaf")
    check(mixing.mix(clash).collect(), docs)
