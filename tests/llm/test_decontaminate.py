"""Suffix automaton against a window-by-window brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import decontaminate as dc


def brute(doc, items, window):
    hit, names = set(), set()
    for name, ws in items:
        k = min(len(ws), window)
        if not k:
            continue
        wins = {tuple(ws[p:p + k]) for p in range(len(ws) - k + 1)}
        for p in range(len(doc) - k + 1):
            if tuple(doc[p:p + k]) in wins:
                hit.update(range(p, p + k))
                names.add(name)
    return hit, names


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12)


@given(st.lists(words, max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c", b"z"]), max_size=40),
       st.integers(1, 5))
@settings(max_examples=500, deadline=None)
def test_automaton_equals_windows(items, doc, window):
    items = [(str(i), ws) for i, ws in enumerate(items)]
    spans, names = dc.SuffixAutomaton(items, window).match(doc)
    got = {q for a, b in spans for q in range(a, b + 1)}
    assert (got, names) == brute(doc, items, window)


def _frames(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    item = [rnd.choice(vocab) for _ in range(40)]
    bench = [(0, " ".join(item)), (1, "Tiny ITEM, here"), (2, None), (3, ""), (None, "no name item"),
             (0, " ".join(item)), (11, " ".join(item[5:30]))]
    docs = [(1, "x " * 300 + " ".join(item[3:20]) + " y" * 20),      # 17 of 337 words
            (2, "x " * 400 + " ".join(item[3:16]) + " y" * 20),      # 13 of 433: not contaminated
            (3, "clean text only"), (4, None), (5, ""), (6, "a tiny, item! HERE."),
            (6, "a tiny, item! HERE."), (None, "no-name.item"), (8, " ".join(item[:12]))]
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "7 AS spans", "'x' AS items", "1 AS n_hit"),
        spark.createDataFrame(bench, "item_id long, text string"))


def test_rows_blocks_and_odd_rows(spark):
    docs, bench = _frames(spark)
    for block in (1, 50, 10_000):
        got = dc.find_spans(docs, bench, block_words=block).collect()
        assert len(got) == 9
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], r)
        assert (by[1]["n_hit"], by[1]["contaminated"], by[1]["items"]) == (17, True, ["0", "11"])
        assert (by[2]["n_hit"], by[2]["contaminated"]) == (13, False)
        assert by[3]["n_hit"] == 0 and not by[3]["contaminated"] and by[3]["items"] == []
        assert by[4]["n_words"] == by[5]["n_words"] == 0 and not by[4]["contaminated"]
        assert (by[6]["n_hit"], by[6]["items"]) == (3, ["1"])
        assert (by[None]["n_hit"], by[None]["items"], by[None]["contaminated"]) == (3, [], True)
        assert by[8]["n_hit"] == 0
    empty = bench.limit(0)
    assert all(r["n_hit"] == 0 for r in dc.find_spans(docs, empty).collect())
    assert dc.find_spans(docs.limit(0), bench).count() == 0


def test_decontaminate_cuts_and_keeps(spark):
    docs, bench = _frames(spark)
    out = dc.decontaminate(docs, bench)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    by = {r["doc_id"]: r for r in out.collect()}
    assert set(by) == {2, 3, 4, 5, 8}
    assert len(by[2]["text"].split()) == 420 and by[2]["text"].startswith("x x")
    assert by[3]["text"] == "clean text only" and by[4]["text"] is None and by[3]["spans"] == 7
