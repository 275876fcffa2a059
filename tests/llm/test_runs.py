"""Runs against a scan of every period, and the query's texts and digests."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import runs


def scan(words, min_length=6, exponent=4):
    """(start, length, period) by trying every period."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, exponent * q):
                out.setdefault((i, j + q - i), q)      # the smallest period comes first
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(6, 4), (2, 2), (6, 3), (1, 5)]))
@settings(max_examples=400, deadline=None)
def test_any_numbers(numbers, limits):
    got = runs.runs_of(np.array(numbers, dtype=np.int64), *limits)
    assert list(zip(*(x.tolist() for x in got))) == scan(numbers, *limits)


@given(st.lists(st.integers(0, 9), max_size=25), st.integers(1, 8), st.integers(2, 12))
@settings(max_examples=200, deadline=None)
def test_periodic_numbers(numbers, period, times):
    numbers = numbers[:7] + numbers[:period] * times + numbers[7:]
    got = runs.runs_of(np.array(numbers, dtype=np.int64))
    assert list(zip(*(x.tolist() for x in got))) == scan(numbers)


def test_long_repetitions_end_soon():
    for numbers, want in ((np.zeros(60_000), (0, 60_000, 1)), (np.tile(np.arange(997), 40), (0, 39_880, 997))):
        got = runs.runs_of(numbers.astype(np.int64))
        assert [tuple(int(v[0]) for v in got)] == [want] and len(got[0]) == 1


def test_stretches_lose_no_run():
    rng = np.random.default_rng(4)
    for _ in range(300):
        x = rng.integers(0, 4, rng.integers(1, 80))
        at, part = runs.stretches(x, np.zeros(len(x), dtype=np.int64), 6, 4)
        start, length, period = runs.runs_of(part * 10 + x[at])
        assert sorted(zip(at[start].tolist(), length.tolist(), period.tolist())) == \
            sorted(scan(x.tolist())) if len(start) else not scan(x.tolist())


def wanted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = scan(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_query_equals_the_scan(spark):
    from conftest import SF_SMALL
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in runs.op11_periodic_runs(spark, SF_SMALL).collect())
    assert got == Counter(wanted(*d) for d in docs)
    assert sum(1 for r in got if r[1]) > len(docs) // 20


@pytest.mark.parametrize("batch_words", [250_000, 30])
def test_odd_rows(spark, monkeypatch, batch_words):
    monkeypatch.setattr(runs, "BATCH_WORDS", batch_words)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (5, "é é é é é é x"), (5, "é é é é é é x"),
            (19, "z y " * 40), (7, "a b" * 3), (8, "k k " * 9), (9, "w " * 3000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int")
    got = runs.run_digests(runs.with_period(df))
    assert Counter(tuple(r) for r in got.collect()) == Counter(wanted(*r) for r in rows)
    assert runs.run_digests(runs.with_period(df.limit(0))).count() == 0


def test_operator_keeps_columns_and_real_outputs(spark):
    df = spark.createDataFrame([("x a b a b a b a b y", 7)], "text string, found int")
    r = runs.find_runs(df).first()
    assert [tuple(x) for x in r["found"]["runs"]] == [(1, 8, 2)] and r["found"]["collapsed"] == "x a b y"
