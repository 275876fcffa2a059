"""Near duplicates against all pairs, and the sampling scheme against its theory."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_CHECK
from split_files import split_file  # noqa: F401
from reelrank.llm import neardup as nd
from reelrank.llm.decontaminate import words_of


def brute(rows):
    """Class of each distinct (id, text), by exact TF-IDF weights and all pairs."""
    docs = {}
    for i, t in rows:
        w = tuple(words_of(t))
        docs.setdefault((i, t or ""), w if w else ("raw", t or ""))
    grams = {}
    for d, w in docs.items():
        if w[:1] == ("raw",):
            grams[d] = Counter()
        else:
            w = w + (0,) * (5 - len(w))
            grams[d] = Counter(w[k:k + 5] for k in range(len(w) - 4))
    n = len(rows)
    df = Counter(g for i, t in rows for g in grams[(i, t or "")])
    weight = {d: {g: c * (1 + nd.IDF_GAIN * math.log(max(1, n / df[g])) / math.log(max(2, n)))
                  for g, c in gs.items()} for d, gs in grams.items()}
    up = {d: d for d in docs}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d
    for a, b in itertools.combinations(docs, 2):
        if docs[a] == docs[b]:
            j = 1.0
        else:
            low = sum(min(weight[a][g], weight[b][g]) for g in weight[a].keys() & weight[b].keys())
            total = sum(weight[a].values()) + sum(weight[b].values()) - low
            j = low / total if total else 0.0
        if j >= nd.SIMILARITY - 1e-6:
            up[find(a)] = find(b)
    groups = {}
    for d in docs:
        groups.setdefault(find(d), set()).add(d)
    return {frozenset(g) for g in groups.values()}


def classes(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, key string, rid int")
    got = nd.near_duplicates(df, **options).collect()
    assert len(got) == len(rows)
    by_rid = {}
    for r in got:
        by_rid[r["rid"]] = r["class_id"]
    return df, got, by_rid


def edited(rnd, words, share):
    return [rnd.choice(["zip", "zap", "zop", "zup"]) + str(rnd.randrange(10 ** 6)) if rnd.random() < share else w
            for w in words]


def test_classes_equal_all_pairs(spark):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(25):
        base = rnd.choices(vocab, k=rnd.randint(3, 400))
        for _ in range(rnd.randint(1, 6)):
            rows.append((len(rows), " ".join(edited(rnd, base, rnd.choice([0, 0, 0.004, 0.01, 0.02, 0.05, 0.2])))))
    chain = rnd.choices(vocab, k=300)              # links that only a chain of texts joins
    for k in range(12):
        chain = chain[6:] + rnd.choices(vocab, k=6)
        rows.append((len(rows), " ".join(chain)))
    rows += [(len(rows) + k, t.upper()) for k, (_, t) in enumerate(rows[:5])]
    _, got, by = classes(spark, rows)
    mine = {}
    for r in got:
        mine.setdefault(r["class_id"], set()).add((r["doc_id"], rows[r["doc_id"]][1]))
    assert {frozenset(g) for g in mine.values()} == brute(rows)
    assert all(k == min(i for i, _ in g) for k, g in mine.items())


def test_large_group_of_near_copies_and_copies(spark):
    """Each near copy is alike the base, two of them often under the threshold: one class."""
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(300)]
    rows = [(k, " ".join(edited(rnd, base, 0.012))) for k in range(250)]
    rows += [(1000 + k, " ".join(base)) for k in range(250)]
    rows += [(5000 + k, " ".join(f"u{k}x{i}" for i in range(50)) + " " + " ".join(base[:60])) for k in range(60)]
    _, got, by = classes(spark, rows)
    want = brute(rows)
    mine = {}
    for r in got:
        mine.setdefault(r["class_id"], set()).add((r["doc_id"], dict(rows)[r["doc_id"]]))
    assert {frozenset(g) for g in mine.values()} == want
    assert max(map(len, want)) >= 440


def test_odd_rows_and_keep_one(spark):
    rows = [(1, None), (2, ""), (3, "!?"), (4, "!?"), (5, "..."), (6, "one two"), (7, "One, two"), (8, "one two three"),
            (9, "a " * 30_000), (9, "a " * 30_000), (None, "one two"), (None, "alone here"), (None, "alone here"),
            (12, "x1 x2 x3 x4 x5 x6"), (12, "x1 x2 x3 x4 x5 x6")]
    df, got, by = classes(spark, rows)
    assert by[1] == by[2] == 1 and by[3] == by[4] == 3 and by[5] == 5
    low = min(6, *[r["rid"] for r in got if r["doc_id"] is None and r["class_id"] == by[6]])
    assert by[6] == by[7] == low and by[8] == 8 and by[9] == 9
    kept = nd.keep_one(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    texts = Counter(r["text"] for r in kept.collect())
    assert sum(texts.values()) == 8 and texts["a " * 30_000] == 1 and texts["alone here"] == 1
    assert texts["one two three"] == 1 and texts["!?"] == 1 and texts["x1 x2 x3 x4 x5 x6"] == 1
    assert nd.near_duplicates(df.limit(0)).count() == 0 and nd.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("by_file", [False, True])
def test_one_id_with_different_texts(spark, tmp_dir, by_file):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "something completely other than that, really"),
            (1, "alpha beta gamma delta epsilon zeta"), (2, words), (2, words + " end"), (2, "third text of two, with words"),
            (3, "something completely other than that, really"), (4, "third text of two, with words"), (5, None), (5, ""),
            (6, "no partner at all for this one here")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(tmp_dir + "/d")
    df = spark.read.parquet(tmp_dir + "/d")
    got = Counter((r["doc_id"], r["text"]) for r in nd.keep_one(df, by_file=by_file).collect())
    kept = sorted((i, (t or "")[:12]) for i, t in got.elements())
    assert len(kept) == 6 and Counter(t for _, t in kept) == Counter(
        ["alpha beta g", "something co", words[:12], "third text o", "", "no partner a"])
    classes = {}
    for r in nd.near_duplicates(df, by_file=by_file).collect():
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, classes.values())) == [[1, 1], [1, 3], [2, 2], [2, 4], [5, 5], [6]]


def test_samples_agree_as_often_as_weights_do():
    rnd = np.random.default_rng(3)
    h = rnd.integers(0, 2 ** 63, 600, dtype=np.uint64)
    got, want = [], []
    for k in range(40):
        wa, wb = rnd.uniform(0.5, 3, 500), rnd.uniform(0.5, 3, 500)
        wb[:300] = wa[:300]
        a, b = (h[:500], wa), (h[100:600] if k % 2 else h[:500], wb)
        sa, sb = (nd.samples_of(x, w, np.array([500]))[0] for x, w in (a, b))
        got.append((sa == sb).mean())
        da, db = dict(zip(a[0].tolist(), wa)), dict(zip(b[0].tolist(), wb))
        low = sum(min(x, db.get(g, 0)) for g, x in da.items())
        want.append(low / (wa.sum() + wb.sum() - low))
        o, p = np.argsort(a[0]), np.argsort(b[0])
        assert nd.weighted_jaccard(a[0][o], wa[o], b[0][p], wb[p]) == pytest.approx(want[-1])
    assert abs(np.mean(got) - np.mean(want)) < 0.02
    assert np.std(np.array(got) - np.array(want)) < 0.08


def test_query_on_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    got = nd.op6_near_dedup(spark, SF_CHECK).collect()
    assert len(got) == len(rows)
    mine, texts = {}, dict(rows)
    for r in got:
        mine.setdefault(r["class_id"], set()).add((r["doc_id"], texts[r["doc_id"]]))
    assert {frozenset(g) for g in mine.values()} == brute_fast(rows)


def brute_fast(rows, empty=0):
    """All pairs that share a shingle, instead of all pairs."""
    by_gram = {}
    for k, (i, t) in enumerate(rows):
        w = words_of(t)
        w = w + [0] * (5 - len(w))
        for g in {tuple(w[p:p + 5]) for p in range(len(w) - 4)}:
            by_gram.setdefault(g, set()).add(k)
    near = set()
    for ks in by_gram.values():
        near.update(itertools.combinations(sorted(ks), 2))
    n = len(rows) + empty
    weights = []
    for i, t in rows:
        w = words_of(t)
        w = w + [0] * (5 - len(w))
        c = Counter(tuple(w[p:p + 5]) for p in range(len(w) - 4))
        weights.append({g: k * (1 + nd.IDF_GAIN * math.log(n / len(by_gram[g])) / math.log(n)) for g, k in c.items()})
    total = [sum(w.values()) for w in weights]
    up = list(range(len(rows)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k
    for a, b in near:
        low = sum(min(x, weights[b].get(g, 0)) for g, x in weights[a].items())
        if low / (total[a] + total[b] - low) >= nd.SIMILARITY - 1e-6:
            up[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), set()).add(rows[k])
    return {frozenset(g) for g in groups.values()}


def test_chunks_that_two_tasks_read(spark, split_file):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    bases = [rnd.choices(vocab, k=60) for _ in range(900)]
    rows = [(i, " ".join(edited(rnd, bases[i % 900], 0.01))) for i in range(1900)] + [(2000, ""), (2001, None)]
    held = split_file(spark.createDataFrame(rows, "doc_id long, text string"))
    mine = {}
    for r in nd.near_duplicates(held, by_file=True).collect():
        mine.setdefault(r["class_id"], set()).add((r["doc_id"], dict(rows)[r["doc_id"]] or ""))
    assert mine.pop(2000) == {(2000, ""), (2001, "")}
    assert {frozenset(g) for g in mine.values()} == brute_fast(rows[:1900], 2)
