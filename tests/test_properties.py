"""Property checks (hypothesis) on small generated inputs, few examples each:
each example runs Spark jobs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelrank.functions import scalar
from reelrank.operators import factors, online, similarity

SETTINGS = dict(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

vec = st.lists(st.integers(-3, 3), min_size=3, max_size=3)


@settings(**SETTINGS)
@given(st.dictionaries(st.integers(0, 500), vec, min_size=2, max_size=40),
       st.sampled_from([0.0, 0.3, 0.6]), st.sampled_from([64.0, 0.0003]))
def test_similarity_matches_brute_force(spark, vecs, threshold, block_mb):
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vecs.items()],
                               "mid int, features array<double>")
    got = sorted((a, b, round(r, 9)) for a, b, r in
                 similarity.similar_pairs(df, threshold, block_mb=block_mb).collect())
    want = []
    for a, va in vecs.items():
        for b, vb in vecs.items():
            na, nb = np.linalg.norm(va), np.linalg.norm(vb)
            if a != b and na > 0 and nb > 0:
                c = float(np.dot(va, vb) / (na * nb))
                if c > threshold:
                    want.append((a, b, round(c, 9)))
    assert got == sorted(want)


@settings(**SETTINGS)
@given(st.dictionaries(st.integers(0, 300), vec, min_size=1, max_size=25),
       st.dictionaries(st.integers(1000, 1300), vec, min_size=1, max_size=30),
       st.integers(1, 6), st.sampled_from([64.0, 0.0002]))
def test_user_top_k_matches_brute_force(spark, users, items, k, block_mb):
    u = spark.createDataFrame([(a, [float(x) for x in v]) for a, v in users.items()],
                              "uid int, features array<double>")
    i = spark.createDataFrame([(a, [float(x) for x in v]) for a, v in items.items()],
                              "mid int, features array<double>")
    got = sorted(tuple(r) for r in factors.user_top_k(u, i, k, block_mb=block_mb).collect())
    want = []
    for uid, uv in users.items():
        sc = sorted((-float(np.dot(uv, iv)), mid) for mid, iv in items.items()
                    if float(np.dot(uv, iv)) > 0)
        want += [(uid, n + 1, mid, -s) for n, (s, mid) in enumerate(sc[:k])]
    assert got == sorted(want)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(-5, 10**6), st.sampled_from([0.5, 1.0, 3.5, 4.25])),
                max_size=8))
def test_encode_decode_roundtrip(spark, recs):
    df = spark.createDataFrame([(1, recs)], "uid int, recs array<struct<rid:int,r:double>>")
    back = df.select(scalar.decode_recs(scalar.encode_recs("recs"))).first()[0]
    assert [tuple(x) for x in back] == [tuple(x) for x in recs]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 30), st.sampled_from([1.0, 3.0, 4.5]),
                          st.integers(0, 50)), min_size=1, max_size=60),
       st.integers(1, 20))
def test_recent_ratings_capped_and_ordered(spark, events, n):
    df = spark.createDataFrame(events, "uid int, mid int, score double, timestamp int")
    got = online.recent_ratings(df, n).collect()
    by_user = {}
    for r in got:
        by_user.setdefault(r["uid"], []).append(r)
    for uid, rs in by_user.items():
        rs.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in rs] == list(range(1, len(rs) + 1)) and len(rs) <= n
        keys = [(r["timestamp"], r["mid"], r["score"]) for r in rs]
        assert keys == sorted(keys, reverse=True)
        every = sorted(((t, m, s) for u, m, s, t in events if u == uid), reverse=True)
        assert keys == every[:n]
