"""The plan properties the design relies on at scale, asserted on the
physical plans (formatted explain output)."""

import contextlib
import io

from pyspark.sql import functions as F

from reelrank.operators import factors, online, similarity, stats
from reelrank.sinks import tables
from reelrank.sources import views

from conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_group_top_k_is_cut_before_the_shuffle(spark):
    top = stats.genre_top_k(views.movies(spark, SF_SMALL),
                            stats.average_score(views.ratings(spark, SF_SMALL)),
                            views.TEST_GENRES, 10)
    p = plan(top, "simple")
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert "BroadcastNestedLoopJoin" not in p      # the genre list is a literal of the scan


def test_aggregates_combine_map_side(spark):
    p = plan(stats.rate_more_movies(views.ratings(spark, SF_SMALL)), "simple")
    assert "partial_count" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(views.ratings(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "l_extendedprice" not in p


def test_blocked_kernels_have_no_cartesian(spark):
    f = views.features(spark, SF_SMALL)
    for df in (similarity.similar_pairs(f, 0.3),
               factors.user_top_k(views.user_profiles(spark, SF_SMALL), f, 10)):
        p = plan(df, "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "MapInArrow" in p
        assert "REPARTITION_BY_NUM" in p           # one partition per block pair, never merged


def test_rating_lookup_is_cut_to_the_batch_users(spark):
    cands = spark.createDataFrame([(1, 10, 5, 0.9)], "uid int, mid int, cand int, sim double")
    rated = views.ratings(spark, SF_SMALL)
    p = plan(online.unrated_candidates(cands, rated, users=cands), "simple")
    assert any("LeftSemi" in ln for ln in p.splitlines()) and "LeftAnti" in p
    assert "CartesianProduct" not in p


def test_similarity_runs_once_in_realtime(spark):
    from reelrank.plans import catalog
    p = plan(catalog.realtime_recs(spark, SF_SMALL), "simple")
    assert "FlatMapGroupsInPandas" not in p and "FlatMapCoGroupsInPandas" not in p   # pairs are read back


def test_bucketed_lookup_prunes_partitions_at_run_time(spark, tmp_dir):
    path = tables.write_bucketed_by_key(views.ratings(spark, SF_SMALL), tmp_dir + "/r", "uid", 8)
    r = spark.read.parquet(path)
    assert tables.layout(r) == ("uid", 8, "uid_bucket_of_8")
    keys = r.filter("uid_bucket_of_8 in (1, 2)").select("uid").limit(5).persist()
    got = tables.lookup(r, keys, "uid")
    lines = [ln for ln in plan(got).splitlines() if ln.startswith("PartitionFilters")]
    assert lines and any("dynamicpruning" in ln for ln in lines)
    assert 0 < got.count() < r.count()
    assert got.join(keys, "uid", "left_semi").count() == r.join(keys, "uid", "left_semi").count()
    assert tables.lookup(r, keys, "mid") is r                  # another key: the whole table


def test_hot_user_recent_ratings(spark):
    # one user holds a third of all events: still exactly n rows for them
    hot = [(1, m % 50, 4.0, m) for m in range(3000)]
    rest = [(u, m, 3.0, m) for u in range(2, 50) for m in range(120)]
    df = spark.createDataFrame(hot + rest, "uid int, mid int, score double, timestamp int")
    rec = online.recent_ratings(df, 20)
    assert rec.filter("uid = 1").count() == 20
    assert rec.filter("uid = 1 AND pos = 1").first()["timestamp"] == 2999
    p = plan(rec, "simple")
    assert "WindowGroupLimit" in p and "Partial" in p
