import os

import pytest
from pyspark.sql import functions as F

from reelrank import schemas as S
from reelrank.operators import als, similarity, stats
from reelrank.plans import jobs
from reelrank.sinks import tables
from reelrank.sources import views

from conftest import SF_SMALL, rows


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def store(spark, tmp_dir):
    _write(tmp_dir + "/in/movies.txt", [
        "1^Old Name^d^90 minutes^i^s^English^Drama|War^a^dir",
        "2^Two^d^90 minutes^i^s^English^Comedy^a^dir",
        "1^New Name^d^90 minutes^i^s^English^Drama|War^a^dir",   # same mid later: replaces
        "bad line"])
    _write(tmp_dir + "/in/ratings.txt", [
        "10,1,4.0,1260759144", "11,1,2.0,1262304000", "10,2,5.0,1262304000", "x,1,1.0,1"])
    _write(tmp_dir + "/in/tags.txt", ["10,1,epic,1", "11,1,epic,2", "11,2,funny,3"])
    st = jobs.Store(spark, tmp_dir + "/store")
    jobs.load_job(spark, tmp_dir + "/in/movies.txt", tmp_dir + "/in/ratings.txt",
                  tmp_dir + "/in/tags.txt", st)
    return st


def test_load_job(spark, store):
    assert rows(store.read(S.MOVIE_TABLE), "mid", "name") == [(1, "New Name"), (1, "Old Name"),
                                                              (2, "Two")]
    assert rows(store.read(jobs.MOVIE_WITH_TAGS_TABLE), "mid", "name") == [(1, "New Name"),
                                                                         (2, "Two")]
    assert store.read(S.RATING_TABLE).count() == 3
    assert store.read(jobs.REJECTS).count() == 2
    assert rows(store.read(jobs.MOVIE_WITH_TAGS_TABLE), "mid", "tags") == [(1, "epic"),
                                                                         (2, "funny")]


def test_rating_is_written_in_versions(spark, store, tmp_dir):
    """The load job runs again, with buckets, while a reader holds the table before."""
    before = store.read(S.RATING_TABLE)
    _write(tmp_dir + "/in/ratings.txt", ["10,1,4.0,1260759144"])
    jobs.load_job(spark, tmp_dir + "/in/movies.txt", tmp_dir + "/in/ratings.txt", tmp_dir + "/in/tags.txt",
                  store, rating_buckets=4)
    after = store.read(S.RATING_TABLE)
    assert before.count() == 3 and after.count() == 1
    assert tables.layout(before) is None and tables.layout(after)[:2] == ("uid", 4)


def test_statistics_job_equals_operators(spark, store):
    jobs.statistics_job(spark, store, ["Drama", "Comedy", "Horror"], 10)
    r = store.read(S.RATING_TABLE)
    assert rows(store.read(S.RATE_MORE_MOVIES_TABLE)) == rows(stats.rate_more_movies(r))
    assert rows(store.read(S.RATE_MORE_MOVIES_RECENTLY_TABLE)) == \
        rows(stats.rate_more_recently(r))
    assert rows(store.read(S.AVERAGE_MOVIES_SCORE_TABLE)) == rows(stats.average_score(r))
    g = {x["genres"]: [tuple(y) for y in x["recs"]]
         for x in store.read(S.GENRES_TOP_MOVIES_TABLE).collect()}
    # the Movie table keeps both lines of mid 1, so (as in the original) it is
    # listed once per movie row
    assert g == {"Drama": [(1, 3.0), (1, 3.0)], "Comedy": [(2, 5.0)]}


def test_als_fixed_seed_counts_and_fit(spark):
    ratings = views.ratings(spark, SF_SMALL).persist()
    model = als.train(ratings, rank=8, max_iter=5, reg_param=0.1, seed=42)
    n_users = ratings.select("uid").distinct().count()
    n_items = ratings.select("mid").distinct().count()
    assert model.userFactors.count() == n_users and model.itemFactors.count() == n_items
    assert model.itemFactors.select(F.size("features")).distinct().first()[0] == 8
    rmse = als.training_rmse(model, ratings)
    mean = ratings.agg(F.avg("score")).first()[0]
    base = ratings.agg(F.sqrt(F.avg((F.col("score") - mean) ** 2))).first()[0]
    assert rmse < base
    again = als.train(ratings, rank=8, max_iter=5, reg_param=0.1, seed=42)
    assert als.training_rmse(again, ratings) == pytest.approx(rmse, rel=1e-6)
    top = als.offline_user_recs(model, views.movies(spark, SF_SMALL), 10)
    per_user = top.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"))
    assert per_user.count() <= n_users and per_user.agg(F.max("n")).first()[0] <= 10
    assert per_user.agg(F.min("lo")).first()[0] > 0
    ratings.unpersist()


def test_offline_and_tuning_jobs(spark, tmp_dir):
    st = jobs.Store(spark, tmp_dir + "/store")
    st.write(views.ratings(spark, SF_SMALL), S.RATING_TABLE)
    st.write(views.movies(spark, SF_SMALL), S.MOVIE_TABLE)
    jobs.offline_job(spark, st, rank=6, max_iter=3, threshold=0.6)
    ur = st.read(S.USER_RECS_TABLE)
    assert ur.count() > 0 and ur.select(F.max(F.size("recs"))).first()[0] <= 10
    first = ur.select(F.col("recs")[0]["r"].alias("a"), F.col("recs")[1]["r"].alias("b")) \
        .filter(F.col("b").isNotNull())
    assert first.filter(F.col("a") < F.col("b")).count() == 0          # sorted desc
    pairs = jobs.movie_recs_pairs(st)
    assert pairs.filter(F.col("mid") == F.col("rid")).count() == 0
    assert pairs.filter(F.col("r") <= 0.6).count() == 0
    best = jobs.tuning_job(spark, st, ranks=[4, 6], reg_params=[0.1]).collect()
    grid = st.read("_tuning_grid").collect()
    assert len(grid) == 2 and len(best) == 1
    assert best[0]["rmse"] == min(g["rmse"] for g in grid)
    held = als.grid_search(spark, st.read(S.RATING_TABLE), [4], [0.1], max_iter=3, holdout=0.2)
    assert held.count() == 1 and held.first()["rmse"] > 0


def test_realtime_and_log_filter_jobs(spark, tmp_dir):
    st = jobs.Store(spark, tmp_dir + "/store")
    st.write(views.ratings(spark, SF_SMALL), S.RATING_TABLE)
    st.write(views.movies(spark, SF_SMALL), S.MOVIE_TABLE)
    pairs = similarity.similar_pairs(views.features(spark, SF_SMALL), 0.2)
    jobs.publish_pairs(spark, st, pairs)
    msgs = views.stream_messages(spark, SF_SMALL).select("value")
    msgs.coalesce(1).write.mode("overwrite").text(tmp_dir + "/topic")
    q = jobs.start_realtime_job(spark, spark.readStream.format("text").load(tmp_dir + "/topic"),
                                st, tmp_dir + "/ckpt", available_now=True, threshold=0.2)
    assert q.exception() is None
    recs = tables.read_replace_table(spark, st.path(S.STREAM_RECS_TABLE))
    n_users = views.stream_ratings(spark, SF_SMALL).select("uid").distinct().count()
    assert recs.count() == n_users and "recs_text" in recs.columns
    # the log-filter job on a processing-time trigger (the production form)
    lines = views.log_lines(spark, SF_SMALL).select("value")
    lines.coalesce(1).write.mode("overwrite").text(tmp_dir + "/logs")
    lq = jobs.start_log_filter_job(spark.readStream.format("text").load(tmp_dir + "/logs"),
                                   tmp_dir + "/filtered", tmp_dir + "/lckpt")
    try:
        lq.processAllAvailable()
    finally:
        lq.stop()
    assert spark.read.parquet(tmp_dir + "/filtered").count() == \
        3 * views.log_lines(spark, SF_SMALL).count() // 5


def test_concurrent_grid_equals_the_serial_one(spark):
    ratings, before = views.ratings(spark, SF_SMALL), set(als._factor_tables(spark))
    run = lambda n: [tuple(r) for r in als.grid_search(
        spark, ratings, [4, 6], [0.01, 0.1, 1.0], max_iter=3, at_once=n).collect()]
    serial, together = run(1), run(4)
    assert [r[:3] for r in serial] == [r[:3] for r in together] == [
        (k, rank, reg) for k, (rank, reg) in enumerate((a, b) for a in (4, 6) for b in (0.01, 0.1, 1.0))]
    assert [r[3] for r in together] == pytest.approx([r[3] for r in serial], rel=1e-6)
    assert set(als._factor_tables(spark)) <= before          # nothing is left in executor storage


def test_training_error_sends_no_vectors_with_the_ratings(spark):
    """The error by blocks equals Spark ML's own predictions, repeats, unknown and null ids included;
    iterations drop their shuffle files."""
    from reelrank.operators import als, factors
    ratings = spark.range(600).selectExpr("cast(id % 20 as int) uid", "cast(id * 7 % 13 as int) mid",
                                          "cast(id % 5 as double) score")
    model = als.train(ratings, rank=4)
    asked = ratings.union(ratings.limit(30)).union(spark.sql("select 999, 1, 2d")).union(spark.sql("select null, 1, 2d"))
    own = factors.rmse(als.predict_pairs(model, asked.filter("uid is not null"))).first()["rmse"]
    assert abs(als.training_rmse(model, asked) - own) < 1e-6
    assert als.als_estimator().getCheckpointInterval() == 1


def test_training_leaves_no_shuffle_files(spark):
    """What a fit has shuffled is gone when it is done, and its factors can still be read; a table
    that is stored itself keeps its files."""
    from reelrank.operators import als

    sc = spark.sparkContext
    tracker = sc._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(30) for m in range(u % 3, 20, 3)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double").repartition(3).checkpoint()
    held = lambda: tracker.shuffleStatuses().size()
    before = held()
    model = als.train(ratings, rank=3, max_iter=2)
    assert held() <= before
    assert model.userFactors.count() == 30 and model.itemFactors.count() == 20
    assert model.recommendForAllUsers(2).count() == 30


def test_large_fits_of_a_grid_are_made_one_by_one(spark, monkeypatch):
    from reelrank.operators import als

    under_way, most, train = [], [], als.train

    def counted(*args, **kw):
        under_way.append(1)
        most.append(len(under_way))
        model = train(*args, **kw)
        under_way.pop()
        return model

    monkeypatch.setattr(als, "train", counted)
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(20) for m in range(u % 3, 20, 3)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    few = als.grid_search(spark, ratings, [2], [0.1, 1.0, 10.0], max_iter=1).collect()
    monkeypatch.setattr(als, "GRID_RATINGS", len(rows))
    most.clear()
    assert als.grid_search(spark, ratings, [2], [0.1, 1.0, 10.0], max_iter=1).collect() == few
    assert max(most) == 1
