from reelrank.operators import stats
from reelrank.schemas import DEFAULT_GENRES, REFERENCE_GENRES

from conftest import rows

MOVIE_COLS = "mid int, name string, genres string"


def test_genre_match_edges(spark):
    movies = spark.createDataFrame([
        (1, "a", "Musical|Comedy"), (2, "b", "Crime|Drama"), (3, "c", None),
        (4, "d", "Software|Western"), (5, "e", "Drama")], MOVIE_COLS)
    genres = stats.genre_table(spark, ["Music", "Crime", "War", "Horror"])
    got = rows(stats.genre_match(movies, genres), "genre", "mid")
    # Music hits Musical, War hits softWARe, null genres never match (D11)
    assert got == [("Crime", 2), ("Music", 1), ("War", 4)]


def test_default_list_fixes_crime():
    assert "Crime" in DEFAULT_GENRES and "Ccrime" not in DEFAULT_GENRES
    assert "Ccrime" in REFERENCE_GENRES and len(REFERENCE_GENRES) == 20


def test_genre_top_k_ties_and_k(spark):
    movies = spark.createDataFrame([(i, f"m{i}", "Drama") for i in range(1, 8)], MOVIE_COLS)
    avgs = spark.createDataFrame([(1, 3.0), (2, 4.0), (3, 4.0), (4, 1.0), (5, 5.0), (6, 2.0)],
                                 "mid int, avg double")
    genres = ["Drama", "Horror"]                      # a list: broadcast, size checked
    top = stats.genre_top_k(movies, avgs, genres, k=3)
    assert rows(top) == [("Drama", 1, 5, 5.0), ("Drama", 2, 2, 4.0), ("Drama", 3, 3, 4.0)]
    nested = stats.genres_top_movies(movies, avgs, genres, k=3).collect()
    assert len(nested) == 1 and nested[0]["genres"] == "Drama"
    assert [tuple(x) for x in nested[0]["recs"]] == [(5, 5.0), (2, 4.0), (3, 4.0)]


def test_counts_and_averages(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 1260759144), (2, 10, 2.0, 1262304000),
                               (1, 11, 5.0, 1262304000)],
                              "uid int, mid int, score double, timestamp int")
    assert rows(stats.rate_more_movies(r)) == [(10, 2), (11, 1)]
    assert rows(stats.rate_more_recently(r)) == [(10, 1, 200912), (10, 1, 201001),
                                                 (11, 1, 201001)]
    assert rows(stats.average_score(r)) == [(10, 3.0), (11, 5.0)]
    assert rows(stats.distinct_users(r)) == [(1,), (2,)]


def test_tags_dup_and_left_join(spark):
    tags = spark.createDataFrame(
        [(1, 10, "funny", 1), (2, 10, "funny", 2), (1, 10, "dark", 3), (3, 12, None, 4)],
        "uid int, mid int, tag string, timestamp int")
    movies = spark.createDataFrame([(10, "a", "x"), (11, "b", "y"), (12, "c", "z")], MOVIE_COLS)
    assert rows(stats.tags_per_movie(tags)) == [(10, "dark|funny"), (12, "")]
    joined = {r["mid"]: r["tags"] for r in stats.movies_with_tags(movies, tags).collect()}
    assert joined == {10: "dark|funny", 11: None, 12: ""}
    assert stats.movies_with_tags(movies, tags).columns.count("mid") == 1


def test_long_genre_list_and_genre_table(spark):
    movies = spark.createDataFrame([(1, "a", "Drama|War"), (2, "b", None)], MOVIE_COLS)
    names = [f"none{i}" for i in range(500)] + ["war", "DRAMA"]
    assert rows(stats.genre_match(movies, names), "genre", "mid") == [("DRAMA", 1), ("war", 1)]
    table = spark.createDataFrame([(x,) for x in [*names, None]], "genre string")
    assert rows(stats.genre_match(movies, table), "genre", "mid") == [("DRAMA", 1), ("war", 1)]
    assert stats.genre_match(movies, []).count() == 0


def test_genre_table_by_index_equals_contains(spark):
    from pyspark.sql import functions as F
    movies = spark.createDataFrame([(k, g) for k, g in enumerate(
        ["Drama|War", "drama", "Sci-Fi|Horror", None, "", "Ho", "aaaa", "Music|Musical", "Drama|War"])], "mid int, genres string")
    names = spark.createDataFrame([(g,) for g in (
        "DRAMA", "war", "ho", "h", "Horror", "aa", "aaa", "Musical", "Music", "xyz", "|", "", None, "war", "sci-fi|horror",
        "dramas", "é")], "genre string")
    want = movies.join(names, F.lower("genres").contains(F.lower("genre"))).select("genre", "mid")
    got = stats.genre_match(movies, names).select("genre", "mid")
    assert rows(got) == rows(want) and got.count() > 20
    assert stats.genre_match(movies, names.limit(0)).count() == 0
    assert stats.genre_match(movies.limit(0), names).count() == 0


def test_many_names_without_a_nested_loop(spark):
    from test_plans import plan
    names = spark.range(100_000).selectExpr("concat('name', id) as genre").union(spark.sql("select 'Drama'"))
    movies = spark.range(3000).selectExpr("cast(id as int) mid", "concat('Drama|name', id % 50, '|War') genres")
    got = stats.genre_match(movies, names)
    p = plan(got, "simple")
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    found = {r["mid"]: r["n"] for r in got.groupBy("mid").count().withColumnRenamed("count", "n").collect()}
    # name7 is in name7 only; name49 also holds name4
    assert found[7] == 2 and found[49] == 3 and len(found) == 3000
