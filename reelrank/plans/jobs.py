"""The application's jobs end to end, each writing its named tables under one
store folder (one sub-folder per table name):

* ``load_job``        text files -> Movie, Rating, Tag, MovieWithTags (+ rejects)
* ``statistics_job``  Rating, Movie -> RateMoreMovies, RateMoreMoviesRecently,
                      AverageMoviesScore, GenresTopMovies
* ``offline_job``     Rating, Movie -> UserRecs, MovieRecs (ALS)
* ``tuning_job``      Rating -> grid RMSEs and the best (rank, lambda)
* ``start_realtime_job`` / ``start_log_filter_job``  the two streams
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank import schemas as S
from reelrank.functions.scalar import year_month
from reelrank.operators import als, similarity, stats
from reelrank.sinks import tables
from reelrank.sources import text
from reelrank.streaming import jobs as stream_jobs

MOVIE_WITH_TAGS_TABLE = "MovieWithTags"
REJECTS = "_rejects"


PAIRS = "_movie_pairs"     # the flat form of MovieRecs that the stream looks up
PAIR_BUCKETS = 64


class Store:
    """Named tables as parquet folders under one base path."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        return tables.overwrite_table(df, self.path(name), partition_by)

    def write_version(self, df: DataFrame, name: str, key: str | None = None, buckets: int | None = None,
                      files_per_bucket: int | None = None) -> int:
        """A new version of a table that running streams look up, by buckets of ``key`` if given."""
        return tables.write_version(self.spark, self.path(name), lambda path: tables.write_bucketed_by_key(
            df, path, key, buckets, files_per_bucket) if buckets else tables.overwrite_table(df, path))

    def read(self, name: str) -> DataFrame:
        """The table; of one that has versions the newest complete one."""
        return tables.read_current(self.spark, self.path(name))


def load_job(spark: SparkSession, movie_path: str, rating_path: str, tag_path: str,
             store: Store, mode: str = "PERMISSIVE", rating_buckets: int | None = None,
             files_per_bucket: int | None = None) -> None:
    """Parse the three text inputs and store them; rejects go to ``_rejects``.

    Movie, Rating and Tag hold every parsed row. MovieWithTags (the search
    documents: movie left-joined to its tag string) is keyed by mid: a later
    line of the movie file replaces an earlier one (by file, then position).
    Rating is written as a new version, so a running real-time job isn't disturbed; with
    ``rating_buckets`` it is stored by buckets of uid for that job's lookups.
    """
    movies = text.load_movies(spark, movie_path, mode)
    ratings = text.load_ratings(spark, rating_path, mode)
    tags = text.load_tags(spark, tag_path, mode)
    store.write(movies.good, S.MOVIE_TABLE)
    store.write_version(ratings.good, S.RATING_TABLE, "uid", rating_buckets, files_per_bucket)
    store.write(tags.good, S.TAG_TABLE)
    if mode.upper() == "PERMISSIVE":
        rejects = movies.rejects.unionByName(ratings.rejects).unionByName(tags.rejects)
        store.write(rejects, REJECTS)
    # rows of a split keep their order, and splits are ordered by where they start
    ordered = text.load_movies(spark, movie_path, mode).good.withColumn(
        "__order", F.struct(F.col("_metadata.file_path").alias("f"),
                            F.col("_metadata.file_block_start").alias("b"),
                            F.monotonically_increasing_id().alias("i")))
    docs = stats.movies_with_tags(ordered, store.read(S.TAG_TABLE))
    store.write(tables.keep_last_by_key(docs, "mid", ["__order"]).drop("__order"),
                MOVIE_WITH_TAGS_TABLE)


def monthly_counts(ratings: DataFrame) -> DataFrame:
    """(yeahmouth, mid, count, sum_score): the one aggregate of the rating table
    every statistic is rolled up from."""
    return (ratings.select("mid", "score", year_month("timestamp").alias("yeahmouth"))
            .groupBy("yeahmouth", "mid")
            .agg(F.count("mid").alias("count"), F.count("score").alias("scores"),
                 F.sum("score").alias("sum_score")))


def rollups(monthly: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """RateMoreMoviesRecently, RateMoreMovies and AverageMoviesScore from the
    monthly pre-aggregate (months x movies rows, far smaller than the ratings)."""
    per_movie = monthly.groupBy("mid").agg(F.sum("count").alias("count"),
                                           F.sum("scores").alias("scores"),
                                           F.sum("sum_score").alias("sum_score"))
    return (monthly.select("mid", "count", "yeahmouth"),
            per_movie.select("mid", "count"),
            per_movie.select("mid", F.try_divide("sum_score", "scores").alias("avg")))


def statistics_tables(ratings: DataFrame, movies: DataFrame,
                      genres: Sequence[str] | DataFrame = S.DEFAULT_GENRES,
                      k: int = S.GENRE_TOP_K) -> dict[str, DataFrame]:
    """The four statistics tables as lazy DataFrames over one rating aggregate."""
    recently, more, averages = rollups(monthly_counts(ratings))
    return {
        S.RATE_MORE_MOVIES_RECENTLY_TABLE: recently,
        S.RATE_MORE_MOVIES_TABLE: more,
        S.AVERAGE_MOVIES_SCORE_TABLE: averages,
        S.GENRES_TOP_MOVIES_TABLE: stats.genres_top_movies(movies, averages, genres, k),
    }


def statistics_job(spark: SparkSession, store: Store, genres: Sequence[str] = S.DEFAULT_GENRES,
                   k: int = S.GENRE_TOP_K) -> None:
    """Write the four statistics tables, reading the rating table once: the
    monthly pre-aggregate is stored first and every table is a roll-up of it
    (the original job scanned the ratings once per table)."""
    ratings = store.read(S.RATING_TABLE).select("mid", "score", "timestamp")
    store.write(monthly_counts(ratings), "_monthly")
    recently, more, averages = rollups(store.read("_monthly"))
    store.write(recently, S.RATE_MORE_MOVIES_RECENTLY_TABLE)
    store.write(more, S.RATE_MORE_MOVIES_TABLE)
    store.write(averages, S.AVERAGE_MOVIES_SCORE_TABLE)
    store.write(stats.genres_top_movies(store.read(S.MOVIE_TABLE),
                                        store.read(S.AVERAGE_MOVIES_SCORE_TABLE), genres, k),
                S.GENRES_TOP_MOVIES_TABLE)


def offline_job(spark: SparkSession, store: Store, rank: int = S.ALS_RANK,
                max_iter: int = S.ALS_MAX_ITER, reg_param: float = S.ALS_REG_PARAM,
                seed: int = S.ALS_SEED, k: int = S.USER_MAX_RECOMMENDATION,
                threshold: float = S.SIMILARITY_THRESHOLD,
                pair_buckets: int = PAIR_BUCKETS) -> None:
    """Train ALS on Rating; write UserRecs (top k per user) and MovieRecs: flat pairs,
    versioned and bucketed for the stream, and from those the nested record, in segments."""
    with als.freeing_factors(spark):
        model = als.train(store.read(S.RATING_TABLE), rank, max_iter, reg_param, seed)
        top = als.offline_user_recs(model, store.read(S.MOVIE_TABLE), k)
        store.write(stats.nest_ranked(top, "uid", "uid", id_col="mid", score_col="score"),
                    S.USER_RECS_TABLE)
        publish_pairs(spark, store, als.offline_movie_recs(model, threshold), pair_buckets)
    store.write(similarity.movie_rec_segments(movie_recs_pairs(store)), S.MOVIE_RECS_TABLE)


def publish_pairs(spark: SparkSession, store: Store, pairs: DataFrame,
                  buckets: int = PAIR_BUCKETS) -> None:
    """Store flat (mid, rid, r) pairs, bucketed by mid, as a new version of their table."""
    store.write_version(pairs.select("mid", "rid", "r"), PAIRS, "mid", buckets)


def tuning_job(spark: SparkSession, store: Store, ranks: Sequence[int] = S.GRID_RANKS,
               reg_params: Sequence[float] = S.GRID_REG_PARAMS) -> DataFrame:
    """Grid search on Rating; writes the grid and returns the best row."""
    grid = als.grid_search(spark, store.read(S.RATING_TABLE), ranks, reg_params)
    store.write(grid, "_tuning_grid")
    return als.best_params(store.read("_tuning_grid"))


def movie_recs_pairs(store: Store) -> DataFrame:
    """Flat (mid, rid, r) pairs of the newest offline run."""
    return store.read(PAIRS).select("mid", "rid", "r")


def start_realtime_job(spark: SparkSession, ratings_topic: DataFrame, store: Store,
                       checkpoint: str, available_now: bool = False, **kw):
    """Rating topic -> StreamRecs (append log under the store); messages that are no
    ratings go to ``_rating_rejects``. Every batch looks up the newest Rating table and the
    pairs of the newest offline run, by the buckets of its own users and movies."""
    return stream_jobs.start_realtime(
        spark, ratings_topic, store.path(PAIRS), store.path(S.RATING_TABLE),
        store.path(S.STREAM_RECS_TABLE), checkpoint, available_now=available_now,
        rejects_path=store.path("_rating_rejects"), **kw)


def start_log_filter_job(lines: DataFrame, sink: str, checkpoint: str,
                         available_now: bool = False, servers: str | None = None):
    """Raw log topic -> rating messages: to the topic ``sink`` of the given Kafka ``servers``,
    or appended to the Parquet folder ``sink`` without servers."""
    stream = stream_jobs.log_filter_stream(lines)
    if servers:
        return stream_jobs.to_kafka(stream, servers, sink, checkpoint, available_now)
    return stream_jobs.run_to_parquet(stream, sink, checkpoint, available_now)
