"""Statistics operators: counts, monthly counts, mean scores, genre top-k, tags.

All are declarative DataFrame plans: aggregations get partial (map-side)
aggregation, per-group top-k gets a partial WindowGroupLimit before its
shuffle, and the genre list is a small literal table broadcast by design.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.functions.scalar import year_month
from reelrank.schemas import DEFAULT_GENRES, GENRE_TOP_K


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Rating count per movie -> (mid, count)."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def ratings_with_month(ratings: DataFrame) -> DataFrame:
    """(mid, score, yeahmouth) with the month as INT yyyyMM (UTC)."""
    return ratings.select("mid", "score", year_month("timestamp").alias("yeahmouth"))


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """Rating count per (month, movie) -> (mid, count, yeahmouth)."""
    return (ratings_with_month(ratings)
            .groupBy("yeahmouth", "mid").agg(F.count("mid").alias("count"))
            .select("mid", "count", "yeahmouth"))


def average_score(ratings: DataFrame) -> DataFrame:
    """Mean score per movie -> (mid, avg)."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def movies_with_score(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies that have a mean score (inner join on mid)."""
    return movies.join(averages, "mid")


def genre_table(spark: SparkSession, genres: Sequence[str] = DEFAULT_GENRES) -> DataFrame:
    """The genre list as a one-column table (a literal of known size), built
    JVM-side from a literal array, with no Python-side data transfer."""
    names = F.array(*[F.lit(str(g)) for g in genres]) if genres else \
        F.array().cast("array<string>")
    return spark.range(1).select(F.explode(names).alias("genre"))


def genre_match(movies: DataFrame, genres: Sequence[str] | DataFrame) -> DataFrame:
    """(genre, movie row) for every genre whose lower-case name is a substring
    of the movie's lower-case genres text. Null genres never match (D11).

    A genre *list* is a literal of the plan: each movie row keeps the names it
    contains (one scan, no shuffle, no join) and is exploded over those. A genre
    *table* is matched by an index of its names' rarest letters (``indexed_match``).
    """
    if isinstance(genres, DataFrame):
        return indexed_match(movies, genres)
    names = F.array(*[F.lit(str(g)) for g in genres]) if genres else F.array().cast("array<string>")
    text = F.lower(F.col("genres"))
    return movies.withColumn("genre", F.explode(F.filter(names, lambda g: text.contains(F.lower(g)))))


GRAM = 3     # letters of an index entry


def _grams(text: Column, n: int) -> Column:
    """The distinct stretches of ``n`` letters of a text; of a shorter text none."""
    return F.array_distinct(F.transform(
        F.when(F.length(text) >= max(n, 1), F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>")),
        lambda k: F.substring(text, k, F.lit(n))))


def indexed_match(movies: DataFrame, genres: DataFrame) -> DataFrame:
    """(movie row, genre) for every name of the table ``genres`` (column genre) that the movie's
    genres text contains, upper and lower case alike, by equi-joins only.

    The distinct texts are matched, then joined back to the movies. A name is looked up by the
    one of its three-letter stretches that the fewest texts have (a shorter name by itself), and
    found candidates are verified. Repeated names match as often as they come, an
    empty name matches every text, a null name or text none.
    """
    text = F.lower(F.col("genres"))
    texts = movies.select(text.alias("t")).filter("t is not null").distinct()
    names = genres.select(F.col("genre"), F.lower("genre").alias("g")).filter("g is not null")
    # lengths of index entries that the names need: GRAM + 1 rows
    sizes = [r["n"] for r in names.select(F.least(F.length("g"), F.lit(GRAM)).alias("n")).distinct().collect()]
    entry = F.when(F.length("g") < GRAM, F.array("g")).otherwise(_grams(F.col("g"), GRAM))
    listed = [_grams(F.col("t"), n) for n in sorted(sizes) if n] + ([F.array(F.lit(""))] if 0 in sizes else [])
    index = texts.select("t", F.explode(F.concat(*listed) if listed else F.array().cast("array<string>")).alias("gram"))
    often = index.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    distinct = names.select("g").distinct().select("g", F.explode(entry).alias("gram"))
    # a stretch that no text has settles its name: it matches nothing
    rarest = distinct.join(often, "gram", "left").groupBy("g").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("gram"))).alias("m")) \
        .filter("m.df > 0").select("g", F.col("m.gram").alias("gram"))
    found = index.join(rarest, "gram").filter(F.col("t").contains(F.col("g"))).select("t", "g")
    return movies.withColumn("__t", text).join(found.withColumnRenamed("t", "__t"), "__t") \
        .join(names, "g").drop("__t", "g")


def genre_top_k(movies: DataFrame, averages: DataFrame, genres: Sequence[str] | DataFrame,
                k: int = GENRE_TOP_K) -> DataFrame:
    """Top k movies per genre by mean score, flat -> (genre, rank, mid, avg).

    Ties by mid ascending. Genres without any match are absent.
    """
    scored = movies.select("mid", "genres").join(averages.select("mid", "avg"), "mid")
    matched = genre_match(scored, genres).select("genre", "mid", "avg")
    w = Window.partitionBy("genre").orderBy(F.desc("avg"), F.asc("mid"))
    return (matched.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("genre", "rank", "mid", "avg"))


def nest_ranked(flat: DataFrame, key: str, key_out: str, id_col: str = "mid",
                score_col: str = "avg", rank_col: str = "rank") -> DataFrame:
    """Flat top-k rows -> (key, recs ARRAY<STRUCT<rid, r>>) in rank order.

    Input is already cut to k rows per key, so each list is bounded by k.
    """
    return flat.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("k"),
                                                 F.col(id_col).cast("int").alias("rid"),
                                                 F.col(score_col).alias("r")))),
            lambda s: F.struct(s["rid"].alias("rid"), s["r"].alias("r")),
        ).alias("recs")
    ).withColumnRenamed(key, key_out)


def genres_top_movies(movies: DataFrame, averages: DataFrame,
                      genres: Sequence[str] | DataFrame, k: int = GENRE_TOP_K) -> DataFrame:
    """GenresRecommendation(genres, recs) as the statistics job stores it."""
    return nest_ranked(genre_top_k(movies, averages, genres, k), "genre", "genres")


def tags_per_movie(tags: DataFrame) -> DataFrame:
    """Distinct tags of each movie joined by "|" (sorted) -> (mid, tags).

    One ``collect_set`` aggregate: each map task sends one deduplicated set per
    movie (partial aggregation), so a movie with a third of all tag rows costs
    one set per task and its final list is bounded by its distinct tags. NULL
    tags are skipped, so a movie with only NULL tags gets "".
    """
    return tags.groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_set("tag"))).alias("tags"))


def movies_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movies left-joined to their tag string; tagless movies keep a NULL."""
    return movies.join(tags_per_movie(tags), "mid", "left")
