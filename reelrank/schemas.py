"""Record schemas, table names and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original application's values for the
# results to match; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Genre list of the statistics job, exactly as shipped (note "Ccrime").
REFERENCE_GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Ccrime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]
# Same list with the typo fixed; this is our default (behaviour change D10).
DEFAULT_GENRES = [g if g != "Ccrime" else "Crime" for g in REFERENCE_GENRES]

# Table (collection) names.
USER_TABLE = "User"
MOVIE_TABLE = "Movie"
RATING_TABLE = "Rating"
TAG_TABLE = "Tag"
AVERAGE_MOVIES_SCORE_TABLE = "AverageMoviesScore"
RATE_MORE_MOVIES_TABLE = "RateMoreMovies"
RATE_MORE_MOVIES_RECENTLY_TABLE = "RateMoreMoviesRecently"
GENRES_TOP_MOVIES_TABLE = "GenresTopMovies"
MOVIE_RECS_TABLE = "MovieRecs"
STREAM_RECS_TABLE = "StreamRecs"
USER_RECS_TABLE = "UserRecs"

# Log line marker and the key every filtered log record carries.
MOVIE_RATING_PREFIX = "MOVIE_RATING_PREFIX"
LOG_PAYLOAD_MARKER = MOVIE_RATING_PREFIX + ":"
LOG_OUTPUT_KEY = "logProcessor"

# Sizes and thresholds.
RECENT_QUEUE_SIZE = 20          # recent ratings kept per user
MAX_SIM_MOVIES = 20             # candidates taken per rating event
USER_MAX_RECOMMENDATION = 10    # top-k per user
GENRE_TOP_K = 10                # top-k per genre
SIMILARITY_THRESHOLD = 0.6      # cosine threshold, batch and online
LIKE_SCORE = 3.0                # score > 3 counts as a like, else a dislike

# ALS settings of the offline job and the tuning grid.
ALS_RANK = 50
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.01
ALS_SEED = 42                   # the original draws a random seed (D12)
GRID_RANKS = [30, 40, 50, 60, 70]
GRID_REG_PARAMS = [1.0, 0.1, 0.001]

# ---------------------------------------------------------------------------
# Record schemas
# ---------------------------------------------------------------------------

MOVIE_FIELDS = ["mid", "name", "descri", "timelong", "issue", "shoot",
                "language", "genres", "actors", "directors"]

MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType(), False)]
    + [T.StructField(f, T.StringType(), True) for f in MOVIE_FIELDS[1:]]
)

RATING = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("timestamp", T.IntegerType(), False),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), True),
    T.StructField("timestamp", T.IntegerType(), False),
])

RECOMMENDATION = T.StructType([
    T.StructField("rid", T.IntegerType(), False),
    T.StructField("r", T.DoubleType(), False),
])
RECS = T.ArrayType(RECOMMENDATION, False)

USER_RECS = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("recs", RECS, False),
])

MOVIE_RECS = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("recs", RECS, False),
])

GENRES_RECS = T.StructType([
    T.StructField("genres", T.StringType(), False),
    T.StructField("recs", RECS, False),
])

FACTORS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("features", T.ArrayType(T.FloatType()), False),
])

USER = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("userName", T.StringType(), False),
    T.StructField("genres", T.ArrayType(T.StringType(), False), False),
    T.StructField("firstLogin", T.BooleanType(), False),
])
