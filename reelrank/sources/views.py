"""Recommender views over the driver's generated parquet tables.

Each view maps one of the generated tables onto a record of the data model
(SURVEY §7.2) with native expressions only, so scans keep column pruning and
filter pushdown. The DuckDB twins of these views live in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.scalar import epoch_seconds
from reelrank.schemas import LOG_PAYLOAD_MARKER

# Genre list used against the generated part table: p_type words and p_name
# words; "Old" also hits "cold"/"gold" and "Tv" hits nothing, both on purpose.
TEST_GENRES = ["Economy", "Small", "Promo", "Ring", "Red", "Old", "Tv"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating(uid, mid, score, timestamp) = lineitem joined to its order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
        epoch_seconds("o_orderdate").cast("int").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie(mid, name, ..., genres, ...) = part; genres = type and name words."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("A "), F.col("p_name"), F.lit(" movie")).alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.lit("June 1, 1998").alias("issue"),
        F.lit("1998").alias("shoot"),
        F.col("p_brand").alias("language"),
        F.concat_ws("|", F.col("p_type"),
                    F.regexp_replace(F.col("p_name"), " ", "|")).alias("genres"),
        F.concat(F.lit("Cast of "), F.col("p_brand")).alias("actors"),
        F.lit("").alias("directors"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag(uid, mid, tag, timestamp) = events; mid is props.k, tag the event type."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def _stream_score() -> F.Column:
    return ((F.col("event_id") % 10) + 1).cast("double") / 2


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating messages "UID|MID|SCORE|TIMESTAMP", one per event, with event order."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        epoch_seconds("ts").cast("int").alias("epoch"),
        F.concat_ws(
            "|",
            F.col("user_id").cast("string"),
            F.get_json_object("props", "$.k"),
            _stream_score().cast("string"),
            epoch_seconds("ts").cast("string"),
        ).alias("value"),
    )


def stream_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating events the messages encode, as typed rows."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        _stream_score().alias("score"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines in five shapes (by event_id mod 5), each carrying a message.

    0 noise without marker; 1 text, marker, message; 2 marker, blanks, message,
    blanks; 3 message then marker with nothing after; 4 marker, message, marker,
    trailing text.
    """
    msgs = stream_messages(spark, sf_dir)
    m, shape = F.col("value"), F.col("event_id") % 5
    line = (
        F.when(shape == 0, F.concat(F.lit("noise event "), F.col("event_id").cast("string")))
        .when(shape == 1, F.concat(F.lit("INFO rating "), F.lit(LOG_PAYLOAD_MARKER), m))
        .when(shape == 2, F.concat(F.lit(LOG_PAYLOAD_MARKER), F.lit("   "), m, F.lit("   ")))
        .when(shape == 3, F.concat(m, F.lit(" "), F.lit(LOG_PAYLOAD_MARKER)))
        .otherwise(F.concat(F.lit(LOG_PAYLOAD_MARKER), m, F.lit(LOG_PAYLOAD_MARKER),
                            F.lit(" trailing")))
    )
    return msgs.select("event_id", "epoch", line.alias("value"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item factors (mid, features ARRAY<FLOAT>) = embeddings."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("mid"),
                    F.col("embedding").alias("features"))


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User factors (uid, features ARRAY<DOUBLE>) derived from the ratings.

    A user's vector is the mean of the item vectors of the movies they rated
    (every rating row counts), computed by Spark ML's ``Summarizer`` as one
    typed partial aggregate per user, so a user holding a third of all ratings
    is still combined map-side before the shuffle.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    r = ratings(spark, sf_dir).select("uid", "mid")
    f = features(spark, sf_dir)
    vecs = r.join(f, "mid").select(
        "uid", array_to_vector(F.col("features").cast("array<double>")).alias("v"))
    return (vecs.groupBy("uid").agg(Summarizer.mean(F.col("v")).alias("m"))
            .select("uid", vector_to_array("m").alias("features")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_name").alias("userName"), F.col("c_mktsegment"))


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, issued by the order's customer (userName, req_order)."""
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                               "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return od.join(c, od.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("userName"),
        F.col("o_orderkey").alias("req_order"),
        F.concat_ws("|", F.col("o_orderstatus"), F.col("o_orderpriority")).alias("genres"),
    )


def noisy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating messages with deterministic defects (by event_id mod 5): 0 and 1
    valid; 2 timestamp missing (3 fields); 3 an extra field (5 fields); 4 the
    score replaced by the event type (4 fields, not a number)."""
    e = table(spark, sf_dir, "events")
    uid, k = F.col("user_id").cast("string"), F.get_json_object("props", "$.k")
    score, ts = _stream_score().cast("string"), epoch_seconds("ts").cast("string")
    shape = F.col("event_id") % 5
    value = (F.when(shape <= 1, F.concat_ws("|", uid, k, score, ts))
             .when(shape == 2, F.concat_ws("|", uid, k, score))
             .when(shape == 3, F.concat_ws("|", uid, k, score, ts, F.col("event_type")))
             .otherwise(F.concat_ws("|", uid, k, F.col("event_type"), ts)))
    return e.select("event_id", epoch_seconds("ts").cast("int").alias("epoch"),
                    value.alias("value"))
