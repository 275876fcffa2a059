"""User-table merges: registration and genre preferences.

The original serves these one request at a time against a document store; as
Spark jobs they are set-based merges of a request table into the user table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.scalar import java_string_hash, split_genres


def empty_users(spark) -> DataFrame:
    from reelrank.schemas import USER
    return spark.createDataFrame([], USER)


def register_users(users: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge register requests (userName, req_order) into ``users``.

    A name already present is refused; among requests for a new name the first
    (lowest req_order) wins. New users get uid = the name's Java string hash,
    no genres and firstLogin = true.
    Returns (users after the merge, outcomes (userName, req_order, success)).
    """
    first = requests.groupBy("userName").agg(F.min("req_order").alias("__first"))
    fresh = first.join(users.select("userName"), "userName", "left_anti")
    new_rows = fresh.select(
        java_string_hash("userName").alias("uid"), "userName",
        F.array().cast("array<string>").alias("genres"), F.lit(True).alias("firstLogin"))
    merged = users.select("uid", "userName", "genres", "firstLogin").unionByName(new_rows)
    outcomes = requests.select("userName", "req_order").join(
        fresh.withColumn("__new", F.lit(True)), "userName", "left") \
        .select("userName", "req_order",
                (F.coalesce(F.col("__new"), F.lit(False))
                 & (F.col("req_order") == F.col("__first"))).alias("success"))
    return merged, outcomes


def update_user_genres(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Apply genre requests (userName, genres "a|b|c", req_order): the latest
    request per name sets the list and clears the first-login flag. Requests
    for unknown names change nothing.
    """
    latest = requests.groupBy("userName").agg(
        F.max_by("genres", "req_order").alias("__genres"))
    return users.join(latest, "userName", "left").select(
        "uid", "userName",
        F.when(F.col("__genres").isNotNull(), split_genres("__genres"))
        .otherwise(F.col("genres")).alias("genres"),
        F.when(F.col("__genres").isNotNull(), F.lit(False))
        .otherwise(F.col("firstLogin")).alias("firstLogin"))
