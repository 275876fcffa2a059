"""Helpers shared by the training-data operators: shared-folder tables, row keys,
document chunks and distributed connected components."""

from __future__ import annotations

import gc
from contextlib import contextmanager

import pyarrow
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.session import fresh_path, ship_package

__all__ = ["read", "cut", "Scratch", "delete_table", "ship_package", "in_fold", "row_key", "kept",
           "chunked", "connected_components"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared work folder and read it back (lineage cut).

    The files are complete before anything reads them, so a lost executor costs
    only the tasks that ran on it. Returns the frame and its path, which the
    caller may give to ``delete_table`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Scratch:
    """Written tables that an operator needs only until its own result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        out, path = cut(df, name)
        self.paths.append(path)
        return out

    def clear(self) -> None:
        for path in self.paths:
            delete_table(self.spark, path)
        self.paths = []


def delete_table(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_KEPT: dict = {}


def kept(key, build=lambda: None):
    """What ``build`` makes, kept by a Python worker for the tasks to come. There is one such
    object at a time: workers outlive stages, and what one operator remembers must not
    take the memory of the next, so every operator's tasks ask for theirs first."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        _KEPT[key] = build()
    return _KEPT[key]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Jobs run inside hand texts to Python in batches of ``rows``; the session's setting is
    back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def in_fold(doc_id: str, mod: int, fold: int):
    """crc32 of the id as text modulo ``mod`` equals ``fold``; false for a null id
    (a row without id takes part in training and is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == fold,
                      F.lit(False))


def row_key(id_col: str, text_col: str):
    """A non-null long that names a row: its id, or a hash of its text when the id is null."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))


#: Rows of a file, or bytes of text, that make a chunk.
CHUNK_ROWS, CHUNK_BYTES = 2048, 4_000_000


def has_file_rows(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.file_path", "_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def file_place(chunk_rows: int) -> tuple[Column, Column]:
    """The chunk of a row that is read from a file, and its place in the file."""
    return (F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / chunk_rows)),
            F.col("_metadata.row_index"))


def chunked(docs: DataFrame, id_col: str, text_col: str, by_file: bool, *more: Column,
            chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows (__id, __rid, __text, __chunk, __at, *more), and the same rows in an order in
    which a task meets the rows of a chunk one after the other.

    With ``by_file`` a chunk is a stretch of ``chunk_rows`` rows of a Parquet file and
    ``__at`` the row's place in the file: no shuffle is needed, but where a file is split
    two tasks may each meet a part of a chunk. Otherwise rows are dealt by key hash
    into chunks of about ``chunk_bytes`` of text, and ``__at`` is 0; so they are where
    ``docs`` doesn't come from files.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_file = by_file and has_file_rows(docs)
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"),
                       F.coalesce(row_key(id_col, text_col), F.xxhash64(text)).alias("__rid"), *more,
                       *([c.alias(n) for c, n in zip(file_place(chunk_rows), ("__chunk", "__at"))] if by_file else []))
    if by_file:
        return rows, rows
    total = rows.agg(F.sum(F.octet_length("__text").cast("long")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // chunk_bytes))
    rows = rows.withColumn("__chunk", F.pmod(F.xxhash64("__rid"), F.lit(n))) \
        .withColumn("__at", F.lit(0).cast("long"))
    return rows, rows.repartition("__chunk").sortWithinPartitions("__chunk")


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Components of an undirected graph: ``edges`` (u, v) -> (node, component).

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    step is a grouped minimum (partial aggregates, so a hot node costs one row
    per task) and a join on the node, which adaptive execution splits when a
    node holds most edges. Each round is written to the shared folder, so
    lineage stays short and a lost executor repeats one round. ``component`` is
    the smallest node of the component. Null ends and self loops are ignored;
    nodes without an edge don't appear; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    e = edges.filter("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, path = cut(e, "cc")
    before = None
    for _ in range(max_rounds):
        # small star: a node and its smaller neighbours point at the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        small, small_path = cut(small, "cc")
        # large star: larger neighbours of a node point at its smallest neighbour
        both = small.union(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v")).distinct()
        large, large_path = cut(large, "cc")
        delete_table(spark, path)
        delete_table(spark, small_path)
        e, path = large, large_path
        # finished when every node points straight at a root: no root is also a child
        now = e.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
