"""Exact top-k search by inner product with a three-phase uniform threshold.

Vectors are cut into ``SLICES`` column slices; a slice of a block of rows is a
list of local scores, and a vector's score is the sum over its slices.

1. Every list reports its k best entries for each query; the k-th best total
   among the reported vectors is a safe cutoff t: the true k-th best is no lower.
2. A vector that reaches t has a slice with at least t / SLICES, so every list
   reports its entries from that uniform threshold on. What an entry lacks is
   bounded by the threshold, and entries that can't reach t are left out.
3. The slices that nobody reported for the remaining entries are looked up, and
   the totals are exact.

Equal vectors are searched once. Queries and rows meet block by block, so a task
holds two bounded blocks however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.llm.common import Scratch, cut, read, ship_package
from reelrank.operators.blocks import cross_pair_sides

SLICES = 2
QUERY_BLOCK, ROW_BLOCK = 512, 8192


def to_ints(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for a null vector or one that holds a
    null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(
        vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows as a matrix; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _slice_scores(q: np.ndarray, v: np.ndarray, slices: int) -> list[np.ndarray]:
    """Score matrix of each slice. Doubles are exact while sums stay under 2**53."""
    width = q.shape[1]
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * width
    if top < 2 ** 53:
        q, v = q.astype(np.float64), v.astype(np.float64)
    at = [width * s // slices for s in range(slices + 1)]
    return [(q[:, a:b] @ v[:, a:b].T).astype(np.int64) for a, b in zip(at, at[1:])]


def _met(queries: DataFrame, rows: DataFrame, blocks: tuple[int, int], kernel: Callable,
         schema: str) -> DataFrame:
    """Runs ``kernel(query block, row block)`` for every pair of blocks."""
    left, right = cross_pair_sides(queries, "gid", blocks[0], rows, "gid", blocks[1])
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(
        lambda q, v: kernel(q, v) if len(q) and len(v) else pd.DataFrame(
            columns=[c.split()[0] for c in schema.split(", ")]), schema)


def _first_lists(k: int, width: int, slices: int):
    def kernel(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        parts = _slice_scores(_matrix(q["v"], width), _matrix(v["v"], width), slices)
        total = sum(parts)
        qids, vids = q["gid"].to_numpy(), v["gid"].to_numpy()
        n = min(k, len(vids))
        at = np.hstack([np.argpartition(-s, n - 1, axis=1)[:, :n] for s in parts])
        rows = np.repeat(np.arange(len(qids)), at.shape[1])
        return pd.DataFrame({"q": qids[rows], "g": vids[at.ravel()],
                             "total": total[rows, at.ravel()]}).drop_duplicates()
    return kernel


def _sufficient(width: int, slices: int):
    def kernel(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        parts = _slice_scores(_matrix(q["v"], width), _matrix(v["v"], width), slices)
        cutoff = q["cutoff"].to_numpy()[:, None]
        qids, vids = q["gid"].to_numpy(), v["gid"].to_numpy()
        seen = np.zeros_like(parts[0])
        mask = np.zeros(seen.shape, dtype=np.int64)
        for s, part in enumerate(parts):
            reported = part * slices >= cutoff
            seen += np.where(reported, part, 0)
            mask += reported * (1 << s)
        missing = slices - np.bitwise_count(mask.astype(np.uint64)).astype(np.int64)
        # a slice that wasn't reported holds less than cutoff / slices
        can = (mask > 0) & (seen * slices + missing * cutoff >= cutoff * slices)
        i, j = np.nonzero(can)
        return pd.DataFrame({"q": qids[i], "g": vids[j], "seen": seen[i, j], "mask": mask[i, j]})
    return kernel


def _rest(q: Column, v: Column, mask: Column, width: int, slices: int) -> Column:
    """Inner product over the slices that ``mask`` lacks."""
    out = F.lit(0).cast("long")
    for s in range(slices):
        a, b = width * s // slices, width * (s + 1) // slices
        part = F.aggregate(F.zip_with(F.slice(q, a + 1, b - a), F.slice(v, a + 1, b - a),
                                      lambda x, y: F.coalesce(x * y, F.lit(0))),
                           F.lit(0).cast("long"), lambda acc, x: acc + x)
        out = out + F.when(F.getbit(mask, F.lit(s)) == 1, F.lit(0).cast("long")).otherwise(part)
    return out


def search(vectors: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
           is_query: Column | None = None, scale: int = 256, slices: int = SLICES,
           query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query row.

    ``is_query`` is a condition on ``id_col`` (default: every row). Components become
    floor(scale * x); the score is the integer inner product; ties go to the
    smaller id. Rows with a null id, a null vector or a null or non-finite component
    take no part; an id that occurs several times counts once, with its smallest
    vector; shorter vectors are filled up with zeros; an empty vector scores 0.
    Fewer than k other rows give fewer results. Other columns are ignored.

    Up to k copies of a best vector are needed beside the query's own, so each
    distinct vector keeps its k + 1 smallest ids, taken before the shuffle.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    ask = F.lit(True) if is_query is None else is_query
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          to_ints(F.col(vector_col), scale).alias("v"), ask.alias("asks")) \
        .filter("id is not null and v is not null")
    rows = scratch.cut(rows.groupBy("id").agg(F.min("v").alias("v"), F.first("asks").alias("asks")), "topk_rows")

    near = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    ids = rows.select("v", "id").withColumn("n", near).filter(F.col("n") <= k + 1) \
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("v").agg(F.bool_or("asks").alias("asks"))
    groups = scratch.cut(ids.join(asked, "v").select(F.get("ids", F.lit(0)).alias("gid"), "v", "ids", "asks"),
                    "topk_groups")
    n, nq, width = groups.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    if not n or not nq:
        scratch.clear()
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, slices)
    queries = groups.filter("asks").select("gid", "v")
    blocks = math.ceil(nq / query_block), math.ceil(n / row_block)
    best = k + 1                               # one of them may be the query's own

    lists = _met(queries, groups.select("gid", "v"), blocks, _first_lists(best, width, slices),
                 "q long, g long, total long")
    order = Window.partitionBy("q").orderBy(F.desc("total"), "g")
    cutoff = lists.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= best) \
        .groupBy("q").agg(F.when(F.count("*") == best, F.min("total")).alias("cutoff"))
    cutoff = scratch.cut(cutoff, "topk_cutoff")
    # with fewer rows than wanted any total will do
    asking = queries.join(cutoff, F.col("gid") == F.col("q")).select(
        "gid", "v", F.coalesce("cutoff", F.lit(-(1 << 56))).alias("cutoff"))
    entries = _met(asking, groups.select("gid", "v"), blocks, _sufficient(width, slices),
                   "q long, g long, seen long, mask long")

    qv = queries.select(F.col("gid").alias("q"), F.col("v").alias("qv"))
    gv = groups.select(F.col("gid").alias("g"), F.col("v").alias("gv"))
    found = entries.join(gv, "g").join(qv, "q").select(
        "q", "g", (F.col("seen") + _rest(F.col("qv"), F.col("gv"), F.col("mask"), width, slices))
        .alias("total"))
    found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= best)
    found, _ = cut(found.join(groups.select(F.col("gid").alias("g"), "ids"), "g")
                   .groupBy("q").agg(F.collect_list(F.struct("total", "ids")).alias("found")), "topk_found")

    # every query row takes its vector's answer: at most (k + 1)^2 ids, itself left out
    asks = rows.filter("asks").select(F.col("id").alias("query_id"), "v")
    mine = asks.join(groups.filter("asks").select("v", F.col("gid").alias("q")), "v").select("query_id", "q")
    mine, _ = cut(mine, "topk_asks")
    scratch.clear()
    scratch.clear()
    flat = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct(
        (-f["total"]).alias("neg"), i.alias("vec_id")))))
    others = F.filter(F.array_sort(flat), lambda x: x["vec_id"] != F.col("query_id"))
    return mine.join(found, "q").select("query_id", F.posexplode(F.slice(others, 1, k))).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"),
        (-F.col("col.neg")).alias("score"))


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), 5, is_query=F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
