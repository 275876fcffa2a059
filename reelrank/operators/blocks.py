"""Block layout for the two quadratic factor products (item x item, user x item).

Rows are hashed into blocks whose size is set from a memory budget, and every
pair of blocks that must meet is formed by an *equi*-join key (a, b): each row
is sent to the block pairs it takes part in. ``cogroup(...).applyInPandas``
then hands one task exactly two bounded blocks, which a numpy kernel
multiplies while emitting only the rows that survive (threshold or top-k).
No pair of rows is ever materialised as a Spark row.

Shuffle volume is n_left * blocks_right + n_right * blocks_left rows, so larger
blocks mean less replication; the budget keeps a block pair within task memory.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.scalar import as_double_array

DEFAULT_BLOCK_MB = 64.0
SLAB_CELLS = 8_000_000  # score-matrix cells computed at once inside a kernel


def as_sent(df: DataFrame, vec: str) -> Column:
    """A vector column as it travels: single precision stays so, half the bytes; kernels work in doubles."""
    return F.col(vec) if df.schema[vec].dataType.simpleString() == "array<float>" else as_double_array(vec)


def block_rows_for(dim: int, block_mb: float = DEFAULT_BLOCK_MB, size: int = 8) -> int:
    return max(1, int(block_mb * 1024 * 1024 // max(1, dim * size)))


def materialize(vectors: DataFrame) -> DataFrame:
    """Reliable checkpoint of the prepared vectors (in ``spark.checkpoint.dir``).

    The block count needs the row count, and every block is then read
    blocks-many times: checkpointing once keeps upstream work (joins,
    aggregations) from running twice and gives the replicated stage a stable,
    lineage-free input that survives a lost executor.
    """
    from reelrank.session import work_dir
    work_dir(vectors.sparkSession)  # sets a checkpoint dir only where none is configured
    return vectors.checkpoint(eager=True)


def count_and_dim(vectors: DataFrame, col: str = "v") -> tuple[int, int]:
    """Row count and vector length in one small aggregate (one row to the driver)."""
    row = vectors.agg(F.count(F.lit(1)).alias("n"),
                      F.max(F.size(col)).alias("d")).first()
    return int(row["n"] or 0), int(row["d"] or 0)


MIN_BLOCK_ROWS = 512  # below this a block is not worth its task


def n_blocks(n: int, rows_per_block: int) -> int:
    return max(1, math.ceil(n / max(1, rows_per_block)))


def target_tasks(spark) -> int:
    """Block pairs wanted so every core of the cluster gets work (2 waves). Executors that
    aren't up yet (dynamic allocation) don't count in the first figure, so the session's
    number of shuffle partitions is a floor."""
    return max(2 * max(1, spark.sparkContext.defaultParallelism),
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def self_blocks(n: int, dim: int, block_mb: float, tasks: int) -> int:
    """Blocks for the self product: enough for memory, and enough block pairs
    (B(B+1)/2) for the cluster, without going below MIN_BLOCK_ROWS rows."""
    by_memory = n_blocks(n, block_rows_for(max(dim, 1), block_mb))
    by_tasks = math.ceil((math.sqrt(8 * tasks + 1) - 1) / 2)
    return max(by_memory, min(by_tasks, max(1, n // MIN_BLOCK_ROWS)))


def cross_blocks(n_left: int, n_right: int, dim: int, block_mb: float,
                 tasks: int) -> tuple[int, int]:
    """Blocks for left x right: the right side (items) by memory only; the left
    side (users) also split further until there are enough block pairs, since
    more left blocks only re-send the (smaller) right side."""
    rows = block_rows_for(max(dim, 1), block_mb)
    br = n_blocks(n_right, rows)
    bl = n_blocks(n_left, rows)
    by_tasks = math.ceil(tasks / br)
    return max(bl, min(by_tasks, max(1, n_left // MIN_BLOCK_ROWS))), br


def block_of(key_col: str, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(key_col)), F.lit(blocks)).cast("int")


def self_pair_sides(df: DataFrame, key_col: str, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Sides for the self product over block pairs a <= b.

    Left rows of block x go to pairs (x, b) for b >= x; right rows of block x go
    to pairs (a, x) for a <= x. A diagonal pair (x, x) is handled from its left
    side alone, so the right side skips it.
    """
    keyed = df.withColumn("__blk", block_of(key_col, blocks))
    left = keyed.select(F.col("__blk").alias("a"),
                        F.explode(F.sequence(F.col("__blk"), F.lit(blocks - 1))).alias("b"),
                        *df.columns)
    # Both sides come from one frame: re-alias the right side's columns so they
    # are new attributes. With shared attribute ids, column pruning under the
    # cogroup can drop the right side's data columns (seen with count()).
    right = keyed.filter(F.col("__blk") > 0).select(
        F.explode(F.sequence(F.lit(0), F.col("__blk") - 1)).alias("a"),
        F.col("__blk").alias("b"), *[F.col(c).alias(c) for c in df.columns])
    return left, right


def cross_pair_sides(left: DataFrame, left_key: str, left_blocks: int,
                     right: DataFrame, right_key: str, right_blocks: int
                     ) -> tuple[DataFrame, DataFrame]:
    """Sides for the product of two tables over all block pairs (a, b)."""
    # fresh attributes on both sides (the two inputs may share a lineage)
    lk = left.select(block_of(left_key, left_blocks).alias("a"),
                     F.explode(F.sequence(F.lit(0), F.lit(right_blocks - 1))).alias("b"),
                     *[F.col(c).alias(c) for c in left.columns])
    rk = right.select(F.explode(F.sequence(F.lit(0), F.lit(left_blocks - 1))).alias("a"),
                      block_of(right_key, right_blocks).alias("b"),
                      *[F.col(c).alias(c) for c in right.columns])
    return lk, rk


def matrix(rows: pa.Table, col: str, dim: int, sent: bool = False) -> np.ndarray:
    """The list column as a (rows, dim) array of doubles, or in the precision it was ``sent`` in."""
    lists = rows.column(col).combine_chunks()
    flat = lists.flatten() if len(rows) else pa.array([], pa.float64())
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=None if sent else np.float64).reshape(len(rows), dim)


def run_pairs(sides: DataFrame, n_pairs: int, kernel: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``kernel(pair, left, right)`` for every pair of blocks: ``sides`` has a row's ``pair``, from 0
    to ``n_pairs`` - 1, and its ``side``, 0 or 1. Each pair has the
    partition of its own number: none holds two, and adaptive execution doesn't merge them by
    their bytes, which say nothing of a product's work."""
    dealt = sides.repartitionById(n_pairs, F.col("pair"))

    def per_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            side = rows.column("side").to_numpy()
            yield from kernel(int(rows.column("pair")[0].as_py()),
                              *(rows.filter(pa.array(side == k)) for k in (0, 1)))

    return dealt.mapInArrow(per_pair, schema)
