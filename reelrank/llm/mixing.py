"""Mixing sources to target weights by pivotal dependent rounding.

A source of weight w takes as many words as its share of the mix, so each of its
documents should be copied target / size of the source times. The integer part is
plain; the fractional parts are rounded dependently: two documents with fractional
parts meet, and words move from one to the other, in a random direction that keeps
both expectations, until one of the two is integral (pivotal method, with documents
of any size as in Deville and Tille, 1998, and Srinivasan, 2001). The words taken
stay the same in every step, so a source ends within one document of its target.

Rows meet in leaves, which a task passes through in order with one open document
in hand. What is left open of each leaf meets the open ones of other leaves in the next
level of a reduction tree, until each source has one open document, which is rounded by
itself. Every level is a written table, so a lost executor repeats some leaves, and random
numbers are hashes of the rows, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.llm.common import Scratch, cut, kept, read, ship_package

WEIGHTS = (5.0, 2.0, 1.0)     # of the sources in order, repeating
SHARE, MOST = 1.5, 2.0        # words of the mix by words given; words of a source, likewise
LEAF = 4096                   # rows, and open documents, that meet in one group
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, m): equal rows are one bundle of ``m`` rows, so that one that
    repeats without end is one row here. Partial sums come before the shuffle."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size")).groupBy("id", "source", "size").agg(
        F.count(F.lit(1)).alias("m"))


def numbered_sources(bundles: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, place, words, n): sources by code point, null last, from 0. Ranges of sources are
    sorted in tasks of their own, and only their counts meet, so any number will do."""
    per = bundles.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("words"),
                                        F.count(F.lit(1)).alias("n"))
    per = per.withColumn("last", F.col("source").isNull())
    parts = scratch.cut(per.repartitionByRange("last", "source").sortWithinPartitions("last", "source")
                        .select("*", F.spark_partition_id().alias("range"),
                                F.monotonically_increasing_id().alias("row")), "mix_sources")
    # ids count up from partition << 33
    parts = parts.withColumn("row", F.col("row").bitwiseAND((1 << 33) - 1))
    counts = parts.groupBy("range").agg(F.count(F.lit(1)).alias("k"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"))
    return parts.join(starts, "range").select(
        "source", (F.col("first") + F.col("row")).alias("place"), "words", "n")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """Adds weight and target. ``share`` of all words is dealt by weight; a source takes
    ``most`` times its own words at the most, and what is above that is dealt again among
    the others, round by round, until none is above. A round is an aggregate: two numbers
    reach the driver."""
    rows = sources.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    limit = most * F.col("words")
    total = share * (rows.agg(F.sum("words").alias("t")).first()["t"] or 0)
    level, full = 0.0, -1
    while True:
        is_full = limit <= level * F.col("weight")
        got = rows.agg(F.count_if(is_full).alias("full"),
                       F.coalesce(F.sum(F.when(is_full, limit)), F.lit(0.0)).alias("taken"),
                       F.sum(F.when(~is_full, F.col("weight"))).alias("open")).first()
        if got["full"] == full or not got["open"]:
            break
        full, level = got["full"], (total - got["taken"]) / got["open"]
    return rows.withColumn("target", F.least(limit, level * F.col("weight")) if level
                           else F.least(limit, F.lit(0.0)))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come group by group, large documents first. One is open at a time; each new one
    moves words to or from it until one of the two is integral. What a group leaves open
    comes out with 0 < x < 1, everything else with x 0 or 1."""
    kept("mixing")
    group, carried = None, None      # the open row of an earlier batch
    x = size = 0.0                   # the open row's part and words

    def changed(rows: pa.RecordBatch, parts: list[float]) -> pa.RecordBatch:
        return rows.set_column(rows.schema.get_field_index("x"), "x", pa.array(parts, pa.float64()))

    for batch in batches:
        parts = batch.column("x").to_pylist()
        sources, leaves, words, coins = (batch.column(c).to_pylist() for c in ("source", "leaf", "weight", "coin"))
        at = None if carried is None else -1     # place of the open row; -1: the carried one
        for k, here in enumerate(zip(sources, leaves)):
            if here != group:
                group = here
                if at == -1:
                    yield changed(carried, [x])
                    carried = None
                elif at is not None:
                    parts[at] = x
                at = None
            y, other = parts[k], words[k]
            if at is None:
                at, x, size = k, y, other
                continue
            # words that the open document can gain from the new one, and lose to it
            can_take, can_give = (1 - x) * size, x * size
            gain, loss = min(can_take, y * other), min(can_give, (1 - y) * other)
            if coins[k] * (gain + loss) < loss:
                x, y = 1.0 if can_take <= gain else x + gain / size, 0.0 if y * other <= gain else y - gain / other
            else:
                x, y = 0.0 if can_give <= loss else x - loss / size, 1.0 if (1 - y) * other <= loss else y + loss / other
            parts[k] = y
            if not 0 < x < 1:
                if at == -1:
                    yield changed(carried, [x])
                    carried = None
                else:
                    parts[at] = x
                at, x, size = (k, y, other) if 0 < y < 1 else (None, 0.0, 0.0)
        rows = changed(batch, parts)
        if at is None or at == -1:
            yield rows
        else:
            yield rows.slice(0, at)
            yield rows.slice(at + 1)
            carried = rows.slice(at, 1)
    if carried is not None:
        yield changed(carried, [x])


def _coin(level: int, seed: int):
    """A number from 0 up to 1 for each bundle and level."""
    h = F.xxhash64(F.lit(seed), F.lit(level), "source", "id", "size")
    return (h.bitwiseAND((1 << 53) - 1) / float(1 << 53)).alias("coin")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = 42) -> DataFrame:
    """Per row of ``docs``: id, source, size (words), source_size, target (words of its source
    in the mix) and copies.

    Sources are ordered by code point, null last, and take ``weights`` in turn. A null
    or empty text has size 0 and no words in the mix. Null ids and repeated rows each get
    a row; equal rows (id, source and size) are rounded as one bundle, whose copies
    are dealt out evenly. Ties of size are ordered by hash. Other columns are ignored, whatever their
    names; an empty table gives an empty result. The expected copies of a row are
    target / source_size, its copies that number rounded up or down; the words taken of a
    source differ from its target by less than one bundle's largest document.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    bundles = scratch.cut(sizes(docs, id_col, text_col, source_col), "mix_rows")
    per, _ = cut(targets(numbered_sources(bundles, scratch), weights, share, most), "mix_targets")
    per = per.select("source", F.col("words").alias("source_size"), "target",
                     F.ceil(F.col("n") / LEAF).alias("leaves"),
                     F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0).alias("rate"))
    most_leaves = per.agg(F.max("leaves").alias("k")).first()["k"] or 1
    # m rows at a rate: whole copies for the bundle, and a part x of one more
    rows = bundles.join(per, bundles["source"].eqNullSafe(per["source"])).drop(per["source"])
    rows = rows.withColumn("whole", F.floor(F.col("m") * F.col("rate"))) \
        .withColumn("x", F.col("m") * F.col("rate") - F.col("whole")) \
        .withColumn("leaf", F.pmod(F.xxhash64("id", "size"), F.col("leaves")))
    fixed = ["id", "source", "size", "m", "source_size", "target", "whole"]
    rows = rows.select(*fixed, F.col("size").cast("double").alias("weight"), "leaf", "x")
    schema = (f"id {id_type}, source string, size long, m long, source_size long, target double, "
              "whole long, weight double, leaf long, x double, coin double")
    open_rows, done, level = rows, [], 0
    while True:
        # a document without words moves none, and an integral one has no part to round
        can_meet = (F.col("size") > 0) & (F.col("x") > 0) & (F.col("x") < 1)
        if level == 0:
            done.append(rows.filter(~can_meet))
        met, _ = cut(open_rows.filter(can_meet).withColumn("coin", _coin(level, seed))
                     .repartition("source", "leaf").sortWithinPartitions(
                         "source", "leaf", F.desc("size"), "coin", "id")
                     .mapInArrow(_meet, schema), "mix_level")
        is_open = (F.col("x") > 0) & (F.col("x") < 1)
        done.append(met.filter(~is_open).drop("coin"))
        open_rows = met.filter(is_open).drop("coin")
        if most_leaves <= 1:
            break
        most_leaves = -(-most_leaves // LEAF)
        open_rows = open_rows.withColumn("leaf", F.floor(F.col("leaf") / LEAF))
        level += 1
    done.append(open_rows)
    got = done[0]
    for more in done[1:]:
        got = got.unionByName(more)
    copies = F.col("whole") + F.when(_coin(-1, seed) < F.col("x"), 1).otherwise(0)
    got = got.withColumn("all", copies).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("k"))
    dealt = F.floor(F.col("all") / F.col("m")) + F.when(F.col("k") <= F.col("all") % F.col("m"), 1).otherwise(0)
    return got.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                      "target", dealt.cast("long").alias("copies"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` by the contract's weights, with what a document adds to the mix."""
    rows = mix(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"), "copies")
