"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a maximal stretch of words whose smallest period q fits it at least
``exponent`` times. Runs are found on an enhanced suffix array (suffix array,
its inverse ISA and the LCP values of neighbours), with no tree nodes: an LCP
interval of depth d that holds the suffixes i and i + d names a tandem repeat of
two words of length d at i, which is branching when the two suffixes go on
differently. Only the suffixes of an interval's smaller children are asked, by
ISA[i + d] and ISA[i - d], so the tests are O(n log n). Every run ends in exactly one
branching repeat of its smallest period; turning that repeat to the left as far as the
words agree gives the run, and repeats of a multiple of the period turn into the same
stretch and are merged with it.

Before that, words are put aside that can't be in a run: in a run every word occurs
``exponent`` times, so a word that is rarer within its stretch ends the stretch, and
stretches that are too short go. This is exact and leaves little of ordinary text.

All steps work on whole arrays of some hundred thousand words, of many texts at once: words
are numbered by text, so suffixes of different texts never agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import kept, read, ship_package

MIN_LENGTH, MIN_EXPONENT = 6, 4
WORD = r"[^\x20\x09-\x0D]+"
BATCH_WORDS = 250_000   # words whose suffixes are sorted together; a longer text is a batch of its own


def stretches(code: np.ndarray, text: np.ndarray, min_length: int, exponent: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in a run, in order, and the number of each place's stretch.
    ``code``: a word's number among the words of its text; ``text``: the text of a place."""
    at, part = np.arange(len(code)), text
    while len(at):
        word = np.unique(part * (int(code.max()) + 1) + code[at], return_inverse=True)[1]
        often = np.bincount(word)[word] >= exponent
        left, part = at[often], part[often]
        begins = np.ones(len(left), dtype=bool)
        begins[1:] = (np.diff(left) != 1) | (np.diff(part) != 0)
        part = np.cumsum(begins) - 1
        long = np.bincount(part, minlength=1)[part] >= min_length
        left, part = left[long], part[long]
        done = len(left) > 0.9 * len(at)     # exact at any time, so it may end early
        at = left
        if done:
            break
    return at, part


class SuffixArray:
    """Enhanced suffix array of an array of numbers by prefix doubling. ``ranks[k]`` orders the
    stretches of 2 ** k numbers, equal ones alike, so that agreement over any length
    is read off in O(log n) steps for all places at once."""

    def __init__(self, numbers: np.ndarray):
        n = self.n = len(numbers)
        self.ranks = []
        rank = np.unique(numbers, return_inverse=True)[1].astype(np.int32)
        step = 1
        while True:
            self.ranks.append(np.append(rank, np.int32(-1)))   # the end agrees with nothing
            if n == 0 or int(rank.max()) == n - 1:
                break
            second = np.zeros(n, dtype=np.int64)
            second[:max(0, n - step)] = rank[step:] + 1
            rank = np.unique(rank.astype(np.int64) * (n + 1) + second, return_inverse=True)[1].astype(np.int32)
            step *= 2
        self.isa = rank
        self.sa = np.argsort(rank, kind="stable").astype(np.int64)
        self.lcp = self.agree(self.sa[:-1], self.sa[1:])

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the suffixes at ``i`` and at ``j`` (others) agree."""
        far = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[k]
            far += (r[np.minimum(i + far, self.n)] == r[np.minimum(j + far, self.n)]).astype(np.int64) << k
        return far

    def agree_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the numbers before ``i`` and before ``j`` > i agree, backwards."""
        far = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[k]
            a, b = i - far - (1 << k), j - far - (1 << k)
            far += ((a >= 0) & (r[np.maximum(a, 0)] == r[np.maximum(b, 0)])).astype(np.int64) << k
        return far

    def intervals(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The children of LCP intervals of ``least`` suffixes or more, but for one largest child
        each: (depth, first of the interval, last of the interval, child's first and last)
        as places of the suffix array."""
        lcp = self.lcp
        m = len(lcp)
        p = np.flatnonzero(lcp)
        low = [lcp]                                  # low[k][x]: least of lcp[x:x + 2 ** k]
        while 1 << len(low) <= m:
            half = 1 << len(low) - 1
            low.append(np.minimum(low[-1][:-half], low[-1][half:]))
        depth = lcp[p]
        first, last = p.copy(), p + 1
        for k in range(len(low) - 1, -1, -1):
            there = low[k]
            back = first - (1 << k)
            first = np.where((back >= 0) & (there[np.maximum(back, 0)] >= depth), back, first)
            on = last + (1 << k) <= m
            on &= there[np.minimum(last, len(there) - 1)] >= depth
            last = np.where(on, last + (1 << k), last)
        wide = last - first + 1 >= least
        p, depth, first, last = p[wide], depth[wide], first[wide], last[wide]
        if not len(p):
            return (np.zeros(0, dtype=np.int64),) * 5
        order = np.lexsort((p, last, first))
        p, depth, first, last = p[order], depth[order], first[order], last[order]
        # a boundary of an interval ends one child; the last boundary also begins the last one
        new = np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1]))
        begin = np.where(new, first, np.append(0, p[:-1] + 1))
        ends = np.append(new[1:], True)
        owner = np.cumsum(new) - 1
        owner = np.append(owner, owner[ends])
        depth, first, last = (np.append(x, x[ends]) for x in (depth, first, last))
        child_first, child_last = np.append(begin, p[ends] + 1), np.append(p, last[:len(p)][ends])
        order = np.lexsort((child_first - child_last, owner))          # largest child first
        smaller = order[np.append(False, owner[order][1:] == owner[order][:-1])]
        return tuple(x[smaller] for x in (depth, first, last, child_first, child_last))


def runs_of(numbers: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of an array of numbers, by start, then period.
    ``exponent`` is 2 at least."""
    none = (np.zeros(0, dtype=np.int64),) * 3
    if len(numbers) < max(2, min_length):
        return none
    array = SuffixArray(numbers)
    depth, first, last, child_first, child_last = array.intervals(exponent)
    sizes = child_last - child_first + 1
    if not len(sizes):
        return none
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + child_first[owner]
    i, d = array.sa[place], depth[owner]
    first, last = first[owner], last[owner]
    padded = np.append(numbers, -1)
    found = []
    for asked in (i + d, i - d):
        ok = (asked >= 0) & (asked < array.n)
        there = array.isa[np.where(ok, asked, 0)]
        ok &= (first <= there) & (there <= last)
        a, q = np.minimum(i, asked)[ok], d[ok]       # words q apart agree from a to a + q
        branching = padded[np.minimum(a + q, array.n)] != padded[np.minimum(a + 2 * q, array.n)]
        found.append(np.stack([a[branching], q[branching]]))
    i, d = np.unique(np.concatenate(found, axis=1), axis=1)
    start = i - array.agree_before(i, i + d)
    length = i + 2 * d - start
    long = length >= np.maximum(min_length, exponent * d)
    start, length, d = start[long], length[long], d[long]
    order = np.lexsort((d, length, start))
    start, length, d = start[order], length[order], d[order]
    once = np.ones(len(start), dtype=bool)           # of equal stretches the smallest period
    once[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, d = start[once], length[once], d[once]
    order = np.lexsort((d, start))
    return start[order], length[order], d[order]


def _batches(texts) -> Iterator[list[list[bytes]]]:
    """Words of each text, in batches of up to BATCH_WORDS words."""
    held, size = [], 0
    for text in texts:
        words = text.encode().split() if text else []    # splits at the bytes 20 and 09 to 0D
        if held and size + len(words) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _collapse(texts: list[list[bytes]], min_length: int, exponent: int) -> tuple[list[list], list[str]]:
    """Runs of each text, and its words without the repetitions."""
    codes = []
    for words in texts:
        seen: dict[bytes, int] = {}
        number = seen.setdefault
        codes.append(np.array([number(w, len(seen)) for w in words], dtype=np.int64))
    sizes = np.array([len(c) for c in codes])
    begin = np.cumsum(sizes) - sizes
    runs: list[list] = [[] for _ in texts]
    kept_words = np.ones(int(sizes.sum()), dtype=bool)
    if len(kept_words):
        code, owner = np.concatenate(codes), np.repeat(np.arange(len(texts)), sizes)
        at, part = stretches(code, owner, min_length, exponent)
        if len(at):
            width = int(code.max()) + 1
            start, length, period = runs_of(part * width + code[at], min_length, exponent)
            start = at[start]                            # a stretch's places follow one another
            for s, n, q, t in zip(start.tolist(), length.tolist(), period.tolist(), owner[start].tolist()):
                runs[t].append({"start": s - int(begin[t]), "length": n, "period": q})
                kept_words[s + q:s + n] = False
    out = []
    for k, words in enumerate(texts):
        if runs[k]:
            keep = kept_words[begin[k]:begin[k] + sizes[k]].tolist()
            words = [w for w, on in zip(words, keep) if on]
        out.append(b" ".join(words).decode())
    return runs, out


def find_runs(docs: DataFrame, *, text_col: str = "text", out_col: str = "found",
              min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> DataFrame:
    """Adds ``out_col`` struct(runs, collapsed): all runs of the words of the text as
    array of struct(start, length, period), by start, then period, words counted from 0;
    and the words that no run holds after its first period, joined by one space.

    A null or empty text, or one of spaces, has no runs and collapses to an empty string. Rows
    are independent: repeated rows, null ids, ties and other columns don't matter; a
    column that is called ``out_col`` is replaced; an empty table gives an empty result.
    The work for n words is O(n log n) tests and O(n log^2 n) sorting, however they repeat.
    """
    ship_package(docs.sparkSession)
    if exponent < 2:
        raise ValueError("a run has at least two periods")

    @F.pandas_udf("runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept("runs")
        for s in texts:
            for some in _batches(s):
                runs, collapsed = _collapse(some, min_length, exponent)
                yield pd.DataFrame({"runs": runs, "collapsed": collapsed})

    return docs.withColumn(out_col, found(F.col(text_col)))


def with_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query's texts: of every tenth document by h = crc32 of its id, all words from
    word a = g % n on repeat the p words from there, with g = h div 10 and
    p = 1 + (n - a) div (3 + g % 8). Null ids and texts without words stay as they are."""
    def turned(w: Column, h: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        often = F.ceil((n - a) / p).cast("int")
        return F.concat_ws(" ", F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(
            F.slice(w, a + 1, p), often)), F.lit(1), n - a))

    # an array of one entry binds the words, so that they are split once
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    new = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, turned(w, h))), 1)
    return docs.withColumn(text_col, F.when(h % 10 == 0, F.coalesce(new, F.col(text_col))).otherwise(F.col(text_col)))


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest (ties: smallest start, then period), and the
    digests of all runs and of the collapsed text."""
    rows = find_runs(docs.select("doc_id", "text")).select("doc_id", "found.runs", "found.collapsed")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` by the contract; every text whole, in one pass without a shuffle."""
    return run_digests(with_period(read(spark, sf_dir, "documents").select("doc_id", "text")))
