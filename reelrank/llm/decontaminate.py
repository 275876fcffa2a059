"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' normalised words form one automaton per block of at most
``block_words`` words. Tasks stream document words through it: the state holds
the longest suffix of the document read so far that occurs in some item, so a
match of ``window`` words or more, or of a whole shorter item, is seen at its
last word in amortised constant time per word. No windows of documents are
materialised or shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import kept, read, ship_package

WINDOW = 13
MAX_SHARE = (1, 20)  # contaminated: hit words / words >= 1/20
BLOCK_WORDS = 200_000

# bytes that end a word: \x00-\x2F \x3A-\x60 \x7B-\x7F after A-Z became a-z
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_WORDS = bytes(
    (c + 32 if 65 <= c <= 90 else 32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F
     else c) for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with item sets per state."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.len = [0]
        self.short: dict[int, list] = {}   # state -> [(words, item)] whole short items
        self.least = window
        own: dict[int, set] = {}
        for item, words in items:
            if not words:
                continue
            last = 0
            for n, w in enumerate(words, 1):
                last = self._extend(last, w)
                if n >= window:
                    own.setdefault(last, set()).add(item)
            if len(words) < window:
                self.short.setdefault(last, []).append((len(words), item))
                self.least = min(self.least, len(words))
        for v in sorted(own.keys() | set(range(1, len(self.len))), key=lambda v: -self.len[v]):
            up = self.link[v]
            if v in own and self.len[up] >= window:
                own.setdefault(up, set()).update(own[v])
        self.items = own
        self._ends: dict[int, list] = {}

    def _new(self, length: int, link: int, nxt: dict) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.len) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state for the strings of ``q`` that also end in ``p``'s strings plus ``w``."""
        clone = self._new(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, w, q)
        cur = self._new(self.len[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, w, q)
        return cur

    def _short_ends(self, s: int) -> list:
        """Whole short items that end where state ``s`` ends, by suffix links."""
        found = self._ends.get(s)
        if found is None:
            up = self.link[s]
            found = self.short.get(s, []) + (self._short_ends(up) if up > 0 else [])
            self._ends[s] = found
        return found

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Hit spans [first, last] in word positions, merged and ordered, and the items."""
        nxt, link, length, window, least = self.next, self.link, self.len, self.window, self.least
        hits: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set = set()
        root = nxt[0]
        s = n = 0
        for i, w in enumerate(words):
            t = nxt[s].get(w)
            if t is None:
                if s:
                    s = link[s]
                    while s > 0 and w not in nxt[s]:
                        s = link[s]
                    n = length[s]
                    t = nxt[s].get(w)
                else:
                    t = root.get(w)
                if t is None:
                    s = n = 0
                    continue
            s = t
            n += 1
            if n >= least:
                if n >= window:
                    hits.append((i - n + 1, i))
                    v = s
                    while length[link[v]] >= window:
                        v = link[v]
                    states.add(v)
                if self.short:
                    for size, item in self._short_ends(s):
                        if size <= n:
                            hits.append((i - size + 1, i))
                            items.add(item)
        for v in states:
            items |= self.items[v]
        return merge_spans(hits), items


def merge_spans(spans: Iterable) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def remove_spans(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.lower())]
    out, pos = [], 0
    for a, b in spans:
        out.append(raw[pos:at[a][0]])
        pos = at[b][1]
    out.append(raw[pos:])
    return b"".join(out).decode()


def _benchmark_blocks(bench: DataFrame, item_col: str, text_col: str,
                      block_words: int) -> Iterator[list[tuple]]:
    """Items as lists of at most ``block_words`` words (or one longer item each)."""
    block, size = [], 0
    rows = bench.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for r in rows.filter("t is not null").toLocalIterator():
        words = words_of(r["t"])
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r["i"], words))
        size += len(words)
    yield block


def _automaton(shared, window: int) -> SuffixAutomaton:
    key, items = shared.value
    return kept(("automaton", key, window), lambda: SuffixAutomaton(items, window))


def find_spans(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               window: int = WINDOW, block_words: int = BLOCK_WORDS,
               max_share: tuple[int, int] = MAX_SHARE, keep: bool = False,
               cut: bool = False) -> DataFrame:
    """Benchmark words in each document row.

    Per row: the id, ``n_words``, ``n_hit``, ``spans`` (first and last word
    position, merged), ``items`` (ids as sorted strings), ``contaminated``
    (n_hit > 0 and the hit share reaches ``max_share``), and with ``keep`` every
    other input column too. Empty or null texts have no words and no hits; items
    without words match nothing; items with a null id count as hits but have no
    name in ``items``; repeated items count once; an empty benchmark hits
    nothing; repeated document rows each get their row. Other input columns are
    ignored unless ``keep`` (then the result names must be free); with ``keep``, ``cut``
    takes the spans out of the text.

    One block of items is broadcast at a time; its size is bounded by
    ``block_words``. A larger benchmark takes one pass per block, whose spans
    are merged row by row (the columns ride along in the same pass).
    """
    sc = docs.sparkSession.sparkContext
    ship_package(docs.sparkSession)
    base = docs if keep else docs.select(id_col, text_col)
    out = base.withColumns({
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"),
        "spans": F.array().cast("array<array<int>>"), "items": F.array().cast("array<string>")})
    num, den = max_share

    def run(shared, finish):
        def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sam = _automaton(shared, window)
            for pdf in batches:
                words, hit, spans, items = [], [], [], []
                for text, old, names in zip(pdf[text_col], pdf["spans"], pdf["items"]):
                    ws = words_of(text)
                    found, its = sam.match(ws)
                    found = merge_spans([*map(list, old), *found]) if len(old) else found
                    words.append(len(ws))
                    hit.append(sum(b - a + 1 for a, b in found))
                    spans.append(found)
                    items.append(sorted({*names, *(x for x in its if x is not None)}))
                out = pdf.assign(n_words=words, n_hit=hit, spans=spans, items=items)
                if finish:
                    out[text_col] = [remove_spans(t, s) if s else t for t, s in zip(pdf[text_col], spans)]
                yield out
        return per_batch

    blocks = [sc.broadcast((uuid.uuid4().hex, b))
              for b in _benchmark_blocks(bench, item_col, item_text, block_words)]
    for k, block in enumerate(blocks):     # the last one knows all spans
        out = out.mapInPandas(run(block, cut and k == len(blocks) - 1), out.schema)
    out = out.withColumn("contaminated", F.expr(f"n_hit > 0 and {den} * n_hit >= {num} * n_words"))
    return out if keep else out.drop(text_col)


def decontaminate(docs: DataFrame, bench: DataFrame, *, text_col: str = "text",
                  max_share: tuple[int, int] = MAX_SHARE, **options) -> DataFrame:
    """The documents without their benchmark passages, same columns.

    Rows whose hit share reaches ``max_share`` (contaminated) are removed; of the
    others, spans that are long enough to count (a whole window or a whole short
    item) are cut from the text. Rows without a hit come back unchanged.
    """
    cols = docs.columns
    rest = [c for c in cols if c != text_col]
    marked = find_spans(docs.select((F.struct(*rest) if rest else F.struct(F.lit(0))).alias("__row"),
                                    F.col(text_col).alias("__text")),
                        bench, text_col="__text", keep=True, cut=True, max_share=max_share, **options)
    clean = marked.filter(~F.col("contaminated"))
    return clean.select(*[F.col("__text").alias(c) if c == text_col else F.col("__row")[c].alias(c)
                         for c in cols])


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        "contaminated")


SQL = r"""
WITH it AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS k,
         array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM it WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
grams AS (
  SELECT r, p, k, array_to_string(w[p : p + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
m AS (SELECT DISTINCT g.r, g.p, g.k, win.item FROM grams g JOIN win ON g.k = win.k AND g.s = win.s),
hit AS (
  SELECT r, count(DISTINCT q) AS n_hit
  FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, p, k FROM m)) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM m WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON d.r = hit.r LEFT JOIN its ON d.r = its.r
"""
