"""Alignment of two tokenizers over the same texts.

Each text is encoded by a byte-level tokenizer (A) and a sentencepiece model (B). Their
own spans are coarse cuts: A's character offsets, turned to bytes, and the spans of B's
sentencepiece proto (the library's 'proto' result; the name 'immutable_proto' is gone from
it). Tokens that share a character, and the tokens of a byte fallback, have no cut of their own
there; between two cuts the lengths of their decoded bytes place them. Where both
tokenizers cut is the end of a group, and a token of A and one of B whose bytes overlap are
linked. How often a pair of ids is linked is counted over all texts.

No token of either vocabulary goes on after a space that follows something else, so a text
falls into parts at such spaces, and parts that come again are aligned once in a block
of texts and remembered by the worker. Texts are handled in blocks: a block asks once for the
corpus-wide count of each of its distinct pairs, so no pair is hot and no table of all
pairs is held anywhere.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import Scratch, cut, kept, read, ship_package

BLOCK_CHARS = 4_000_000      # text of a block
MEMO_PARTS, MEMO_CHARS = 100_000, 32   # parts of a generation that a worker remembers (there are two), the longest
ROW_PARTS = 200              # parts that are encoded as one text
PIECE = attrgetter("id", "begin", "end")
WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
BLANKS = [c + " " for c in WHITE]
SPACE = "▁"             # how sentencepiece writes a space


def _byte_values() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, the others as the
    characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Aligner:
    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        value = _byte_values()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            if all(c in value for c in token):
                self.a_bytes[k] = bytes(value[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
                        for k, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # a piece that holds a space after something else would reach over the end of a part
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def parts_of(self, text: str) -> list[str]:
        """The text cut before each space that follows a character which isn't white space and
        is followed by more; such a space isn't part of either side."""
        if not self.splits:
            return [text]
        parts = text.split(" ")
        if not (text[0] == " " or text[-1].isspace() or any(map(text.__contains__, BLANKS))):
            return parts
        out = parts[:1]
        for p in parts[1:]:
            if p == "" or out[-1] == "" or out[-1][-1].isspace():
                out[-1] += " " + p
            else:
                out.append(p)
        return out

    def aligned(self, parts: list[str], again: list[bool]) -> list[tuple]:
        """For each of the parts, which are distinct, a space being before it: whether both
        tokenizers give its bytes back, its tokens of A and of B, groups, group text, and
        the linked pairs of ids as bytes of 64-bit numbers. ``again``: the part occurs more
        than once; others are remembered only if they were known before."""
        found = [self.young.get(p) or self.old.get(p) for p in parts]
        missing = [k for k, x in enumerate(found) if x is None]
        known = [x is not None for x in found]
        for k, new in zip(missing, self.fresh([parts[k] for k in missing])):
            found[k] = new
        for p, x, known_before, more in zip(parts, found, known, again):
            if (more or known_before) and p not in self.young and len(p) <= MEMO_CHARS:
                if len(self.young) >= MEMO_PARTS:
                    self.young, self.old = {}, self.young
                self.young[p] = x
        return found

    def fresh(self, parts: list[str]) -> Iterator[tuple]:
        """As ``aligned``, without memory. Parts that may stand side by side are encoded in rows, as
        one text each; a row that doesn't give its bytes back is encoded part by part."""
        for k in range(0, len(parts), 50 * ROW_PARTS):
            some = parts[k:k + 50 * ROW_PARTS]
            alone = np.array([p == "" or p[0] == " " or p[-1].isspace() for p in some], dtype=bool) | (not self.splits)
            rows = [[i] for i in np.flatnonzero(alone)]
            side = np.flatnonzero(~alone)
            rows += [side[i:i + ROW_PARTS] for i in range(0, len(side), ROW_PARTS)]
            out: list = [None] * len(some)
            again = []
            for row, new in zip(rows, self._rows([[some[i] for i in row] for row in rows])):
                if new is None and len(row) > 1:
                    again += [[i] for i in row]
                else:
                    for i, x in zip(row, new or [(False, 0, 0, 0, "", b"")]):
                        out[i] = x
            for row, new in zip(again, self._rows([[some[i] for i in row] for row in again])):
                out[row[0]] = new[0] if new else (False, 0, 0, 0, "", b"")
            yield from out

    def _rows(self, rows: list[list[str]]) -> Iterator[list[tuple] | None]:
        """The parts of each row, or None where a tokenizer changes the row's bytes."""
        if not rows:
            return
        texts = [" ".join(row) for row in rows]
        raw = [b" " + t.encode() for t in texts]
        size = np.array(list(map(len, raw)))
        base = np.cumsum(size) - size
        a_list, a_span, a_n = [], [], []
        for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False):
            a_n.append(len(e))
            a_list += e.ids
            a_span += e.offsets
        b_span, b_n = [], []
        for proto in self.b.encode(texts, return_type="proto", num_threads=1):
            pieces = proto.pieces
            b_n.append(len(pieces))
            b_span += map(PIECE, pieces)
        a_ids, a_n, b_n = (np.array(x, dtype=np.int64) for x in (a_list, a_n, b_n))
        b_ids, begin, end = np.fromiter(chain.from_iterable(b_span), dtype=np.int64,
                                        count=3 * len(b_span)).reshape(-1, 3).T
        a_own, b_own = (np.repeat(np.arange(len(rows)), n) for n in (a_n, b_n))
        a_stop, b_stop = np.cumsum(a_n), np.cumsum(b_n)
        # A's spans are characters; over all rows together they become bytes
        points = np.frombuffer(b"".join(raw).decode().encode("utf-32-le"), dtype="<u4")
        at_byte = np.append(0, np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)))
        chars = np.array(list(map(len, texts))) + 1
        span = np.fromiter(chain.from_iterable(a_span), dtype=np.int64, count=2 * len(a_ids)).reshape(-1, 2)
        a_begin, a_end = at_byte[span.T + (np.cumsum(chars) - chars)[a_own]]
        # B's spans are bytes of the text without the space that it puts before
        b_begin, b_end = base[b_own] + np.where(begin > 0, begin + 1, 0), base[b_own] + end + 1
        a_ends = refined(a_begin, a_end, self.a_size[a_ids], a_own, base)
        b_ends = refined(b_begin, b_end, self.b_size[b_ids], b_own, base)
        b_list = b_ids.tolist()
        good = np.array([
            b"".join(map(self.a_bytes.__getitem__, a_list[x - n:x])) == r
            and b"".join(map(self.b_bytes.__getitem__, b_list[y - m:y])) == r
            for r, x, n, y, m in zip(raw, a_stop.tolist(), a_n.tolist(), b_stop.tolist(), b_n.tolist())], dtype=bool)
        a_on, b_on = good[a_own], good[b_own]
        a_ids, a_ends, b_ids, b_ends = a_ids[a_on], a_ends[a_on], b_ids[b_on], b_ends[b_on]
        # where tokens end, marked byte by byte
        total = int(size.sum())
        a_mark, b_mark = (np.zeros(total + 1, dtype=bool) for _ in range(2))
        a_mark[a_ends], b_mark[b_ends] = True, True
        ends = np.flatnonzero(a_mark | b_mark)
        in_a, in_b = a_mark[ends], b_mark[ends]
        a_at, b_at = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b   # the tokens that reach there
        pairs = (a_ids[a_at] * len(self.b_bytes) + b_ids[b_at]).tobytes()
        both = in_a & in_b
        group = np.cumsum(both) - both
        # group texts: tokens by group, A before B, each with what follows it
        key = np.append(2 * group[in_a], 2 * group[in_b] + 1)
        order = np.argsort(key, kind="stable")
        key, ids = key[order], np.append(a_ids, b_ids)[order]
        sign = np.full(len(key), ";")
        sign[:-1] = np.where(key[1:] == key[:-1], ",", np.where(key[1:] // 2 == key[:-1] // 2, "|", ";"))
        written = list(map(str.__add__, map(str, ids.tolist()), sign.tolist()))
        # the parts of good rows, by the bytes where they end
        lengths = [len(p.encode()) + 1 for row, ok in zip(rows, good.tolist()) if ok for p in row]
        row_base = np.repeat(base[good] - (np.cumsum(size[good]) - size[good]), [len(r) for r, ok in zip(rows, good) if ok])
        stops = np.cumsum(lengths, dtype=np.int64) + row_base
        n, m, g, links = (np.searchsorted(x, stops, "right") for x in (a_ends, b_ends, ends[both], ends))
        at = zip((n + m).tolist(), *(np.diff(x, prepend=0).tolist() for x in (n, m, g)), (8 * links).tolist())
        from_token = from_link = 0
        for row, ok in zip(rows, good.tolist()):
            if not ok:
                yield None
                continue
            out = []
            for _ in row:
                token, n, m, g, link = next(at)
                out.append((True, n, m, g, "".join(written[from_token:token])[:-1], pairs[from_link:link]))
                from_token, from_link = token, link
            yield out


def refined(begin: np.ndarray, end: np.ndarray, size: np.ndarray, owner: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes. ``begin`` and ``end`` are the tokenizer's own spans as bytes,
    ``size`` the bytes that a token decodes to, ``base`` where its text begins. A span's end is a
    cut where the next token begins there; other tokens are placed from the cut before
    them by their decoded bytes."""
    n = len(end)
    if not n:
        return end
    is_cut = np.ones(n, dtype=bool)
    is_cut[:-1] = (owner[1:] != owner[:-1]) | ((begin[1:] == end[:-1]) & (end[1:] > begin[1:]) & (end[:-1] > begin[:-1]))
    new = np.append(True, is_cut[:-1])                   # first token after a cut
    run = np.cumsum(new) - 1
    anchor = np.where(np.append(True, owner[1:] != owner[:-1]), base[owner], np.append(0, end[:-1]))[new]
    through = np.cumsum(size)
    placed = anchor[run] + through - (through - size)[new][run]
    return np.where(is_cut, end, placed)


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("id", id_type), ("block", pa.int64()), *((c, pa.int64()) for c in NUMBERS),
                      ("groups", pa.string()), ("words", pa.binary()),
                      ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("links", pa.binary())])


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _block_rows(aligner: Aligner, number: int, ids: pa.Array, texts: list, schema: pa.Schema) -> pa.RecordBatch:
    """A row for each text and one for the block. ``words`` of a text are the steps between its sorted
    parts' numbers; ``links`` of the block gives every part's number of links, then
    the places of their pairs in ``pairs``."""
    index: dict[str, int] = {}
    place = index.setdefault
    held = [np.array([place(p, len(index)) for p in aligner.parts_of(t)], dtype=np.int64) if t else
            np.zeros(0, dtype=np.int64) for t in texts]
    lengths = np.array(list(map(len, held)))
    all_words = np.concatenate(held)
    times = np.bincount(all_words, minlength=len(index))
    parts = aligner.aligned(list(index), (times > 1).tolist())
    numbers = np.array([(not p[0], *p[1:4], len(p[5]) // 8) for p in parts], dtype=np.int64).reshape(-1, 5)
    written = [p[4] for p in parts]
    sums = np.concatenate([np.zeros((1, 5), dtype=np.int64), np.cumsum(numbers[all_words], axis=0)])
    stop = np.cumsum(lengths)
    sums = sums[stop] - sums[stop - lengths]
    changed = sums[:, 0] > 0                             # other bytes: the text has no tokens
    sums = np.where(changed[:, None], 0, sums[:, 1:])
    groups, words = [], []
    for k, w in enumerate(held):
        if changed[k]:
            times -= np.bincount(w, minlength=len(times))
            w = w[:0]
        groups.append(";".join(map(written.__getitem__, w.tolist())))
        w.sort()
        words.append(np.diff(w, prepend=0).astype("<u4").tobytes())
    used = times > 0
    count = np.where(used, numbers[:, 4], 0)
    flat = np.frombuffer(b"".join([p[5] for p, on in zip(parts, used.tolist()) if on]), dtype=np.int64)
    pairs, at = np.unique(flat, return_inverse=True)
    weight = np.bincount(at, np.repeat(times, count), len(pairs)).astype(np.int64)
    packed = np.concatenate([[len(parts)], count, at]).astype("<u4").tobytes()
    n = len(texts)
    columns = [
        pa.concat_arrays([ids, pa.nulls(1, ids.type)]), pa.array([number] * (n + 1), pa.int64()),
        *(pa.array(sums[:, c].tolist() + [None], pa.int64()) for c in range(4)),
        pa.array(groups + [None], pa.string()), pa.array(words + [None], pa.binary()),
        pa.array([None] * n + [pairs], pa.list_(pa.int64())), pa.array([None] * n + [weight], pa.list_(pa.int64())),
        pa.array([None] * n + [packed], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _aligner(shared) -> Aligner:
    a_json, b_model, key = shared.value
    return kept(("alignment", key), lambda: Aligner(a_json, b_model))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Texts of a block with the counts of its pairs: sums by part, then by text."""
    kept("alignment scores")
    is_block = left.column("links").is_valid().to_pylist()
    packed = np.frombuffer(left.column("links")[is_block.index(True)].as_py(), dtype="<u4").astype(np.int64)
    n = int(packed[0])
    size, at = packed[1:n + 1], packed[n + 1:]
    count, best = np.zeros(right.num_rows, dtype=np.int64), np.zeros(right.num_rows, dtype=np.int64)
    place = right.column("at").to_numpy()
    count[place], best[place] = right.column("c").to_numpy(), right.column("best").to_numpy()
    stop = np.cumsum(size)
    both = [np.append(0, np.cumsum(x[at])) for x in (count, best)]
    by_part = [x[stop] - x[stop - size] for x in both]
    texts = left.filter(pc.is_null(left.column("links")))
    sums = [[], []]
    for words in texts.column("words").to_pylist():
        w = np.cumsum(np.frombuffer(words, dtype="<u4").astype(np.int64))
        for out, x in zip(sums, by_part):
            out.append(int(x[w].sum()))
    texts = texts.select(["id", *NUMBERS, "groups"])
    return texts.append_column("n_best", pa.array(sums[1], pa.int64())) \
        .append_column("count_sum", pa.array(sums[0], pa.int64()))


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text",
          groups: Callable[[Column], Column] = lambda g: g) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum. ``groups`` is the text
    `a1,a2|b1;a3|b2,b3` of ids in order, or what the function ``groups`` makes of it (it is
    applied before rows are written). ``count_sum`` sums over the text's links how often
    their pair of ids is linked in all rows; ``n_best`` are the links whose count is the
    highest of all pairs with their B id, ties included.

    A text that is null, empty, or that a tokenizer changes (its joined bytes aren't a space
    and the text) has no tokens: numbers 0 and groups ''. Null ids and repeated rows each get
    a row, and each counts; other columns are ignored, whatever their names; an empty
    table gives an empty result. Broadcast are the two vocabulary files, whose size doesn't
    depend on the data.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    shared = spark.sparkContext.broadcast((a_json, b_model, hashlib.sha256(a_json.encode() + b_model).hexdigest()))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        number = TaskContext.get().partitionId() << 32
        ids, texts, size, schema = [], [], 0, None
        for batch in batches:
            schema = _schema(batch.schema.field("id").type)
            begin = 0
            for k, t in enumerate(batch.column("text").to_pylist()):
                texts.append(t)
                size += len(t or "")
                if size >= BLOCK_CHARS:
                    yield _block_rows(aligner, number, pa.concat_arrays(
                        [*ids, batch.column("id").slice(begin, k + 1 - begin)]), texts, schema)
                    ids, texts, size, begin, number = [], [], 0, k + 1, number + 1
            ids.append(batch.column("id").slice(begin))
        if texts:
            yield _block_rows(aligner, number, pa.concat_arrays(ids), texts, schema)

    made = rows.mapInArrow(per_task, (
        f"id {id_type}, block long, {', '.join(f'{c} long' for c in NUMBERS)}, groups string, words binary, "
        "pairs array<long>, times array<long>, links binary"))
    scratch = Scratch(spark)
    made = scratch.cut(made.withColumn("groups", groups(F.col("groups"))), "alignment")
    one = made.filter("links is not null").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "p")) \
        .select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = scratch.cut(one.groupBy("pair").agg(F.sum("times").alias("c")), "alignment_counts")
    # one row for each id of B, so no more than its vocabulary has
    b_id = F.pmod("pair", F.lit(_pieces(b_model)))
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("c").alias("most"))
    counts = counts.withColumn("b", b_id).join(F.broadcast(highest), "b").select(
        "pair", "c", (F.col("c") == F.col("most")).cast("long").alias("best"))
    asked = one.select(F.col("block").alias("of"), "at", "pair").join(counts, "pair").select("of", "at", "c", "best")
    texts = made.select("block", "id", *NUMBERS, "groups", "words", "links")
    groups_type = made.schema["groups"].dataType.simpleString()
    done, _ = cut(texts.groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(_scored, (
        f"id {id_type}, {', '.join(f'{c} long' for c in NUMBERS)}, groups {groups_type}, n_best long, count_sum long")),
        "alignment_rows")
    scratch.clear()
    shared.destroy()
    return done.withColumnRenamed("id", id_col)


def _pieces(b_model: bytes) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=b_model).get_piece_size()


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` whole; a text without tokens keeps '' where others have a digest."""
    import public_tokenizers
    return align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"),
                 groups=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256))) \
        .withColumnRenamed("groups", "groups_sha256")
