"""Scalar functions as native Spark expressions (codegen, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from reelrank.schemas import LIKE_SCORE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- parsing -----------------------------------------------------------------

def java_trim(col) -> Column:
    """Trim every char <= U+0020 from both ends, like ``String.trim``."""
    return F.regexp_replace(_c(col), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strict_int(col) -> Column:
    """Integer parse that, like ``Integer.parseInt``, refuses blanks; NULL when invalid."""
    c = _c(col)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def lenient_double(col) -> Column:
    """Double parse that ignores surrounding blanks like ``Double.parseDouble``."""
    return java_trim(col).try_cast("double")


def split_keep_all(col, sep_regex: str) -> Column:
    """Split keeping trailing empty fields (behaviour change D8)."""
    return F.split(_c(col), sep_regex, -1)


def field(parts, i: int) -> Column:
    """i-th element (0-based) or NULL when the array is shorter."""
    return F.get(_c(parts), i)


# --- time --------------------------------------------------------------------

def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ, read as UTC wall time.

    Built from date and clock fields so it does not depend on the session time zone.
    """
    c = _c(ts)
    return (
        F.unix_date(c.cast("date")).cast("bigint") * 86400
        + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    )


def year_month(epoch_secs) -> Column:
    """epoch seconds -> INT yyyyMM in UTC (the statistics job's month key)."""
    day = F.date_from_unix_date(F.floor(_c(epoch_secs) / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


CHANGE_DATE_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x INT) RETURNS INT "
    "RETURN CAST(year(date_from_unix_date(CAST(floor(x / 86400) AS INT))) * 100 "
    "+ month(date_from_unix_date(CAST(floor(x / 86400) AS INT))) AS INT)"
)


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``changeDate`` as a SQL function (a SQL UDF, inlined by Catalyst)."""
    spark.sql(CHANGE_DATE_SQL)


# --- vectors -----------------------------------------------------------------

def as_double_array(col) -> Column:
    return _c(col).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """dot(a, b) / (|a| |b|); NULL when either vector has zero length (D9)."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


# --- scoring -----------------------------------------------------------------

def log2_count(n) -> Column:
    """log2 of a like/dislike count; a missing count acts as 1 (D1)."""
    return F.log2(F.greatest(F.coalesce(_c(n), F.lit(0)), F.lit(1)).cast("double"))


def is_like(score) -> Column:
    return _c(score) > LIKE_SCORE


# --- record codecs -----------------------------------------------------------

def encode_recs(recs) -> Column:
    """ARRAY<STRUCT<rid, r>> -> "rid:r|rid:r" (the stream table's string form)."""
    return F.array_join(
        F.transform(_c(recs), lambda x: F.concat_ws(":", x["rid"].cast("string"),
                                                    x["r"].cast("string"))),
        "|",
    )


def decode_recs(text) -> Column:
    """"rid:r|rid:r" -> ARRAY<STRUCT<rid INT, r DOUBLE>>; empty text -> empty array."""
    items = F.filter(F.split(_c(text), r"\|", -1), lambda s: s != "")
    return F.transform(
        items,
        lambda s: F.struct(
            strict_int(java_trim(F.get(F.split(s, ":", -1), 0))).alias("rid"),
            lenient_double(F.get(F.split(s, ":", -1), 1)).alias("r"),
        ),
    )


def decode_recent_item(text) -> Column:
    """"mid|score" (one recent-rating queue item) -> STRUCT<mid INT, score DOUBLE>."""
    parts = F.split(_c(text), r"\|", -1)
    return F.struct(
        strict_int(java_trim(field(parts, 0))).alias("mid"),
        lenient_double(field(parts, 1)).alias("score"),
    )


# --- users -------------------------------------------------------------------

def java_string_hash(col) -> Column:
    """``String.hashCode``: 31-polynomial over UTF-16 code units, 32-bit wrap.

    Units come from the UTF-16BE encoding, so characters outside the BMP count
    as their two surrogates, as in the JVM.
    """
    return _hash_from_hex(F.hex(F.encode(_c(col), "UTF-16BE")))


def _hash_from_hex(hexed: Column) -> Column:
    units = F.transform(
        F.sequence(F.lit(0), (F.length(hexed) / 4).cast("int") - 1),
        lambda i: F.conv(F.substring(hexed, i * 4 + 1, 4), 16, 10).cast("bigint"),
    )
    folded = F.aggregate(units, F.lit(0).cast("bigint"),
                         lambda acc, u: F.pmod(acc * 31 + u, F.lit(4294967296)))
    signed = F.when(folded >= 2147483648, folded - 4294967296).otherwise(folded)
    return F.when(F.length(hexed) == 0, F.lit(0)).otherwise(signed).cast("int")


def jvm_split(text, sep_regex: str) -> Column:
    """Split as the JVM's ``String.split`` does: trailing empty fields are dropped, all of
    them for a text of separators only; an empty text is one empty field."""
    c = _c(text)
    kept = F.regexp_replace(c, f"({sep_regex})+$", "")
    return F.when((kept == "") & (c != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(kept, sep_regex, -1))


def split_genres(text) -> Column:
    """"a|b|c" -> ARRAY<STRING> (the preferences request form), by ``jvm_split``."""
    return jvm_split(text, r"\|")
