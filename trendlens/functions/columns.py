"""Scalar column functions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
that projections stay in whole-stage codegen and filters above them still
reach the scan.  Division and casts use the ``try_`` forms: with ANSI mode on
a zero denominator or a bad string gives NULL rather than failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_length(col) -> Column:
    """length in characters (code points)."""
    return F.length(_c(col))


def word_count_single_space(col) -> Column:
    """pieces after splitting on one space; empties count ('a  b ' -> 4, '' -> 1).

    That is the number of spaces plus one, counted without building the array
    of words (texts can hold tens of thousands of words).  NULL gives NULL.
    """
    c = _c(col)
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + F.lit(1)


def word_count_whitespace(col) -> Column:
    """words separated by any whitespace run, no empty words ('' -> 0)."""
    c = _c(col)
    words = F.split(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+")
    return F.when(c.isNotNull(), F.size(F.filter(words, lambda w: w != F.lit(""))))


def split_on(col, regex: str) -> Column:
    """Split a string on a regular expression; NULL stays NULL."""
    return F.split(_c(col), regex)


def split_pipe(col) -> Column:
    """pipe-joined tags to an array (the pipe is a regex metacharacter)."""
    return F.split(_c(col), r"\|")


def normalize_tag(col, trim: bool = True, lower: bool = True) -> Column:
    """F5 on one tag: optional trim, optional lower-case."""
    c = _c(col)
    if lower:
        c = F.lower(c)
    if trim:
        c = F.trim(c)
    return c


def lower_all(col) -> Column:
    """lower-case every element; a NULL array becomes an empty array.

    Native ``transform`` replaces a Python UDF: no Python worker, and filters
    above it are not blocked by a BatchEvalPython barrier.
    """
    return F.coalesce(F.transform(_c(col), lambda x: F.lower(x)),
                      F.array().cast(T.ArrayType(T.StringType())))


def drop_blank(col) -> Column:
    """Remove elements that are empty after trimming."""
    return F.filter(_c(col), lambda x: F.trim(x) != F.lit(""))


TIME_PARTS = {
    "year": F.year,
    "month": F.month,
    "dayofweek": F.dayofweek,   # 1 = Sunday
    "hour": F.hour,
}


def time_part(col, part: str) -> Column:
    """year, month, day of week (1 = Sunday .. 7 = Saturday) or hour."""
    return TIME_PARTS[part](_c(col))


def ratio(num, den, digits: int | None = None) -> Column:
    """num / den, NULL on a zero denominator, optionally rounded half-up."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.round(r, digits) if digits is not None else r


def log1p(col) -> Column:
    """F10."""
    return F.log1p(_c(col))


def parse_publish_time(col, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """F8: parse a request timestamp; a malformed string gives NULL."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def as_string(col) -> Column:
    """numeric -> categorical string."""
    return _c(col).cast("string")


def decode_json(col, schema) -> Column:
    """JSON text (or bytes) to a struct; mismatching fields become NULL."""
    c = _c(col)
    return F.from_json(c.cast("string"), schema)
