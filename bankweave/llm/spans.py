"""Where the matches of an expression lie in a text, by built-in expressions.

A text is split at an expression's matches; where a match starts follows from the lengths of the parts and matches
in front of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEAR = 40  # code points on either side that count as nearby
_CHUNK = 64
_PIECE = 128


def _running(values: Column) -> Column:
    """Sum of an array, and the sums of all elements in front of each."""
    return F.aggregate(
        values, F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before")),
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["before"], F.array(acc["sum"])).alias("before")))


def _offsets(matches: Column, parts: Column) -> Column:
    """Length of all parts and matches in front of each part, by chunks, so that no long array is copied once per element."""
    n = F.size(matches)

    def chunk(i: Column) -> Column:
        count = F.least(F.lit(_CHUNK), n - i * _CHUNK)
        pair = F.zip_with(F.slice(parts, i * _CHUNK + 1, count), F.slice(matches, i * _CHUNK + 1, count), lambda p, m: F.char_length(p) + F.char_length(m))
        return _running(pair)

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / _CHUNK).cast("int")), chunk)
    starts = _running(F.transform(chunks, lambda c: c["sum"]))["before"]
    return F.flatten(F.zip_with(chunks, starts, lambda c, start: F.transform(c["before"], lambda x: x + start)))


def proposals(matches: Column, parts: Column) -> Column:
    """Array of (start, match) from an expression's matches and the parts of the text between them.

    Both are columns that are there already, as they are read many times.
    """
    n = F.size(matches)
    rows = F.arrays_zip(_offsets(matches, parts).alias("at"), F.slice(parts, 1, n).alias("part"), matches.alias("match"))
    return F.transform(rows, lambda r: F.struct((r["at"] + F.char_length(r["part"])).alias("start"), r["match"].alias("match")))


def pieces(text: Column) -> Column:
    """A text in pieces of one length, so that a cut from it does not count code points from the text's start."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_PIECE}}}+"), F.lit(0))


def cut(held: Column, start: Column, length: Column | int) -> Column:
    """``length`` code points (at most ``_PIECE``, fewer at the text's end) from ``start`` on, from the pieces of a text."""
    first = F.floor(start / _PIECE).cast("int")
    return F.substring(F.array_join(F.slice(held, first + 1, 2), ""), start - first * _PIECE + 1, F.lit(length) if isinstance(length, int) else length)


def before(held: Column, start: Column) -> Column:
    """The ``NEAR`` code points in front of a span, whatever they hold; ``held`` is the text in pieces."""
    at = F.greatest(start - NEAR, F.lit(0))
    return cut(held, at, start - at)


def after(held: Column, end: Column) -> Column:
    return cut(held, end, NEAR)
