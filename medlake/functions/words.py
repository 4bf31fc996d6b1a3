"""Hashed bags of words as column expressions: the filled places of the default text vectors, without Python workers."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a word is once A-Z are lowered, and the leading hexadecimal digits of its MD5 that are hashed.
WORD = "[a-z0-9]+"
HASH_DIGITS = 8


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_slots(text: Column, dim: int) -> Column:
    """The slots of all ASCII words of ``text``, sorted, repeats included."""

    def slot(word: Column) -> Column:
        digits = F.substring(F.md5(word), 1, HASH_DIGITS)
        return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(dim)).cast("int")

    plain = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.sort_array(F.transform(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), slot))


def _run_lengths(ordered: Column) -> Column:
    """How often each distinct value of a sorted array occurs, in its order; linear in the array."""
    size = F.size(ordered)
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))

    def lengths(starts: Column) -> Column:
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(size))
        return F.zip_with(starts, F.slice(ends, 1, F.size(starts)), lambda a, b: b - a)

    first = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
    return bound(F.filter(places, first), lengths)


def sparse_words(text: Column, dim: int) -> Column:
    """``struct(slots array<int>, weights array<float>)``: the filled slots of the vector of length 1, ascending.

    A text without words has no slots; a null text gives null.
    """

    def weighed(counts: Column) -> Column:
        squares = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, c: a + c.cast("bigint") * c)
        norm = F.sqrt(squares.cast("double"))
        return bound(norm, lambda length: F.transform(counts, lambda c: (c / length).cast("float")))

    def vector(ordered: Column) -> Column:
        return F.struct(
            F.array_distinct(ordered).alias("slots"), bound(_run_lengths(ordered), weighed).alias("weights")
        )

    return F.when(text.isNotNull(), bound(word_slots(text, dim), vector))
