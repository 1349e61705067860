"""Text functions (F3, F4, P11, P14) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's string hash.
HASH_MODULUS = 11113   # table size, a prime
HASH_SHIFT = 5         # h << 5
HASH_LETTER_BASE = 96  # letter value = UTF-16 code unit - 96 ('a' -> 1)
KEY_JOINER = "+"       # composite row key: title + "+" + id


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split_space(line) -> Column:
    """Tokens of ``line.split(" ")`` with Java semantics.

    Java drops trailing empty strings, so a line of only spaces gives no token,
    an empty line gives one empty token, and interior empties stay. Spark's
    ``split`` keeps trailing empties, so trailing spaces are stripped first.
    """
    line = _c(line)
    stripped = F.regexp_replace(line, " +$", "")
    return (F.when(line == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, " ", -1)))


def text_lines(text) -> Column:
    """Lines of a text, as a line-oriented text source would read them."""
    return F.split(_c(text), "\n", -1)


def _hash_step(h: Column, unit: Column) -> Column:
    # Java int arithmetic: '%' keeps the dividend's sign, like Spark's '%'.
    return (F.shiftleft(h, HASH_SHIFT) + unit - F.lit(HASH_LETTER_BASE)) % F.lit(HASH_MODULUS)


def text_hash(text) -> Column:
    """the reference's bucket hash of a whole string.

    h = ((h << 5) + (unit - 96)) mod 11113 over the UTF-16 code units, from
    h = 0; the result can be negative. Characters outside the BMP are two code
    units in Java, so they take two steps (high then low surrogate).
    """
    chars = F.filter(F.split(_c(text), ""), lambda ch: ch != "")

    def step(h, ch):
        cp = F.ascii(ch)
        off = cp - F.lit(0x10000)
        hi = F.lit(0xD800) + F.shiftright(off, 10)
        lo = F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))
        return F.when(cp < F.lit(0x10000), _hash_step(h, cp)).otherwise(
            _hash_step(_hash_step(h, hi), lo))

    return F.when(_c(text).isNull(), F.lit(None).cast("int")).otherwise(
        F.aggregate(chars, F.lit(0), step))


def composite_key(title, ident) -> Column:
    """``title + "+" + id``; NULL if either part is NULL (unlike concat_ws)."""
    return F.concat(_c(title), F.lit(KEY_JOINER), _c(ident))
