"""Small text and conversion helpers, all built from Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters the JVM counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def is_blank(value) -> Column:
    """True for null, empty and white-space-only text."""
    text = _col(value)
    return text.isNull() | (F.btrim(text, F.lit(WHITE_SPACE)) == "")


def is_not_blank(value) -> Column:
    return ~is_blank(value)


def text_or_null_word(value) -> Column:
    """The text, or the word ``null`` where there is none, as JVM text joining shows it."""
    return F.coalesce(_col(value), F.lit("null"))


def join_text(*values) -> Column:
    return F.concat(*[text_or_null_word(value) for value in values])


def to_long(value) -> Column:
    """Text to a whole number, null where it is none; a decimal loses its fraction.

    The fraction is cut off as text, so no number of digits can round it up.
    """
    text = _col(value)
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(
        text.try_cast("bigint"),
        whole.try_cast("bigint"),
        text.try_cast("decimal(38,18)").try_cast("bigint"),
    )


def to_text(value) -> Column:
    return _col(value).cast("string")


def map_get_or(mapping, key: str, default: str = "") -> Column:
    """The map's value under a key, or the default where the key is absent."""
    return F.coalesce(F.try_element_at(_col(mapping), F.lit(key)), F.lit(default))
