"""Value cleaning: byte-literal text such as ``b'1138.0'`` -> ``1138.0`` and
lenient numeric casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BYTE_LITERAL_PATTERNS, FILL_TOKEN, MISSING_TOKENS


def clean_byte_literal(c: Column) -> Column:
    """Strip a leading ``b'``, then a trailing ``'``, then one leading and one
    trailing double quote - in that order (``"b'7'"`` therefore stays
    ``b'7'``)."""
    for pattern in BYTE_LITERAL_PATTERNS:
        c = F.regexp_replace(c, pattern, "")
    return c


def to_double(c: Column) -> Column:
    """Text -> double; unparseable text (including ``NULL``) -> NULL.  A plain
    cast would raise under ANSI mode."""
    return c.try_cast("double")


def is_missing(c: Column, tokens=MISSING_TOKENS) -> Column:
    """True for SQL NULL and for the CSV reader's missing-value tokens."""
    return c.isNull() | c.isin(list(tokens))


def fill_missing_text(c: Column, tokens=MISSING_TOKENS, fill: str = FILL_TOKEN) -> Column:
    """Missing values become the text ``NULL`` (the loader's fill)."""
    return F.when(is_missing(c, tokens), F.lit(fill)).otherwise(c.cast("string"))
