"""Scalar column expressions.

All of these compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A finite decimal literal, optionally signed, optionally with an exponent.
# Spark's try_cast also accepts "NaN", "Infinity" and suffixes like "5d";
# those are not numbers for our purposes, so we gate on this pattern first.
_NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DIGITS_RE = r"^[0-9]+$"

MISSING_TOKEN = ".."


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_missing_token(c: ColumnOrName, token: str = MISSING_TOKEN) -> Column:
    """Map the statistics office's missing marker (``..``) to NULL."""
    return F.nullif(_col(c).cast("string"), F.lit(token))


def to_numeric(c: ColumnOrName) -> Column:
    """Coerce anything to DOUBLE; unparseable, NaN and infinite values become NULL."""
    s = F.trim(null_if_missing_token(c))
    return F.when(s.rlike(_NUMERIC_RE), s.try_cast("double"))


def to_integer(c: ColumnOrName) -> Column:
    """Coerce to INT when the value is a whole number, else NULL."""
    d = to_numeric(c)
    return F.when(d == F.floor(d), d.try_cast("int"))


def normalize_key(c: ColumnOrName, width: int = 7) -> Column:
    """Canonical entity key: ``str(int(float(x)))`` cut to ``width`` or zero-padded.

    Non-numeric input gives NULL. A negative value keeps its sign in front of
    the padding, like Python's ``zfill``.
    """
    d = to_numeric(c)
    s = d.try_cast("bigint").cast("string")
    padded = F.when(
        s.startswith("-"), F.concat(F.lit("-"), F.lpad(F.substring(s, 2, width), width - 1, "0"))
    ).otherwise(F.lpad(s, width, "0"))
    return F.when(F.length(s) >= width, F.substring(s, 1, width)).otherwise(padded)


def normalize_key_guarded(c: ColumnOrName, width: int = 7) -> Column:
    """Normalise only non-null, all-digit keys (after trimming); others → NULL."""
    s = F.trim(_col(c).cast("string"))
    return F.when(s.rlike(_DIGITS_RE), normalize_key(s, width))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with a zero denominator giving NULL (never an ANSI error)."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def in_group(c: ColumnOrName, codes: Iterable) -> Column:
    """Class-group membership flag (compiles to InSet for long lists)."""
    return _col(c).isin(list(codes))


def code_label(c: ColumnOrName, mapping: Mapping) -> Column:
    """Look a code up in a literal map; unmapped codes give NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs.extend([F.lit(k), F.lit(v)])
    return F.try_element_at(F.create_map(*pairs), _col(c))
