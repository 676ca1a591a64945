"""Column-level helpers (pure ``pyspark.sql.functions`` expressions)."""

from terrarank.functions.scalars import (
    code_label,
    in_group,
    normalize_key,
    normalize_key_guarded,
    null_if_missing_token,
    safe_div,
    to_integer,
    to_numeric,
)

__all__ = [
    "code_label",
    "in_group",
    "normalize_key",
    "normalize_key_guarded",
    "null_if_missing_token",
    "safe_div",
    "to_integer",
    "to_numeric",
]
