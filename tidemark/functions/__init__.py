"""Column helpers shared by the models; all of them stay inside code generation."""

from tidemark.functions.keys import hash_of, surrogate_key
from tidemark.functions.measures import (
    conditional_sum,
    days_between,
    divide_exact,
    loaded_at,
    months_between_starts,
    not_deleted,
    parse_utc,
    safe_divide,
    share_of,
    utc,
    utc_like,
)

__all__ = [
    "conditional_sum",
    "days_between",
    "divide_exact",
    "hash_of",
    "loaded_at",
    "months_between_starts",
    "not_deleted",
    "parse_utc",
    "safe_divide",
    "share_of",
    "surrogate_key",
    "utc",
    "utc_like",
]
