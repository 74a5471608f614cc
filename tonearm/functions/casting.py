"""Casts that keep "missing" and "uncastable" apart, as SQL expression texts."""

from __future__ import annotations

# Texts a JSON number reader takes for a missing number.
MISSING_TEXTS = ["", "null", "NULL"]

_MISSING = ", ".join(f"'{t}'" for t in MISSING_TEXTS)


def is_missing(leaf: str) -> str:
    return f"({leaf} IS NULL OR {leaf} IN ({_MISSING}))"


def lenient(leaf: str, type_name: str = "bigint") -> str:
    """Number from a string leaf; missing and uncastable both give null (none of the
    texts for "missing" casts to a number)."""
    return f"try_cast({leaf} AS {type_name})"


def uncastable(leaf: str, type_name: str = "bigint") -> str:
    """True when a value is there but is no number of that type."""
    return f"({lenient(leaf, type_name)} IS NULL AND NOT {is_missing(leaf)})"
