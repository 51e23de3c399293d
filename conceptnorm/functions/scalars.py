"""Scalar column functions (F7-F12): JVM-side expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written).
# ---------------------------------------------------------------------------
UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"
# The whitespace a Python str method or `\s` pattern treats as space, written
# as a regex class body usable by both Java regex and RE2.
WS_CLASS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Shape of a CURIE: prefix, colon, no whitespace after it.
CURIE_PATTERN = r"^[A-Za-z][A-Za-z0-9._-]*:[^" + WS_CLASS + r"]+$"
# Identifiers with this prefix (any case) are never a name match.
EXCLUDED_NAME_PREFIX = "pmid:"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL (Spark compares NaN = NaN as true)."""
    c = col(c)
    return F.when(c == F.lit(float("nan")), F.lit(None).cast("double")).otherwise(c)


def ascii_lower(c: Column | str) -> Column:
    """F8: case folding of A-Z only (non-ASCII letters keep their case)."""
    return F.translate(col(c), UPPER_ASCII, LOWER_ASCII)


def nocase_order(c: Column | str) -> list[Column]:
    """F8: NOCASE ordering keys (ASCII-folded, then exact)."""
    return [ascii_lower(c), col(c)]


def stripped(c: Column | str) -> Column:
    """A string without the whitespace at its ends."""
    return F.regexp_replace(col(c), f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")


def is_curie(c: Column | str) -> Column:
    """CURIE-shaped string."""
    return col(c).rlike(CURIE_PATTERN)


def is_named(c: Column | str) -> Column:
    """not NULL and not only spaces (TRIM removes spaces only)."""
    c = col(c)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def not_excluded_for_names(curie: Column | str) -> Column:
    """CURIEs starting with PMID: (any ASCII case) are skipped."""
    return ~ascii_lower(curie).startswith(EXCLUDED_NAME_PREFIX)


def has_duplicates(arr: Column | str) -> Column:
    """An array with a repeated element."""
    arr = col(arr)
    return F.size(arr) != F.size(F.array_distinct(arr))
