"""Name variants for name resolution (F1-F5), as native column expressions.

A name's variants, in order:

1. the name itself;
2. the name with one trailing *balanced* parenthetical removed, repeatedly
   (every intermediate is a variant);
3. the original name with inline abbreviations ``(XX...)`` removed;
4. the singular of the last word of every variant so far.

Each variant has its whitespace runs collapsed to one space and is trimmed;
empty variants and repeats are dropped, keeping the first occurrence.

Balanced-parenthesis stripping is not a regular language, so it is one
``aggregate`` fold over the characters from the right: outside a group,
whitespace is skipped and anything but ``)`` ends the scan; inside, the depth
is tracked and each return to depth 0 records a cut. A group still open at the
start of the string (unbalanced) ends the scan without a cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from conceptnorm.functions.scalars import WS_CLASS, col

# Inline abbreviation: 2 letters then up to 8 letters/digits in parentheses.
ABBREVIATION_PATTERN = r"[" + WS_CLASS + r"]*\([A-Za-z]{2}[A-Za-z0-9]{0,8}\)"
# Singularization rules: text shorter than 5 or a last word shorter than 4 is
# left alone; "ies" becomes "y" when the word is longer than 4; otherwise a
# final "s" (but not "ss") is dropped.
MIN_TEXT_FOR_SINGULAR = 5
MIN_WORD_FOR_SINGULAR = 4


def normalize_ws(c: Column | str) -> Column:
    """collapse whitespace runs to one space and trim."""
    collapsed = F.regexp_replace(col(c), f"[{WS_CLASS}]+", " ")
    return F.regexp_replace(collapsed, "^ | $", "")


def rstrip_ws(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"[{WS_CLASS}]+$", "")


def paren_cuts(c: Column | str) -> Column:
    """Positions (1-based) of the '(' of each trailing balanced group, from
    the right; successive entries are successive strips."""
    s = col(c)
    init = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("active"),
                    F.array().cast("array<int>").alias("cuts"))

    def step(acc, idx):
        ch = s.substr(idx, F.lit(1))
        depth, active, cuts = acc["depth"], acc["active"], acc["cuts"]
        outside = depth == 0
        is_ws = ch.rlike(f"^[{WS_CLASS}]$")
        new_depth = (F.when(~active, depth)
                     .when(outside & is_ws, depth)
                     .when(ch == ")", depth + 1)
                     .when(~outside & (ch == "("), depth - 1)
                     .otherwise(depth))
        new_active = (F.when(~active, F.lit(False))
                      .when(outside & ~is_ws & (ch != ")"), F.lit(False))
                      .otherwise(F.lit(True)))
        closes = active & ~outside & (ch == "(") & (depth == 1)
        new_cuts = F.when(closes, F.concat(cuts, F.array(idx.cast("int")))).otherwise(cuts)
        return F.struct(new_depth.alias("depth"), new_active.alias("active"),
                        new_cuts.alias("cuts"))

    positions = F.sequence(F.length(s), F.lit(1), F.lit(-1))
    folded = F.aggregate(F.when(F.length(s) > 0, positions).otherwise(F.array().cast("array<int>")),
                         init, step)
    return folded["cuts"]


def paren_strips(c: Column | str) -> Column:
    """successive trailing-parenthetical strips of a name (non-empty)."""
    s = col(c)
    stripped = F.transform(paren_cuts(s), lambda p: rstrip_ws(s.substr(F.lit(1), p - 1)))
    return F.filter(stripped, lambda x: F.length(x) > 0)


def remove_abbreviations(c: Column | str) -> Column:
    """drop inline abbreviations such as ``(IL6)`` anywhere."""
    return F.regexp_replace(col(c), ABBREVIATION_PATTERN, "")


def singular(c: Column | str) -> Column:
    """singular of the last space-separated word, NULL when unchanged."""
    s = col(c)
    tail = F.substring_index(s, " ", -1)
    head_len = F.length(s) - F.length(tail) - 1
    head = F.when(head_len > 0, s.substr(F.lit(1), head_len)).otherwise(F.lit(""))
    has_head = F.length(s) > F.length(tail)
    n = F.length(tail)
    new_tail = (F.when(tail.endswith("ies") & (n > 4), F.concat(tail.substr(F.lit(1), n - 3), F.lit("y")))
                .when(tail.endswith("s") & ~tail.endswith("ss"), tail.substr(F.lit(1), n - 1)))
    joined = F.when(has_head, F.concat(head, F.lit(" "), new_tail)).otherwise(new_tail)
    return (F.when(F.length(s) < MIN_TEXT_FOR_SINGULAR, F.lit(None).cast("string"))
             .when(n < MIN_WORD_FOR_SINGULAR, F.lit(None).cast("string"))
             .otherwise(joined))


def clean_variants(arr: Column) -> Column:
    """Normalize whitespace, drop empties, keep first occurrences."""
    return _clean(arr)


def _clean(arr: Column) -> Column:
    normalized = F.transform(arr, normalize_ws)
    return F.array_distinct(F.filter(normalized, lambda x: x.isNotNull() & (F.length(x) > 0)))


def name_variants(c: Column | str) -> Column:
    """ordered, distinct variants of a name."""
    name = col(c)
    base = _clean(F.concat(F.array(name), paren_strips(name),
                           F.array(remove_abbreviations(name))))
    return _clean(F.concat(base, F.transform(base, singular)))
