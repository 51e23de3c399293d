"""Suffix arrays by linear grouping, and what they say about equal stretches of short byte strings.

The array comes in two steps without renaming or recursion. First the suffixes are grouped by their
Lyndon prefixes: groups are taken from the highest to the lowest; each suffix of a group points to
the nearest position before it that lies in a lower group, and the positions pointed to move up
within their own groups, those with more pointers higher. Then the order within the groups is
emitted in one pass over the array itself: a suffix that has its place gives the next places of
their groups to the position before it and to what that one's pointers lead to.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a symbol.
WIDE = 16


def suffix_array(symbols: list[int]) -> list[int]:
    """Positions of the suffixes of ``symbols`` in ascending order. The last symbol has to be
    smaller than all others."""
    n = len(symbols)
    order = np.argsort(np.asarray(symbols, dtype=np.int64), kind="stable")
    ranked = np.asarray(symbols, dtype=np.int64)[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, sizes)
    size_at = np.zeros(n + 1, np.int64)
    size_at[first] = sizes
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    line, group, size, at = order.tolist(), group.tolist(), size_at.tolist(), place.tolist()
    before = _grouped(line, group, size, at)
    return _emitted(group, before)


def _grouped(line: list[int], group: list[int], size: list[int], at: list[int]) -> list[int]:
    """Refine the groups (``group``: where in ``line`` a position's group begins) to those of equal
    Lyndon prefixes. Returns for each position the nearest one before it of a lower group, or -1."""
    top = len(line)
    before = [-1] * top
    while top:
        low = group[line[top - 1]]
        if top - low == 1:                       # a group of one
            p = i = line[low]
            p -= 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0 and size[group[p]] > 1:
                _raised([p], line, group, size, at)
            top = low
            continue
        counts: dict[int, list[int]] = {}
        last, n = -1, 0
        for i in sorted(line[low:top]):          # equal targets follow each other
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p == last:
                n += 1
            else:
                if last >= 0:
                    counts.setdefault(n, []).append(last)
                last, n = p, 1
        if last >= 0:
            counts.setdefault(n, []).append(last)
        for k in sorted(counts, reverse=True):
            _raised(counts[k], line, group, size, at)
        top = low
    return before


def _raised(targets: list[int], line: list[int], group: list[int], size: list[int], at: list[int]) -> None:
    """Take positions out of their groups and make new groups of them, each just above the old one."""
    left: dict[int, list[int]] = {}
    for p in targets:
        g = group[p]
        if g in left:
            left[g].append(p)
        else:
            left[g] = [p]
    for g, moved in left.items():
        rest = size[g] - len(moved)
        if not rest:
            continue
        end = g + size[g] - 1
        for p in moved:
            q, other = at[p], line[end]
            line[q], at[other] = other, q
            line[end], at[p] = p, end
            end -= 1
        size[g] = rest
        new = g + rest
        size[new] = len(moved)
        for p in moved:
            group[p] = new


def _emitted(group: list[int], before: list[int]) -> list[int]:
    """The suffixes in order, from their groups and pointers."""
    n = len(group)
    free, out, open_ = list(range(n + 1)), [0] * n, [True] * n
    if n:
        out[0], open_[n - 1] = n - 1, False
        free[group[n - 1]] += 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and open_[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            open_[p] = False
            p = before[p]
    return out


def _symbols(pieces: list[bytes], marks: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces cut into symbols of 16 bytes (padded with zeros) so that each piece's mark is a
    cut; before the first cut stands one more symbol that ends there. Returns the bytes by symbol,
    the piece of each symbol, and the place in its piece at which a symbol begins."""
    parts, owner, starts = [], [], []
    for k, (piece, mark) in enumerate(zip(pieces, marks, strict=True)):
        lead = mark % WIDE
        n = 1 + -(-(len(piece) - lead) // WIDE)
        parts.append(b"\0" * (WIDE - lead) + piece + b"\0" * (n * WIDE - (WIDE - lead) - len(piece)))
        owner.append(np.full(n, k))
        starts.append(np.arange(n) * WIDE - (WIDE - lead))
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WIDE), np.concatenate(owner), np.concatenate(starts)


def _shared_bytes(sa: np.ndarray, text: np.ndarray, ranks: np.ndarray, most: int) -> np.ndarray:
    """Bytes, ``most`` at most, that each suffix shares with the one before it in the order.
    ``text`` has no bytes for separators; their rows are empty and their ranks differ."""
    shared = np.zeros(len(sa), np.int64)
    live = np.arange(1, len(sa))
    for t in range(-(-most // WIDE)):
        a, b = sa[live - 1] + t, sa[live] + t
        same = ranks[a] == ranks[b]
        shared[live[same]] = (t + 1) * WIDE
        ends = live[~same]
        differ = text[sa[ends - 1] + t] != text[sa[ends] + t]
        shared[ends] = t * WIDE + np.where(differ.any(axis=1), differ.argmax(axis=1), 0)
        live = live[same]
        if not len(live):
            break
    return np.minimum(shared, most)


def repeated_windows(pieces: list[bytes], marks: list[int], length: int) -> list[np.ndarray]:
    """For each piece the starts of its windows of ``length`` bytes that also occur in another
    piece, with the mark at the same place of the window. A window holds the byte after its mark."""
    text, owner, starts = _symbols(pieces, marks)
    hi, lo = (text[:, i:i + 8].copy().view(">u8").ravel().astype(np.uint64) for i in (0, 8))
    order = np.lexsort((lo, hi))
    new = np.r_[False, (hi[order[1:]] != hi[order[:-1]]) | (lo[order[1:]] != lo[order[:-1]])]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)

    # a separator after each piece, all different and below every symbol
    m = len(pieces)
    place = np.arange(len(rank)) + owner          # of a symbol among symbols and separators
    total = len(rank) + m
    line = np.empty(total, np.int64)
    line[place] = rank + m
    gaps = np.flatnonzero(np.bincount(place, minlength=total) == 0)
    line[gaps] = np.arange(m - 1, -1, -1)
    at_symbol = np.full(total, -1)
    at_symbol[place] = np.arange(len(rank))
    sa = np.asarray(suffix_array(line.tolist()), np.int64)
    rows = np.zeros((total, WIDE), np.uint8)
    rows[place] = text
    shared = _shared_bytes(sa, rows, line, length)

    symbol = at_symbol[sa]
    ok = (symbol > 0) & (starts[np.maximum(symbol, 0)] >= 0)
    symbol, at = symbol[ok], np.flatnonzero(ok)
    piece, start = owner[symbol], starts[symbol]
    last = np.asarray([len(p) for p in pieces])[piece] - length
    found_piece, found_start = [], []
    for s in range(WIDE):
        valid = np.flatnonzero((start - s >= 0) & (start - s <= last))
        # windows of one interval share what follows the cut; the s bytes before it are compared
        interval = np.cumsum(shared < length - s)[at[valid]]
        twice = np.bincount(interval, minlength=1)[interval] > 1 if len(valid) else valid.astype(bool)
        valid, interval = valid[twice], interval[twice]
        if not len(valid):
            continue
        left = symbol[valid] - 1
        mask_lo = np.uint64(2**64 - 1 if s >= 8 else (1 << 8 * s) - 1)
        mask_hi = np.uint64((1 << 8 * max(0, s - 8)) - 1)
        x, y = hi[left] & mask_hi, lo[left] & mask_lo
        by = np.lexsort((y, x, interval))
        same = (interval[by[1:]] == interval[by[:-1]]) & (x[by[1:]] == x[by[:-1]]) & (y[by[1:]] == y[by[:-1]])
        hit = by[np.r_[False, same] | np.r_[same, False]]
        found_piece.append(piece[valid[hit]])
        found_start.append(start[valid[hit]] - s)
    if not found_piece:
        return [np.zeros(0, np.int64)] * m
    found_piece, found_start = np.concatenate(found_piece), np.concatenate(found_start)
    by = np.lexsort((found_start, found_piece))
    return np.split(found_start[by], np.searchsorted(found_piece[by], np.arange(1, m)))
