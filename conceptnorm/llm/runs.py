"""Periodic runs of words, by an enhanced suffix array (suffix array, its inverse, LCP values).

A run is a stretch of consecutive words with smallest period q, of at least max(least, 2 * q)
words, that no neighbouring word extends. Its last 2 * q words are a square (some q words twice)
whose next word breaks the period. Such a square at word i is a branching one: the suffixes i and
i + q share exactly q words, so they are in different children of the LCP interval of depth q. For
each interval all suffixes of its children but the largest are looked at: a square begins at i if
i + q is in the interval and in another child, and at i - q if that one is in the largest child.
Each suffix is looked at as often as its side is the smaller one, a logarithm of the words. The
intervals come from the LCP values with a stack; no tree is built. Squares are then moved to the
left as long as the word before equals the one q further on; squares of the same stretch are one run,
and the least q is its period.

Only stretches in which every word could be in a run get a suffix array: in a run all pairs of
neighbouring words, but for one pair in the middle at most, occur twice. This leaves out most prose
and no run.

Defined results: a null or wordless text has no runs. Repeated rows get equal results. Each row is
looked at by itself, so its memory grows with the row alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import texts
from conceptnorm.llm.words import Words, mix, slices

LEAST = 12


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the values, and for each value the first place of its equals there."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    head = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    rank = np.empty(len(values), np.int64)
    rank[order] = np.repeat(head, np.diff(np.r_[head, len(values)]))
    return order, rank


def enhanced_suffix_array(words: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sa, isa, lcp) of many short sequences at once: ``part`` is the number of each word's
    sequence, not falling. Suffixes are ordered by sequence first, and share nothing beyond theirs.
    lcp[i] belongs to sa[i - 1] and sa[i]."""
    n = len(words)
    end = np.searchsorted(part, part, side="right")
    _, word = _ranks(words)
    sa, rank = _ranks(part * np.int64(n + 1) + word + 1)
    lcp = np.zeros(n, np.int64)
    steps, k = [(0, rank)], 1
    open_ = np.arange(n)
    while True:
        # only suffixes whose first k words aren't theirs alone are ordered further
        ahead = np.r_[rank[sa[1:]] == rank[sa[:-1]], False]
        tied = ahead.copy()
        tied[1:] |= ahead[:-1]
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        at = sa[open_]
        beyond = at + k < end[at]
        follow = np.where(beyond, rank[np.minimum(at + k, n - 1)] + 1, 0)
        by = np.lexsort((follow, rank[at]))
        at, follow, old = at[by], follow[by], rank[at][by]
        sa[open_] = at
        head = np.r_[True, (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])]
        new = rank.copy()
        new[at] = open_[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        rank, k = new, 2 * k
        steps.append((k, rank))
    isa = rank
    # shared words of neighbours, from the ranks by the first 1, 2, 4, ... words
    a, b = sa[:-1].copy(), sa[1:].copy()
    for k, by in reversed([(max(1, k), r) for k, r in steps]):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[by[a[inside]] == by[b[inside]]]
        lcp[1:][same] += k
        a[same] += k
        b[same] += k
    return sa, isa, lcp


def _intervals(lcp: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(low, high, depth, child low, child high) for the children of each LCP interval (depth over
    0) but its largest, bounds included; the largest child follows from the others."""
    out = []
    stack: list[list] = []                       # [depth, low, children's first places]
    for i in range(1, len(lcp) + 1):
        depth = lcp[i] if i < len(lcp) else 0
        low = i - 1
        while stack and stack[-1][0] > depth:
            d, low, cuts = stack.pop()
            ends = [*cuts[1:], i]
            largest = max(range(len(cuts)), key=lambda j: ends[j] - cuts[j])
            lo, hi = cuts[largest], ends[largest] - 1
            out += [(low, i - 1, d, c, e - 1, lo, hi) for j, (c, e) in enumerate(zip(cuts, ends, strict=True)) if j != largest]
        if depth:
            if stack and stack[-1][0] == depth:
                stack[-1][2].append(i)
            else:
                stack.append([depth, low, [low, i]])
    return out


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, q) of the squares whose next word, if any, breaks the period q."""
    found = np.array(_intervals(lcp.tolist()), np.int64).reshape(-1, 7)
    low, high, depth, first, last, big_low, big_high = found.T
    n = last - first + 1
    which = np.repeat(np.arange(len(n)), n)
    suffix = sa[first[which] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    d, lo, hi = depth[which], low[which], high[which]
    ahead, behind = suffix + d, suffix - d
    there = isa[np.minimum(ahead, len(sa) - 1)]
    square = (ahead < len(sa)) & (there >= lo) & (there <= hi) & ((there < first[which]) | (there > last[which]))
    there = isa[np.maximum(behind, 0)]
    before = (behind >= 0) & (there >= big_low[which]) & (there <= big_high[which])
    return np.r_[suffix[square], behind[before]], np.r_[d[square], d[before]]


def _stretches(words: np.ndarray, part: np.ndarray, least: int) -> np.ndarray:
    """The positions that can be in a run of ``least`` words: part of a stretch of that length in
    which pairs of words recur, without two neighbouring gaps. part: number of the text, not falling."""
    at = np.arange(len(words))
    while len(at):
        pair = np.flatnonzero(part[1:] == part[:-1])
        word = words[at]
        kind = mix(word[pair] * np.uint64(3) + word[pair + 1]) ^ mix(part[pair].astype(np.uint64))
        order = np.argsort(kind)
        same = kind[order[1:]] == kind[order[:-1]]
        good = np.zeros(len(at), bool)
        good[pair[order[1:][same]]] = True
        good[pair[order[:-1][same]]] = True
        # a gap of one pair is closed; the last word of a text begins no pair
        closed = good.copy()
        closed[1:-1] |= good[:-2] & good[2:] & (part[:-2] == part[2:])
        # a stretch of pairs covers one more word
        edge = np.flatnonzero(np.diff(np.r_[False, closed, False].astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        keep = end - begin + 1 >= least
        begin, end = begin[keep], end[keep] + 1
        n = end - begin
        to = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        now, number = at[to], np.repeat(np.arange(len(n)), n)
        if len(now) == len(at) and len(n) == len(np.unique(part)):
            return np.stack([now, number])
        at, part = now, number
    return np.zeros((2, 0), np.int64)


def runs(words: np.ndarray, part: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of many texts at once, by start and period. ``words``
    are numbers for words, ``part`` the number of each word's text, not falling."""
    none = (np.zeros(0, np.int64),) * 3
    at, number = _stretches(words, part, least)
    if not len(at):
        return none
    own = words[at]
    sa, isa, lcp = enhanced_suffix_array(own, number)
    start, q = branching_squares(sa, isa, lcp)
    end = start + 2 * q
    by = np.lexsort((q, end))
    start, end, q = start[by], end[by], q[by]
    found = [none]
    while len(start):
        # of squares that end alike, the shortest; longer ones inside its run repeat it
        head = np.r_[True, end[1:] != end[:-1]]
        low = _leftmost(own, start[head], q[head], np.searchsorted(number, number[start[head]]))
        found.append((low, end[head] - low, q[head]))
        of = np.cumsum(head) - 1
        rest = ~head & ((q % q[head][of] != 0) | (start < low[of]))
        start, end, q = start[rest], end[rest], q[rest]
    start, size, q = (np.concatenate(x) for x in zip(*found, strict=True))
    long = size >= np.maximum(least, 2 * q)
    start, size, q = start[long], size[long], q[long]
    by = np.lexsort((q, size, start))
    start, size, q = start[by], size[by], q[by]
    new = np.r_[True, (start[1:] != start[:-1]) | (size[1:] != size[:-1])][:len(start)]
    start, size, q = start[new], size[new], q[new]
    by = np.lexsort((q, start))
    return at[start[by]], size[by], q[by]


def _leftmost(own: np.ndarray, start: np.ndarray, q: np.ndarray, first: np.ndarray, step: int = 64) -> np.ndarray:
    """Where squares come to when they are rotated to the left, not beyond ``first``."""
    start = start.copy()
    moving = np.arange(len(start))
    while len(moving):
        i = start[moving, None] - 1 - np.arange(step)
        same = (i >= first[moving, None]) & (own[np.maximum(i, 0)] == own[np.clip(i + q[moving, None], 0, len(own) - 1)])
        n = np.where(same.all(axis=1), step, same.argmin(axis=1))
        start[moving] -= n
        moving = moving[n == step]
    return start


def _found(least: int, looped: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), lower=False)
                first, counts = words.first, words.counts
                index = np.arange(len(words.starts))
                if looped:
                    a, p = (np.asarray(batch.column(c)) for c in ("loop_from", "loop_period"))
                    row = words.row_of_word()
                    i = index - first[row]
                    back = (p[row] > 0) & (i >= a[row])
                    index = np.where(back, first[row] + a[row] + (i - a[row]) % np.maximum(p[row], 1), index)
                part = words.row_of_word()
                start, size, period = runs(words.hashes()[index], part, least)
                of = np.searchsorted(start, first)
                lists, kept = [], []
                for r, (x, n) in enumerate(zip(first[:-1].tolist(), counts.tolist(), strict=True)):
                    own = slice(of[r], of[r + 1])
                    stays = np.ones(n, bool)
                    found = []
                    for s, m, q in zip((start[own] - x).tolist(), size[own].tolist(), period[own].tolist(), strict=True):
                        found.append({"start": s, "length": m, "period": q})
                        stays[s + q:s + m] = False
                    lists.append(found)
                    data = words.data
                    kept.append(b" ".join(data[words.starts[j]:words.ends[j]].tobytes() for j in index[x:x + n][stays].tolist()).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()),
                     pa.array(lists, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                     pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  loop: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length and period by start and period),
    collapsed (the text's words joined by one space, without those that a run holds after its
    first period). ``loop`` names two columns, a and p: before the search, each word i >= a
    becomes word a + (i - a) % p where p is over 0."""
    keep = [F.coalesce(F.col(f"`{c}`").cast("bigint"), F.lit(0)).alias(to)
            for c, to in zip(loop or (), ("loop_from", "loop_period"), strict=False)]
    rows = texts(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *keep), "text")
    return rows.mapInArrow(
        _found(least, bool(loop)),
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
