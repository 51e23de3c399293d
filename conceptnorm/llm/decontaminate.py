"""Benchmark decontamination by winnowing.

Every text is cut into k-word grams; of each run of ``window - k + 1`` consecutive grams the one
of least hash is kept as a fingerprint. Two texts that share ``window`` words in a row hold the
same run of grams there, so they keep the same fingerprint: no shared span is missed, while about
one gram in five is looked up. A document's fingerprints are joined with those of the benchmark,
and each hit is extended to the windows around it, which are compared word by word. The benchmark
is the small side: it is read in blocks of bounded size, each block is broadcast, and documents
pass through all of them in one map without a shuffle, so no key and no passage is ever hot.

Defined results: a null or wordless text has no words and no hits; an item of fewer words than a
window (but not none) is itself one window; wordless items are ignored; an item without an id
goes by the empty string; repeated documents each get their own row, repeated items count once
for each id; an empty benchmark or table of documents gives clean or no rows; other columns of
the input are kept by ``clean`` and dropped by ``contamination``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import texts
from conceptnorm.llm.words import ALNUM, SLICE, Words, grams, slices, sliding

WINDOW, GRAM = 13, 5
#: Bytes of benchmark text in a broadcast block, about.
BLOCK_BYTES = 8 << 20
_STATE = "__n_words bigint, __spans array<struct<start: int, end: int>>, __items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Lookup:
    """Which of some 64-bit hashes are in a set: a bit table first, then the sorted set."""

    def __init__(self, hashes: Iterable[int]):
        self.sorted = np.unique(np.fromiter(hashes, dtype=np.uint64))
        self.shift = np.uint64(64 - 20)
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[self.sorted >> self.shift] = True

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[hashes >> self.shift])
        if not len(at):
            return at
        place = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        return at[self.sorted[place] == hashes[at]]


def fingerprints(hashes: np.ndarray, row: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: positions and hashes of the grams that are least in some run of them within a
    row. All of equal least grams are kept."""
    gram = grams(hashes, k)
    run = window - k + 1
    least = sliding(gram, run, np.minimum)
    least = np.where(row[:len(least)] == row[window - 1:], least, np.uint64(0))
    pad = np.zeros(run - 1, dtype=np.uint64)
    reach = sliding(np.concatenate([pad, least, pad]), run, np.maximum)
    at = np.flatnonzero((reach == gram) & (reach > 0)) if len(least) else np.zeros(0, np.int64)
    return at, gram[at]


class Index:
    """The windows of a block of benchmark items, and the fingerprints that lead to them."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, k: int = GRAM):
        self.window, self.k = window, k
        self.at: dict[bytes, set[str]] = {}
        words = Words(pa.array([text for _, text in items], pa.string()), ALNUM)
        hashes, row = words.hashes(), words.row_of_word()
        windows, short = set(), {}
        whole = grams(hashes, window)
        for i, (name, _) in enumerate(items):
            a, n = int(words.first[i]), int(words.counts[i])
            if 0 < n < window:
                self.at.setdefault(words.text(a, n), set()).add(name)
                short.setdefault(n, set()).add(int(grams(hashes[a:a + n], n)[0]))
            for s in range(a, a + n - window + 1):
                self.at.setdefault(words.text(s, window), set()).add(name)
                windows.add(int(whole[s]))
        self.seeds = Lookup(fingerprints(hashes, row, window, k)[1].tolist() if len(row) >= window else [])
        self.windows = Lookup(windows)
        self.short = {n: Lookup(x) for n, x in short.items()}

    def occurrences(self, words: Words) -> Iterator[tuple[int, int, set[str]]]:
        """First word, number of words and items of each window of the block in the texts."""
        hashes, row = words.hashes(), words.row_of_word()
        if len(hashes) >= self.window and len(self.seeds.sorted):
            at, prints = fingerprints(hashes, row, self.window, self.k)
            at = at[self.seeds.positions(prints)]
            near = np.unique(at[:, None] - np.arange(self.window - self.k + 1)[None, :])
            near = near[(near >= 0) & (near <= len(row) - self.window)]
            near = near[row[near] == row[near + self.window - 1]]
            if len(near):                        # the hits, extended to whole windows
                around = hashes[near[:, None] + np.arange(self.window)[None, :]]
                whole = grams(around.ravel(), self.window)[::self.window]
                for s in near[self.windows.positions(whole)].tolist():
                    if found := self.at.get(words.text(s, self.window)):
                        yield s, self.window, found
        for n, lookup in self.short.items():     # each of its own grams is an item's fingerprint
            at = lookup.positions(grams(hashes, n))
            for s in at[row[at] == row[at + n - 1]].tolist():
                if found := self.at.get(words.text(s, n)):
                    yield s, n, found


def _merge(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(b, out[-1]["end"])
        else:
            out.append({"start": a, "end": b})
    return out


def _pass(index: Index, text_col: str, carry: list[str], again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col, SLICE):
                words = Words(batch.column(text_col), ALNUM)
                row = words.row_of_word()
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                for s, n, found in index.occurrences(words):
                    r = int(row[s])
                    a = s - int(words.first[r])
                    own = spans.setdefault(r, [])
                    if own and own[-1][0] <= a <= own[-1][1]:
                        own[-1] = (own[-1][0], max(own[-1][1], a + n))
                    else:
                        own.append((a, a + n))
                    items.setdefault(r, set()).update(found)
                if again:                        # what earlier blocks have found
                    for r, (x, y) in enumerate(zip(batch.column("__spans").to_pylist(), batch.column("__items").to_pylist(), strict=True)):
                        if x:
                            spans.setdefault(r, []).extend((z["start"], z["end"]) for z in x)
                            items.setdefault(r, set()).update(y)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in carry), pa.array(words.counts, pa.int64()),
                     pa.array([_merge(spans[r]) if r in spans else [] for r in range(n)], _SPANS),
                     pa.array([sorted(items[r]) if r in items else [] for r in range(n)], pa.list_(pa.string()))],
                    names=[*carry, "__n_words", "__spans", "__items"])
    return run


def _scan(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str, item_col: str,
          item_text_col: str, block_bytes: int) -> DataFrame:
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text_col).cast("string").alias("text")).dropna(subset=["text"]).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = texts(docs, text_col)
    for i in range(blocks):                      # one block is on the driver at a time
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()
        last = i == blocks - 1
        names = carry if last else list(dict.fromkeys([*carry, text_col]))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name in names)
        names = [f.name for f in out.schema if f.name in names]
        need = list(dict.fromkeys([*names, text_col, *(["__spans", "__items"] if i else [])]))
        index = Index([(r["item"], r["text"]) for r in rows])
        out = out.select(*(F.col(f"`{c}`") for c in need)).mapInArrow(
            _pass(index, text_col, names, bool(i)), ", ".join([x for x in (schema, _STATE) if x]))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_words, spans (word positions of what the benchmark holds,
    merged, end exclusive), items (ids of the items met, sorted), n_hit (words in the spans)."""
    found = _scan(docs, benchmark, [id_col], text_col, item_col, item_text_col, block_bytes)
    return found.select(id_col, F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"),
                        F.col("__items").alias("items"), _hit().alias("n_hit"))


def _hit():
    return F.aggregate("__spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def contaminated(n_hit, n_words):
    """The rule: some word is hit, and hit words are a twentieth of all or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that aren't contaminated, whole and with all their columns."""
    found = _scan(docs, benchmark, docs.columns, text_col, item_col, item_text_col, block_bytes)
    return found.filter(~contaminated(_hit(), F.col("__n_words"))).select(*(F.col(f"`{c}`") for c in docs.columns))
