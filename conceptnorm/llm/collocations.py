"""Collocations: phrases that are frequent, and more so than their parts would have it.

Frequent phrases are found by dynamic itemset counting. The corpus is dealt into shards, which are
scanned in a cycle, one a step. A phrase is counted from the step after both phrases that it
consists of (all but its last word, all but its first) have reached the threshold, even while
those are still being counted; it is done when it has been counted for one whole cycle. So phrases
of several lengths are counted in the same scan, and no frequent phrase is missed: its parts are at
least as frequent and reach the threshold within their own cycles. It ends when no phrase is open.

Each step is a job over one shard. Tasks leave out what can't be active with two bitmaps of the
phrases that have reached the threshold (so far, and within the last cycle; at most MAX_BITS each,
so a few phrases too many pass), count what is left, and only exactly the active ones go on before
counts are shuffled: tasks look them up in the keys of those phrases, and beyond BROADCAST_PHRASES a join
does. Spark's own broadcast isn't used for it, as the driver would hold several times the keys. Counts of a step are staged. A phrase can only come to
the threshold over a cycle if it has the threshold's share of a cycle's steps in one of them, so
only such phrases' counts are added up. Phrases are 60-bit hashes with their length (n frequent ones
among m meet one of another phrase with a chance of n * m / 2**60); a last scan counts the frequent
ones again and spells them, each once a task.

Defined results: a null text has no words, a null language is ``und``. Equal rows count each. Texts
without two words in a piece add to n alone. Languages without a candidate have no rows. Other
columns of the input don't matter and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import stage
from conceptnorm.llm.words import Words, mix, slices
from conceptnorm.operators.skew import top_k_per_group

LEAST, LONGEST, PERCENT, TOP = 100, 5, 100, 2_000
#: Parts that the corpus is scanned in.
SHARDS = 3
#: Bits of a bitmap: 16 for each phrase, within these bounds.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
#: Phrases that each task holds at most (12 bytes each); more are joined by a shuffle.
BROADCAST_PHRASES = 1_000_000
#: Counts that a task holds before it passes them on.
HELD = 1 << 21

_ALL = np.arange(256)
_CUT = np.isin(_ALL, [*b".,;:!?\n\x0b\x0c\r"])
_WORD = ~(_CUT | np.isin(_ALL, [0x20, 0x09]))
_U = np.uint64
_LENGTH_BITS = 4


class _Bitmap:
    """Sets of 64-bit numbers by one bit for each of their hashes."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys >> _U(_LENGTH_BITS)) & _U(self.bits - 1)
        return (self.words[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) == 1


def _bits(n: int) -> int:
    bits = MIN_BITS
    while bits < min(MAX_BITS, 16 * n):
        bits *= 2
    return bits


class _Held:
    """Keys in ascending order, and the steps at which they reached the threshold."""

    def __init__(self, keys: np.ndarray, steps: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.steps = keys[order], steps[order]

    def bitmap(self, since: int = 0) -> _Bitmap:
        bits = _bits(len(self.keys))
        has = np.zeros(bits, bool)
        has[(self.keys[self.steps >= since] >> _U(_LENGTH_BITS)) & _U(bits - 1)] = True
        return _Bitmap(bits, np.packbits(has, bitorder="little").view("<u8"))

    def step(self, keys: np.ndarray) -> np.ndarray:
        """The step of each key, -1 for those that aren't here."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.steps[place], -1)


def _held(phrases: DataFrame, n: int) -> _Held | None:
    """The n rows (key, step), if they are few enough."""
    if n > BROADCAST_PHRASES:
        return None
    rows = phrases.select("key", "step").toArrow()
    return _Held(rows.column("key").to_numpy().view(_U), rows.column("step").to_numpy())


def _among(held: _Held, wanted: bool):
    """The rows whose key is held, or those whose isn't."""
    maybe = held.bitmap()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(_U)
            has = maybe.has(keys)
            at = np.flatnonzero(has)
            has[at] = held.step(keys[at]) >= 0
            yield batch.filter(pa.array(has == wanted))
    return run


def _bitmaps(phrases: DataFrame, n: int, *since: int) -> list[_Bitmap]:
    """A bitmap of those of the n keys that have come since each step. What comes to the driver is MAX_BITS each at most."""
    bits = _bits(n)
    slot = F.shiftrightunsigned("key", _LENGTH_BITS).bitwiseAND(F.lit(bits - 1).cast("bigint"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    rows = phrases.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        *(F.bit_or(F.when(F.col("step") >= x, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"b{i}") for i, x in enumerate(since)))
    found = rows.toArrow()
    out = []
    for i in range(len(since)):
        words = np.zeros(bits >> 6, _U)
        words[found.column("word").to_numpy()] = found.column(f"b{i}").to_numpy().view(_U)
        out.append(_Bitmap(bits, words))
    return out


class _Phrases:
    """Keys of the phrases of some rows (text, lang)."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = Words(batch.column("text"), _WORD)
        self.row = self.words.row_of_word()
        self.lang = batch.column("lang").to_pylist()
        salt = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(self.lang)}
        salts = np.array([salt[x] for x in self.lang], _U)
        self.hash = mix(self.words.hashes() ^ salts[self.row])
        cuts = np.cumsum(_CUT[self.words.data])[self.words.starts] if len(self.row) else self.row
        self.piece = np.cumsum(np.r_[True, (cuts[1:] != cuts[:-1]) | (self.row[1:] != self.row[:-1])][:len(self.row)])

    def keys(self, n: int, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), _U)
        for j in range(n):
            out = (out + self.hash[at + j]) * _U(0x9E3779B97F4A7C15)
        return (mix(out) & ~_U((1 << _LENGTH_BITS) - 1)) | _U(n)

    def within(self, longest: int, known: _Bitmap) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, at, keys, whether known), for n = 1 all words, then the phrases both of whose parts
        are known."""
        at = np.arange(len(self.row))
        for n in range(1, longest + 1):
            keys = self.keys(n, at)
            has = known.has(keys)
            yield n, at, keys, has
            good = np.flatnonzero(has)
            nearby = good[:-1][at[good[1:]] == at[good[:-1]] + 1]      # places in at
            nearby = nearby[self.piece[at[nearby]] == self.piece[np.minimum(at[nearby] + n, len(self.row) - 1)]]
            at = at[nearby]


def _counted(known: _Bitmap, recent: _Bitmap, held: _Held | None, since: int, words_too: bool, longest: int):
    """(key, head, tail, n): counts of active phrases, with the keys of their two parts. held: the
    phrases that have reached the threshold, so that none but the active ones come; without it, a few more."""
    def pack(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        key, head, tail, n = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return key[first], head[order][first], tail[order][first], np.add.reduceat(n[order], first)

    def active(rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        if held is None:
            return rows
        key, head, tail, _ = rows
        one, other = held.step(head), held.step(tail)
        own = (key & _U((1 << _LENGTH_BITS) - 1) == 1) | ((one >= 0) & (other >= 0) & (np.maximum(one, other) >= since))
        return tuple(x[own] for x in rows)

    def batch(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, head, tail, n = rows
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, head, tail)] + [pa.array(n)],
                                          names=["key", "head", "tail", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[tuple[np.ndarray, ...]] = []
        for whole in batches:
            for part in slices(whole, "text"):
                phrases = _Phrases(part)
                old_at = old_keys = None
                for n, at, keys, _ in phrases.within(longest, known):
                    if n == 1:
                        own = (keys, np.zeros_like(keys), np.zeros_like(keys)) if words_too else None
                    else:
                        place = np.searchsorted(old_at, at)
                        head, tail = old_keys[place], old_keys[place + 1]
                        new = recent.has(head) | recent.has(tail)
                        own = (keys[new], head[new], tail[new])
                    if own is not None and len(own[0]):
                        counts.append(pack([(*own, np.ones(len(own[0]), np.int64))]))
                    old_at, old_keys = at, keys
                if sum(len(x[0]) for x in counts) > HELD:
                    counts = [active(pack(counts))]
                    if len(counts[0][0]) > HELD // 2:
                        yield batch(counts.pop())
        if counts:
            yield batch(active(pack(counts)))
    return run


def _written(known: _Bitmap, longest: int):
    """(lang, phrase, n): counts of the known phrases by their words, and all words under null. A
    task spells each phrase once."""
    def batch(held: dict[str, int], keys: np.ndarray, counts: np.ndarray, spelt: list[tuple[str, str]], place: np.ndarray) -> pa.RecordBatch:
        own = [spelt[i] for i in place.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([*held, *(x for x, _ in own)], pa.string()), pa.array([*[None] * len(held), *(x for _, x in own)], pa.string()),
             pa.array([*held.values(), *counts.tolist()], pa.int64())], names=["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        none = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        (keys, counts, place), spelt = none, []
        for whole in batches:
            for part in slices(whole, "text"):
                phrases = _Phrases(part)
                for x, n in zip(phrases.lang, phrases.words.counts.tolist(), strict=True):
                    total[x] = total.get(x, 0) + n
                for n, at, found, has in phrases.within(longest, known):
                    found, at = found[has], at[has]
                    own, first, count = np.unique(found, return_index=True, return_counts=True)
                    old = np.searchsorted(keys, own)
                    there = np.zeros(len(own), bool)
                    there[old < len(keys)] = keys[old[old < len(keys)]] == own[old < len(keys)]
                    counts[old[there]] += count[there]
                    new = ~there
                    if not new.any():
                        continue
                    begin = len(spelt)
                    spelt += [(phrases.lang[phrases.row[i]], phrases.words.text(i, n).decode()) for i in at[first[new]].tolist()]
                    keys = np.concatenate([keys, own[new]])
                    counts = np.concatenate([counts, count[new]])
                    place = np.concatenate([place, np.arange(begin, len(spelt))])
                    order = np.argsort(keys)
                    keys, counts, place = keys[order], counts[order], place[order]
                if len(keys) > HELD:
                    yield batch(total, keys, counts, spelt, place)
                    total, ((keys, counts, place), spelt) = {}, (none, [])
        yield batch(total, keys, counts, spelt, place)
    return run


def _length(key):
    return F.col(key).bitwiseAND(F.lit((1 << _LENGTH_BITS) - 1).cast("bigint"))


def frequent(corpus: DataFrame, least: int, longest: int, shards: int) -> tuple[DataFrame, int]:
    """(key, step) of all phrases that occur ``least`` times, and the step at which that was clear;
    and their number. corpus: rows (text, lang, shard)."""
    reached, n_reached, n_open = corpus.sparkSession.createDataFrame([], "key bigint, step int"), 0, 0
    counts: list[DataFrame] = []
    step = 0
    while step < shards or n_open:
        held, since = _held(reached, n_reached), step - shards
        known, recent = (held.bitmap(), held.bitmap(since)) if held else _bitmaps(reached, n_reached, 0, since)
        active = corpus.filter(F.col("shard") == step % shards).select("text", "lang").mapInArrow(
            _counted(known, recent, held, since, step < shards, longest), "key bigint, head bigint, tail bigint, n bigint")
        if held is None:
            active = active.join(reached.select(F.col("key").alias("head"), F.col("step").alias("head_step")), "head", "left") \
                .join(reached.select(F.col("key").alias("tail"), F.col("step").alias("tail_step")), "tail", "left") \
                .filter((_length("key") == 1) | (F.col("head_step").isNotNull() & F.col("tail_step").isNotNull()
                                                 & (F.greatest("head_step", "tail_step") >= since)))
        counts = [*counts, stage(active.groupBy("key").agg(F.sum("n").alias("n")), "counts")][-shards:]
        # whoever comes to the threshold now has its share of it in one of the cycle's steps
        cycle = reduce(DataFrame.unionByName, counts)
        likely = cycle.filter(F.col("n") * shards >= least).select("key").distinct()
        likely = stage(likely.mapInArrow(_among(held, False), "key bigint") if held else likely.join(reached.select("key"), "key", "left_anti"), "likely")
        few = _held(likely.withColumn("step", F.lit(0)), likely.count())
        new = cycle.mapInArrow(_among(few, True), "key bigint, n bigint") if few else cycle.join(likely, "key", "left_semi")
        new = new.groupBy("key").agg(F.sum("n").alias("n")) \
            .filter(F.col("n") >= least).select("key", F.lit(step).alias("step"))
        reached = stage(reached.unionByName(new), "reached")
        step += 1
        n_reached, n_open = reached.agg(F.count("*"), F.count_if((F.col("step") >= step - shards) & (_length("key") < longest))).first()
    return reached, n_reached


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST,
                 percent: int = PERCENT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words (15 at
    most) of each language by score, a descending and phrase. Phrases that lie in a longer one with
    ``percent`` of their occurrences are left out."""
    corpus = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                         F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                         F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    corpus = stage(corpus, "shards", by="shard", compression="zstd")
    known, = _bitmaps(*frequent(corpus, least, longest, shards), 0)
    found = corpus.select("text", "lang").mapInArrow(_written(known, longest), "lang string, phrase string, n bigint")
    found = stage(found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("phrase").isNull() | (F.col("n") >= least)), "phrases")

    totals = found.filter("phrase IS NULL").select("lang", F.col("n").alias("total"))
    known = found.filter("phrase IS NOT NULL").select("lang", "phrase", F.col("n").alias("f"), F.split("phrase", " ").alias("words"))
    several = known.filter(F.size("words") > 1)
    # a longer phrase that is as frequent has parts one word shorter that are at least as frequent
    inner = several.filter(F.size("words") > 2).select("lang", "f", F.explode(F.array(
        F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("part"))
    longer = inner.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    own = several.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f")))

    cuts = own.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"),
                       F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("right"))
    part = known.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]) \
        .join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "total", "l", "r")}
    cuts = cuts.withColumn("score", F.call_function("div", 1000 * wide["a"] * wide["total"], wide["l"] * wide["r"]))
    best = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    return top_k_per_group(best, ["lang"], order, top, salt_on="phrase").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
