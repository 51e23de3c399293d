"""Removal of repeated passages by suffix arrays.

A byte of a text goes if it is covered by a string of ``length`` bytes that also starts anywhere
else, in the same text or another one.

Equal strings have to meet before they can be sorted. Each window of ``length`` bytes is given to
an anchor: the place in it where the hash of the next ``gram`` bytes is least (the first such
place). That depends on the window's bytes alone, so equal windows have equal anchors at the same
place. The piece of an anchor is what its windows cover, a few hundred bytes. Pieces whose anchor's
gram is nowhere else go no further. Equal pieces are one class with a count; all windows of a class
of two or more are repeated. The classes of one gram that differ are sorted together: a suffix
array (``suffix_array``) over all of a bin's pieces, in which windows that share ``length`` bytes
are neighbours.

A gram that very many different pieces hold is not sorted at once. Its pieces are cut in two by
the distance of window and anchor, again and again; each part is binned by the bytes that all
windows of its distances share, and equal parts become one. A part of one distance is a single
window, so a bin always comes under the bound, and nothing is dropped.

Defined results: a null text is empty; an empty text, and one shorter than ``length``, keeps all
its bytes. Each row is a text of its own, so of two equal rows both lose what they share. Rows
without an id are handled like others. Other columns of the input don't matter and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import stage, texts
from conceptnorm.llm.suffix_array import repeated_windows
from conceptnorm.llm.words import _buffers, mix, slices, sliding

LENGTH, GRAM = 400, 200
#: Different pieces that are sorted as one bin at most; beyond, the bin is divided.
MAX_PIECES = 1_000
#: Bytes of pieces that one suffix array is made of, about.
BATCH_BYTES = 512 << 10

_U = np.uint64
#: Bytes of text that a task looks at at once, as a power of two: its arrays hold many times as many, and its worker keeps them.
_BLOCK_BITS = 18
_LANE = 8
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of any stretch (of 8 bytes or more) of a block of bytes."""

    _pow = _inv = np.zeros(0, _U)

    def __init__(self, data: np.ndarray):
        n = max(0, len(data) - _LANE + 1)
        lanes = np.empty(n, _U)
        for r in range(min(_LANE, n)):
            m = (len(data) - r) // _LANE
            lanes[r::_LANE] = np.frombuffer(data[r:r + m * _LANE].tobytes(), "<u8")
        if len(_Hashes._pow) < n + 1:
            _Hashes._pow, _Hashes._inv = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)
        self.total = np.zeros(n + 1, _U)
        np.cumsum(mix(lanes) * self._pow[:n], out=self.total[1:])

    def of(self, start, size):
        """size: 8 at least; both may be arrays."""
        return mix((self.total[start + size - _LANE + 1] - self.total[start]) * self._inv[start])


def _pieces(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(row, lo, at, size, gram hash, digest) of the pieces of the rows between ``bounds``: lo is
    where the piece begins in its row, at its anchor's place in the piece."""
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    block = 1 << _BLOCK_BITS
    for begin in range(0, len(data) - length + 1, block):
        part = data[begin:begin + block + length - 1]
        hashes = _Hashes(part)
        h = hashes.of(np.arange(len(part) - gram + 1), gram)
        low = _U((1 << _BLOCK_BITS + 1) - 1)      # a part has fewer bytes
        least = sliding((h & ~low) | np.arange(len(h), dtype=_U), length - gram + 1, np.minimum)
        anchor = (least & low).astype(np.int64)
        n = len(part) - length + 1
        inside = row_of[begin:begin + n] == row_of[begin + length - 1:begin + length - 1 + n]
        start = np.flatnonzero(inside)
        if not len(start):
            continue
        anchor, row = anchor[start], row_of[begin + start]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1) | (row[1:] != row[:-1])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(start)] - 1
        lo, size, a = start[first], start[last] - start[first] + length, anchor[first]
        digest = mix(hashes.of(lo, size) + (a - lo).astype(_U))
        yield row[first], begin + lo - bounds[row[first]], a - lo, size, h[a], digest


def _lists(values: np.ndarray, row: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(values, kind))


_COLUMNS = (("lo", np.int64, pa.int64()), ("at", np.int32, pa.int32()), ("size", np.int32, pa.int32()),
            ("gram", np.int64, pa.int64()), ("digest", np.int64, pa.int64()))


def _anchored(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << _BLOCK_BITS):
                data, bounds = _buffers(batch.column("text"))
                found = list(_pieces(data, bounds, length, gram))
                row, *rest = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"),
                     *(_lists(x.view(kind) if x.dtype == _U else x.astype(kind), row, batch.num_rows, to)
                       for x, (_, kind, to) in zip(rest, _COLUMNS, strict=True))],
                    names=["doc_id", "text_hash", *(c for c, _, _ in _COLUMNS)])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces that are asked for (rows: text, wanted)."""
    for batch in (x for whole in batches for x in slices(whole, "text", 1 << _BLOCK_BITS)):
        bins, digests, ats, contents = [], [], [], []
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
            data = memoryview(text.as_buffer())
            for x in wanted:
                bins.append(x["gram"])
                digests.append(x["digest"])
                ats.append(x["at"])
                contents.append(bytes(data[x["lo"]:x["lo"] + x["size"]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bins, pa.int64()), pa.array(digests, pa.int64()), pa.array(ats, pa.int32()), pa.array(contents, pa.binary())],
            names=["bin", "digest", "at", "content"])


_PIECE = "bin bigint, digest bigint, at int, content binary"


def _halves(length: int, width: int):
    """Each piece in parts by the distance of window and anchor, ``width`` distances a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                content, at = r["content"], r["at"]
                nearest = at - (len(content) - length)
                hashes = _Hashes(np.frombuffer(content, np.uint8))
                for d in range(nearest // width * width, at + 1, width):
                    begin, end = at - min(at, d + width - 1), at - max(nearest, d) + length
                    place, size = np.array([at - d, begin]), np.array([length - width + 1, end - begin])
                    of_core, of_part = hashes.of(place, size)
                    salt = np.array([r["bin"], 0]).view(_U) ^ np.array([d, at - begin]).astype(_U)
                    core, digest = mix(np.array([of_core, of_part]) ^ mix(salt)).view(np.int64).tolist()
                    out.append((r["bin"], r["digest"], begin, core, digest, at - begin, content[begin:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                names=["of_bin", "of_digest", "shift", "bin", "digest", "at", "content"])
    return run


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (first, last) of sorted numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist(), strict=True))


def _sorted(length: int):
    """Repeated windows of pieces that come in the order of their bins."""
    def found(rows: list[tuple]) -> pa.RecordBatch:
        marks = repeated_windows([x[3] for x in rows], [x[2] for x in rows], length)
        out = [(x[0], x[1], a, b) for x, m in zip(rows, marks, strict=True) for a, b in _runs(m)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int64() if i < 2 else pa.int32()) for i in range(4)],
            names=["bin", "digest", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bin", "digest", "at", "content")), strict=True):
                if size >= BATCH_BYTES and row[0] != rows[-1][0]:
                    yield found(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield found(rows)
    return run


def _repeated(pieces: DataFrame, length: int, gram: int, max_pieces: int) -> DataFrame:
    """(bin, digest, first, last): runs of windows of ``pieces`` (distinct by bin and digest) that
    other pieces of their bin hold too."""
    width = 1 << (length - gram).bit_length()    # distances are 0 to length - gram
    levels, results = [], []
    while True:
        large = pieces.groupBy("bin").agg(F.count("*").alias("n")).filter(F.col("n") > max_pieces).select("bin")
        ready, more = pieces, None
        if width > 1 and large.head(1):
            large = stage(large, "large")
            ready, more = pieces.join(large, "bin", "left_anti"), pieces.join(large, "bin", "left_semi")
        results.append(stage(
            ready.repartition("bin").sortWithinPartitions("bin", "digest").mapInArrow(
                _sorted(length), "bin bigint, digest bigint, first int, last int"), "sorted"))
        if more is None:
            break
        width //= 2
        parts = stage(more.mapInArrow(
            _halves(length, width), f"of_bin bigint, of_digest bigint, shift int, {_PIECE}"), "parts")
        levels.append(parts.drop("content", "at"))
        classes = stage(parts.groupBy("bin", "digest").agg(
            F.count("*").alias("n"), F.first("at").alias("at"), F.first("content").alias("content")), "classes")
        # a part of several pieces is repeated as a whole
        results.append(classes.filter("n > 1").select(
            "bin", "digest", F.lit(0).alias("first"), (F.octet_length("content") - length).alias("last")))
        pieces = classes.drop("n")
    # what holds for a part holds for the pieces that have it
    out = results.pop()
    while levels:
        whole, parts = results.pop(), levels.pop()
        up = parts.join(out.unionByName(whole), ["bin", "digest"]).select(
            F.col("of_bin").alias("bin"), F.col("of_digest").alias("digest"),
            (F.col("first") + F.col("shift")).alias("first"), (F.col("last") + F.col("shift")).alias("last"))
        out = stage(results.pop().unionByName(up), "repeated")
    return out


def _without(length: int):
    """The texts without the spans (rows: text, spans with first and last window)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, "text", 1 << _BLOCK_BITS)):
            size, kept, removed = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                data = bytes(text.as_buffer()) if text.is_valid else b""
                gone: list[list[int]] = []
                for a, b in sorted((x["first"], x["last"] + length) for x in spans or ()):
                    if gone and a <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], b)
                    else:
                        gone.append([a, b])
                out, end = [], 0
                for a, b in gone:
                    out.append(data[end:a])
                    end = b
                size.append(len(data))
                kept.append(b"".join([*out, data[end:]]))
                removed.append([{"start": a, "end": b} for a, b in gone])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.binary()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "kept", "removed"])
    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM, max_pieces: int = MAX_PIECES) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (the bytes that stay, binary), removed (maximal
    spans of bytes that go, as start and end)."""
    docs = texts(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "text")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    of_id = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint"
    anchors = stage(docs.filter(F.octet_length("text") >= length).mapInArrow(
        _anchored(length, gram),
        f"{of_id}, lo array<bigint>, at array<int>, size array<int>, gram array<bigint>, digest array<bigint>"), "anchors")
    each = anchors.select("doc_id", "text_hash", F.explode(F.arrays_zip("lo", "at", "size", "gram", "digest")).alias("x")) \
        .select("doc_id", "text_hash", "x.*")

    classes = each.groupBy("gram", "digest").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("doc_id", "text_hash", "lo", "at", "size")))
    classes = stage(classes, "classes")
    grams = classes.groupBy("gram").agg(F.count("*").alias("classes"), F.sum("n").alias("pieces")).filter("pieces > 1")
    shared = stage(classes.join(grams.drop("pieces"), "gram"), "shared")

    # the bytes of pieces that share a gram with different ones
    wanted = shared.filter("classes > 1").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("gram", "digest", "lo", "at", "size")).alias("wanted"))
    holders = docs.filter(F.octet_length("text") >= length).dropDuplicates(["doc_id", "text_hash"])
    holders = holders.join(wanted.select(*(F.col(c).alias(f"of_{c}") for c in ("doc_id", "text_hash")), "wanted"),
                           F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("text_hash") == F.col("of_text_hash")))
    pieces = stage(holders.select("text", "wanted").mapInArrow(_cut, _PIECE), "pieces")
    partly = _repeated(pieces, length, gram, max_pieces).select(F.col("bin").alias("gram"), "digest", "first", "last")

    found = stage(shared.filter("n > 1").select("gram", "digest", F.lit(0).alias("first"), (F.col("size") - length).alias("last"))
                  .unionByName(partly).distinct(), "windows")
    spans = each.drop("at", "size").join(found, ["gram", "digest"]).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last"))).alias("spans"))
    spans = spans.select(*(F.col(c).alias(f"of_{c}") for c in ("doc_id", "text_hash")), "spans")
    return docs.join(spans, F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("text_hash") == F.col("of_text_hash")), "left") \
        .select("doc_id", "text", "spans").mapInArrow(
            _without(length), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, kept binary, "
                              "removed array<struct<start:bigint,end:bigint>>")
