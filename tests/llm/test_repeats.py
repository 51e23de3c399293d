"""Repeated passages and suffix arrays against brute force."""

import random
from collections import Counter

import pytest

from conceptnorm.llm.repeats import without_repeats
from conceptnorm.llm.suffix_array import repeated_windows, suffix_array


def test_suffix_array_by_sorting():
    rng = random.Random(1)
    for _ in range(500):
        symbols = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert suffix_array([]) == []


def test_windows_of_pieces_against_all_of_them():
    rng = random.Random(2)
    length = 40
    for _ in range(200):
        core, base = (bytes(rng.choice(b"ab\0") for _ in range(n)) for n in (16, 60))
        pieces, marks = [], []
        for _ in range(rng.randint(1, 10)):
            left, right = bytearray(base), bytearray(base[::-1])
            left[rng.randrange(60)] = right[rng.randrange(60)] = rng.choice(b"ab\0")
            mark = rng.randint(0, length - 16)
            piece = bytes(left[60 - mark:]) + core + bytes(right[:length - 16 - mark + rng.randint(0, mark)])
            if (piece, mark) not in zip(pieces, marks, strict=True):
                pieces.append(piece)
                marks.append(mark)
        seen = Counter((p[i:i + length], m - i) for p, m in zip(pieces, marks, strict=True) for i in range(len(p) - length + 1))
        expected = [[i for i in range(len(p) - length + 1) if seen[p[i:i + length], m - i] > 1] for p, m in zip(pieces, marks, strict=True)]
        assert [x.tolist() for x in repeated_windows(pieces, marks, length)] == expected


def brute(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = [i for i in range(len(b)) if gone[i] and not (i and gone[i - 1])]
        out.append((d, len(b), len(spans), bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(200)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [text(rng.randint(8, 40)) for _ in range(6)]
    rows = [(i, " ".join(x for _ in range(rng.randint(0, 5)) for x in (text(rng.randint(0, 12)), rng.choice(passages))))
            for i in range(60)]
    # nothing, an empty text, periodic ones, a copy, a repeated row, rows without an id
    return [*rows, (200, None), (201, ""), (202, "a" * 500), (203, "ab" * 300), (204, rows[3][1]), rows[3], (None, rows[5][1]), (None, "zz")]


# a bin of one piece at most divides every group down to single windows
@pytest.mark.parametrize(("length", "gram", "most"), [(64, 32, 1_000), (64, 32, 2), (40, 20, 1)])
def test_removed_bytes_against_brute_force(spark, length, gram, most):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, content int, spans string")
    found = without_repeats(docs, length=length, gram=gram, max_pieces=most).collect()
    assert sorted([(r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in found], key=str) == brute(rows, length)


def test_long_text_over_several_blocks(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    noise = "".join(chr(97 + x % 26) for x in rng.randbytes(5_000_000))
    at = (1 << 21) - 350                          # across the end of a block
    text = noise[:at] + passage + noise[at:] + passage
    found = {r.doc_id: r for r in without_repeats(spark.createDataFrame([(1, text), (2, "x" * 399)], "doc_id int, text string")).collect()}
    spans = [(x.start, x.end) for x in found[1].removed]
    assert (at, at + 700) in spans and (len(text) - 700, len(text)) in spans
    assert bytes(found[1].kept).decode() == noise
    assert found[2].removed == [] and found[2].n_bytes == 399


def test_no_rows(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_memory_of_a_task_is_small():
    """What looking for anchors takes at once: numpy's arrays, of two megabytes of text."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from conceptnorm.llm import repeats
    rng = np.random.default_rng(3)
    rows = [rng.integers(97, 123, 2_000, np.uint8).tobytes().decode() for _ in range(1_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000)), pa.array(rows), pa.array(range(1_000))], names=["doc_id", "text", "text_hash"])
    tracemalloc.start()
    for _ in repeats._anchored(400, 200)([batch]):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 48 << 20
