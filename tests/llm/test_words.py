import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from conceptnorm.llm import words as W

TEXT = st.text(alphabet="aZ09 \t\n.é日\U0001F600_-", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_the_patterns(rows):
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in rows]
    for kind, pattern in ((W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = W.Words(pa.array(rows, pa.string()), kind)
        want = [re.findall(pattern, t) for t in low]
        assert found.counts.tolist() == [len(w) for w in want]
        flat = [w for row in want for w in row]
        assert [found.text(i, 1).decode() for i in range(len(found.starts))] == flat
        hashes = found.hashes()
        assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_hashes_don_t_depend_on_place_and_take_words_longer_than_a_block():
    long = "x" * (W._BLOCK + 5)
    found = W.Words(pa.array([f"b {long} a b", f"a {long}"], pa.string()))
    h = found.hashes()
    assert h[0] == h[3] and h[2] == h[4] and h[1] == h[5] and len(set(h.tolist())) == 3
    many = W.Words(pa.array(["ab " * 100_000], pa.string())).hashes()
    assert len(set(many.tolist())) == 1


def test_sliding_and_slices():
    x = np.array([5, 3, 9, 1, 7, 7, 2])
    for n in range(1, 9):
        assert W.sliding(x, n, np.minimum).tolist() == [min(x[i:i + n]) for i in range(len(x) - n + 1)]
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4], "text": ["aa", None, "b" * 50, "c"]})
    assert [s.column("id").to_pylist() for s in W.slices(batch, "text", 10)] == [[1, 2], [3], [4]]
    assert [s.num_rows for s in W.slices(batch.slice(1, 2), "text", 1000)] == [2]
