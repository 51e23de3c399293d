import random
import re

import pytest

from conceptnorm.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(name or "")
    out = {}
    for key, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    met |= windows[tuple(w[i:i + n])]
        out[key] = (len(w), len(hit), sorted(met))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(5)
    vocabulary = ["The", "of", "é1", "x", "Zed", "7", "日本"]
    some = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [(str(i), some(rng.choice([0, 1, 3, 8, 12, 13, 14, 30]))) for i in range(12)]
    items += [("0", items[0][1]), ("n", None), (None, some(20)), ("same", items[5][1])]
    docs = [(i, some(rng.choice([0, 5, 40, 200]))) for i in range(40)]
    docs += [(100 + i, f"{some(9)} {text.upper()} {some(9)}") for i, (_, text) in enumerate(items) if text]
    docs += [(900, None), (901, ""), (902, "... \n"), (903, "the " * 3000)]
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs] + [(docs[0][0], docs[0][1], "x", 1)], "doc_id long, text string, item_id string, n_words int")
    b = spark.createDataFrame(items, "item_id string, text string")
    rows = D.contamination(d, b, block_bytes=block_bytes).collect()
    want = brute(docs, items)
    assert len(rows) == len(docs) + 1
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == want[r["doc_id"]], r["doc_id"]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
    keep = {k for k, (n, hit, _) in want.items() if not (hit and 20 * hit >= n)}
    clean = D.clean(d, b, block_bytes=block_bytes)
    assert clean.columns == d.columns and {r["doc_id"] for r in clean.collect()} == keep


def test_every_shared_span_has_a_fingerprint_in_common():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 4, 60, dtype=np.uint64), rng.integers(0, 4, 60, dtype=np.uint64)
        b[20:33] = a[5:18]
        prints = [set(D.fingerprints(x, np.zeros(len(x), int), 13, 5)[1].tolist()) for x in (a, b)]
        shared = {int(h) for h in D.grams(a[5:18], 5)}
        assert prints[0] & prints[1] & shared


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([("1", "a b c")], "item_id string, text string")
    assert D.contamination(d.limit(0), b).collect() == []
    assert D.contamination(d, b.limit(0)).first()["n_hit"] == 0
    assert D.clean(d, b.limit(0)).collect() == d.collect()
