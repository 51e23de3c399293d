"""Periodic runs against a search over all periods."""

import random
import re

import numpy as np

from conceptnorm.llm.runs import enhanced_suffix_array, periodic_runs, runs


def brute(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)   # the least period comes first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequence(rng):
    words = [rng.randint(1, rng.choice([1, 2, 3, 6, 30])) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.5:
        a = rng.randrange(len(words))
        p = 1 + (len(words) - a) // rng.randint(3, 10)
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
    return words


def test_enhanced_suffix_array():
    rng = random.Random(1)
    for _ in range(200):
        texts = [[rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        words = np.array(sum(texts, []), np.uint64)
        part = np.repeat(np.arange(3), [len(t) for t in texts])
        end = np.searchsorted(part, part, side="right")
        sa, isa, lcp = enhanced_suffix_array(words, part)
        tails = [(part[i], words[i:end[i]].tolist()) for i in range(len(words))]
        assert sa.tolist() == sorted(range(len(words)), key=lambda i: tails[i])
        assert isa[sa].tolist() == list(range(len(words)))
        for k in range(1, len(sa)):
            (p, a), (q, b) = tails[sa[k - 1]], tails[sa[k]]
            shared = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
            assert lcp[k] == (shared if p == q else 0)


def test_runs_of_many_texts_at_once():
    rng = random.Random(2)
    for _ in range(600):
        texts = [sequence(rng) for _ in range(rng.randint(1, 6))]
        words = np.array(sum(texts, []), np.uint64)
        first = np.cumsum([0, *(len(t) for t in texts)])
        part = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        for least in (4, 12):
            expected = [(s + first[k], n, q) for k, t in enumerate(texts) for s, n, q in brute(t, least)]
            assert list(zip(*(x.tolist() for x in runs(words, part, least)), strict=True)) == expected


def test_collapsed_texts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}é" for x in sequence(rng))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (None, "a b " * 10), rows[0], (103, "x " * 30_000), (104, "word " * 11)]
    docs = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, runs string")
    found = sorted(((r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed)
                    for r in periodic_runs(docs).collect()), key=str)
    expected = []
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        own = brute(words, 12) if d != 103 else [(0, 30_000, 1)]
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        expected.append((d, len(words), own, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert found == sorted(expected, key=str)


def test_looped_words(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words), 10, 7), (2, " ".join(words), None, None)], "doc_id int, text string, a int, p int")
    one, two = sorted(periodic_runs(docs, loop=("a", "p")).collect())
    assert [(x.start, x.length, x.period) for x in one.runs] == [(10, 30, 7)]
    assert one.collapsed == " ".join(words[:17]) and two.collapsed == " ".join(words) and two.runs == []


def test_no_rows(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id string, text string")).collect() == []
