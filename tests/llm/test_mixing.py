import random
import re

import pytest

from conceptnorm.llm import mixing as M


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > limit * sizes[s] + 1e-9]
        if not over:
            return stopped | goal
        stopped |= {s: limit * sizes[s] for s in over}


def corpus(n=1500):
    rng = random.Random(11)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "a", "é", "Z", None]), "w " * rng.choice([1, 2, 3, 10, 50, 400]), 1) for i in range(n)]
    rows += [(7, "hot", "x y", 1)] * 9 + [(None, "b", "x", 1), (5000, "void", None, 1), (5001, "void", " \n", 1), (5002, "one", "big " * 3000, 1)]
    return rows


@pytest.mark.parametrize("block", [20_000, 40])
def test_targets_and_sums(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rows = corpus()
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    got = M.mix(d).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = brute_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"] * 9)
    assert all(abs(taken[s] - want[s]) <= largest[s] + 1e-6 for s in sizes)
    again = M.mix(d.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_copies_are_expected_copies_on_the_mean(spark):
    d = spark.createDataFrame([(i, "s" if i % 3 else "t", "w " * (1 + i % 17)) for i in range(900)], "doc_id long, source string, text string")
    mean = {}
    for seed in range(12):
        for r in M.mix(d, seed=seed).collect():
            mean.setdefault(r["source"], {}).setdefault(r["size"], []).append(r["copies"] - r["target"] / r["source_size"])
    for by_size in mean.values():
        assert all(abs(sum(x) / len(x)) < 0.12 for x in by_size.values())


def test_the_mix_itself_and_empty_tables(spark):
    rows = corpus(200)
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    copies = {}
    for r in M.mix(d).collect():
        copies[r["doc_id"], r["source"], r["size"]] = r["copies"]
    got = {}
    out = M.mixed(d)
    assert out.columns == d.columns
    for r in out.collect():
        k = (r["doc_id"], r["source"], r["text"])
        got[k] = got.get(k, 0) + 1
    want = {}
    for i, s, t, _ in rows:
        if n := copies[i, s, size(t)]:
            want[i, s, t] = want.get((i, s, t), 0) + n
    assert got == want
    assert M.mix(d.limit(0)).collect() == [] and M.mixed(d.limit(0)).collect() == []
    zero = spark.createDataFrame([(1, "a", None), (2, "b", "")], "doc_id long, source string, text string")
    assert [(r["target"], r["taken"]) for r in M.mix(zero).collect()] == [(0.0, 0)] * 2
