"""Collocations against counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from conceptnorm.llm import collocations as c


def brute(rows, least, longest, percent, top):
    count, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        own = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = {x[i:i + k]: 0 for x in own for k in range(2, len(x)) for i in range(len(x) - k + 1)}
        for x, a in own.items():
            for k in range(2, len(x)):
                for i in range(len(x) - k + 1):
                    inside[x[i:i + k]] = max(inside[x[i:i + k]], a)
        scored = []
        for p, a in own.items():
            if 100 * inside.get(p, -1) >= percent * a:
                continue
            score, k = min(((1000 * a * n[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(n):
    rng = random.Random(n)
    words = ["The", "cat", "sat", "new", "york", "city", "hall", "é", "ab", "zz", "q1"]
    phrases = ["new york city hall", "new york", "cat sat", "é ab", "the"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([*words, *phrases, rng.choice(phrases).upper()]) + rng.choice([" ", " ", "\t", ", ", ".", "\n", " "])
                       for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return [*rows, (None, "en"), ("", None), ("cat sat " * 300, "en"), rows[0], rows[0]]


@pytest.mark.parametrize(("least", "longest", "percent", "top", "shards"), [(20, 5, 100, 2_000, 3), (10, 4, 60, 7, 1)])
def test_against_all_phrases(spark, least, longest, percent, top, shards):
    rows = corpus(200)
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "text string, lang string, n int, phrase string").repartition(3)
    found = c.collocations(docs, least=least, longest=longest, percent=percent, top=top, shards=shards)
    got = sorted(tuple(r) for r in found.collect())
    expected = brute(rows, least, longest, percent, top)
    assert expected and got == expected


def test_small_bitmaps_and_shuffled_phrases(spark, monkeypatch):
    """Bitmaps that let nearly everything through, and no broadcast: the same rows."""
    monkeypatch.setattr(c, "MIN_BITS", 64)
    monkeypatch.setattr(c, "MAX_BITS", 64)
    monkeypatch.setattr(c, "BROADCAST_PHRASES", -1)
    rows = corpus(80)
    found = c.collocations(spark.createDataFrame(rows, "text string, lang string"), least=10, shards=2)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10, 5, 100, 2_000)


def test_scores_beyond_64_bits(spark):
    """a * n * 1000 and l * r as decimals: the query's arithmetic, on counts of a large corpus."""
    a, n, left, right = 3 * 10**12 + 7, 16 * 10**15 + 3, 5 * 10**14 + 1, 4 * 10**12 + 9
    row = spark.range(1).selectExpr(
        f"(1000 * cast({a} AS decimal(38,0)) * cast({n} AS decimal(38,0))) div (cast({left} AS decimal(38,0)) * cast({right} AS decimal(38,0))) AS s").first()
    assert row.s == 1000 * a * n // (left * right)


def test_no_rows(spark):
    assert c.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert c.collocations(spark.createDataFrame([(None, None), ("one", "en")], "text string, lang string"), least=1).collect() == []


def test_few_phrases_are_looked_up_in_tasks(spark, monkeypatch):
    """No broadcast of Spark's, whose tables the driver would hold, and the rows of the shuffled join."""
    plans = []

    def stage(df, name, real=c.stage, **how):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, **how)

    monkeypatch.setattr(c, "stage", stage)
    docs = spark.createDataFrame(corpus(80), "text string, lang string")
    docs = docs.select(docs.text, docs.lang)
    reached, n = c.frequent(docs.selectExpr("coalesce(text, '') AS text", "coalesce(lang, 'und') AS lang", "0 AS shard"), 10, 4, 1)
    held = sorted(tuple(r) for r in reached.collect())
    assert n == len(held) > 0 and not any("Broadcast" in p for p in plans)
    monkeypatch.setattr(c, "BROADCAST_PHRASES", -1)
    reached, n = c.frequent(docs.selectExpr("coalesce(text, '') AS text", "coalesce(lang, 'und') AS lang", "0 AS shard"), 10, 4, 1)
    assert sorted(tuple(r) for r in reached.collect()) == held
