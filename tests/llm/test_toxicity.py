import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptnorm.llm import toxicity as T

TABLES = "/root/testdata/sf0.1"
BAD = ["grobbler", "zwelfmuck", "vexturd"]


def corpus(n=400):
    rng = random.Random(16)
    bits = ["th", "en", "ing", "er", "at", "on", "es", "ou"]
    word = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [word() for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(2, 7) * toxic):
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words).capitalize(), 0.5))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = corpus()
    d = spark.createDataFrame(rows, "doc_id long, text string, score double")
    y = spark.createDataFrame(labels + [(3, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = T.learn(d, y.filter("doc_id % 3 <> 0"))
    got = {r["doc_id"]: r for r in T.scores(d, model).collect()}
    held = [(i, t) for i, t in labels if i % 3 == 0]
    right = sum((got[i]["score"] >= 0.5) == bool(t) for i, t in held)
    assert right >= 0.95 * len(held)
    again = T.learn(d.repartition(4), y.filter("doc_id % 3 <> 0"))
    assert again == model


def test_edge_cases(spark):
    rows, labels = corpus(120)
    rows += [(900, None, 0.1), (901, "", 0.1), (902, " \n", 0.1), (None, rows[0][1], 0.1), (903, "grobbler " * 30000, 0.1), (0, rows[0][1], 0.1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score double")
    y = spark.createDataFrame(labels + [(1, 1), (1, 0)], "doc_id long, toxic int")
    model = T.learn(d, y)
    got = T.scores(d, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (900, 901, 902)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert [r["score"] > 0.5 for r in got if r["doc_id"] == 903] == [True]
    assert T.learn(d, y.filter("toxic = 0")) is None and T.learn(d, y.limit(0)) is None
    assert {r["score"] for r in T.scores(d, None).collect()} == {0.0}
    assert T.scores(d.limit(0), model).collect() == []


def test_margins_are_differences_of_compressed_lengths():
    import pyarrow as pa
    model = T.Model(b" and the other one " * 3, b" and the other one " * 3 + b" grobbler ", b"and the other one ", b" and the other")
    text = "and the other one grobbler grobbler x y z"
    counts = next(T.margins(model, pa.array([text])))
    a, b = T._compressor(model.ordinary), T._compressor(model.toxic)
    want = np.zeros((len(T.WINDOWS), T.MARGINS + 1), int)
    words = text.split()
    for row, (size, step) in zip(want, T.WINDOWS, strict=True):
        i = 0
        while True:
            part = model.lead + " ".join(words[i:i + size]).encode() + model.tail
            row[max(0, min(T.MARGINS, len(a.compress(part)) - len(b.compress(part))))] += 1
            if i + size >= len(words):
                break
            i += step
    assert counts.tolist() == want.tolist()


def test_phrases_of_ordinary_words():
    # every word is as frequent in either class; toxic documents hold phrases of them, the others the same backwards
    import pyarrow as pa
    rng = random.Random(17)
    words = [a + b + c for a in "ka lo mi ru te vi zo pe".split() for b in "den fas gor lim rup sok wab hel".split() for c in "t ny ra ek".split()]
    phrases = ["kadent migorny lofast", "rufasny kagort", "lodenny rugort mifast"]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(40, 80))]
        for _ in range(4):
            at = rng.randrange(len(text))
            text[at:at] = rng.choice(phrases).split()[::1 if i % 3 == 0 else -1]
        rows.append((" ".join(text), int(i % 3 == 0)))
    model = T.dictionaries(rows[:400])
    counts, y = np.array(list(T.margins(model, pa.array([t for t, _ in rows])))), np.array([float(k) for _, k in rows])
    model = T.calibrate(model, counts[400:500], y[400:500])
    held = np.array([model.score(x) for x in counts[500:]])
    toxic, ordinary = held[y[500:] == 1], held[y[500:] == 0]
    assert (toxic[:, None] > ordinary).mean() >= 0.9


def test_several_texts_of_an_id_teach_the_first(spark):
    rows, labels = corpus(120)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    twins = [(i, "\uffff " + t, x) for i, t, x in rows]
    models = [T.learn(spark.createDataFrame(r, "doc_id long, text string, score double").repartition(n), y)
              for r, n in ((rows, 1), (rows + twins, 3), (twins + rows, 2))]
    assert models[0] == models[1] == models[2]


@pytest.mark.skipif(not os.path.exists(f"{TABLES}/labels.parquet"), reason="no tables")
def test_held_out_labels_of_the_tables(spark):
    # a floor below what the README measures: most toxic documents found, few others marked
    from conceptnorm.llm.queries import op9_toxicity
    y = spark.read.parquet(f"{TABLES}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("y")).dropna()
    got = op9_toxicity(spark, TABLES).filter("held_out").join(y, "doc_id").groupBy("y").agg(
        F.avg("predicted").alias("marked"), F.count("*").alias("n"))
    marked = {r["y"]: r["marked"] for r in got.collect()}
    assert marked[1] >= 0.75 and marked[0] <= 0.02


def test_each_word_is_compressed_once_and_dictionaries_take_turns_seldom(monkeypatch):
    import pyarrow as pa
    made, calls = [], []

    def compressor(content, real=T._compressor):
        name, inner = len(made), real(content)
        made.append(name)

        class Counting:
            def compress(self, part):
                calls.append((name, part))
                return inner.compress(part)
        return Counting()

    monkeypatch.setattr(T, "_compressor", compressor)
    model = T.Model(b" and the other one " * 3, b" and the other one " * 3 + b" grobbler ", b"and the other one ", b" and the other")
    of = T.margin_of(model)
    text = pa.array(["and the other one grobbler grobbler x y z " * 20, None, "", "x y new"])
    first = [x.tolist() for x in T.margins(model, text, of)]
    ofwords = [part for name, part in calls if name == made[-1]]
    assert len(ofwords) == len(set(ofwords)) == 9
    turns = sum(a != b for (a, _), (b, _) in zip(calls, calls[1:], strict=False))
    assert turns <= 4
    # words that no longer fit are looked up again, with the same result
    monkeypatch.setattr(T, "KEPT", 2)
    assert [x.tolist() for x in T.margins(model, text, of)] == [x.tolist() for x in T.margins(model, text)] == first
