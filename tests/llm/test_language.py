import random

import numpy as np

from conceptnorm.llm import language as L

LETTERS = {"aa": "etaoin", "bb": "zxqwkj", "cc": "éñçßü", "dd": "日本語文字"}


def corpus(n=200):
    rng = random.Random(14)
    word = lambda k: "".join(rng.choice(LETTERS[k]) for _ in range(rng.randrange(1, 7)))
    return [(i, " ".join(word(k) for _ in range(rng.randrange(5, 60))).capitalize(), k, 1) for i in range(n) for k in [rng.choice(list(LETTERS))]]


def test_held_out_accuracy_and_ids(spark):
    rows = corpus()
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    known = L.prototypes(d.filter("doc_id % 2 = 0"))
    assert [k for k, _ in known] == sorted(LETTERS)
    again = L.prototypes(d.filter("doc_id % 2 = 0").repartition(5))
    assert all(np.array_equal(a, b) for (_, a), (_, b) in zip(known, again, strict=True))
    got = {r["doc_id"]: r for r in L.predict(d, known).collect()}
    held = [(i, k) for i, _, k, _ in rows if i % 2]
    assert sum(got[i]["lang_pred"] == k for i, k in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_bundle_is_the_sum_of_bound_vectors():
    space = L.Space(dim=64, slots=64)
    text = "Abc  d1é"
    seq = [0] + [space._slot(ord(c)) for c in "abc"] + [0, space._slot(ord("d")), 0, space._slot(ord("é")), 0]
    want = sum(space.shifted[0][a].astype(int) * space.shifted[1][b] * space.shifted[2][c] for a, b, c in zip(seq, seq[1:], seq[2:]))
    assert np.array_equal(space.bundle(*space.counts(text)), want)
    assert np.array_equal(space.shifted[0][5], np.roll(space.shifted[2][5], 2))


def test_pieces_of_long_texts_add_up(monkeypatch):
    rng = random.Random(15)
    text = "".join(rng.choice("abc é\n1\U0001F600\U00020000") for _ in range(2000))
    space = L.Space(dim=32)
    whole = dict(zip(*map(np.ndarray.tolist, space.counts(text)), strict=True))
    for piece in (1, 2, 7, 999):
        monkeypatch.setattr(L, "_PIECE", piece)
        assert dict(zip(*map(np.ndarray.tolist, space.counts(text)), strict=True)) == whole


def test_edge_cases(spark):
    rows = corpus(40) + [(900, None, "aa", 1), (901, "", "aa", 1), (902, "12 - 3!", None, 1), (None, "eta oin", None, 1), (900, None, "aa", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    known = L.prototypes(d)
    got = L.predict(d, known).collect()
    assert len(got) == len(rows)
    assert {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (900, 901, 902)} == {("und", 0.0)}
    assert [r["lang_pred"] for r in got if r["doc_id"] is None] == ["aa"]
    kept = L.identified(d, known)
    assert kept.columns == d.columns and kept.count() == 41
    assert L.prototypes(d.limit(0)) == [] and {r["lang_pred"] for r in L.predict(d, []).collect()} == {"und"}
    assert L.predict(d.limit(0), known).collect() == []
