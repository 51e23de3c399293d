import random
import re
from collections import Counter

from conceptnorm.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = {p for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def test_counts_against_brute_force(spark):
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice(["a", "b", "é", "日本", "#x", "<b>", "$"]) for _ in range(n))
    texts = [some(n).replace(" ", rng.choice([" ", "  ", "\n", "\t"]), 5) for n in (1, 7, 8, 9, 16, 20, 60, 300, 5000)]
    texts += ["x y\nx y\n\n \nx y ", "a b c d e f g h " * 4, None, "", " \n\t", "\x0b\x0cq\r"]
    d = spark.createDataFrame([(i, t, 1, 0.5) for i, t in enumerate(texts)] + [(0, texts[0], 1, 0.5), (None, "a", 1, 0.5)],
                              "doc_id long, text string, h1 int, ratio double")
    rows = Q.scores(d, spark.createDataFrame([(0,), (0,), (None,)], "doc_id long")).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        want = counts("a" if r["doc_id"] is None else texts[r["doc_id"]])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] is False or not r["base_failed"]


def test_ratio_tells_trusted_text_from_other(spark):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice(["sun", "moon", "star", "sky"]) + str(rng.randrange(9)) for _ in range(60))) for i in range(60)]
    bad = [(100 + i, " ".join("| " + rng.choice(["buy", "now"]) + str(rng.randrange(9)) for _ in range(30))) for i in range(60)]
    d = spark.createDataFrame(good + bad, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(30)], "doc_id long")
    rows = {r["doc_id"]: r for r in Q.scores(d, trusted).collect()}
    assert all(rows[k]["kept"] for k, _ in good) and not any(rows[k]["kept"] for k, _ in bad)
    again = {r["doc_id"]: r["ratio"] for r in Q.scores(d.repartition(5), trusted).collect()}
    assert all(abs(again[k] - r["ratio"]) < 1e-9 for k, r in rows.items())


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert Q.scores(d.limit(0), none).collect() == []
    assert Q.scores(d, none).first()["ratio"] == 0


def test_main_path_is_native(spark):
    d = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    plan = Q.scores(d, d.select("doc_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
