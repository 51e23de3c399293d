import random
import re

from conceptnorm.llm import near_dup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=2):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(docs):
    sets = {k: shingles(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus():
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    docs = []
    for base in (some(150), some(60), some(12), ["of", "the"] * 30 + some(40)):
        docs.append(base)
        for _ in range(25):          # a chain of edits: the ends are no near duplicates
            base = list(base)
            base[rng.randrange(len(base))] = f"w{rng.randrange(4000)}"
            docs.append(base)
    docs += [some(rng.choice([1, 2, 3, 40])) for _ in range(60)] + [docs[3]] * 8 + [["Same", "text"]] * 3 + [["same", "TEXT"]]
    texts = [" ".join(d) for d in docs] + [None, "", " \n\t", "one", "ONE", "x " * 20000]
    keys = list(range(len(texts)))
    rng.shuffle(keys)
    return list(zip(keys, texts, strict=True))


def test_against_brute_force(spark):
    docs = corpus()
    d = spark.createDataFrame([(k, t, 0, "n") for k, t in docs], "doc_id long, text string, node int, bucket string").repartition(3)
    want = brute(docs)
    rows = N.near_duplicates(d).collect()
    assert len(rows) == len(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    kept = N.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, (_, c) in want.items() if k == c)


def test_members_that_differ_from_the_hub_are_still_linked(spark):
    # in one bucket: the least id is near neither of the others, which are near each other
    buckets = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (1, 3, 10), (1, 4, 10)], "bucket long, node long, n_shingles long")
    text = {1: "a b c d e f g h i j k", 2: "z y x w v u t s r q p", 3: "z y x w v u t s r q p o", 4: "m1 m2 m3 m4 m5 m6 m7 m8 m9 m10 m11"}
    docs = spark.createDataFrame([(k, t) for k, t in text.items()], "doc_id long, text string").withColumn("text_hash", N.F.xxhash64("text"))
    classes = docs.select(N.F.col("doc_id").alias("node"), N.F.col("text_hash").alias("node_hash"))
    found = N._linked(docs, classes, buckets, 2, 80, None)
    assert {(r["node"], r["root"]) for r in found.collect()} == {(3, 2)}


def test_repeated_rows_shared_ids_and_missing_ids(spark):
    same = "p q r s t u v w x y z"
    d = spark.createDataFrame([(5, same), (5, same), (7, same), (None, same), (8, "k l m n"), (8, "g h i j"), (3, "g h i j"), (None, None), (None, "k k")],
                              "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(d).collect()), key=str)
    assert got == sorted([(5, 10, 5, True), (5, 10, 5, True), (7, 10, 5, False), (-1, 10, 5, False), (8, 3, 3, False), (8, 3, 3, False),
                          (3, 3, 3, True), (-1, 0, None, True), (-1, 1, None, True)], key=str)
    kept = [r["doc_id"] for r in N.one_of_each(d).collect()]
    assert sorted(k for k in kept if k is not None) == [3, 5]


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(d).collect() == [] and N.one_of_each(d).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = {r["node"]: r["root"] for r in N.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found.get(x, x) == find(x) for x in root)
