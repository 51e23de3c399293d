"""The written store: buckets, heavy CURIEs, label order, Bloom-pruned appends."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conceptnorm.functions.scalars import ascii_lower
from conceptnorm.operators import append, conflate, keys, label_order, lookup, names
from conceptnorm.plans import layout
from conceptnorm.plans.vocabulary import Vocabulary

RECORD = ("file_name string, file_ord int, file_path string, split_start bigint, row_in_split bigint, type string, ic double, "
          "identifiers array<struct<i:string,l:string,d:array<string>,t:array<string>>>, preferred_name string, taxa array<string>")
TYPES = ["biolink:Gene", "biolink:Drug"]


def records(spark, first, n, labels):
    rng = random.Random(first)
    rows = []
    for k in range(first, first + n):
        members = [(f"A:{k}", rng.choice(labels) + (f" {k}" if k % 3 else ""))] + [("HOT:1", "hot")] * (k % 2) + [(f"B:{k}", None)]
        own = [(i, text, [], [f"T:{k % 4}"]) for i, text in members]
        rows.append(("x.txt", 1, "x.txt", 0, k, TYPES[k % 2], None, own, f"name {k}", []))
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture()
def written(spark, tmp_path):
    def build(n=60, heavy_rows=None, labels=("Alpha", "alpha beta", "Gamma", "émile", "delta")):
        recs = records(spark, 0, n, list(labels))
        types = spark.createDataFrame([(t,) for t in TYPES], "curie string")
        path = str(tmp_path / f"store{n}-{heavy_rows}")
        built = Vocabulary.build(recs, None, types, strict=False)
        built.write(path, heavy_rows=heavy_rows)
        return built, Vocabulary.load(spark, path), path
    return build


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lookups_exchange_their_inputs_only(spark, written, no_broadcast):
    built, store, _ = written()
    inputs = spark.createDataFrame([("A:1",), ("HOT:1",), ("none",), ("A:1",)], "curie string")
    found = lookup.preferred(store, inputs)
    assert plan(found).count("Exchange hashpartitioning") == 1
    assert plan(lookup.preferred(store, store.identifiers.select("curie"))).count("Exchange") == 0
    assert sorted(found.collect()) == sorted(lookup.preferred(built, inputs).collect())
    assert {tuple(r) for r in lookup.preferred_for(store, ["A:1"]).collect()} == {("A:1", "A:1", "biolink:Drug")}


def test_heavy_curies_lie_beside_the_buckets(spark, written):
    built, store, path = written(heavy_rows=5)
    assert layout.layout(spark, path)["membership_wide"][1] and not layout.layout(spark, path)["cliques_wide"][1]
    parts = store.parts("membership_wide")
    assert [r[0] for r in parts[1].select("member_curie").distinct().collect()] == ["HOT:1"]
    assert parts[0].where("member_curie = 'HOT:1'").count() == 0
    everyone = store.identifiers.select("curie")
    for op in (lookup.preferred, lookup.any_cliques, lookup.synonyms, lookup.all_names, lookup.categories):
        assert sorted(map(str, op(store, everyone).collect())) == sorted(map(str, op(built, everyone).collect()))


def test_names_read_the_files_they_lead_to(spark, written, monkeypatch):
    monkeypatch.setattr(label_order, "LABELS_PER_FILE", 4)
    built, store, path = written()
    asked = spark.createDataFrame([(x,) for x in ("ALPHA", "gamma 1", "zzz", "Émile", "émile 4", "delta 2s", "", "hot")], "name string")
    assert sorted(map(str, names.name_to_curie(store, asked).collect())) == sorted(map(str, names.name_to_curie(built, asked).collect()))
    files = label_order.files(spark, path)
    assert files.count() > 10 and files.agg(F.sum("n_labels")).first()[0] == built.identifiers.where("label IS NOT NULL").count()
    one = spark.createDataFrame([("gamma 1",)], "vkey string")
    routed = label_order.routed(one, files, names.next_labels)
    assert routed.count() == 1
    assert len(label_order.read_files(spark, path, routed).inputFiles()) == 1


def test_ties_over_files_and_runs(spark, tmp_path, monkeypatch):
    """Equal labels over several files, and a later run with lesser CURIEs."""
    monkeypatch.setattr(label_order, "LABELS_PER_FILE", 2)
    path = str(tmp_path / "labels")
    first = [(i, f"C:{i:02}", "Same") for i in range(10, 20)] + [(30, "C:30", "samee"), (31, "PMID:1", "same")]
    more = [(1, "C:01", "same"), (2, "C:02", "Same"), (3, "C:03", "tail")]
    for run, rows in enumerate((first, more)):
        label_order.write(spark.createDataFrame(rows, "id long, curie string, label string"), path, run)
    keys_ = spark.createDataFrame([("sam",), ("same",), ("samef",), ("u",)], "vkey string")
    found = {r.vkey: (r.best.label, r.best.curie) for r in label_order.next_stored(spark, path, keys_, names.next_labels).collect()}
    everything = sorted((x[2].lower(), x[2], x[1]) for x in first + more if not x[1].startswith("PMID"))
    expected = {k: next(((b, c) for a, b, c in everything if a >= k), None) for k in ("sam", "same", "samef", "u")}
    assert found == {k: v for k, v in expected.items() if v}


def test_appends_keep_buckets_labels_and_answers(spark, written, monkeypatch):
    monkeypatch.setattr(label_order, "LABELS_PER_FILE", 4)
    built, store, path = written()
    new = records(spark, 40, 60, ["alpha", "Omega", "beta"])      # cliques 40 to 59 again, 60 to 99 new
    expected = append.append_compendia(built, new, strict=False)
    got = append.append_to_store(spark, path, new, strict=False)
    for name in ("identifiers", "membership_wide", "cliques_wide", "identifiers_taxa"):
        a, b = (sorted(map(str, getattr(s, name).select(*sorted(getattr(expected, name).columns)).collect())) for s in (expected, got))
        assert a == b, name
    everyone = got.identifiers.select("curie")
    assert sorted(lookup.preferred(got, everyone).collect()) == sorted(lookup.preferred(expected, everyone).collect())
    asked = spark.createDataFrame([("omega",), ("alpha",), ("beta 41",)], "name string")
    assert sorted(map(str, names.name_to_curie(got, asked).collect())) == sorted(map(str, names.name_to_curie(expected, asked).collect()))


def test_bloom_filter_lets_through_little_else(spark):
    store = spark.range(20_000).select(F.concat(F.lit("X:"), "id").alias("curie"))
    batch = store.where("curie IN ('X:7', 'X:19999')").unionByName(spark.createDataFrame([("none",), (None,)], "curie string"))
    kept = keys.possibly_among(store, "curie", batch)
    found = {r[0] for r in kept.collect()}
    assert {"X:7", "X:19999"} <= found and len(found) < 50
    assert "scalar-subquery" in plan(kept) or "Subquery" in plan(kept)
    many = store.where("xxhash64(curie) % 4 = 0")
    n = keys.possibly_among(store, "curie", many).count()
    assert many.count() <= n < 1.1 * many.count()
    assert keys.possibly_among(store, "curie", store.limit(0)).count() == 0


def test_store_without_layout_still_opens(spark, written, tmp_path):
    built, _, _ = written(20)
    path = str(tmp_path / "plain")
    for name, df in built.all_frames().items():
        df.write.parquet(f"{path}/{name}")
    plain = Vocabulary.load(spark, path)
    assert os.listdir(path) and plain.parts("membership_wide")[0].count() == built.membership_wide.count()
    asked = spark.createDataFrame([("delta",)], "name string")
    assert sorted(names.name_to_curie(plain, asked).collect()) == sorted(names.name_to_curie(built, asked).collect())


def test_texts_are_joined_last_and_stay_in_their_buckets(spark, written, no_broadcast):
    built, store, _ = written()
    everyone = store.identifiers.select("curie")
    for op in (lookup.preferred_cliques, lookup.any_cliques):
        found = op(store, everyone)
        assert sorted(map(str, found.collect())) == sorted(map(str, op(built, everyone).collect()))
        # the only exchange is that of the rows without texts
        text = plan(op(store, everyone))
        assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(primary_identifier_id" in text


def test_samples_of_any_size(spark, written, monkeypatch):
    _, store, _ = written()
    monkeypatch.setattr(lookup, "CELL_ROWS", 3)
    everything = [r[0] for r in store.identifiers.select("curie").orderBy(F.md5(F.concat(F.lit("5"), F.col("curie")))).collect()]
    for n in (1, 7, len(everything) // 3, len(everything)):
        assert sorted(r[0] for r in lookup.sample_identifiers(store, n, 5).collect()) == sorted(everything[:n])
    for n in (0, len(everything) + 1):
        with pytest.raises(ValueError):
            lookup.sample_identifiers(store, n)


def test_harvest_at_any_depth(spark):
    deep = "[" * 20 + '"DEEP:1"' + "]" * 20
    lines = ['{"i":"A:1","KEY:1":{"x":["B:2",{"y":[["C:3"]]}],"n":5,"z":null,"t":true}}', "", "  ", '"ROOT:1"', "[]", "{}",
             '["A:1","no curie","D: 4","\\u0045:5",""]', deep, "null", '{"o":{"A:9":"A:1"}}']
    found = conflate.harvest_any(spark.createDataFrame([(x,) for x in lines] + [(None,)], "value string"))
    assert sorted(r[0] for r in found.collect()) == ["A:1", "B:2", "C:3", "DEEP:1", "E:5", "ROOT:1"]
    bad = spark.createDataFrame([("{",), ('"A:1"',)], "value string")
    assert [r[0] for r in conflate.harvest_any(bad, strict=False).collect()] == ["A:1"]
    with pytest.raises(Exception, match="MALFORMED"):
        conflate.harvest_any(bad).collect()
    assert conflate.harvest_any(spark.createDataFrame([], "value string")).collect() == []


def test_shuffle_files_go_with_their_query(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = disk.getAllBlocks().length()
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
    until = time.time() + 10
    while disk.getAllBlocks().length() > before and time.time() < until:
        time.sleep(0.1)
    assert disk.getAllBlocks().length() <= before


def below(df, node):
    """The plan from the first line with ``node`` to the end of what is below it."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if node in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    end = next((i for i in range(at + 1, len(lines)) if len(lines[i]) - len(lines[i].lstrip(" :+-")) <= depth), len(lines))
    return "\n".join(lines[at:end])


def test_only_described_cliques_are_exchanged_for_texts(spark, tmp_path):
    rows = [("x.txt", 1, "x.txt", 0, k, TYPES[k % 2], 1.0 * k, [(f"A:{k}", f"a {k}", [f"text {k}", "more"] if k % 9 == 0 else [], []), ("M:1", None, [], [])], f"name {k}", [])
            for k in range(60)]
    types = spark.createDataFrame([(t,) for t in TYPES], "curie string")
    path = str(tmp_path / "described")
    Vocabulary.build(spark.createDataFrame(rows, RECORD), None, types, strict=False).write(path)
    store = Vocabulary.load(spark, path)
    inputs = spark.createDataFrame([(f"A:{k}",) for k in range(60)] + [("M:1",), ("M:1",), ("none",)], "curie string")
    for found, heads in ((lookup.any_cliques(store, inputs).select("input_curie", "identifier", "description", "label"), 3),
                         (lookup.preferred_cliques(store, inputs).select(F.col("identifier").alias("input_curie"), "identifier", "description", "label"), 1)):
        want = [(i, f"A:{k}", d, f"name {k}") for k in range(60) for i in (f"A:{k}", "M:1", "M:1")[:heads]
                for d in ([f"text {k}", "more"] if k % 9 == 0 else [None])]
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
        assert "shiftrightunsigned" in below(found, "Join LeftOuter")


def test_names_meet_by_clique_only_where_there_are_further_ones(spark, written):
    built, _, path = written(80)
    store = Vocabulary.load(spark, path)
    inputs = spark.createDataFrame([(f"A:{k}",) for k in range(0, 80, 2)] + [("HOT:1",), ("B:3",), ("B:3",), ("none",)], "curie string")
    asked = {r["curie"] for r in inputs.collect()}
    want, label = set(), {r["curie"]: r["label"] for r in store.identifiers.collect()}
    of = {}
    for r in store.membership_wide.collect():
        of.setdefault(r["clique_id"], []).append(r)
    for members in of.values():
        for i in asked & {m["member_curie"] for m in members}:
            want |= {(i, n) for n in [label[i], members[0]["preferred_name"], *(m["member_label"] for m in members)] if n}
    for v in (store, built):
        found = lookup.all_names(v, inputs)
        assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "shiftrightunsigned" in lookup.all_names(store, inputs)._jdf.queryExecution().optimizedPlan().toString()
