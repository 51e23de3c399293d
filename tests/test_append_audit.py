"""Audits of an append by its own keys; results in NOCASE order; factored conflation."""

from pyspark.sql import functions as F

from conceptnorm.operators import append_audit, audit, lookup, ordered
from conceptnorm.plans.vocabulary import Vocabulary
from helpers import store_from_rows


def store(spark):
    return store_from_rows(
        spark, types=[(1, "t:A"), (2, "t:B")],
        identifiers=[(1, "A:1", "beta"), (2, "A:2", "Alpha"), (3, "A:3", "alpha"), (4, "A:4", "  ")],
        cliques=[(1, 1, None, 1, "Zeta"), (2, 2, None, 2, "eta")],
        identifiers_cliques=[(1, 1), (3, 1), (4, 1), (2, 2)],
        conflation_clusters=[(1, 1), (2, 2)],
        conflation_members=[(1, 1, 1), (1, 2, 0), (2, 3, 1), (2, 1, 0)])


def found(df):
    return sorted((r["check_name"], r["row_key"]) for r in df.collect())


def test_clean_append_has_no_violations(spark):
    rows = {"identifiers": spark.createDataFrame([(5, "A:5", None)], "id long, curie string, label string"),
            "cliques": spark.createDataFrame([(3, 5, None, 1, "x")], "id long, primary_identifier_id long, ic double, type_id long, preferred_name string"),
            "identifiers_cliques": spark.createDataFrame([(5, 3), (1, 3)], "identifier_id long, clique_id long")}
    assert found(append_audit.violations(store(spark), rows)) == []


def test_only_violations_of_the_new_rows(spark):
    s = store(spark)
    # what the store breaks by itself isn't the append's
    s.identifiers = s.identifiers.unionByName(s.identifiers.where("id = 4"))
    rows = {"identifiers": spark.createDataFrame([(9, "A:1", None), (10, None, "n")], "id long, curie string, label string"),
            "cliques": spark.createDataFrame([(3, 1, None, 1, "again"), (4, 77, None, 8, None)],
                                             "id long, primary_identifier_id long, ic double, type_id long, preferred_name string"),
            "identifiers_cliques": spark.createDataFrame([(9, 3), (99, 55)], "identifier_id long, clique_id long"),
            "descriptions": spark.createDataFrame([(1, None)], "id long, desc string"),
            "conflation_clusters": spark.createDataFrame([(3, 7)], "id long, type int"),
            "conflation_members": spark.createDataFrame([(1, 3, 1), (2, 1, 5), (6, 2, 1)], "cluster_id long, identifier_id long, is_canonical int")}
    assert found(append_audit.violations(s, rows)) == sorted([
        ("unique_identifiers_curie", "A:1"), ("unique_cliques_primary_type", "1,1"), ("unique_conflation_members", "1,2"),
        ("fk_cliques_primary", "77"), ("fk_cliques_type", "8"), ("fk_icliques_identifier", "99"), ("fk_icliques_clique", "55"),
        ("fk_members_cluster", "6"), ("not_null_identifiers_curie", "10"), ("not_null_cliques_columns", "4"),
        ("empty_cliques", "4"), ("not_null_descriptions_desc", "1"), ("check_conflation_type", "3"),
        ("check_is_canonical", "2,1"), ("one_canonical_per_cluster", "1"), ("one_canonical_per_cluster", "2")])


def test_agrees_with_the_full_audit(spark):
    s = store(spark)
    rows = {"identifiers": spark.createDataFrame([(k, f"A:{k % 7}", None) for k in range(5, 40)], "id long, curie string, label string"),
            "conflation_members": spark.createDataFrame([(k % 5, k, k % 3) for k in range(1, 40)],
                                                        "cluster_id long, identifier_id long, is_canonical int")}
    whole = Vocabulary.from_tables({n: df.unionByName(rows[n]) if n in rows else df for n, df in s.tables().items()})
    full = {k: n for k, n in ((r["check_name"], r["violations"]) for r in audit.report(whole).collect()) if n}
    mine = append_audit.violations(s, rows).groupBy("check_name").count()
    assert {r["check_name"]: r["count"] for r in mine.collect()} == full


def test_a_bloom_filter_stands_on_the_store_scan(spark):
    s = store(spark)
    plan = append_audit.unique_violations(s, s.identifiers, "identifiers")._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


def test_names_and_categories_in_nocase_order(spark):
    s = store(spark)
    inputs = spark.createDataFrame([("A:1",), ("A:2",), ("A:9",), (None,), ("A:1",)], "curie string")
    got = {(r["curie"], r["position"]): r["name"] for r in ordered.all_names(s, inputs).collect()}
    assert got == {("A:1", 1): "alpha", ("A:1", 2): "beta", ("A:1", 3): "Zeta", ("A:2", 1): "Alpha", ("A:2", 2): "eta"}
    got = {(r["curie"], r["position"]): r["category"] for r in ordered.categories(s, inputs).collect()}
    assert got == {("A:1", 1): "t:A", ("A:1", 2): "t:B", ("A:2", 1): "t:A", ("A:2", 2): "t:B"}
    assert ordered.all_names(s, inputs.limit(0)).collect() == []


def test_positions_of_a_hot_input_are_dense(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("curie"), F.md5(F.col("id").cast("string")).alias("name")) \
        .unionByName(spark.createDataFrame([("cold", "b"), ("cold", "A")], "curie string, name string")).repartition(7)
    got = ordered.positioned(rows, "curie", ordered.nocase_order("name")).collect()
    hot = sorted((r["name"], r["position"]) for r in got if r["curie"] == "hot")
    assert [p for _, p in hot] == list(range(1, 5001))
    assert {r["name"]: r["position"] for r in got if r["curie"] == "cold"} == {"A": 1, "b": 2}


def test_factored_conflation_is_the_whole_answer(spark):
    s = store(spark)
    inputs = spark.createDataFrame([("A:1",), ("A:3",), ("A:3",), ("A:8",)], "curie string")
    links = lookup.conflation_links(s, inputs)
    members = lookup.conflation_members(s, links)
    assert members.count() == members.distinct().count() == 4
    joined = links.join(members, "cluster_id").drop("cluster_id")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, lookup.conflation(s, inputs).collect()))
