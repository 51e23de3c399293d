"""Audits, profiles and row counts."""

from conceptnorm.operators import audit
from conceptnorm.plans.vocabulary import max_id
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, store_from_rows, write_sample_release


def test_row_counts_two_tables_empty_and_none(spark):
    t1 = spark.createDataFrame([(1,), (2,)], "a int")
    t2 = spark.createDataFrame([(1,)], "a int")
    empty = spark.createDataFrame([], "a int")
    got = {r.table_name: r.row_count for r in audit.row_counts({"t1": t1, "t2": t2}).collect()}
    assert got == {"t1": 2, "t2": 1}
    assert audit.row_counts({"t": empty}).first().row_count == 0
    assert audit.row_counts({}, spark).count() == 0
    pretty = audit.pretty_counts(audit.row_counts({"t": spark.range(1234567)})).first()
    assert pretty.row_count == "1,234,567"


def test_clean_store_has_no_violations(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    store = release.load_release(spark, root, types_vocab=types)
    report = {r.check_name: r.violations for r in audit.report(store).collect()}
    assert len(report) == 22 and set(report.values()) == {0}
    audit.assert_clean(store)
    assert max_id(store.identifiers).first().max_id == 9


def test_mutated_store_violations(spark):
    bad = store_from_rows(
        spark,
        types=[(1, "biolink:Gene"), (2, "biolink:Gene")],
        identifiers=[(1, "A:1", None), (2, "A:1", None), (3, "B:1", None)],
        cliques=[(1, 1, None, 1, "a"), (2, 1, None, 1, "a"), (3, 9, None, 7, None)],
        identifiers_cliques=[(1, 1), (3, 2), (8, 1)],
        identifiers_taxa=[(1, 3), (1, 3)],
        conflation_clusters=[(1, 1), (2, 3)],
        conflation_members=[(1, 1, 1), (1, 3, 1), (2, 2, 0), (2, 3, 2)],
    )
    report = {r.check_name: r.violations for r in audit.report(bad).collect()}
    assert report["unique_types_curie"] == 1
    assert report["unique_identifiers_curie"] == 1
    assert report["unique_cliques_primary_type"] == 1
    assert report["unique_identifiers_taxa"] == 1
    assert report["fk_cliques_primary"] == 1
    assert report["fk_cliques_type"] == 1
    assert report["fk_icliques_identifier"] == 1
    assert report["check_conflation_type"] == 1
    assert report["check_is_canonical"] == 1
    assert report["not_null_cliques_columns"] == 1
    assert report["empty_cliques"] == 1
    assert report["one_canonical_per_cluster"] == 2
    try:
        audit.assert_clean(bad)
    except ValueError as err:
        assert "unique_identifiers_curie" in str(err)
    else:
        raise AssertionError("expected a violation")


def test_duplicate_sample_limit(spark):
    df = spark.createDataFrame([(f"P:{i % 15}", "t") for i in range(45)], "p string, t string")
    dup = audit.duplicates(df, ["p", "t"])
    assert dup.count() == 15 and set(r.n for r in dup.collect()) == {3}
    top = [r.p for r in audit.duplicate_sample(df, ["p", "t"], 10).collect()]
    assert top == sorted(f"P:{i}" for i in range(15))[:10]


def test_empty_records_audit(spark):
    from conceptnorm.schema import COMPENDIA_RECORD
    recs = spark.createDataFrame([("t", None, [], "n", []), ("t", None, None, "m", []),
                                  ("t", None, [("A:1", None, None, None)], "o", [])],
                                 COMPENDIA_RECORD)
    assert sorted(r.preferred_name for r in audit.empty_records(recs).collect()) == ["m", "n"]
    assert audit.orphans(spark.createDataFrame([(1,), (5,)], "k bigint"), "k",
                         spark.createDataFrame([(1,)], "id bigint")).count() == 1
