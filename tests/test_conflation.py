"""Conflation parsing, resolution and curation."""

import pytest
from pyspark.sql import functions as F

from conceptnorm.operators import conflate
from conceptnorm.operators.conflate import ConflationError


def lines(spark, values, type_id=1):
    rows = [("DrugChemical.txt", type_id, 1, "DrugChemical.txt", 0, i, v)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "file_name string, conflation_type int, file_ord int, "
                                       "file_path string, split_start bigint, "
                                       "row_in_split bigint, value string")


def idents(spark, curies):
    return spark.createDataFrame([(i + 1, c, None) for i, c in enumerate(curies)],
                                 "id bigint, curie string, label string")


PARSE_CASES = [
    ('["A:1","A:2"]', ["A:1", "A:2"], None),
    ("['A:1', 'A:2']", ["A:1", "A:2"], None),
    ("('A:1', 'A:2')", ["A:1", "A:2"], None),
    ("('A:1',)", ["A:1"], None),
    ('["A:1", 5]', None, "not all strings"),
    ("[]", None, "empty"),
    ("not a list", None, "not a list of CURIEs"),
]


def test_parse_cases(spark):
    parsed = conflate.parse_lines(lines(spark, [c[0] for c in PARSE_CASES] + ["   "]))
    got = {r.value: (r.members, r.error) for r in parsed.collect()}
    assert len(got) == len(PARSE_CASES)            # the blank line is skipped
    for value, members, error in PARSE_CASES:
        m, e = got[value]
        assert e == error, value
        if error is None:
            assert m == members, value


def test_duplicates_keep_canonical_first(spark):
    parsed = conflate.parse_lines(lines(spark, ['["A:1","A:1","A:2"]', '["A:1","A:2","A:2"]']))
    rows = conflate.cluster_members(parsed).orderBy("cluster_id", "pos").collect()
    assert [(r.cluster_id, r.curie, r.is_canonical) for r in rows] == [
        (1, "A:1", 1), (1, "A:2", 0), (2, "A:1", 1), (2, "A:2", 0)]


def test_missing_members_reported_and_strict_raises(spark):
    ids = idents(spark, ["A:1", "A:2"])
    tables = conflate.normalize_conflation(lines(spark, ['["X:0","A:1"]', '["A:1","X:9","X:1"]',
                                                         '["A:2","A:1"]']), ids, strict=False)
    report = {r.cluster_id: (r.canonical_missing, r.n_missing, r.first_missing)
              for r in tables.missing.collect()}
    assert report == {1: (True, 1, ["X:0"]), 2: (False, 2, ["X:1", "X:9"])}
    assert tables.conflation_clusters.count() == 1          # lenient: quarantined
    with pytest.raises(ConflationError, match="canonical"):
        conflate.normalize_conflation(lines(spark, ['["X:0","A:1"]']), ids, strict=True)
    with pytest.raises(ConflationError, match="missing CURIE"):
        conflate.normalize_conflation(lines(spark, ['["A:1","X:9"]']), ids, strict=True)
    with pytest.raises(ConflationError, match="empty"):
        conflate.normalize_conflation(lines(spark, ['[]']), ids, strict=True)


def test_missing_lists_first_ten_sorted(spark):
    members = [f"M:{i:02d}" for i in range(25, 0, -1)]
    value = '["A:1", ' + ", ".join(f'"{m}"' for m in members) + "]"
    tables = conflate.normalize_conflation(lines(spark, [value]), idents(spark, ["A:1"]), strict=False)
    row = tables.missing.first()
    assert row.n_missing == 25 and row.first_missing == sorted(members)[:10]


def test_invalid_type_flagged(spark):
    parsed = conflate.parse_lines(lines(spark, ['["A:1"]'], type_id=3))
    assert parsed.first().error == "invalid conflation type"


def test_filter_clusters_and_stats(spark):
    parsed = conflate.parse_lines(lines(spark, ['["A:1","A:2"]', '["A:1","B:1"]',
                                                '["A:2","A:2","A:1"]']))
    valid = spark.createDataFrame([("A:1",), ("A:2",)], "curie string")
    flags = conflate.filter_clusters(parsed, valid)
    kept = {r.value: r.kept for r in flags.collect()}
    assert kept == {'["A:1","A:2"]': True, '["A:1","B:1"]': False, '["A:2","A:2","A:1"]': True}
    stats = conflate.filter_stats(flags).first().asDict()
    assert stats == {"total": 3, "kept": 2, "dropped": 1, "dropped_pct": 33.33,
                     "kept_with_duplicates": 1}


def test_harvest_and_valid_set(spark):
    from conceptnorm.schema import COMPENDIA_RECORD
    recs = spark.createDataFrame([(
        "biolink:Gene", 1.0, [("G:1", "a label", ["see X:1", "Y:2"], ["T:1"])], "name", ["T:1"]),
    ], COMPENDIA_RECORD)
    got = {r.curie for r in conflate.harvest_curies(recs).collect()}
    assert got == {"biolink:Gene", "G:1", "Y:2", "T:1"}
    assert {r.curie for r in conflate.valid_curies(recs).collect()} == {"G:1"}


def test_type_from_file_name(spark):
    df = spark.createDataFrame([("DrugChemical.txt",), ("GeneProtein.txt",), ("Other.txt",)],
                               "f string")
    got = [r.t for r in df.select(conflate.conflation_type_of(F.col("f")).alias("t")).collect()]
    assert got == [1, 2, None]


def test_keep_empty_and_require_kept(spark):
    parsed = conflate.parse_lines(lines(spark, ['[]', '["Z:1"]']))
    valid = spark.createDataFrame([("A:1",)], "curie string")
    strict = conflate.filter_stats(conflate.filter_clusters(parsed, valid))
    with pytest.raises(ValueError, match="no cluster kept"):
        conflate.require_kept(strict)
    loose = conflate.filter_clusters(parsed, valid, keep_empty=True)
    assert {r.value: r.kept for r in loose.collect()} == {"[]": True, '["Z:1"]': False}
    assert conflate.require_kept(conflate.filter_stats(loose)).first().kept == 1
