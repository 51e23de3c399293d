"""Ingest (A1-A5, B1-B11, C1-C4) on a small release with every edge case."""

import math

import pytest
from pyspark.sql import functions as F

from conceptnorm.operators.normalize import LoadError
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, write_sample_release


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = write_sample_release(str(tmp_path_factory.mktemp("release")))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    return release.load_release(spark, root, types_vocab=types)


def test_row_counts(store):
    counts = {k: v.count() for k, v in store.tables().items()}
    assert counts == {"types": 3, "identifiers": 9, "cliques": 6, "descriptions": 2,
                      "identifiers_descriptions": 2, "identifiers_cliques": 9,
                      "identifiers_taxa": 3, "conflation_clusters": 2, "conflation_members": 4}


def test_first_seen_label_sticks_and_unknown_taxa(store):
    labels = {r.curie: r.label for r in store.identifiers.collect()}
    assert labels["P:1"] is None            # first seen unlabelled, later label ignored
    assert labels["G:4"] == "gene four"     # first label kept over a later one
    assert labels["E:1"] is None
    assert labels["TX:1"] == "Taxon one"    # defined taxon keeps its label
    assert labels["TX:8"] == labels["TX:9"] == "unknown taxon"


def test_identifier_ids_follow_curie_order(store):
    rows = store.identifiers.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 10))
    assert [r.curie for r in rows] == sorted(r.curie for r in rows)


def test_clique_ids_follow_load_order(store):
    rows = store.cliques_wide.orderBy("clique_id").collect()
    assert [r.primary_curie for r in rows] == ["TX:1", "G:1", "G:2", "G:3", "G:4", "P:1"]
    assert [r.clique_id for r in rows] == list(range(1, 7))
    ics = [r.ic for r in rows if r.ic is not None]
    assert ics == [83.4]


def test_descriptions_belong_to_their_member(store):
    rows = (store.identifiers_descriptions
            .join(store.descriptions.withColumnRenamed("id", "description_id"), "description_id")
            .join(store.identifiers.withColumnRenamed("id", "identifier_id"), "identifier_id")
            .orderBy("description_id").collect())
    assert [(r.curie, r.desc) for r in rows] == [("G:1", "first desc"), ("G:1", "second desc")]


def test_conflation_resolved_in_line_order(store):
    rows = store.conflation_wide.orderBy("cluster_id", "pos").collect()
    assert [(r.cluster_id, r.member_curie, r.is_canonical) for r in rows] == [
        (1, "P:1", 1), (1, "G:4", 0), (2, "G:1", 1), (2, "E:1", 0)]


def test_in_memory_and_file_ingest_agree(spark, store, tmp_path):
    root = write_sample_release(str(tmp_path))
    recs = release.read_compendia(spark, release.compendia_paths(spark, root))
    lines = release.read_conflation(spark, root)
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    # in-memory path: same rows, numbered by a range sort instead of by split
    other = Vocabulary.build(recs, lines, types, scan_order=False)
    assert sorted(map(tuple, other.identifiers.collect())) == \
        sorted(map(tuple, store.identifiers.collect()))
    assert sorted(map(tuple, other.cliques.collect())) == sorted(map(tuple, store.cliques.collect()))


def test_nan_ic_becomes_null(spark):
    from conceptnorm.functions.scalars import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    out = [r.y for r in df.select(nan_to_null("x").alias("y")).collect()]
    assert out[0] is None and out[1] == 1.0 and out[2] is None
    assert not any(isinstance(v, float) and math.isnan(v) for v in out)


def test_strict_mode_rejects_unknown_type(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    types = spark.createDataFrame([("biolink:Gene",)], "curie string")
    with pytest.raises(LoadError, match="type not in vocabulary"):
        release.load_release(spark, root, types_vocab=types, strict=True)


def test_strict_mode_rejects_empty_clique(spark, tmp_path):
    from helpers import record, write_lines
    write_lines(str(tmp_path / "compendia"), "Gene.txt",
                [record("biolink:Gene", [{"i": "G:1", "l": "a"}]),
                 record("biolink:Gene", [], name="nothing here")])
    write_lines(str(tmp_path / "conflation"), "GeneProtein.txt", [""])
    with pytest.raises(LoadError, match="nothing here"):
        release.load_release(spark, str(tmp_path), strict=True)


def test_failfast_scan_rejects_malformed_line(spark, tmp_path):
    from helpers import write_lines
    write_lines(str(tmp_path / "compendia"), "Gene.txt", ['{"type": "biolink:Gene", oops'])
    write_lines(str(tmp_path / "conflation"), "GeneProtein.txt", [""])
    with pytest.raises(Exception):
        release.load_release(spark, str(tmp_path)).identifiers.count()


def test_store_roundtrip(spark, store, tmp_path):
    path = str(tmp_path / "store")
    store.write(path)
    loaded = Vocabulary.load(spark, path)
    for name, df in store.all_frames().items():
        assert sorted(map(tuple, getattr(loaded, name).collect())) == \
            sorted(map(tuple, df.collect())), name
    assert loaded.identifiers.where(F.col("curie") == "G:1").count() == 1


def test_missing_taxa_rejected_when_not_inserted(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    recs = release.read_compendia(spark, release.compendia_paths(spark, root))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    with pytest.raises(LoadError, match=r"taxon missing from identifiers \(clique 3\): TX:9"):
        Vocabulary.build(recs, None, types, scan_order=True, insert_missing_taxa=False)


def test_staged_data_can_be_dropped_after_write(spark, tmp_path):
    import os

    from conceptnorm.operators.keys import staging_scope
    from conceptnorm.session import drop_paths
    root = write_sample_release(str(tmp_path / "release"))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    with staging_scope() as staged:
        built = release.load_release(spark, root, types_vocab=types, materialize=False)
        built.write(str(tmp_path / "store"))
    assert len(staged) >= 4
    assert drop_paths(spark, staged) == len(staged)
    assert not any(os.path.exists(p.replace("file:", "")) for p in staged)
    loaded = Vocabulary.load(spark, str(tmp_path / "store"))
    assert loaded.identifiers.count() == 9 and loaded.membership_wide.count() == 9


def test_strict_mode_rejects_duplicate_primary_type_and_taxon_link(spark, tmp_path):
    from helpers import record, write_lines
    types = spark.createDataFrame([("biolink:Gene",)], "curie string")
    write_lines(str(tmp_path / "a" / "compendia"), "Gene.txt",
                [record("biolink:Gene", [{"i": "G:1", "l": "a"}]),
                 record("biolink:Gene", [{"i": "G:1", "l": "b"}])])
    write_lines(str(tmp_path / "a" / "conflation"), "GeneProtein.txt", [""])
    with pytest.raises(LoadError, match="duplicate clique"):
        release.load_release(spark, str(tmp_path / "a"), types_vocab=types, strict=True)
    write_lines(str(tmp_path / "b" / "compendia"), "Gene.txt",
                [record("biolink:Gene", [{"i": "G:1", "l": "a", "t": ["T:1"]}]),
                 record("biolink:Gene", [{"i": "G:2", "l": "b"}, {"i": "G:1", "t": ["T:1"]}])])
    write_lines(str(tmp_path / "b" / "conflation"), "GeneProtein.txt", [""])
    with pytest.raises(LoadError, match="duplicate taxon link"):
        release.load_release(spark, str(tmp_path / "b"), types_vocab=types, strict=True)
    lenient = release.load_release(spark, str(tmp_path / "b"), types_vocab=types, strict=False)
    assert lenient.identifiers_taxa.count() == 1


def test_lenient_mode_leaves_out_records_of_unknown_type(spark, tmp_path):
    from conceptnorm.operators import audit
    root = write_sample_release(str(tmp_path))
    types = spark.createDataFrame([("biolink:Gene",), ("biolink:OrganismTaxon",)], "curie string")
    store = release.load_release(spark, root, types_vocab=types, strict=False)
    assert [(r.file_name, r.reason) for r in store.rejected.collect() if r.file_name == "Protein.txt"] == \
        [("Protein.txt", "type not in vocabulary: biolink:Protein")]
    assert store.cliques.count() == 5                     # the Protein record is left out
    assert store.identifiers_cliques.count() == 7
    report = {r.check_name: r.violations for r in audit.report(store).collect()}
    assert set(report.values()) == {0}                    # no orphans
