"""Release listing, selection and file checks."""

import os

from conceptnorm.sources import release
from helpers import record, write_lines, write_sample_release


def test_shard_selection_and_taxon_first(spark, tmp_path):
    folder = str(tmp_path)
    for name in ["OrganismTaxon.txt", "Gene.txt", "SmallMolecule.txt", "SmallMolecule.txt.00",
                 "SmallMolecule.txt.01", "README.md"]:
        write_lines(folder, name, [record("biolink:Gene", [{"i": "G:1"}])])
    sel = {r.file_name: (r.selected, r.file_ord, r.note)
           for r in release.selected_compendia(release.manifest(spark, folder)).collect()}
    assert sel["OrganismTaxon.txt"] == (True, 1, None)
    assert sel["Gene.txt"] == (True, 2, None)
    assert sel["SmallMolecule.txt.00"] == (True, 3, None)
    assert sel["SmallMolecule.txt.01"] == (True, 4, None)
    assert sel["SmallMolecule.txt"] == (False, None, "replaced by shards")
    assert sel["README.md"] == (False, None, "unrecognized file name")


def test_manifest_sizes(spark, tmp_path):
    path = write_lines(str(tmp_path), "Gene.txt", ["a", "b"])
    rows = release.manifest(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.n_parts, r.size) for r in rows] == [
        ("Gene.txt", 1, os.path.getsize(path))]
    listed = release.list_entries(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.n_parts, r.size) for r in listed] == [
        ("Gene.txt", 1, os.path.getsize(path))]


def test_listing_counts_part_folders(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "value string").repartition(3)
    df.write.text(str(tmp_path / "Gene.txt"))
    a = {r.file_name: (r.n_parts, r.size) for r in release.list_entries(spark, str(tmp_path)).collect()}
    b = {r.file_name: (r.n_parts, r.size) for r in release.manifest(spark, str(tmp_path)).collect()}
    assert a == b and a["Gene.txt"][0] == 3


def test_conflation_selection_types(spark, tmp_path):
    for name in ["GeneProtein.txt", "DrugChemical.txt", "notes.md"]:
        write_lines(str(tmp_path), name, ["[]"])
    rows = release.selected_conflation(release.manifest(spark, str(tmp_path))).collect()
    assert [(r.file_name, r.file_ord, r.conflation_type) for r in rows] == [
        ("DrugChemical.txt", 1, 1), ("GeneProtein.txt", 2, 2)]


def test_required_columns_and_type_profile(spark, tmp_path):
    folder = str(tmp_path / "compendia")
    write_lines(folder, "Gene.txt", [record("biolink:Gene", [{"i": "G:1"}]), "",
                                     record("biolink:Protein", [{"i": "P:1"}])])
    write_lines(folder, "Broken.txt", ['{"identifiers": [{"i": "B:1"}], "ic": null}'])
    paths = release.compendia_paths(spark, str(tmp_path))
    req = {r.file_name: r.missing for r in release.required_columns(spark, paths).collect()}
    assert req == {"Gene.txt": "", "Broken.txt": "type,preferred_name,taxa"}
    prof = {r.file_name: (r.first_type, r.n_types, r.n_records, r.first_type_missing)
            for r in release.type_profile(spark, paths).collect()}
    assert prof == {"Gene.txt": ("biolink:Gene", 2, 2, False),
                    "Broken.txt": (None, 0, 1, True)}
    vocab = spark.createDataFrame([("biolink:Protein",)], "curie string")
    known = {r.file_name: r.first_type_known
             for r in release.type_profile(spark, paths, vocab).collect()}
    assert known == {"Gene.txt": False, "Broken.txt": False}


def test_malformed_lines(spark, tmp_path):
    folder = str(tmp_path / "compendia")
    good = record("biolink:Gene", [{"i": "G:1"}])
    bad = ['{"type": "biolink:Gene", "identifiers": [', good.replace("null", '"abc"', 1), "[1,2]",
           good + " xyz", good + "," + good, "7", '"text"']
    write_lines(folder, "Gene.txt", [good, "", bad[0], "\t", *bad[1:], "  " + good, good])
    write_lines(folder, "Other.txt", ["", "x", good])
    paths = release.compendia_paths(spark, str(tmp_path))
    rows = {(r.file_name, r.line_number): r.preview for r in release.malformed_lines(spark, paths).collect()}
    assert rows == {("Gene.txt", 3): bad[0], **{("Gene.txt", 5 + i): b[:200] for i, b in enumerate(bad[1:])},
                    ("Other.txt", 2): "x"}


def test_line_order_survives_many_splits(spark, tmp_path):
    # one file cut into many splits: ids must still follow line order
    folder = str(tmp_path / "compendia")
    n = 3000
    write_lines(folder, "Gene.txt", [record("biolink:Gene", [{"i": f"G:{k:05d}", "l": "x" * 200}])
                                     for k in range(n)])
    write_lines(str(tmp_path / "conflation"), "GeneProtein.txt", [""])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        recs = release.read_compendia(spark, release.compendia_paths(spark, str(tmp_path)))
        assert recs.rdd.getNumPartitions() > 5
        from conceptnorm.operators.normalize import number_records
        rows = number_records(recs, scan_order=True).select(
            "clique_id", recs["identifiers"][0]["i"].alias("c")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.clique_id, r.c) for r in rows)
    assert got == [(k + 1, f"G:{k:05d}") for k in range(n)]


def test_written_lines_verbatim(spark, tmp_path):
    df = spark.createDataFrame([("['A:1', 'A:2']",), ('["B:1"]',)], "value string")
    out = str(tmp_path / "kept")
    release.write_lines(df, out)
    back = sorted(r.value for r in spark.read.text(out).collect())
    assert back == sorted(["['A:1', 'A:2']", '["B:1"]'])


def test_sample_release_reads(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    recs = release.read_compendia(spark, release.compendia_paths(spark, root))
    assert recs.count() == 6
    assert {r.file_name for r in recs.select("file_name").distinct().collect()} == {
        "OrganismTaxon.txt", "Gene.txt", "Protein.txt"}


def test_profile_is_one_scan_and_agrees_with_the_single_checks(spark, tmp_path):
    folder = tmp_path / "compendia"
    folder.mkdir()
    good = '{"type":"T","ic":null,"identifiers":[{"i":"A:1"}],"preferred_name":"a","taxa":[]}'
    (folder / "A.txt").write_text(f"\n{good}\n   \n[1,2]\n{good[:20]}\n{good} xyz\n{good.replace('T', 'U', 1)}\n")
    (folder / "B.txt").write_text('{"type":1,"other":2}\n{bad\n')
    (folder / "C.txt").write_text(f"{{bad\n{good}\n")
    paths = release.compendia_paths(spark, str(tmp_path))
    found = release.profile(spark, paths)
    got = {r["file_name"]: r.asDict() for r in found.collect()}
    assert {k: (r["n_records"], r["n_malformed"], r["first_type"], r["n_types"], r["missing"]) for k, r in got.items()} == {
        "A.txt": (5, 3, "T", 2, ""), "B.txt": (2, 1, "1", 1, "ic,identifiers,preferred_name,taxa"), "C.txt": (2, 1, None, 1, "")}
    assert got["B.txt"]["present"] == "other,type"
    malformed = {r["file_name"]: r["count"] for r in release.malformed_lines(spark, paths).groupBy("file_name").count().collect()}
    assert malformed == {k: r["n_malformed"] for k, r in got.items()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
