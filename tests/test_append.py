"""Append (A10), conflation rebuild (A11) and the streaming append."""

import os

from pyspark.sql import functions as F

from conceptnorm.operators.append import append_compendia, rebuild_conflation
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.sources import release
from conceptnorm.streaming.incremental import load_streamed, start_append_stream
from helpers import SAMPLE_COMPENDIA, SAMPLE_TYPES, write_lines, write_sample_release


def _types(spark):
    return spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")


def test_append_keeps_existing_ids_and_labels(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    paths = release.compendia_paths(spark, root)
    base_paths = [p for p in paths if p[0] != "Protein.txt"]
    new_paths = [p for p in paths if p[0] == "Protein.txt"]
    base = Vocabulary.build(release.read_compendia(spark, base_paths), None, _types(spark))
    before = {r.curie: (r.id, r.label) for r in base.identifiers.collect()}
    after = append_compendia(base, release.read_compendia(spark, new_paths))
    now = {r.curie: (r.id, r.label) for r in after.identifiers.collect()}
    assert all(now[c] == before[c] for c in before)          # nothing renumbered or relabelled
    assert set(now) == set(before)                          # P:1 and G:4 were already known
    assert now["P:1"][1] is None
    cliques = after.cliques_wide.orderBy("clique_id").collect()
    assert [r.primary_curie for r in cliques][-1] == "P:1"
    assert [r.clique_id for r in cliques] == list(range(1, 7))
    assert after.identifiers_cliques.count() == 9


def test_append_new_identifier_gets_next_id(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    base = release.load_release(spark, root, types_vocab=_types(spark))
    write_lines(str(tmp_path / "more"), "Gene.txt",
                ['{"type": "biolink:Gene", "ic": null, "identifiers": [{"i": "AAA:1", "l": "new"}],'
                 ' "preferred_name": "new", "taxa": []}'])
    extra = release.read_compendia(spark, [("Gene.txt", 1, str(tmp_path / "more" / "Gene.txt"))])
    after = append_compendia(base, extra)
    row = after.identifiers.where(F.col("curie") == "AAA:1").first()
    assert (row.id, row.label) == (10, "new")


def test_rebuild_conflation_replaces_only_conflation(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    store = release.load_release(spark, root, types_vocab=_types(spark))
    lines = spark.createDataFrame(
        [("GeneProtein.txt", 2, 1, "GeneProtein.txt", 0, 0, '["G:2", "G:3"]')],
        "file_name string, conflation_type int, file_ord int, file_path string, "
        "split_start bigint, row_in_split bigint, value string")
    rebuilt = rebuild_conflation(store, lines)
    assert [(r.member_curie, r.is_canonical) for r in
            rebuilt.conflation_wide.orderBy("pos").collect()] == [("G:2", 1), ("G:3", 0)]
    assert rebuilt.identifiers is store.identifiers


def test_streaming_append_matches_batch(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / d) for d in ("incoming", "store", "ckpt"))
    os.makedirs(src)
    write_lines(src, "a_Gene.txt", SAMPLE_COMPENDIA["OrganismTaxon.txt"] + SAMPLE_COMPENDIA["Gene.txt"])
    q = start_append_stream(spark, src, store, ckpt, _types(spark))
    q.awaitTermination()
    first = load_streamed(spark, store)
    assert first.cliques.count() == 5
    write_lines(src, "b_Protein.txt", SAMPLE_COMPENDIA["Protein.txt"])
    q = start_append_stream(spark, src, store, ckpt, _types(spark))
    q.awaitTermination()
    done = load_streamed(spark, store)
    labels = {r.curie: r.label for r in done.identifiers.collect()}
    assert len(labels) == 9 and labels["P:1"] is None and labels["TX:8"] == "unknown taxon"
    assert done.cliques.count() == 6 and done.identifiers_cliques.count() == 9
    ids = [r.id for r in done.identifiers.collect()]
    assert sorted(ids) == list(range(1, 10))
    assert [r.primary_curie for r in done.cliques_wide.orderBy("clique_id").collect()] == \
        ["TX:1", "G:1", "G:2", "G:3", "G:4", "P:1"]
