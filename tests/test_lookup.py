"""Lookups E1-E14 on hand-made stores (cases as the reference's tests)."""

import pytest
from pyspark.sql import functions as F

from conceptnorm.operators import lookup
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, store_from_rows, write_sample_release


@pytest.fixture(scope="module")
def ordering_store(spark):
    # three compounds, water a member of all three cliques (ids out of order)
    return store_from_rows(
        spark,
        types=[(1, "biolink:SmallMolecule")],
        identifiers=[(1, "CHEBI:1", "Compound A"), (2, "CHEBI:2", "Compound B"),
                     (3, "CHEBI:3", "Compound C"), (4, "MESH:D014867", "Water")],
        descriptions=[(1, "Desc A"), (2, "Desc B"), (3, "Desc C")],
        cliques=[(3, 3, 0.1, 1, "Compound C"), (1, 1, 0.9, 1, "Compound A"),
                 (2, 2, 0.5, 1, "Compound B")],
        identifiers_cliques=[(4, 3), (4, 1), (4, 2)],
        identifiers_descriptions=[(1, 1), (2, 2), (3, 3)])


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    root = write_sample_release(str(tmp_path_factory.mktemp("release")))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    return release.load_release(spark, root, types_vocab=types)


def one(spark, curie):
    return lookup.single(spark, curie)


def test_any_cliques_ordered_by_clique_id(spark, ordering_store):
    rows = (lookup.any_cliques(ordering_store, one(spark, "MESH:D014867"))
            .orderBy("clique_id", "identifier").collect())
    assert [r.identifier for r in rows] == ["CHEBI:1", "CHEBI:2", "CHEBI:3"]
    assert [r.description for r in rows] == ["Desc A", "Desc B", "Desc C"]
    assert [r.label for r in rows] == ["Compound A", "Compound B", "Compound C"]
    again = (lookup.any_cliques(ordering_store, one(spark, "MESH:D014867"))
             .orderBy("clique_id", "identifier").collect())
    assert again == rows                                   # repeatable


def test_preferred_cliques_description_fan_out(spark, ordering_store):
    rows = lookup.preferred_cliques(ordering_store, one(spark, "CHEBI:1")).collect()
    assert [(r.identifier, r.description, r.ic, r.type_curie) for r in rows] == [
        ("CHEBI:1", "Desc A", 0.9, "biolink:SmallMolecule")]
    nested = lookup.as_clique_info(lookup.preferred_cliques(ordering_store, one(spark, "CHEBI:1")))
    info = nested.first().clique
    assert info.id.identifier == "CHEBI:1" and info.type == ["biolink:SmallMolecule"]


def test_label_lookup(spark, ordering_store):
    rows = {r.curie: r.label for r in
            lookup.label(ordering_store, spark.createDataFrame(
                [("CHEBI:1",), ("NOPE:1",)], "curie string")).collect()}
    assert rows == {"CHEBI:1": "Compound A", "NOPE:1": None}


def test_preferred_repeats_inputs_and_skips_unknown(spark, sample):
    inputs = spark.createDataFrame([("G:4",), ("G:4",), ("XYZZY:1",)], "curie string")
    rows = lookup.preferred(sample, inputs).collect()
    assert sorted((r.preferred_curie, r.type_curie) for r in rows) == [
        ("G:4", "biolink:Gene"), ("G:4", "biolink:Gene"),
        ("P:1", "biolink:Protein"), ("P:1", "biolink:Protein")]


def test_conflation_includes_query_and_filters_type(spark, sample):
    rows = lookup.conflation(sample, one(spark, "G:4")).collect()
    assert sorted((r.query_curie, r.member_curie, r.member_is_canonical, r.conflation_type_id)
                  for r in rows) == [("G:4", "G:4", 0, 2), ("G:4", "P:1", 1, 2)]
    assert lookup.conflation_filtered(sample, one(spark, "G:4"), conflation_type="DrugChemical") \
        .count() == 0
    with pytest.raises(ValueError, match="invalid conflation type"):
        lookup.conflation_filtered(sample, one(spark, "G:4"), conflation_type="Nope")


def test_synonyms_taxon_label(spark, sample):
    syn = {r.synonym_curie for r in lookup.synonyms(sample, one(spark, "P:1")).collect()}
    assert syn == {"P:1", "G:4"}
    assert lookup.synonyms(sample, one(spark, "E:1")).count() == 0   # not a primary
    tax = {r.curie: r.taxon_curie for r in lookup.taxon(
        sample, spark.createDataFrame([("G:1",), ("G:2",), ("P:1",)], "curie string")).collect()}
    assert tax == {"G:1": "TX:1", "G:2": "TX:9", "P:1": None}


def test_all_names_and_categories(spark, sample):
    names = sorted(r.name for r in lookup.all_names(sample, one(spark, "P:1")).collect())
    assert names == ["gene four", "protein one"]
    cats = sorted(r.category for r in lookup.categories(sample, one(spark, "G:1")).collect())
    assert cats == ["biolink:Gene"]
    cats = sorted(r.category for r in lookup.categories(sample, one(spark, "P:1")).collect())
    assert cats == ["biolink:Gene", "biolink:Protein"]
    assert lookup.categories(sample, one(spark, "XYZZY:1")).count() == 0


def test_categories_through_cluster_mates(spark, ordering_store, sample):
    # E:1 heads no clique and is in clique 2 only; its mate G:1 brings nothing new,
    # but a mate in another type's clique does: P:1 (Protein) for G:4 (Gene)
    cats = sorted(r.category for r in lookup.categories(sample, one(spark, "G:4")).collect())
    assert cats == ["biolink:Gene", "biolink:Protein"]


def test_sample_and_ids(spark, sample):
    got = [r.curie for r in lookup.sample_identifiers(sample, 3, seed=7).collect()]
    assert len(got) == 3 and len(set(got)) == 3
    assert got == [r.curie for r in lookup.sample_identifiers(sample, 3, seed=7).collect()]
    lookup.check_sample_size(sample, 9)
    with pytest.raises(ValueError):
        lookup.check_sample_size(sample, 10)
    ids = spark.createDataFrame([(1,), (1,), (99,)], "id bigint")
    assert [(r.id, r.curie) for r in lookup.ids_to_curies(sample, ids).collect()] == [(1, "E:1")]


def test_unknown_inputs_give_nothing(spark, sample):
    x = one(spark, "XYZZY:1")
    for fn in (lookup.preferred, lookup.conflation, lookup.preferred_cliques,
               lookup.any_cliques, lookup.synonyms, lookup.all_names):
        assert fn(sample, x).count() == 0, fn.__name__
    assert lookup.label(sample, x).first().label is None
    assert sample.identifiers.where(F.col("curie") == "XYZZY:1").count() == 0


def test_literal_lookups_push_filters(spark, sample, tmp_path):
    from conceptnorm.plans.vocabulary import Vocabulary
    path = str(tmp_path / "store")
    sample.write(path)
    store = Vocabulary.load(spark, path)
    df = lookup.preferred_for(store, ["G:4", "XYZZY:1"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(member_curie" in plan
    assert sorted((r.input_curie, r.preferred_curie) for r in df.collect()) == [
        ("G:4", "G:4"), ("G:4", "P:1")]
    rows = lookup.conflation_for(store, "G:4", "GeneProtein").collect()
    assert sorted((r.member_curie, r.is_canonical) for r in rows) == [("G:4", 0), ("P:1", 1)]
    assert lookup.conflation_for(store, "G:4", "DrugChemical").count() == 0


def test_results_in_input_order(spark, sample):
    order = ["P:1", "G:1", "P:1", "TX:1", "XYZZY:1", "G:2"]
    inputs = lookup.numbered_inputs(spark.createDataFrame([(c,) for c in order], "curie string")
                                    .coalesce(1))
    rows = lookup.preferred(sample, inputs).orderBy("input_ord", "preferred_curie").collect()
    # P:1 heads one clique and is a member of another: two rows per input
    assert [r.input_curie for r in rows] == ["P:1", "P:1", "G:1", "P:1", "P:1", "TX:1", "G:2"]


def test_names_and_categories_of_a_primary_that_is_not_a_member(spark, ordering_store):
    # CHEBI:1 heads clique 1 but is not in the membership table of this store
    names = sorted(r.name for r in lookup.all_names(ordering_store, one(spark, "CHEBI:1")).collect())
    assert names == ["Compound A", "Water"]
    cats = [r.category for r in lookup.categories(ordering_store, one(spark, "CHEBI:1")).collect()]
    assert cats == ["biolink:SmallMolecule"]
    water = sorted(r.name for r in lookup.all_names(ordering_store,
                                                    one(spark, "MESH:D014867")).collect())
    assert water == ["Compound A", "Compound B", "Compound C", "Water"]
