"""Ids over blank and invalid lines, file matching, staging scopes, shared folders, appends on disk."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from conceptnorm import session
from conceptnorm.operators import audit, keys, lookup
from conceptnorm.operators.append import append_to_store, replace_conflation
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, record, store_from_rows, write_lines, write_sample_release


def gappy_release(root: str) -> str:
    """Blank and invalid lines between clusters, in two files of several splits."""
    drugs, genes = [f"A:{i}" for i in range(400)], [f"G:{i}" for i in range(300)]
    write_lines(f"{root}/compendia", "Gene.txt", [record("biolink:Gene", [{"i": c, "l": c}]) for c in drugs + genes])
    lines = []
    for i, c in enumerate(drugs):
        lines += [f'["{c}"]'] + [""] * (i % 3) + (["not a list"] if i % 50 == 7 else []) + ["\t"] * (i % 2)
    write_lines(f"{root}/conflation", "DrugChemical.txt", lines)
    write_lines(f"{root}/conflation", "GeneProtein.txt", ["", *[f'["{c}"]' for c in genes]])
    return root


def test_cluster_ids_are_dense_over_gaps(spark, tmp_path):
    root = gappy_release(str(tmp_path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        v = release.load_release(spark, root, strict=False)
        rows = v.conflation_wide.orderBy("cluster_id").collect()
        assert [r.cluster_id for r in rows] == list(range(1, 701))
        assert [r.member_curie for r in rows] == [f"A:{i}" for i in range(400)] + [f"G:{i}" for i in range(300)]
        assert audit.canonical_count_violations(v.conflation_members).count() == 0
        assert [r.member_curie for r in lookup.conflation_for(v, "A:2").collect()] == ["A:2"]
        assert {r.reason for r in v.rejected.collect()} == {"not a list of CURIEs"}
        with pytest.raises(ValueError, match="not a list"):
            release.load_release(spark, root)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("form", ["file://{}", "file:{}", "{}/../{name}/.", "{}//"])
def test_any_spelling_of_a_path_reads_the_same(spark, tmp_path, form):
    folder = tmp_path / "a release+50% é.txt"
    root = write_sample_release(str(folder))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    v = release.load_release(spark, form.format(root, name=folder.name), types_vocab=types)
    assert v.identifiers.count() == 9 and v.conflation_members.count() == 4


def test_scopes_of_concurrent_builds_are_their_own(spark):
    def build(name):
        with keys.staging_scope() as paths:
            with ThreadPoolExecutor(2) as pool:
                for f in [keys.submit(pool, keys.stage, spark.range(3), f"{name}{i}") for i in range(3)]:
                    f.result()
            return paths

    with ThreadPoolExecutor(2) as pool:
        a, b = (pool.submit(build, n) for n in "xy")
        assert len(a.result()) == len(b.result()) == 3 and not set(a.result()) & set(b.result())


def test_no_machine_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session._local_checkpoint_root(master)


def test_settings_of_the_user_stay(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "7m")
    session.configure(spark)
    assert spark.conf.get(key) == "7m"
    spark.conf.set(key, old)


def test_repeated_literal_inputs_are_repeated(spark):
    v = store_from_rows(spark, types=[(1, "t")], identifiers=[(1, "A:1", None)], cliques=[(1, 1, None, 1, "x")],
                        identifiers_cliques=[(1, 1)])
    assert lookup.preferred_for(v, ["A:1", "A:1", "B:1"]).count() == 2


def test_append_and_replace_on_disk(spark, tmp_path):
    root, path = write_sample_release(str(tmp_path / "r")), str(tmp_path / "store")
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    release.load_release(spark, root, types_vocab=types).write(path)
    write_lines(str(tmp_path / "more" / "compendia"), "Gene.txt",
                [record("biolink:Gene", [{"i": "G:9", "l": "nine", "d": ["third"], "t": ["TX:1"]}, {"i": "G:1", "t": ["TX:1"]}])])
    more = release.read_compendia(spark, release.compendia_paths(spark, str(tmp_path / "more")))
    v = append_to_store(spark, path, more)
    assert v.identifiers.count() == 10 and v.cliques.count() == 7
    assert [r.id for r in v.descriptions.orderBy("id").collect()] == [1, 2, 3]
    assert {r.check_name for r in audit.report(v).collect() if r.violations} == set()
    write_lines(str(tmp_path / "c" / "conflation"), "GeneProtein.txt", ['["G:9","G:2"]'])
    v = replace_conflation(spark, path, release.read_conflation(spark, str(tmp_path / "c")))
    assert [(r.cluster_id, r.member_curie) for r in v.conflation_wide.orderBy("pos").collect()] == [(1, "G:9"), (1, "G:2")]
    assert Vocabulary.load(spark, path).identifiers.count() == 10


def test_file_named_otherwise_takes_the_callers_type(spark, tmp_path):
    write_lines(str(tmp_path / "conflation"), "DrugChemical-test.txt", ['["A:1"]'])
    with pytest.raises(ValueError, match="unknown conflation file"):
        release.read_conflation(spark, str(tmp_path))
    row = release.read_conflation(spark, str(tmp_path), {"DrugChemical-test.txt": "DrugChemical"}).first()
    assert row.conflation_type == 1


def test_stream_epochs_agree_with_a_batch(spark, tmp_path):
    from conceptnorm.streaming.incremental import append_batch, load_streamed
    store = str(tmp_path / "stream")
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    first = [record("biolink:Gene", [{"i": "G:1", "l": "one", "t": ["T:1"]}])]
    second = [record("biolink:OrganismTaxon", [{"i": "T:1", "l": "taxon"}]),
              record("biolink:Gene", [{"i": "G:2", "l": "two"}, {"i": "G:1", "t": ["T:1"]}]),
              record("biolink:Other", [{"i": "O:1"}], name="lost")]
    for epoch, lines in enumerate((first, second, second[:0])):
        folder = tmp_path / f"e{epoch}"
        write_lines(str(folder / "compendia"), "Gene.txt", lines or [""])
        for _ in range(2):          # a replay writes the same rows
            append_batch(release.read_compendia(spark, release.compendia_paths(spark, str(folder))), epoch, store, types)
    v = load_streamed(spark, store)
    assert {r.curie: r.label for r in v.identifiers.collect()} == {"G:1": "one", "G:2": "two", "T:1": "taxon"}
    assert v.identifiers_taxa.count() == 1
    assert {r.member_label for r in v.membership_wide.where("member_curie = 'T:1'").collect()} == {"taxon"}
    assert [r.reason for r in spark.read.parquet(f"{store}/rejected").collect()] == ["type not in vocabulary: biolink:Other"]
