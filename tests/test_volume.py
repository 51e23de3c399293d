"""What an ingest moves and writes: each row once, however large the input is judged."""

import glob

import pytest
from pyspark.sql import functions as F

from conceptnorm.operators.keys import dense_ids_by_split
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.sources import fixtures as fx
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, write_sample_release


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large(spark):
    """A session that takes every table for too large to be broadcast unasked."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("whole", [True, False])
def test_numbering_by_split_does_not_join_by_exchange(large, whole):
    rows = large.createDataFrame([(f, "p", s, 100 * s + r, f"{f}{s}{r}") for f in (2, 1) for s in (0, 7) for r in (1, 2, 3)],
                                 "file_ord int, file_path string, split_start bigint, row_in_split bigint, v string")
    out = dense_ids_by_split(rows, "id", whole_splits=whole)
    assert "SortMergeJoin" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
    assert [r.v for r in out.orderBy("id").collect()] == [f"{f}{s}{r}" for f in (1, 2) for s in (0, 7) for r in (1, 2, 3)]
    assert [r.id for r in out.orderBy("id").collect()] == list(range(1, 13))


def test_materialized_views_are_columnar(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    store = release.load_release(spark, root, types_vocab=spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string"))
    for df in (store.membership_wide, store.conflation_wide):
        assert "FileScan parquet" in _plan(df) and "ExistingRDD" not in _plan(df)


def test_texts_of_a_built_store_equal_its_description_tables(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    built = release.load_release(spark, root, types_vocab=spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string"))
    built.write(str(tmp_path / "store"))
    for store in (built, Vocabulary.load(spark, str(tmp_path / "store"))):
        joined = store.identifiers_descriptions.join(store.descriptions.withColumnRenamed("id", "description_id"), "description_id")
        want = {(r.identifier_id, r.description_id, r.desc) for r in joined.collect()}
        assert {(r.identifier_id, r.description_id, r.description) for r in store.described().collect()} == want
        assert {w[2] for w in want} == {"first desc", "second desc"}


def _tables(spark, root):
    spark.createDataFrame([(0, "a", "T", 1), (1, "b", "T", 2)], "p_partkey bigint, p_name string, p_type string, p_size int").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(0, "d0"), (1, None), (2, "d2")], "doc_id bigint, text string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, 5), (0, 3), (0, 5), (0, None), (1, 3), (None, 3)], "l_partkey bigint, l_suppkey bigint").write.parquet(f"{root}/lineitem.parquet")
    return root


def test_parts_group_their_suppliers_in_one_exchange(spark, tmp_path):
    recs = fx.part_records(spark, _tables(spark, str(tmp_path)))
    assert not any("l_suppkey" in x.split("hashpartitioning(", 1)[1].split(")")[0] for x in _plan(recs).splitlines() if "hashpartitioning(" in x)
    got = {r.preferred_name: [m.i for m in r.identifiers] for r in recs.collect()}
    assert got == {"a": ["PART:0", "SUPP:3", "SUPP:5"], "b": ["PART:1", "SUPP:3"]}


def test_written_records_are_compressed(spark, tmp_path):
    recs = fx.part_records(spark, _tables(spark, str(tmp_path / "in")))
    lines = spark.createDataFrame([("DrugChemical.txt", 1, '["PART:0"]')], "file_name string, row_in_split int, value string")
    root = release.write_release(recs, lines, str(tmp_path / "out"))
    parts = glob.glob(f"{root}/compendia/*/part-*")
    assert parts and all(p.endswith(".json.gz") for p in parts)
    back = release.read_compendia(spark, release.compendia_paths(spark, root))
    key = F.to_json(F.struct("type", "ic", "identifiers", "preferred_name", "taxa")).alias("x")
    assert sorted(r.x for r in back.select(key).collect()) == sorted(r.x for r in recs.select(key).collect())


def test_a_task_takes_no_more_than_32_mb_of_an_exchange(spark):
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
