"""Property tests: variant invariants, lookup containment, audit sensitivity."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from conceptnorm.functions.names import name_variants
from conceptnorm.operators import lookup
from conceptnorm.sources import release
from helpers import SAMPLE_TYPES, write_sample_release

ALPHABET = st.sampled_from(list("abcXYZ ()s\t") + ["ies", "ss", " (IL6)"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=20))
def test_variant_invariants(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for row in df.select("name", name_variants("name").alias("v")).collect():
        v = row.v
        assert len(v) == len(set(v))                                  # distinct
        assert all(x and x == x.strip() and "  " not in x and "\t" not in x for x in v)
        first = re.sub(r"\s+", " ", row.name).strip()
        assert (v[0] == first) if first else (v == [])                # the name comes first
        assert all(x.count("(") <= row.name.count("(") for x in v)    # stripping only removes


def test_bulk_contains_single_and_conflation_contains_filtered(spark, tmp_path):
    root = write_sample_release(str(tmp_path))
    types = spark.createDataFrame([(t,) for t in SAMPLE_TYPES], "curie string")
    store = release.load_release(spark, root, types_vocab=types)
    every = store.identifiers.select("curie")
    bulk = {tuple(r) for r in lookup.preferred(store, every).collect()}
    for c in [r.curie for r in every.collect()]:
        one = {tuple(r) for r in lookup.preferred(store, lookup.single(spark, c)).collect()}
        assert one <= bulk
        e4 = {(r.member_curie, r.member_is_canonical)
              for r in lookup.conflation(store, lookup.single(spark, c)).collect()}
        e3 = {(r.member_curie, r.is_canonical) for r in lookup.conflation_filtered(
            store, lookup.single(spark, c), conflation_type="GeneProtein").collect()}
        assert e3 <= e4
