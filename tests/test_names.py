"""Name variants (F1-F5) and name -> identifier."""

import pytest

from conceptnorm.functions.names import name_variants, singular
from conceptnorm.operators import names
from helpers import store_from_rows

VARIANT_CASES = [
    ("Foo (a) (b)", ["Foo (a) (b)", "Foo (a)", "Foo"]),
    ("Foo (a (b))", ["Foo (a (b))", "Foo"]),
    ("Foo (IL6) bars", ["Foo (IL6) bars", "Foo bars", "Foo (IL6) bar", "Foo bar"]),
    ("glass", ["glass"]),
    ("dies", ["dies"]),
    ("a b)", ["a b)"]),
    ("Aspirin (pain reliever)", ["Aspirin (pain reliever)", "Aspirin"]),
    ("   Aspirin   ", ["Aspirin"]),
    ("Therapies", ["Therapies", "Therapy"]),
    ("x ((a)", ["x ((a)", "x ("]),
    ("(a)", ["(a)"]),
    ("ab\t (cd)  ", ["ab (cd)", "ab"]),
    ("", []),
]


def test_variants(spark):
    df = spark.createDataFrame([(n,) for n, _ in VARIANT_CASES], "name string")
    got = {r.name: r.v for r in df.select("name", name_variants("name").alias("v")).collect()}
    for name, expected in VARIANT_CASES:
        assert got[name] == expected, name


def test_singular_rules(spark):
    cases = {"Therapies": "Therapy", "ties": None, "big ties": "big tie", "glass": None,
             "cats": None,
             "big cats": "big cat", "dogs of war": None, "many dogs": "many dog",
             "ab ies": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.x for r in df.select("s", singular("s").alias("x")).collect()}
    assert got == cases


@pytest.fixture(scope="module")
def store(spark):
    return store_from_rows(spark, identifiers=[
        (1, "CHEBI:15365", "Aspirin"), (2, "MESH:D014409", "Interleukin 6 receptor"),
        (3, "CHEBI:9754", "Therapy"), (4, "X:1", "abcdef"), (5, "PMID:12345", "Pmidexclusive label")])


RESOLVE = {
    "Aspi": ("CHEBI:15365", "Aspirin"), "Aspirin": ("CHEBI:15365", "Aspirin"),
    "aspirin": ("CHEBI:15365", "Aspirin"), "   Aspirin   ": ("CHEBI:15365", "Aspirin"),
    "Aspirin (pain reliever)": ("CHEBI:15365", "Aspirin"),
    "Aspirins": ("CHEBI:15365", "Aspirin"),
    "Interleukin 6 (IL6) receptor": ("MESH:D014409", "Interleukin 6 receptor"),
    "Therapies": ("CHEBI:9754", "Therapy"), "abc": ("X:1", "abcdef"),
    "ab%f": (None, None), "a_c": (None, None), "Pmidexclusive": (None, None),
    "Zzz nonexistent substance": (None, None),
}


def test_name_to_curie(spark, store):
    inputs = spark.createDataFrame([(n,) for n in RESOLVE], "name string")
    got = {r.name: (r.curie, r.label) for r in names.name_to_curie(store, inputs).collect()}
    assert got == RESOLVE


def test_name_tie_break_is_folded_label_then_curie(spark):
    s = store_from_rows(spark, identifiers=[(1, "B:2", "alpha beta"), (2, "A:1", "Alpha"),
                                            (3, "C:3", "alpha")])
    inputs = spark.createDataFrame([("alp",)], "name string")
    row = names.name_to_curie(s, inputs).first()
    # folded labels "alpha" tie; the exact label "Alpha" sorts before "alpha"
    assert (row.curie, row.label) == ("A:1", "Alpha")


def test_earlier_variant_wins_over_better_label(spark):
    s = store_from_rows(spark, identifiers=[(1, "A:1", "aaa cats"), (2, "B:1", "aaa cat food")])
    inputs = spark.createDataFrame([("aaa cats",)], "name string")
    assert names.name_to_curie(s, inputs).first().curie == "A:1"
