"""Results in order (F8): names and categories as the single-key lookups list them.

A row-number per input would put an input that has a third of all rows into one task. So the rows
are range-sorted by (input, order keys) as a whole, which splits an input's rows over partitions,
and get a dense number there; a row's position is its number less the least one of its input,
which is combined map-side before anything moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptnorm.functions.scalars import nocase_order
from conceptnorm.operators import lookup
from conceptnorm.operators.keys import dense_ids
from conceptnorm.plans.vocabulary import Vocabulary


def positioned(df: DataFrame, group: str, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the place, from 1, of each row among those of its ``group`` (not NULL), by
    ``order``. Rows alike in all keys get neighbouring places in no defined order."""
    rows = dense_ids(df, [F.col(group), *order], id_col="_at")
    first = rows.groupBy(group).agg(F.min("_at").alias("_first"))
    return rows.join(first, group).withColumn(name, F.col("_at") - F.col("_first") + 1).drop("_at", "_first")


def all_names(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """E10 in NOCASE order: (curie, position, name), names that fold alike by code point."""
    found = lookup.all_names(vocab, inputs, col)
    return positioned(found, "curie", nocase_order("name")).select("curie", "position", "name")


def categories(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """E11 in NOCASE order: (curie, position, category)."""
    found = lookup.categories(vocab, inputs, col)
    return positioned(found, "curie", nocase_order("category")).select("curie", "position", "category")
