"""Data-quality audits and profiles.

The relational constraints a row store enforces on insert are, on Spark,
operators that return the violating rows (or their counts). Each audit is a
grouped count or an anti join: partial aggregation before the shuffle, so a
hot key costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptnorm.plans.vocabulary import Vocabulary


def row_counts(tables: dict[str, DataFrame], spark=None) -> DataFrame:
    """(table_name, row_count) for every table (no tables: no rows;
    pass ``spark`` for that case)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, parts)


def pretty_counts(counts: DataFrame) -> DataFrame:
    """D7 display form: counts with thousands separators."""
    return counts.select("table_name", F.format_number("row_count", 0).alias("row_count"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once, with their count ``n``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def duplicate_sample(df: DataFrame, keys: list[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` duplicated keys (HAVING ... LIMIT 10)."""
    return duplicates(df, keys).orderBy(*keys).limit(limit)


def orphans(child: DataFrame, child_col: str, parent: DataFrame,
            parent_col: str = "id") -> DataFrame:
    """D3: child rows whose foreign key has no parent row."""
    keys = parent.select(F.col(parent_col).alias(child_col))
    return child.where(F.col(child_col).isNotNull()).join(keys, child_col, "left_anti")


def violations(df: DataFrame, bad: Column) -> DataFrame:
    """Rows failing a CHECK / NOT NULL predicate."""
    return df.where(bad)


def canonical_count_violations(conflation_members: DataFrame) -> DataFrame:
    """Clusters whose number of canonical members is not exactly one."""
    return (conflation_members.groupBy("cluster_id")
            .agg(F.sum("is_canonical").alias("n_canonical"))
            .where(F.col("n_canonical") != 1))


def empty_records(records: DataFrame) -> DataFrame:
    """D5 on input: records with no identifiers."""
    return records.where(F.coalesce(F.size("identifiers"), F.lit(0)) <= 0)


def memberless_cliques(v: Vocabulary) -> DataFrame:
    """D5 on a store: cliques with no membership row."""
    return v.cliques.join(v.identifiers_cliques.select(F.col("clique_id").alias("id")),
                          "id", "left_anti")


def checks(v: Vocabulary) -> dict[str, DataFrame]:
    """Every constraint of the store as a frame of violating rows."""
    return {
        "unique_types_curie": duplicates(v.types, ["curie"]),
        "unique_identifiers_curie": duplicates(v.identifiers, ["curie"]),
        "unique_cliques_primary_type": duplicates(v.cliques, ["primary_identifier_id", "type_id"]),
        "unique_identifiers_taxa": duplicates(v.identifiers_taxa,
                                              ["identifier_id", "taxa_identifier_id"]),
        "unique_conflation_members": duplicates(v.conflation_members,
                                                ["cluster_id", "identifier_id"]),
        "fk_cliques_primary": orphans(v.cliques, "primary_identifier_id", v.identifiers),
        "fk_cliques_type": orphans(v.cliques, "type_id", v.types),
        "fk_idesc_description": orphans(v.identifiers_descriptions, "description_id",
                                        v.descriptions),
        "fk_idesc_identifier": orphans(v.identifiers_descriptions, "identifier_id", v.identifiers),
        "fk_icliques_identifier": orphans(v.identifiers_cliques, "identifier_id", v.identifiers),
        "fk_icliques_clique": orphans(v.identifiers_cliques, "clique_id", v.cliques),
        "fk_itaxa_identifier": orphans(v.identifiers_taxa, "identifier_id", v.identifiers),
        "fk_itaxa_taxon": orphans(v.identifiers_taxa, "taxa_identifier_id", v.identifiers),
        "fk_members_cluster": orphans(v.conflation_members, "cluster_id", v.conflation_clusters),
        "fk_members_identifier": orphans(v.conflation_members, "identifier_id", v.identifiers),
        "check_conflation_type": violations(v.conflation_clusters,
                                            ~F.coalesce(F.col("type").isin(1, 2), F.lit(False))),
        "check_is_canonical": violations(v.conflation_members,
                                         ~F.coalesce(F.col("is_canonical").isin(0, 1),
                                                     F.lit(False))),
        "not_null_identifiers_curie": violations(v.identifiers, F.col("curie").isNull()),
        "not_null_cliques_columns": violations(
            v.cliques, F.col("primary_identifier_id").isNull() | F.col("type_id").isNull()
            | F.col("preferred_name").isNull()),
        "not_null_descriptions_desc": violations(v.descriptions, F.col("desc").isNull()),
        "empty_cliques": memberless_cliques(v),
        "one_canonical_per_cluster": canonical_count_violations(v.conflation_members),
    }


def report(v: Vocabulary) -> DataFrame:
    """D1-D6 summary: (check_name, violations) with one row per constraint."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
               .select(F.lit(name).alias("check_name"), "violations")
             for name, df in checks(v).items()]
    return reduce(DataFrame.unionByName, parts)


def assert_clean(v: Vocabulary) -> None:
    """Strict mode: raise naming every violated constraint (run as an
    explicit action before a store is written)."""
    bad = [r["check_name"] for r in report(v).where(F.col("violations") > 0).collect()]
    if bad:
        raise ValueError(f"constraint violations: {', '.join(bad)}")
