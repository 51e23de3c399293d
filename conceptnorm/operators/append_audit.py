"""D1-D6 of an append: its rows audited before they are written.

A full audit reads every table of the store. Rows that an append adds can only break a constraint
among themselves or with the stored rows that have their keys, so only those are read: a Bloom
filter of the append's keys is a filter on each store scan, before any exchange.

``rows`` is what ``append.new_rows`` gives: a frame per table; tables that get no rows may lack.
Violations that the store had before and that no new row takes part in are not listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptnorm.operators import audit
from conceptnorm.operators.keys import possibly_among
from conceptnorm.plans.vocabulary import Vocabulary

# table -> columns that are unique together, the first one the most selective
UNIQUE = {"types": ["curie"], "identifiers": ["curie"], "cliques": ["primary_identifier_id", "type_id"],
          "identifiers_taxa": ["identifier_id", "taxa_identifier_id"],
          "conflation_members": ["identifier_id", "cluster_id"]}
# check -> (child table, column, parent table)
FOREIGN = {"fk_cliques_primary": ("cliques", "primary_identifier_id", "identifiers"),
           "fk_cliques_type": ("cliques", "type_id", "types"),
           "fk_idesc_description": ("identifiers_descriptions", "description_id", "descriptions"),
           "fk_idesc_identifier": ("identifiers_descriptions", "identifier_id", "identifiers"),
           "fk_icliques_identifier": ("identifiers_cliques", "identifier_id", "identifiers"),
           "fk_icliques_clique": ("identifiers_cliques", "clique_id", "cliques"),
           "fk_itaxa_identifier": ("identifiers_taxa", "identifier_id", "identifiers"),
           "fk_itaxa_taxon": ("identifiers_taxa", "taxa_identifier_id", "identifiers"),
           "fk_members_cluster": ("conflation_members", "cluster_id", "conflation_clusters"),
           "fk_members_identifier": ("conflation_members", "identifier_id", "identifiers")}


def _stored(store: Vocabulary, table: str, column: str, keys: DataFrame, key_column: str | None = None) -> DataFrame:
    """The stored rows of a table whose ``column`` may be among the keys."""
    return possibly_among(getattr(store, table), column, keys, key_column)


def unique_violations(store: Vocabulary, rows: DataFrame, table: str) -> DataFrame:
    """The keys of new rows that occur more than once, in them or with the store's."""
    keys = UNIQUE[table]
    new = rows.select(*keys)
    old = _stored(store, table, keys[0], new).select(*keys).join(new.distinct(), keys, "left_semi")
    return audit.duplicates(new.unionByName(old), keys).select(*keys)


def orphan_rows(store: Vocabulary, rows: dict[str, DataFrame], check: str) -> DataFrame:
    """D3: new rows whose key has a parent neither in the store nor among the new rows."""
    table, column, parent = FOREIGN[check]
    parents = _stored(store, parent, "id", rows[table], column).select("id")
    if parent in rows:
        parents = parents.unionByName(rows[parent].select("id"))
    return audit.orphans(rows[table], column, parents)


def empty_cliques(store: Vocabulary, rows: dict[str, DataFrame]) -> DataFrame:
    """New cliques without a member."""
    held = _stored(store, "identifiers_cliques", "clique_id", rows["cliques"], "id").select("clique_id")
    if "identifiers_cliques" in rows:
        held = held.unionByName(rows["identifiers_cliques"].select("clique_id"))
    return rows["cliques"].join(held.select(F.col("clique_id").alias("id")), "id", "left_anti")


def canonical_violations(store: Vocabulary, members: DataFrame) -> DataFrame:
    """Clusters that get members and then have not exactly one canonical."""
    touched = members.select("cluster_id").distinct()
    old = _stored(store, "conflation_members", "cluster_id", touched).join(touched, "cluster_id", "left_semi")
    both = members.select("cluster_id", "is_canonical").unionByName(old.select("cluster_id", "is_canonical"))
    return audit.canonical_count_violations(both)


def checks(store: Vocabulary, rows: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, list[str]]]:
    """Each constraint that the append can break: its violating rows and their key columns."""
    out: dict[str, tuple[DataFrame, list[str]]] = {}
    for table, keys in UNIQUE.items():
        if table in rows:
            name = "primary_type" if table == "cliques" else "curie" if keys == ["curie"] else ""
            out["_".join(x for x in ("unique", table, name) if x)] = (unique_violations(store, rows[table], table), keys)
    for check, (table, column, _) in FOREIGN.items():
        if table in rows:
            out[check] = (orphan_rows(store, rows, check), [column])
    if "identifiers" in rows:
        out["not_null_identifiers_curie"] = (audit.violations(rows["identifiers"], F.col("curie").isNull()), ["id"])
    if "cliques" in rows:
        bad = F.col("primary_identifier_id").isNull() | F.col("type_id").isNull() | F.col("preferred_name").isNull()
        out["not_null_cliques_columns"] = (audit.violations(rows["cliques"], bad), ["id"])
        out["empty_cliques"] = (empty_cliques(store, rows), ["id"])
    if "descriptions" in rows:
        out["not_null_descriptions_desc"] = (audit.violations(rows["descriptions"], F.col("desc").isNull()), ["id"])
    if "conflation_clusters" in rows:
        bad = ~F.coalesce(F.col("type").isin(1, 2), F.lit(False))
        out["check_conflation_type"] = (audit.violations(rows["conflation_clusters"], bad), ["id"])
    if "conflation_members" in rows:
        members = rows["conflation_members"]
        bad = ~F.coalesce(F.col("is_canonical").isin(0, 1), F.lit(False))
        out["check_is_canonical"] = (audit.violations(members, bad), ["cluster_id", "identifier_id"])
        out["one_canonical_per_cluster"] = (canonical_violations(store, members), ["cluster_id"])
    return out


def violations(store: Vocabulary, rows: dict[str, DataFrame]) -> DataFrame:
    """(check_name, row_key): every violation that the append would bring, its key columns joined
    by commas."""
    parts = [df.select(F.lit(name).alias("check_name"),
                       F.concat_ws(",", *(F.col(k).cast("string") for k in keys)).alias("row_key"))
             for name, (df, keys) in checks(store, rows).items()]
    return reduce(DataFrame.unionByName, parts)
