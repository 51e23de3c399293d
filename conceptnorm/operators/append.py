"""Incremental store maintenance: append a compendium (A10), rebuild the
conflation tables in place (A11)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptnorm.operators import label_order
from conceptnorm.operators.conflate import normalize_conflation
from conceptnorm.operators.keys import max_id, possibly_among, stage
from conceptnorm.operators.normalize import CompendiaTables, ExistingStore, normalize_compendia
from conceptnorm.plans import layout
from conceptnorm.plans.vocabulary import Vocabulary

APPENDED = ("identifiers", "cliques", "descriptions", "identifiers_descriptions", "identifiers_cliques",
            "identifiers_taxa", "membership_wide", "cliques_wide")
CONFLATION = ("conflation_clusters", "conflation_members", "conflation_wide")


def new_rows(store: Vocabulary, records: DataFrame, strict: bool = True,
             scan_order: bool = False) -> tuple[dict[str, DataFrame], CompendiaTables]:
    """The rows that ``records`` add to each table of a store. Known
    identifiers keep id and label; new identifiers, cliques and descriptions
    get ids after the store's largest; a taxon link is new if the store lacks
    it. Appending a loaded record again duplicates (primary, type): run the
    D1 audit on the result."""
    last = max_id(store.identifiers)
    existing = ExistingStore(identifiers=store.identifiers, max_clique_id=max_id(store.cliques),
                             max_description_id=max_id(store.descriptions))
    new = normalize_compendia(records, store.types.select("curie"), strict=strict, existing=existing,
                              scan_order=scan_order, materialize=False)
    rows = {name: getattr(new, name) for name in APPENDED}
    rows["identifiers"] = new.identifiers.where(new.identifiers["id"] > last)
    links = stage(new.identifiers_taxa, "links")
    old = possibly_among(store.identifiers_taxa, "identifier_id", links.select("identifier_id").distinct())
    rows["identifiers_taxa"] = links.join(old, ["identifier_id", "taxa_identifier_id"], "left_anti")
    return rows, new


def append_compendia(store: Vocabulary, records: DataFrame, strict: bool = True) -> Vocabulary:
    """A10: the store with ``records`` appended, as frames."""
    rows, new = new_rows(store, records, strict)
    out = replace(store, **{name: getattr(store, name).unionByName(df) for name, df in rows.items()})
    out.rejected = new.rejected
    return out


def append_to_store(spark: SparkSession, path: str, records: DataFrame, strict: bool = True) -> Vocabulary:
    """A10 on disk: only the new rows are written, into the written store at
    ``path``. They are staged first, so no table is read while it grows."""
    rows, new = new_rows(Vocabulary.load(spark, path), records, strict)
    staged = {name: stage(df, f"append-{name}") for name, df in rows.items()}
    path = path.rstrip("/")
    bucketed = layout.layout(spark, path)
    for name, df in staged.items():
        if name in bucketed:
            layout.append_rows(df, path, name)
        else:
            df.write.mode("append").parquet(f"{path}/{name}")
    if layout.DESCRIPTIONS in bucketed:
        texts = staged["identifiers_descriptions"].join(staged["descriptions"].select(
            F.col("id").alias("description_id"), F.col("desc").alias("description")), "description_id")
        layout.append_rows(texts, path, layout.DESCRIPTIONS)
    label_order.append(staged["identifiers"], path)
    out = Vocabulary.load(spark, path)
    out.rejected = new.rejected
    return out


def rebuild_conflation(store: Vocabulary, lines: DataFrame, strict: bool = True,
                       scan_order: bool = False) -> Vocabulary:
    """Recompute both conflation tables against the stored identifiers;
    every other table is untouched."""
    conf = normalize_conflation(lines, store.identifiers, strict=strict, scan_order=scan_order)
    out = replace(store, **{name: getattr(conf, name) for name in CONFLATION})
    out.rejected = conf.rejected
    return out


def replace_conflation(spark: SparkSession, path: str, lines: DataFrame, strict: bool = True,
                       scan_order: bool = False) -> Vocabulary:
    """A11 on disk: overwrite the conflation tables (and their view) of the
    written store at ``path``; no other file is touched."""
    rebuilt = rebuild_conflation(Vocabulary.load(spark, path), lines, strict, scan_order)
    path = path.rstrip("/")
    found = layout.layout(spark, path)
    for name, df in [(name, stage(getattr(rebuilt, name), name)) for name in CONFLATION]:
        if name in found:
            buckets = found[name][0]
            heavy = layout.heavy_ids(df, layout.BUCKETED[name][1])
            heavy = heavy if heavy.head(1) else None
            layout.write_table(df, path, name, buckets, heavy)
            found[name] = (buckets, heavy is not None)
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
    if found:
        layout.write_layout(spark, path, [(name, *x) for name, x in found.items()])
    out = Vocabulary.load(spark, path)
    out.rejected = rebuilt.rejected
    return out
