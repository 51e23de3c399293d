"""Compendia normalization (B1-B11): records -> relational tables.

One DAG instead of chunk-by-chunk inserts:

    records --dense clique ids (input order)--> recs (checkpointed)
    recs --posexplode--> members (clique_id, pos, curie, label, t)
    members --groupBy curie, first-seen label--> defined identifiers
    taxa refs --anti join--> unknown taxa; union -> dense ids by curie
    members x identifiers (shuffle on curie) -> memberships, taxon links
    recs --explode d--> descriptions (+ dense ids) and their links

Hot keys: an identifier that is a member of a third of all cliques only
reaches the shuffle after map-side partial aggregation (first label,
distinct taxa); in the member-to-id join the identifiers side is unique per
key, so AQE's skew-join split of the member side is safe.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptnorm.functions.scalars import nan_to_null
from conceptnorm.operators.keys import (bounded_broadcast, dense_ids, dense_ids_by_split, max_id,
                                        possibly_among, stage, submit)
from conceptnorm.schema import ORDER_KEY, UNKNOWN_TAXON_LABEL

# cliques whose description counts are summed in one window
CLIQUES_PER_BLOCK = 1 << 16
# distinct taxa above this many, or of too many bytes (operators.keys), are joined with a shuffle (AQE splits skew)
MAX_BROADCAST_TAXA = 5_000_000
# a type vocabulary larger than this is joined with a shuffle, not broadcast
MAX_BROADCAST_TYPES = 100_000


class LoadError(ValueError):
    """Strict-mode violation found while loading a release."""


@dataclass
class CompendiaTables:
    types: DataFrame
    identifiers: DataFrame
    cliques: DataFrame
    descriptions: DataFrame
    identifiers_descriptions: DataFrame
    identifiers_cliques: DataFrame
    identifiers_taxa: DataFrame
    # serving views: one row per membership / per clique with everything a
    # lookup needs
    membership_wide: DataFrame
    cliques_wide: DataFrame
    # (identifier_id, description_id, description)
    descriptions_wide: DataFrame
    # records that a lenient load has left out (a strict one raises)
    rejected: DataFrame


def number_records(records: DataFrame, start_after: int = 0,
                   scan_order: bool = False) -> DataFrame:
    """B6 key: 1-based clique ids in input order (file, part, split, row).

    ``scan_order``: rows come straight from the release readers, so ids are
    assigned per split without shuffling the records; otherwise the records
    are range-partitioned on the order key.
    """
    if scan_order:
        return dense_ids_by_split(records, "clique_id", start_after=start_after,
                                  whole_splits=True)
    return dense_ids(records, ORDER_KEY, "clique_id", start_after=start_after)


def explode_members(recs: DataFrame) -> DataFrame:
    """B1: one row per (clique, member position)."""
    return (recs.select("clique_id", F.posexplode("identifiers").alias("pos", "m"))
                .select("clique_id", "pos", F.col("m.i").alias("curie"),
                        F.col("m.l").alias("label"),
                        F.coalesce(F.col("m.t"), F.array().cast("array<string>")).alias("t")))


def first_seen_labels(members: DataFrame) -> DataFrame:
    """One row per CURIE with the label of its earliest occurrence.

    A NULL first label sticks; later labels never fill it in.
    """
    return (members.groupBy("curie")
                   .agg(F.min_by("label", F.struct("clique_id", "pos")).alias("label")))


def unknown_taxa(members: DataFrame, defined: DataFrame) -> DataFrame:
    """Taxon CURIEs referenced but never defined, labelled as unknown."""
    refs = members.select(F.explode("t").alias("curie")).distinct()
    return (refs.join(defined, "curie", "left_anti")
                .select("curie", F.lit(UNKNOWN_TAXON_LABEL).alias("label")))


def first_missing_taxon(members: DataFrame, known: DataFrame):
    """Strict B4: the undefined taxon referenced earliest (with its clique),
    or None. One bounded action (at most one row reaches the driver)."""
    refs = members.select("clique_id", F.explode("t").alias("curie"))
    missing = refs.join(known, "curie", "left_anti")
    return missing.orderBy("clique_id", "curie").limit(1).first()


def type_table(types_vocab: DataFrame) -> DataFrame:
    """Vocabulary with ids following the sorted CURIE order.

    The class vocabulary is small (hundreds of classes); once its size is
    proven, one ordered window numbers it. Larger inputs take the two-pass
    dense-id path."""
    vocab = types_vocab.select("curie").distinct()
    if vocab.limit(MAX_BROADCAST_TYPES + 1).count() <= MAX_BROADCAST_TYPES:
        # proven small: one ordered window over the vocabulary
        return vocab.select(F.row_number().over(Window.orderBy("curie")).cast("bigint").alias("id"),
                            "curie")
    return dense_ids(vocab, ["curie"], "id")


def n_descriptions(identifiers: Column | str) -> Column:
    """How many descriptions a record's members have."""
    return F.aggregate(identifiers, F.lit(0).cast("bigint"),
                       lambda acc, m: acc + F.coalesce(F.size(m["d"]), F.lit(0)))


def description_offsets(recs: DataFrame, start_after: int = 0) -> DataFrame:
    """(clique_id, desc_offset): how many descriptions come before a clique's
    first, for cliques that have any. Two levels of running sums: within
    blocks of cliques, and over the blocks (one row each)."""
    counts = recs.select("clique_id", n_descriptions("identifiers").alias("n")).where(F.col("n") > 0)
    counts = counts.withColumn("block", F.floor(F.col("clique_id") / CLIQUES_PER_BLOCK))
    before = Window.unboundedPreceding, -1
    blocks = counts.groupBy("block").agg(F.sum("n").alias("total"))
    blocks = blocks.select("block", F.coalesce(F.sum("total").over(
        Window.orderBy("block").rowsBetween(*before)), F.lit(0)).alias("block_offset"))
    within = F.sum("n").over(Window.partitionBy("block").orderBy("clique_id").rowsBetween(*before))
    return (counts.withColumn("within", F.coalesce(within, F.lit(0))).join(blocks, "block")
                  .select("clique_id", (F.col("block_offset") + F.col("within") + F.lit(start_after))
                          .cast("bigint").alias("desc_offset")))


def rejected_records(recs: DataFrame, types: DataFrame) -> DataFrame:
    """What a lenient load leaves out: (file_name, line_key, reason, value)
    of records without identifiers or with a type outside the vocabulary."""
    empty = F.coalesce(F.size("identifiers"), F.lit(0)) <= 0
    known = types.select(F.col("curie").alias("type"), F.lit(True).alias("_known"))
    reason = (F.when(empty, F.lit("no identifiers"))
               .when(F.col("_known").isNull(), F.concat(F.lit("type not in vocabulary: "),
                                                        F.coalesce("type", F.lit("")))))
    return (recs.join(known, "type", "left").withColumn("reason", reason)
                .where(F.col("reason").isNotNull())
                .select("file_name", F.col("row_in_split").alias("line_key"), "reason",
                        F.col("preferred_name").alias("value")))


def check_types(recs: DataFrame, types: DataFrame) -> DataFrame:
    """B10 audit: record types that are not in the vocabulary."""
    return (recs.select(F.col("type").alias("curie")).distinct()
                .join(types, "curie", "left_anti"))


@dataclass
class ExistingStore:
    """What an append needs from a store already written (A10)."""
    identifiers: DataFrame
    max_clique_id: int
    max_description_id: int = 0


def normalize_compendia(records: DataFrame, types_vocab: DataFrame,
                        strict: bool = True,
                        existing: ExistingStore | None = None,
                        scan_order: bool = False,
                        materialize: bool = True,
                        insert_missing_taxa: bool = True) -> CompendiaTables:
    """B1-B11. With ``existing`` the records are appended to a store: known
    identifiers keep their id and label, new ones get ids after the largest,
    and clique ids (hence description ids) continue after the store's."""
    # parse once: the records are staged as Parquet (split numbering then
    # reads four small columns) and every table below reads only the
    # (nested) columns it needs
    start = existing.max_clique_id if existing else 0
    def vocabulary_map():
        types = stage(type_table(types_vocab), "types")
        type_map = bounded_broadcast(
            types.select(F.col("curie").alias("type_curie"), F.col("id").alias("type_id")),
            MAX_BROADCAST_TYPES)
        return types, type_map

    with ThreadPoolExecutor(max_workers=1) as pool:   # independent jobs run together
        types_job = submit(pool, vocabulary_map)
        if scan_order:
            recs = number_records(stage(records, "records"), start, scan_order=True)
        else:
            recs = number_records(records, start)        # stages the sorted records
        types, type_map = types_job.result()
    if strict:
        bad = check_types(recs, types).limit(1).collect()
        if bad:
            raise LoadError(f"type not in vocabulary: {bad[0]['curie']}")
        empty = recs.where(F.coalesce(F.size("identifiers"), F.lit(0)) <= 0).limit(1).collect()
        if empty:
            raise LoadError("clique has no identifiers; preferred name: "
                            f"{empty[0]['preferred_name']}")
    # lenient: a record without identifiers or with a type outside the
    # vocabulary is left out whole (after numbering, so split ids stay exact)
    # and reported, keeping the store consistent
    rejected = rejected_records(recs, types)
    recs = (recs.where(F.size("identifiers") > 0)
                .join(type_map.select(F.col("type_curie").alias("type")), "type", "left_semi"))

    members = explode_members(recs)
    defined = first_seen_labels(members)
    if existing is not None:
        # of the store only what the batch can touch: a Bloom filter of its
        # CURIEs on the scan, before anything is exchanged
        touched = stage(defined.select("curie").unionByName(
            members.select(F.explode("t").alias("curie"))).distinct(), "touched")
        known = stage(possibly_among(existing.identifiers.select("id", "curie", "label"), "curie", touched), "known")
    if not insert_missing_taxa:
        there = defined.select("curie")
        if existing is not None:
            there = there.unionByName(known.select("curie"))
        first = first_missing_taxon(members, there)
        if first is not None:
            raise LoadError(f"taxon missing from identifiers (clique {first['clique_id']}): "
                            f"{first['curie']}")
    if existing is None:
        identifiers = dense_ids(defined.unionByName(unknown_taxa(members, defined)),
                                ["curie"], "id").select("id", "curie", "label")
    else:
        fresh = defined.join(known.select("curie"), "curie", "left_anti")
        missing_taxa = unknown_taxa(members, defined.select("curie")
                                    .unionByName(known.select("curie")))
        added = dense_ids(fresh.unionByName(missing_taxa), ["curie"], "id",
                          start_after=max_id(existing.identifiers)).select("id", "curie", "label")
        identifiers = known.unionByName(added)
    id_map = identifiers.select("curie", F.col("id").alias("identifier_id"))

    # the one big member -> id join, staged: memberships, taxon links and the
    # serving view all read it instead of repeating the shuffle
    with ThreadPoolExecutor(max_workers=2) as pool:
        member_job = submit(pool, stage, members.join(identifiers.select(
            "curie", F.col("id").alias("identifier_id"), F.col("label").alias("member_label")),
            "curie"), "members")
        # one taxon may be linked from a third of all members (e.g. human
        # genes): resolve the distinct taxa once and broadcast that map when
        # its size is proven small, so links never shuffle by (hot) taxon
        taxon_job = submit(pool, 
            bounded_broadcast,
            members.select(F.explode("t").alias("curie")).distinct()
                   .join(id_map.withColumnRenamed("identifier_id", "taxa_identifier_id"),
                         "curie"),
            MAX_BROADCAST_TAXA)
        member_ids, taxon_ids = member_job.result(), taxon_job.result()
    identifiers_cliques = member_ids.select("identifier_id", "clique_id")

    taxa_links = (member_ids.select("identifier_id", F.explode("t").alias("curie"))
                  .join(taxon_ids, "curie")
                  .select("identifier_id", "taxa_identifier_id"))
    identifiers_taxa = taxa_links.dropDuplicates()

    clique_rows = recs.select(
        "clique_id",
        F.get("identifiers", 0)["i"].alias("primary_curie"),
        nan_to_null(F.col("ic")).alias("ic"),
        F.col("type").alias("type_curie"),
        "preferred_name")
    cliques_wide = (clique_rows
                    .join(id_map.withColumnRenamed("curie", "primary_curie")
                                .withColumnRenamed("identifier_id", "primary_identifier_id"),
                          "primary_curie")
                    .join(type_map, "type_curie"))
    cliques = cliques_wide.select(F.col("clique_id").alias("id"), "primary_identifier_id",
                                  "ic", "type_id", "preferred_name")
    if strict:
        # the two UNIQUE constraints a load enforces: (primary, type) per
        # clique and (identifier, taxon) per link; lenient mode keeps the
        # cliques (audit D1 reports them) and de-duplicates the links
        dup = (clique_rows.groupBy("primary_curie", "type_curie").count()
               .where(F.col("count") > 1).limit(1).collect())
        if dup:
            raise LoadError(f"duplicate clique for ({dup[0]['primary_curie']}, "
                            f"{dup[0]['type_curie']})")
        dup = (taxa_links.groupBy("identifier_id", "taxa_identifier_id").count()
               .where(F.col("count") > 1).limit(1).collect())
        if dup:
            raise LoadError("duplicate taxon link for identifier id "
                            f"{dup[0]['identifier_id']}")

    # descriptions are numbered by clique, then by place within it (members in
    # order): the clique's offset plus the place
    desc_rows = (recs.select("clique_id", F.posexplode(F.flatten(F.transform(
                    "identifiers", lambda m: F.transform(
                        F.coalesce(m["d"], F.array().cast("array<string>")),
                        lambda d: F.struct(m["i"].alias("curie"), d.alias("desc")))))).alias("dpos", "x"))
                     .select("clique_id", "dpos", F.col("x.curie").alias("curie"),
                             F.col("x.desc").alias("desc")))
    offsets = description_offsets(recs, existing.max_description_id if existing else 0)
    desc_ids = desc_rows.join(offsets, "clique_id").withColumn(
        "description_id", (F.col("desc_offset") + F.col("dpos") + 1).cast("bigint"))
    descriptions = desc_ids.select(F.col("description_id").alias("id"), "desc")
    # ids are resolved without the texts, which then move once
    desc_links = desc_ids.select("clique_id", "dpos", "description_id", "curie").join(id_map, "curie")
    identifiers_descriptions = desc_links.select("description_id", "identifier_id")
    descriptions_wide = (desc_rows.select("clique_id", "dpos", F.col("desc").alias("description"))
                         .join(desc_links.select("clique_id", "dpos", "description_id", "identifier_id"), ["clique_id", "dpos"])
                         .select("identifier_id", "description_id", "description"))

    labelled = member_ids.select("clique_id", "pos", "curie", "member_label",
                                 F.col("identifier_id").alias("member_id"))
    membership_wide = (labelled.withColumnRenamed("curie", "member_curie")
                       .join(cliques_wide, "clique_id")
                       .select("member_curie", "member_id", "member_label", "clique_id", "pos",
                               "primary_curie", "primary_identifier_id", "type_curie",
                               "ic", "preferred_name"))
    if materialize:
        membership_wide = stage(membership_wide, "membership")

    return CompendiaTables(
        types=types.select("id", "curie"),
        identifiers=identifiers,
        cliques=cliques,
        descriptions=descriptions,
        identifiers_descriptions=identifiers_descriptions,
        identifiers_cliques=identifiers_cliques,
        identifiers_taxa=identifiers_taxa,
        membership_wide=membership_wide,
        cliques_wide=cliques_wide.select("clique_id", "primary_curie", "primary_identifier_id",
                                         "type_curie", "ic", "preferred_name"),
        descriptions_wide=descriptions_wide,
        rejected=rejected,
    )
