"""Registered queries: one per operator family, over whole driver tables.

Every query reads the driver's tables through the release mapping
(``sources.fixtures``) so its work grows with them. Lookup inputs are whole
columns (every identifier, every cluster member, every order line, every
part name), never subsets. The built store is cached per session and data
directory, so the registered queries share one ingest.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptnorm.operators import append_audit, audit, conflate, lookup, names, ordered
from conceptnorm.plans.vocabulary import Vocabulary, max_id
from conceptnorm.operators.keys import staging_scope
from conceptnorm.session import configure, drop_paths, scratch_path, session_key
from conceptnorm.sources import fixtures as fx
from conceptnorm.sources import release

_STORES: dict[tuple[str, str, tuple[str, ...]], Vocabulary] = {}
_LOCK = threading.RLock()

# fixed parameters of the sampling query
SAMPLE_SIZE = 100
SAMPLE_SEED = 42


def vocabulary(spark: SparkSession, sf_dir: str,
               files: tuple[str, ...] = fx.COMPENDIA_FILES) -> Vocabulary:
    """The store of the release mapped from ``sf_dir`` (cached per session).

    The whole release takes the production path: written once as files,
    ingested from the files, the store written as Parquet to the shared
    checkpoint folder and opened read-only. A subset of compendia files
    (curation and append scenarios) is built in memory.
    """
    configure(spark)
    key = (session_key(spark), sf_dir, files)
    with _LOCK:                       # concurrent callers share one build
        return _build_store(spark, sf_dir, files, key)


def _build_store(spark: SparkSession, sf_dir: str, files: tuple[str, ...], key) -> Vocabulary:
    if key not in _STORES:
        types = fx.types_from_tables(spark, sf_dir)
        if files == fx.COMPENDIA_FILES:
            root = release.write_fixture_release(spark, sf_dir)
            path = scratch_path(spark, "store")
            with staging_scope() as staged:
                built = release.load_release(spark, root, types_vocab=types, materialize=False)
                built.write(path)
            drop_paths(spark, staged)     # the written store no longer needs them
            _STORES[key] = Vocabulary.load(spark, path)
        else:
            recs = fx.compendia_records(spark, sf_dir, files)
            # clusters may have members that the subset lacks: those are left out and listed
            _STORES[key] = Vocabulary.build(recs, fx.conflation_lines(spark, sf_dir), types, strict=False)
    return _STORES[key]


def _all_identifiers(v: Vocabulary) -> DataFrame:
    return v.identifiers.select("curie")


# -- B: normalization ------------------------------------------------------

def members_exploded(spark, sf_dir):
    recs = fx.compendia_records(spark, sf_dir)
    rows = recs.select("file_name", "row_in_split", F.posexplode("identifiers").alias("pos", "m"),
                       F.col("identifiers")[0]["i"].alias("primary_curie"))
    return rows.select("file_name", F.col("row_in_split").alias("record_key"),
                       F.col("pos").alias("member_pos"), F.col("m.i").alias("curie"),
                       F.col("m.l").alias("label"), "primary_curie")


def identifiers_first_label(spark, sf_dir):
    return vocabulary(spark, sf_dir).identifiers.select("id", "curie", "label")


def cliques_table(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return (v.cliques
            .join(v.identifiers.select(F.col("id").alias("primary_identifier_id"),
                                       F.col("curie").alias("primary_curie")),
                  "primary_identifier_id")
            .join(v.types.select(F.col("id").alias("type_id"), F.col("curie").alias("type_curie")),
                  "type_id")
            .select(F.col("id").alias("clique_id"), "primary_curie", "type_curie", "ic",
                    "preferred_name"))


def membership_table(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return (v.identifiers_cliques
            .join(v.identifiers.select(F.col("id").alias("identifier_id"),
                                       F.col("curie").alias("member_curie")), "identifier_id")
            .select("member_curie", "clique_id"))


def taxon_links(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    ids = v.identifiers
    return (v.identifiers_taxa
            .join(ids.select(F.col("id").alias("identifier_id"), "curie"), "identifier_id")
            .join(ids.select(F.col("id").alias("taxa_identifier_id"),
                             F.col("curie").alias("taxon_curie")), "taxa_identifier_id")
            .select("curie", "taxon_curie"))


def descriptions_table(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return (v.descriptions.withColumnRenamed("id", "description_id")
            .join(v.identifiers_descriptions, "description_id")
            .join(v.identifiers.select(F.col("id").alias("identifier_id"), "curie"),
                  "identifier_id")
            .select("description_id", "curie", F.col("desc").alias("description")))


def types_table(spark, sf_dir):
    return vocabulary(spark, sf_dir).types.select("id", "curie")


def table_row_counts(spark, sf_dir):
    return audit.row_counts(vocabulary(spark, sf_dir).tables())


# -- E: lookups ------------------------------------------------------------

def preferred_bulk(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return lookup.preferred(v, _all_identifiers(v))


def _first_key(spark, sf_dir, table: str, key: str, prefix: str) -> str:
    """The CURIE of a table's least key (one scalar from the table)."""
    return fx.table(spark, sf_dir, table).agg(
        fx.curie(prefix, F.min(key)).alias("c")).first()["c"]


def preferred_one(spark, sf_dir):
    """E1 for one CURIE (the least supplier): a filter pushed to the scan."""
    v = vocabulary(spark, sf_dir)
    return lookup.preferred_for(v, [_first_key(spark, sf_dir, "supplier", "s_suppkey", "SUPP:")])


def edges_normalized(spark, sf_dir):
    """Every order line as a customer->part edge, both ends normalized."""
    v = vocabulary(spark, sf_dir)
    edges = (fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
             .join(fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                             "o_custkey"), "l_orderkey")
             .select("l_orderkey", "l_linenumber",
                     fx.curie("CUST:", "o_custkey").alias("subject_curie"),
                     fx.curie("PART:", "l_partkey").alias("object_curie")))
    subj = lookup.preferred(v, edges, "subject_curie").select(
        "l_orderkey", "l_linenumber", "object_curie",
        F.col("input_curie").alias("subject_curie"),
        F.col("preferred_curie").alias("subject_preferred"),
        F.col("type_curie").alias("subject_type"))
    both = lookup.preferred(v, subj, "object_curie")
    return both.select("l_orderkey", "l_linenumber", "subject_curie", "subject_preferred",
                       "subject_type", F.col("input_curie").alias("object_curie"),
                       F.col("preferred_curie").alias("object_preferred"),
                       F.col("type_curie").alias("object_type"))


def conflation_clusters_resolved(spark, sf_dir):
    cw = vocabulary(spark, sf_dir).conflation_wide
    return cw.select("cluster_id", "conflation_type", "member_curie",
                     F.col("pos").alias("member_pos"), "is_canonical")


def conflation_bulk(spark, sf_dir):
    """E4 for every member of every cluster. Clusters keep their size at any
    scale, so the result grows as the members do."""
    v = vocabulary(spark, sf_dir)
    return lookup.conflation(v, v.conflation_wide.select(F.col("member_curie").alias("curie")).distinct())


def conflation_factored(spark, sf_dir):
    """E4 for every customer as links and members: each cluster's members once."""
    v = vocabulary(spark, sf_dir)
    inputs = fx.table(spark, sf_dir, "customer").select(fx.curie("CUST:", "c_custkey").alias("curie"))
    links = lookup.conflation_links(v, inputs)
    none = {"is_canonical": "int", "conflation_type_id": "int"}
    return (links.select(F.lit("link").alias("kind"), "cluster_id", F.col("query_curie").alias("curie"),
                         *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
            .unionByName(lookup.conflation_members(v, links).select(
                F.lit("member").alias("kind"), "cluster_id", F.col("member_curie").alias("curie"),
                F.col("member_is_canonical").alias("is_canonical"), "conflation_type_id")))


def conflation_one(spark, sf_dir):
    """E3 for one CURIE (the least customer), GeneProtein clusters only."""
    v = vocabulary(spark, sf_dir)
    return lookup.conflation_for(v, _first_key(spark, sf_dir, "customer", "c_custkey", "CUST:"),
                                 "GeneProtein")


def preferred_cliques(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    primaries = lookup.cliques_wide(v).select(F.col("primary_curie").alias("curie")).distinct()
    return lookup.preferred_cliques(v, primaries)


def any_cliques(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return lookup.any_cliques(v, _all_identifiers(v))


def synonyms(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return lookup.synonyms(v, _all_identifiers(v))


def taxon(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return lookup.taxon(v, _all_identifiers(v))


def label(spark, sf_dir):
    """Labels of every customer's gene and Ensembl CURIE (most of the latter
    are unknown, giving NULL)."""
    v = vocabulary(spark, sf_dir)
    cust = fx.table(spark, sf_dir, "customer")
    inputs = (cust.select(fx.curie("CUST:", "c_custkey").alias("curie"))
              .unionByName(cust.select(fx.curie("ENS:", "c_custkey").alias("curie"))))
    return lookup.label(v, inputs)


def all_names(spark, sf_dir):
    """E10 for every identifier."""
    v = vocabulary(spark, sf_dir)
    return lookup.all_names(v, _all_identifiers(v))


def categories(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return lookup.categories(v, _all_identifiers(v))


def all_names_ordered(spark, sf_dir):
    """E10 for every identifier, each one's names in NOCASE order."""
    v = vocabulary(spark, sf_dir)
    return ordered.all_names(v, _all_identifiers(v))


def categories_ordered(spark, sf_dir):
    """E11 for every identifier, each one's categories in NOCASE order."""
    v = vocabulary(spark, sf_dir)
    return ordered.categories(v, _all_identifiers(v))


def query_names(spark, sf_dir) -> DataFrame:
    """Every part name as typed, pluralized, with a trailing note, upper-cased
    and reversed (the last resolves to nothing); every customer name with an
    abbreviation inside and with a note that has one of its own."""
    p = fx.table(spark, sf_dir, "part").select("p_name")
    forms = [F.col("p_name"), F.concat("p_name", F.lit("s")),
             F.concat("p_name", F.lit(" (abc def)")), F.upper("p_name"), F.reverse("p_name")]
    out = None
    for f in forms:
        d = p.select(f.alias("name"))
        out = d if out is None else out.unionByName(d)
    c = fx.table(spark, sf_dir, "customer").select("c_name")
    return (out.unionByName(c.select(F.replace("c_name", F.lit("#"), F.lit(" (AB1)#")).alias("name")))
            .unionByName(c.select(F.concat("c_name", F.lit(" (of 1 (see 2) or 3)")).alias("name"))))


def name_variants(spark, sf_dir):
    return names.variants(query_names(spark, sf_dir))


def name_to_curie(spark, sf_dir):
    return names.name_to_curie(vocabulary(spark, sf_dir), query_names(spark, sf_dir))


def sample_identifiers(spark, sf_dir):
    return lookup.sample_identifiers(vocabulary(spark, sf_dir), SAMPLE_SIZE, SAMPLE_SEED)


def sample_third(spark, sf_dir):
    """E13 for a third of all identifiers."""
    v = vocabulary(spark, sf_dir)
    return lookup.sample_identifiers(v, v.identifiers.count() // 3, SAMPLE_SEED)


def ids_to_curies(spark, sf_dir):
    """Every order key used as an identifier id (ids past the end miss)."""
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return lookup.ids_to_curies(vocabulary(spark, sf_dir), orders)


# -- C: conflation curation ------------------------------------------------

def conflation_missing(spark, sf_dir):
    """C5 against a store loaded without the gene compendium: every
    GeneProtein cluster references absent CURIEs."""
    files = tuple(f for f in fx.COMPENDIA_FILES if f != "Gene.txt")
    v = vocabulary(spark, sf_dir, files)
    parsed = conflate.parse_lines(fx.conflation_lines(spark, sf_dir))
    resolved = conflate.resolve(conflate.cluster_members(parsed), v.identifiers)
    report = conflate.missing_report(resolved)
    canon = resolved.where(F.col("pos") == 0).select("cluster_id",
                                                     F.col("curie").alias("canonical_curie"))
    return (report.join(canon, "cluster_id")
                  .select("canonical_curie", "canonical_missing", "n_missing",
                          F.array_join("first_missing", " ").alias("first_missing")))


def _filter_flags(spark, sf_dir):
    subset = ("OrganismTaxon.txt", "Gene.txt")
    valid = conflate.valid_curies(fx.compendia_records(spark, sf_dir, subset))
    parsed = conflate.parse_lines(fx.conflation_lines(spark, sf_dir))
    return conflate.filter_clusters(parsed, valid)


def clusters_filtered(spark, sf_dir):
    """Clusters fully inside the taxon+gene compendia subset."""
    flags = _filter_flags(spark, sf_dir)
    return flags.select(F.element_at("members", 1).alias("canonical_curie"),
                        "conflation_type", F.size("members").alias("n_members"), "kept")


def cluster_filter_stats(spark, sf_dir):
    return conflate.filter_stats(_filter_flags(spark, sf_dir))


def kept_cluster_lines(spark, sf_dir):
    """Kept clusters' original lines, verbatim."""
    return _filter_flags(spark, sf_dir).where("kept").select("value")


def curie_harvest(spark, sf_dir):
    return conflate.harvest_curies(fx.compendia_records(spark, sf_dir))


def curie_harvest_any(spark, sf_dir):
    """C10 over lines whose keys and depth no schema knows."""
    return conflate.harvest_any(fx.nested_lines(spark, sf_dir))


# -- D: audits --------------------------------------------------------------

def audit_report(spark, sf_dir):
    return audit.report(vocabulary(spark, sf_dir))


def audit_append(spark, sf_dir):
    """D1-D6 of an append, by its own keys: what it would break, row by row."""
    v = vocabulary(spark, sf_dir)
    return append_audit.violations(v, fx.faulty_append(spark, sf_dir, v))


def max_ids(spark, sf_dir):
    """D9 of each table that has ids, of the written store."""
    tables = vocabulary(spark, sf_dir).tables()
    out = [max_id(tables[name]).select(F.lit(name).alias("table_name"), "max_id") for name in sorted(tables) if "id" in tables[name].columns]
    return reduce(DataFrame.unionByName, out)


def _reappended(spark, sf_dir):
    """The release with the supplier compendium appended a second time."""
    recs = fx.compendia_records(spark, sf_dir)
    again = fx.supplier_records(spark, sf_dir).withColumn("file_ord", F.lit(5))
    return recs.unionByName(again)


def audit_unique_reappend(spark, sf_dir):
    rows = _reappended(spark, sf_dir).select(
        F.col("identifiers")[0]["i"].alias("primary_curie"), F.col("type").alias("type_curie"))
    return audit.duplicates(rows, ["primary_curie", "type_curie"])


def duplicate_primary_type(spark, sf_dir):
    rows = _reappended(spark, sf_dir).select(
        F.col("identifiers")[0]["i"].alias("primary_curie"), F.col("type").alias("type_curie"))
    return audit.duplicate_sample(rows, ["primary_curie", "type_curie"], 10)


# -- A: files ----------------------------------------------------------------

def _written_release(spark, sf_dir) -> str:
    return release.write_fixture_release(spark, sf_dir)


def file_type_profile(spark, sf_dir):
    root = _written_release(spark, sf_dir)
    return release.type_profile(spark, release.compendia_paths(spark, root))


def required_columns(spark, sf_dir):
    root = _written_release(spark, sf_dir)
    return release.required_columns(spark, release.compendia_paths(spark, root))


def release_manifest(spark, sf_dir):
    """A3/A4: the written release listed and selected (load order, notes);
    byte sizes stay in ``release.manifest`` (they depend on the writer)."""
    root = _written_release(spark, sf_dir)
    return (release.selected_compendia(release.manifest(spark, f"{root}/compendia"))
            .select("file_name", "selected", "file_ord", "note"))


def odd_release(spark, sf_dir):
    """A4, A7, A8, D7, D8 of a folder with shards, a foreign name, missing keys
    and faulty lines: what is selected, and the profile of what is read."""
    folder = f"{scratch_path(spark, 'odd')}/compendia"
    for name, lines in fx.odd_release(spark, sf_dir).items():
        lines.orderBy("line_key").select("value").write.text(f"{folder}/{name}")
    chosen = release.selected_compendia(release.list_entries(spark, folder)).select("file_name", "selected", "file_ord", "note")
    profile = release.profile(spark, release.compendia_paths(spark, folder.removesuffix("/compendia")))
    return chosen.join(profile, "file_name", "left")


def ingest_from_files(spark, sf_dir):
    """A1/A2/A5: the whole store loaded from written JSON-lines/list files;
    returns the identifiers (same rows as ``identifiers_first_label``)."""
    root = _written_release(spark, sf_dir)
    v = release.load_release(spark, root)
    return v.identifiers.select("id", "curie", "label")


def append_new_identifiers(spark, sf_dir):
    """A10: a store of the first three compendia written to disk, then the
    supplier file appended there: every identifier with whether the append
    added it."""
    from conceptnorm.operators.append import append_to_store
    base = vocabulary(spark, sf_dir, fx.COMPENDIA_FILES[:3])
    path = scratch_path(spark, "append-store")
    base.write(path)
    added = append_to_store(spark, path, fx.supplier_records(spark, sf_dir))
    old = base.identifiers.select("curie", F.lit(False).alias("is_new"))
    return (added.identifiers.join(old, "curie", "left")
            .select("curie", "label", F.coalesce("is_new", F.lit(True)).alias("is_new")))


def rejected_rows(spark, sf_dir):
    """What a lenient load leaves out, when neither the gene compendium nor
    the type of the suppliers is there: by file and line, with the reason."""
    files = tuple(f for f in fx.COMPENDIA_FILES if f != "Gene.txt")
    types = fx.types_from_tables(spark, sf_dir).where(F.col("curie") != "biolink:Drug")
    v = Vocabulary.build(fx.compendia_records(spark, sf_dir, files), fx.conflation_lines(spark, sf_dir),
                         types, strict=False)
    return v.rejected


def malformed_lines(spark, sf_dir):
    """A8 over a compendium in which four lines in seven are faulty."""
    root = scratch_path(spark, "faulty")
    (fx.faulty_lines(spark, sf_dir).orderBy("line_key").select("value")
       .write.text(f"{root}/compendia/SmallMolecule.txt"))
    return release.malformed_lines(spark, release.compendia_paths(spark, root))


def audit_violations(spark, sf_dir):
    """D1-D6 over a store that breaks every constraint."""
    return audit.report(Vocabulary.from_tables(fx.faulty_tables(spark, sf_dir)))


def rebuild_conflation(spark, sf_dir):
    """Open the written store, rebuild both conflation tables from the
    release's conflation files; the rebuilt clusters in natural keys."""
    from conceptnorm.operators.append import rebuild_conflation as rebuild
    root = _written_release(spark, sf_dir)
    rebuilt = rebuild(vocabulary(spark, sf_dir), release.read_conflation(spark, root))
    return rebuilt.conflation_wide.select("cluster_id", "conflation_type", "member_curie",
                                          F.col("pos").alias("member_pos"), "is_canonical")


def stream_append_identifiers(spark, sf_dir):
    """A10 as a stream: the release's compendia files picked up by a
    Structured Streaming query and appended micro-batch by micro-batch;
    the identifiers (CURIE, label) of the resulting store."""
    from conceptnorm.streaming.incremental import load_streamed, start_append_stream
    root = _written_release(spark, sf_dir)
    store, ckpt = scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt")
    query = start_append_stream(spark, f"{root}/compendia", store, ckpt,
                                fx.types_from_tables(spark, sf_dir), recursive=True)
    query.awaitTermination()
    return load_streamed(spark, store).identifiers.select("curie", "label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "members_exploded": members_exploded,
    "identifiers_first_label": identifiers_first_label,
    "cliques_table": cliques_table,
    "membership_table": membership_table,
    "taxon_links": taxon_links,
    "descriptions_table": descriptions_table,
    "types_table": types_table,
    "table_row_counts": table_row_counts,
    "preferred_bulk": preferred_bulk,
    "preferred_one": preferred_one,
    "edges_normalized": edges_normalized,
    "conflation_clusters_resolved": conflation_clusters_resolved,
    "conflation_bulk": conflation_bulk,
    "conflation_factored": conflation_factored,
    "conflation_one": conflation_one,
    "preferred_cliques": preferred_cliques,
    "any_cliques": any_cliques,
    "synonyms": synonyms,
    "taxon": taxon,
    "label": label,
    "all_names": all_names,
    "categories": categories,
    "all_names_ordered": all_names_ordered,
    "categories_ordered": categories_ordered,
    "name_variants": name_variants,
    "name_to_curie": name_to_curie,
    "sample_identifiers": sample_identifiers,
    "sample_third": sample_third,
    "ids_to_curies": ids_to_curies,
    "conflation_missing": conflation_missing,
    "clusters_filtered": clusters_filtered,
    "cluster_filter_stats": cluster_filter_stats,
    "kept_cluster_lines": kept_cluster_lines,
    "curie_harvest": curie_harvest,
    "curie_harvest_any": curie_harvest_any,
    "max_ids": max_ids,
    "audit_report": audit_report,
    "audit_violations": audit_violations,
    "audit_append": audit_append,
    "audit_unique_reappend": audit_unique_reappend,
    "duplicate_primary_type": duplicate_primary_type,
    "file_type_profile": file_type_profile,
    "required_columns": required_columns,
    "release_manifest": release_manifest,
    "odd_release": odd_release,
    "ingest_from_files": ingest_from_files,
    "append_new_identifiers": append_new_identifiers,
    "rejected_rows": rejected_rows,
    "malformed_lines": malformed_lines,
    "rebuild_conflation": rebuild_conflation,
    "stream_append_identifiers": stream_append_identifiers,
}

