"""Driver tables -> a release: compendia records and conflation lines.

The mapping (FIXTURES.md section 3) makes a release whose size grows with the
tables, so every operator can run at scale and be checked against DuckDB:

* ``OrganismTaxon.txt`` one taxon record per nation;
* ``Gene.txt`` one record per customer, plus an unlabelled ``ENS:`` secondary
  member for every third customer; its taxon is its nation, for every fifth
  customer its market segment, which no file defines (the unknown-taxon rule);
* ``MolecularMixture.txt`` one record per part; secondary members are the
  distinct suppliers of its order lines (unlabelled); the part's descriptions
  are the full texts of documents ``2k`` and ``2k+1``;
* ``SmallMolecule.txt`` one record per supplier (labelled, but after the
  unlabelled first sighting above, so first-seen labels stay NULL);
* ``DrugChemical.txt`` one cluster per four consecutive parts and the supplier
  of that number; ``GeneProtein.txt`` one per three consecutive customers and,
  where its number divides by seven, the part of that number, so some clusters
  are mixed over files. Clusters keep their size at any scale. Every fifth line
  repeats its canonical member at its end; a blank line follows every eleventh.

File names sort in load order; the taxon file is loaded first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptnorm.schema import CONFLATION_TYPE_IDS

# Fixed file names of the derived release, in load order.
COMPENDIA_FILES = ("OrganismTaxon.txt", "Gene.txt", "MolecularMixture.txt",
                   "SmallMolecule.txt")
CONFLATION_FILES = ("DrugChemical.txt", "GeneProtein.txt")
# ids of appended rows start after these
AGAIN, NEW = 10**12, 2 * 10**12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def curie(prefix: str, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), key.cast("string"))


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def member(i: Column, label: Column | None = None, d: Column | None = None,
           t: Column | None = None) -> Column:
    return F.struct(
        i.alias("i"),
        (label if label is not None else F.lit(None).cast("string")).alias("l"),
        (d if d is not None else _no_strings()).alias("d"),
        (t if t is not None else _no_strings()).alias("t"))


def _record(df: DataFrame, file_name: str, file_ord: int, key: str,
            type_: Column, ic: Column, identifiers: Column, name: Column,
            taxa: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(file_name).alias("file_name"),
        F.lit(file_ord).alias("file_ord"),
        F.lit(file_name).alias("file_path"),
        F.lit(0).cast("bigint").alias("split_start"),
        F.col(key).cast("bigint").alias("row_in_split"),
        type_.alias("type"),
        ic.cast("double").alias("ic"),
        identifiers.alias("identifiers"),
        name.alias("preferred_name"),
        (taxa if taxa is not None else _no_strings()).alias("taxa"))


def taxon_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return _record(nation, COMPENDIA_FILES[0], 1, "n_nationkey",
                   F.lit("biolink:OrganismTaxon"), F.lit(None),
                   F.array(member(curie("TAXON:", "n_nationkey"), F.col("n_name"))),
                   F.col("n_name"))


def gene_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    taxa = F.array(F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("TAXON:"), "c_mktsegment"))
                   .otherwise(curie("TAXON:", "c_nationkey")))
    primary = member(curie("CUST:", "c_custkey"), F.col("c_name"), t=taxa)
    ens = member(curie("ENS:", "c_custkey"))
    ids = F.when(F.col("c_custkey") % 3 == 0, F.array(primary, ens)).otherwise(F.array(primary))
    ic = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal") / 100)
    return _record(customer, COMPENDIA_FILES[1], 2, "c_custkey", F.lit("biolink:Gene"),
                   ic, ids, F.col("c_name"), taxa)


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    docs = (table(spark, sf_dir, "documents")
            .select(F.floor(F.col("doc_id") / 2).cast("bigint").alias("p_partkey"),
                    F.struct("doc_id", "text").alias("doc"))
            .groupBy("p_partkey")                      # two documents per part
            .agg(F.array_sort(F.collect_list("doc")).alias("docs"))
            .select("p_partkey", F.transform("docs", lambda x: x["text"]).alias("d")))
    supps = (table(spark, sf_dir, "lineitem")
             .select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
             .repartition("p_partkey")      # the pairs move once, and aren't held twice
             .groupBy("p_partkey")          # a record's member list, as the format holds it
             .agg(F.array_sort(F.collect_set("l_suppkey")).alias("supps")))
    joined = part.join(docs, "p_partkey", "left").join(supps, "p_partkey", "left")
    primary = member(curie("PART:", "p_partkey"), F.col("p_name"),
                     F.coalesce(F.col("d"), _no_strings()))
    others = F.transform(F.coalesce(F.col("supps"), F.array().cast("array<bigint>")),
                         lambda s: member(curie("SUPP:", s)))
    return _record(joined, COMPENDIA_FILES[2], 3, "p_partkey",
                   F.concat(F.lit("biolink:"), F.col("p_type")),
                   F.col("p_size"), F.concat(F.array(primary), others), F.col("p_name"))


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return _record(supplier, COMPENDIA_FILES[3], 4, "s_suppkey", F.lit("biolink:Drug"),
                   F.lit(None), F.array(member(curie("SUPP:", "s_suppkey"), F.col("s_name"))),
                   F.col("s_name"))


def compendia_records(spark: SparkSession, sf_dir: str,
                      files: tuple[str, ...] = COMPENDIA_FILES) -> DataFrame:
    """Records of the chosen compendia files (all four by default)."""
    builders = {COMPENDIA_FILES[0]: taxon_records, COMPENDIA_FILES[1]: gene_records,
                COMPENDIA_FILES[2]: part_records, COMPENDIA_FILES[3]: supplier_records}
    frames = [builders[f](spark, sf_dir) for f in files]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _cluster_lines(members: DataFrame, file_name: str, file_ord: int) -> DataFrame:
    # a line is one list; clusters have a handful of members at any scale
    own = F.transform(F.array_sort(F.collect_list(F.struct("ord", "key", "curie"))), lambda x: x["curie"])
    lines = members.groupBy("cluster").agg(own.alias("own"))
    value = F.when(F.col("cluster") % 5 == 0, F.concat("own", F.slice("own", 1, 1))).otherwise(F.col("own"))
    text = F.to_json(value)
    written = F.when(F.col("cluster") % 11 == 0, F.array(text, F.lit(""))).otherwise(F.array(text))
    return lines.select("cluster", F.posexplode(written).alias("n", "value")).select(
        F.lit(file_name).alias("file_name"),
        F.lit(CONFLATION_TYPE_IDS[file_name.removesuffix(".txt")]).alias("conflation_type"),
        F.lit(file_ord).alias("file_ord"),
        F.lit(file_name).alias("file_path"),
        F.lit(0).cast("bigint").alias("split_start"),
        (2 * F.col("cluster") + F.col("n")).cast("bigint").alias("row_in_split"),
        "value")


def _cluster_members(df: DataFrame, prefix: str, key: str, cluster: Column, ord_: int) -> DataFrame:
    return df.select(cluster.cast("bigint").alias("cluster"), F.lit(ord_).alias("ord"),
                     F.col(key).cast("bigint").alias("key"), curie(prefix, key).alias("curie"))


def conflation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list-literal line per cluster, as the conflation files hold them."""
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    drug = (_cluster_members(part, "PART:", "p_partkey", F.floor(F.col("p_partkey") / 4), 0)
            .unionByName(_cluster_members(table(spark, sf_dir, "supplier"), "SUPP:", "s_suppkey",
                                          F.col("s_suppkey"), 1)))
    mixed = part.where(F.col("p_partkey") % 7 == 0).join(
        customer.select(F.floor(F.col("c_custkey") / 3).alias("p_partkey")).distinct(), "p_partkey", "left_semi")
    gene = (_cluster_members(customer, "CUST:", "c_custkey", F.floor(F.col("c_custkey") / 3), 0)
            .unionByName(_cluster_members(mixed, "PART:", "p_partkey", F.col("p_partkey"), 1)))
    return (_cluster_lines(drug, CONFLATION_FILES[0], 1)
            .unionByName(_cluster_lines(gene, CONFLATION_FILES[1], 2)))


def types_vocabulary(records: DataFrame) -> DataFrame:
    """The class vocabulary a release is loaded against (distinct types)."""
    return records.select(F.col("type").alias("curie")).distinct()


def types_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vocabulary read from the tables directly (part types only
    need the part table): what a loader receives as its class list."""
    fixed = spark.createDataFrame([("biolink:OrganismTaxon",), ("biolink:Gene",),
                                   ("biolink:Drug",)], "curie string")
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("biolink:"), F.col("p_type")).alias("curie"))
    return fixed.unionByName(parts).distinct()


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): a record line per customer with keys that the format doesn't
    have, CURIEs under them at several depths, CURIEs as keys, and in every
    third line one more object around it; a blank line after every fifth."""
    k = F.col("c_custkey").cast("string")
    inner = F.concat(
        F.lit('{"type":"biolink:Gene","identifiers":[{"i":"CUST:'), k, F.lit('","xrefs":{"same":["ENS:'), k,
        F.lit('",{"deep":[["ORD:'), k, F.lit('",7,null,true],"a b: no CURIE"]}]}}],"KEY:'), k,
        F.lit('":{"ref":"NATION:'), F.col("c_nationkey").cast("string"), F.lit('","n":'), k,
        F.lit('},"seg\\u006dent":"SEG\\u003a'), F.col("c_mktsegment"), F.lit('","name":"'), F.col("c_name"), F.lit('"}'))
    line = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('{"wrapped":[{"more":'), inner, F.lit('},"WRAP:'), k, F.lit('"]}'))).otherwise(inner)
    lines = F.when(F.col("c_custkey") % 5 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    return table(spark, sf_dir, "customer").select(F.explode(lines).alias("value"))


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_key, value): a compendium line per supplier, four in seven of them faulty (cut short,
    followed by text, not a record, of a wrong type); a blank line after every fifth."""
    k = F.col("s_suppkey")
    good = F.concat(F.lit('{"type":"biolink:Drug","ic":null,"identifiers":[{"i":"SUPP:'), k.cast("string"),
                    F.lit('"}],"preferred_name":"'), F.col("s_name"), F.lit('","taxa":[]}'))
    value = (F.when(k % 7 == 0, F.left(good, F.lit(30))).when(k % 7 == 1, F.concat(good, F.lit(" xyz")))
             .when(k % 7 == 2, F.lit("[1,2]")).when(k % 7 == 3, F.replace(good, F.lit('"ic":null'), F.lit('"ic":"abc"')))
             .otherwise(good))
    lines = F.when(k % 5 == 0, F.array(value, F.lit(""))).otherwise(F.array(value))
    return (table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(lines).alias("n", "value"))
            .select((2 * k + F.col("n")).alias("line_key"), "value"))


def odd_release(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Entries of a compendia folder that a load can't take as they are, as (line_key, value): a file
    beside its two shards, a foreign name, a file without ``taxa`` and mostly without ``ic``, and one whose
    odd lines lack a type and whose every fifth is cut short."""
    def lines(name: str, key: str, label: str, kind, prefix: str, taxa=F.lit(',"taxa":[]'), ic=F.lit(',"ic":null'), where=None):
        k = F.col(key)
        value = F.concat(F.lit('{"identifiers":[{"i":"'), F.lit(prefix), k.cast("string"), F.lit('"}],"preferred_name":"'),
                         F.col(label), F.lit('"'), ic, taxa, kind, F.lit("}"))
        rows = table(spark, sf_dir, name).select(k.cast("bigint").alias("line_key"), value.alias("value"))
        return rows if where is None else rows.where(where)

    def typed(kind: str):
        return F.lit(f',"type":"{kind}"')

    line = F.col("line_key")
    gene = F.when(F.col("c_custkey") % 3 == 0, typed("biolink:Protein")).otherwise(typed("biolink:Gene"))
    genes = lines("customer", "c_custkey", "c_name", gene, "CUST:")
    ic = F.when(F.col("p_partkey") % 3 == 0, F.lit(',"ic":1.5')).otherwise(F.lit(""))
    drugs = lines("supplier", "s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, typed("biolink:Drug")).otherwise(F.lit("")), "SUPP:")
    return {
        "OrganismTaxon.txt": lines("nation", "n_nationkey", "n_name", typed("biolink:OrganismTaxon"), "NCBITaxon:"),
        "Gene.txt": genes, "Gene.txt.00": genes.where(line % 2 == 0), "Gene.txt.01": genes.where(line % 2 == 1),
        "Protein.txt": lines("part", "p_partkey", "p_name", typed("biolink:Protein"), "PART:", taxa=F.lit(""), ic=ic),
        "Drug.txt": drugs.withColumn("value", F.when(line % 5 == 0, F.left("value", F.lit(25))).otherwise(F.col("value"))),
        "README.md": table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("line_key"), F.col("r_name").alias("value")),
    }


def faulty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine tables of a store that breaks every constraint, made from the parts' keys."""
    part = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey").cast("bigint"))
    return {name: part.selectExpr(*columns).where(keep) for name, (columns, keep) in FAULTY.items()}


# table: columns as SQL over the part key k, and which rows there are
FAULTY = {
    "types": (["k AS id", "concat('t:', CAST(CAST(floor(k / 2) AS BIGINT) AS STRING)) AS curie"], "id >= 0"),
    "identifiers": (["k AS id", "CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN concat('dup:', CAST(k % 3 AS STRING)) "
                     "ELSE concat('i:', CAST(k AS STRING)) END AS curie", "CAST(NULL AS STRING) AS label"], "id >= 0"),
    "cliques": (["k AS id", "CASE WHEN k % 9 = 0 THEN k + 100000000 WHEN k % 9 = 1 THEN NULL ELSE k % 4 END AS primary_identifier_id",
                 "CAST(NULL AS DOUBLE) AS ic", "CASE WHEN k % 8 = 0 THEN k + 100000000 WHEN k % 8 = 1 THEN NULL ELSE k % 6 END AS type_id",
                 "CASE WHEN k % 11 = 0 THEN NULL ELSE 'name' END AS preferred_name"], "id >= 0"),
    "descriptions": (["k AS id", "CASE WHEN k % 6 = 0 THEN NULL ELSE 'text' END AS desc"], "id >= 0"),
    "identifiers_descriptions": (["CASE WHEN k % 5 = 0 THEN k + 100000000 ELSE k END AS description_id",
                                  "CASE WHEN k % 7 = 0 THEN k + 100000000 ELSE k END AS identifier_id"], "description_id >= 0"),
    "identifiers_cliques": (["CASE WHEN k % 5 = 1 THEN k + 100000000 ELSE k END AS identifier_id",
                             "CASE WHEN k % 3 = 0 THEN k + 100000000 ELSE k END AS clique_id"], "identifier_id >= 0"),
    "identifiers_taxa": (["CASE WHEN k % 12 = 1 THEN k + 100000000 ELSE CAST(floor(k / 4) AS BIGINT) END AS identifier_id",
                          "CASE WHEN k % 13 = 2 THEN k + 100000000 ELSE CAST(floor(k / 4) AS BIGINT) END AS taxa_identifier_id"],
                         "identifier_id >= 0"),
    "conflation_clusters": (["k AS id", "CAST(CASE WHEN k % 14 = 0 THEN 3 WHEN k % 14 = 2 THEN NULL ELSE 1 END AS INT) AS type"],
                            "id % 2 = 0"),
    "conflation_members": (["CAST(floor(k / 3) AS BIGINT) AS cluster_id",
                            "CASE WHEN k % 15 = 0 THEN k + 100000000 ELSE CAST(floor(k / 2) AS BIGINT) END AS identifier_id",
                            "CAST(k % 4 AS INT) AS is_canonical"], "cluster_id >= 0"),
}


def faulty_append(spark: SparkSession, sf_dir: str, store) -> dict[str, DataFrame]:
    """Rows that an append would add to the release's store, many of which break a constraint:
    every supplier again (identifier and clique; odd ones without a member), new identifiers and,
    for some customers, cliques with an unknown primary, without a name or members of an unknown
    clique, stored taxon links again, and unknown identifiers as second canonical members."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("k"), curie("SUPP:", "s_suppkey").alias("curie"), "s_name")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("k"), "c_name")
    again, new = F.col("k") + AGAIN, F.col("k") + NEW
    known = supplier.join(store.identifiers.select("curie", F.col("id").alias("old_id")), "curie")
    type_id = {t: F.broadcast(store.types.where(F.col("curie") == t).select(F.col("id").alias("type_id")))   # one row
               for t in ("biolink:Drug", "biolink:Gene")}
    k7, no_ic = F.col("k") % 7, F.lit(None).cast("double").alias("ic")
    cliques = (known.join(type_id["biolink:Drug"]).select(
        again.alias("id"), F.col("old_id").alias("primary_identifier_id"), no_ic, "type_id", F.col("s_name").alias("preferred_name"))
        .unionByName(customer.where(k7 < 2).join(type_id["biolink:Gene"]).select(
            new.alias("id"), F.when(k7 == 0, new + NEW).otherwise(new).alias("primary_identifier_id"), no_ic, "type_id",
            F.when(k7 == 0, F.col("c_name")).alias("preferred_name"))))
    members = (known.where("k % 2 = 0").select(F.col("old_id").alias("identifier_id"), again.alias("clique_id"))
               .unionByName(customer.where(k7 == 0).select(new.alias("identifier_id"), new.alias("clique_id")))
               .unionByName(customer.where(k7 == 2).select(new.alias("identifier_id"), (new + NEW).alias("clique_id"))))
    c3 = F.col("cluster_id") % 3
    return {
        "identifiers": supplier.select(again.alias("id"), "curie", F.col("s_name").alias("label")).unionByName(
            customer.select(new.alias("id"), curie("NEW:", "k").alias("curie"), F.col("c_name").alias("label"))),
        "cliques": cliques, "identifiers_cliques": members,
        "identifiers_taxa": store.identifiers_taxa.where("identifier_id % 2 = 0"),
        "conflation_members": store.conflation_wide.select("cluster_id").distinct().where(c3 < 2).select(
            "cluster_id", (F.col("cluster_id") + 3 * NEW).alias("identifier_id"), (1 + c3).cast("int").alias("is_canonical"))}
