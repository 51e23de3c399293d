"""Lookup / normalization operators.

Every lookup is bulk: it takes a DataFrame of inputs (a single CURIE is a
one-row frame) and is one or two joins against the serving views, planned by
Catalyst (broadcast when the inputs are measured small, sort-merge
otherwise). Input duplicates are preserved where the single-key function
would return its rows once per call; unknown CURIEs give no rows unless noted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conceptnorm.functions.scalars import is_named
from conceptnorm.operators.keys import bloom_filter, maybe_among, possibly_among
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.schema import CONFLATION_TYPE_IDS


def single(spark: SparkSession, curie: str, name: str = "curie") -> DataFrame:
    """A one-row input frame for a single-key lookup."""
    return spark.createDataFrame([(curie,)], f"{name} string")


def numbered_inputs(inputs: DataFrame, col: str = "input_ord") -> DataFrame:
    """Tag inputs with their scan order; lookups carry the column through, so
    ``orderBy(col)`` returns results in input order (repeats repeated)."""
    return inputs.withColumn(col, F.monotonically_increasing_id())


def _input(inputs: DataFrame, col: str, as_name: str) -> DataFrame:
    return inputs.withColumnRenamed(col, as_name) if col != as_name else inputs


def cliques_wide(vocab: Vocabulary) -> DataFrame:
    """One row per clique: primary CURIE, type CURIE, ic, preferred name."""
    return vocab.cliques_wide


def descriptions_of(vocab: Vocabulary) -> DataFrame:
    """(identifier_id, description): one row per stored description. In a
    written store they lie in buckets by identifier, so no text is exchanged."""
    return vocab.described().select("identifier_id", "description")


def _joined(vocab: Vocabulary, table: str, inputs: DataFrame, key: str, columns: list) -> DataFrame:
    """The inputs joined to a serving table on its bucket column: with its
    buckets, and with the CURIEs that have a part of their own."""
    out = [inputs.join(part.select(*columns), key) for part in vocab.parts(table)]
    return reduce(DataFrame.unionByName, out)


# E1 / E2 ------------------------------------------------------------------

def preferred(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """(input_curie, preferred_curie, type_curie), one row per clique
    containing the input, repeated for repeated inputs. Other input columns
    (e.g. an ordinal) are carried through."""
    return _joined(vocab, "membership_wide", _input(inputs, col, "input_curie"), "input_curie",
                   [F.col("member_curie").alias("input_curie"), F.col("primary_curie").alias("preferred_curie"),
                    "type_curie"])


def preferred_for(vocab: Vocabulary, curies: list[str]) -> DataFrame:
    """E1 for literal CURIEs, one result per input as in ``preferred``
    (repeats repeated). The same CURIEs are also a filter on the scan of the
    CURIE-sorted serving table (row-group min/max and bloom-filter skipping)."""
    spark = vocab.membership_wide.sparkSession
    inputs = spark.createDataFrame([(c,) for c in curies], "input_curie string")
    mw = vocab.membership_wide.where(F.col("member_curie").isin(sorted(set(curies))))
    return inputs.join(mw.select(F.col("member_curie").alias("input_curie"),
                                 F.col("primary_curie").alias("preferred_curie"), "type_curie"),
                       "input_curie")


def conflation_for(vocab: Vocabulary, curie: str,
                   conflation_type: str | None = None) -> DataFrame:
    """E3 for one literal CURIE: its clusters by a pushed filter on the
    CURIE-sorted conflation view, then their members by a semi join."""
    type_id = conflation_type_id(conflation_type)
    cw = vocab.conflation_wide
    clusters = cw.where(F.col("member_curie") == curie).select("cluster_id")
    out = cw.join(clusters, "cluster_id", "left_semi")
    if type_id is not None:
        out = out.where(F.col("conflation_type") == type_id)
    return out.select(F.lit(curie).alias("query_curie"), "member_curie", "is_canonical")


# E3 / E4 ------------------------------------------------------------------

def conflation_links(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """(query_curie, cluster_id): the clusters of each input, repeated for repeated inputs."""
    return _joined(vocab, "conflation_wide", _input(inputs, col, "query_curie"), "query_curie",
                   [F.col("member_curie").alias("query_curie"), "cluster_id"])


def conflation_members(vocab: Vocabulary, links: DataFrame | None = None) -> DataFrame:
    """(cluster_id, member_curie, member_is_canonical, conflation_type_id): the members of the
    clusters that ``links`` name, each once however many inputs share its cluster; of all without.
    With the links this is the answer to E4 in inputs + members rows, not in their product."""
    cw = vocab.conflation_wide
    if links is not None:
        cw = cw.join(links.select("cluster_id").distinct(), "cluster_id", "left_semi")
    return cw.select("cluster_id", "member_curie", F.col("is_canonical").alias("member_is_canonical"),
                     F.col("conflation_type").alias("conflation_type_id"))


def conflation(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """(query_curie, member_curie, member_is_canonical, conflation_type_id)
    for every member of every cluster containing the input, the input
    included; no de-duplication across clusters."""
    return conflation_links(vocab, inputs, col).join(conflation_members(vocab), "cluster_id").drop("cluster_id")


def conflation_type_id(name: str | None) -> int | None:
    if name is None:
        return None
    if name not in CONFLATION_TYPE_IDS:
        raise ValueError(f"invalid conflation type name: {name}")
    return CONFLATION_TYPE_IDS[name]


def conflation_filtered(vocab: Vocabulary, inputs: DataFrame, col: str = "curie",
                        conflation_type: str | None = None) -> DataFrame:
    """(query_curie, member_curie, is_canonical), optionally one type."""
    type_id = conflation_type_id(conflation_type)
    out = conflation(vocab, inputs, col)
    if type_id is not None:
        out = out.where(F.col("conflation_type_id") == type_id)
    return out.select("query_curie", "member_curie",
                      F.col("member_is_canonical").alias("is_canonical"))


# E5 / E6 ------------------------------------------------------------------

def _with_descriptions(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    # LEFT join: one output row per description of the primary, one NULL row
    # when it has none (description fan-out is part of the semantics). Only rows
    # whose primary may have one are exchanged for it.
    texts = descriptions_of(vocab).withColumnRenamed("identifier_id", "primary_identifier_id")
    keys = texts.select("primary_identifier_id").distinct()
    described = F.coalesce(maybe_among("primary_identifier_id", bloom_filter(keys, "primary_identifier_id")), F.lit(False))
    without = rows.where(~described).withColumn("description", F.lit(None).cast("string"))
    return rows.where(described).join(texts, "primary_identifier_id", "left").unionByName(without)


def preferred_cliques(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """E5: clique info of cliques headed by the input (flattened CliqueInfo:
    identifier, description, label, ic, type_curie)."""
    rows = _joined(vocab, "cliques_wide", _input(inputs, col, "primary_curie"), "primary_curie",
                   ["primary_curie", "clique_id", "primary_identifier_id", "type_curie", "ic", "preferred_name"])
    return (_with_descriptions(rows, vocab)
            .select(F.col("primary_curie").alias("identifier"), "description",
                    F.col("preferred_name").alias("label"), "ic", "type_curie"))


def any_cliques(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """Clique info of every clique containing the input; the description
    is the primary's. Sort with ``orderBy('clique_id', 'identifier')``."""
    rows = _joined(vocab, "membership_wide", _input(inputs, col, "input_curie"), "input_curie",
                   [F.col("member_curie").alias("input_curie"), "clique_id", "primary_curie",
                    "primary_identifier_id", "type_curie", "ic", "preferred_name"])
    return (_with_descriptions(rows, vocab)
            .select("input_curie", "clique_id", F.col("primary_curie").alias("identifier"),
                    "description", F.col("preferred_name").alias("label"), "ic",
                    "type_curie"))


def as_clique_info(df: DataFrame) -> DataFrame:
    """Nest flattened clique rows as {id:{identifier,description,label}, ic, type:[t]}."""
    return df.select(
        *[c for c in df.columns if c not in ("identifier", "description", "label",
                                              "ic", "type_curie")],
        F.struct(F.struct("identifier", "description", "label").alias("id"),
                 F.col("ic"), F.array("type_curie").alias("type")).alias("clique"))


# E7 - E9 ------------------------------------------------------------------

def synonyms(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """Distinct (preferred_curie, synonym_curie) over all cliques the
    input heads (all types merged)."""
    mw = vocab.membership_wide.select("primary_curie", F.col("member_curie").alias("synonym_curie"))
    return (_input(inputs, col, "primary_curie").select("primary_curie").distinct()
            .join(mw, "primary_curie")
            .select(F.col("primary_curie").alias("preferred_curie"), "synonym_curie")
            .distinct())


def taxon(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """(curie, taxon_curie) -- the least linked taxon, NULL if none.

    Links are cut to the wanted identifiers, then to distinct taxa for their
    names, so a taxon that a third of all links has is not a hot join key:
    the taxon side is one row per taxon and small beside the links."""
    ids = vocab.identifiers
    wanted = (_input(inputs, col, "curie").select("curie").distinct()
              .join(ids.select("curie", F.col("id").alias("identifier_id")), "curie"))
    links = vocab.identifiers_taxa.join(wanted, "identifier_id")
    names = (links.select("taxa_identifier_id").distinct()
             .join(ids.select(F.col("id").alias("taxa_identifier_id"), F.col("curie").alias("taxon")),
                   "taxa_identifier_id"))
    per_curie = (links.join(names, "taxa_identifier_id")
                 .groupBy("curie").agg(F.min("taxon").alias("taxon_curie")))
    return _input(inputs, col, "curie").join(per_curie, "curie", "left")


def label(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """(curie, label), NULL when absent or unlabelled."""
    return _input(inputs, col, "curie").join(vocab.identifiers.select("curie", "label"),
                                             "curie", "left")


# E10 / E11 ----------------------------------------------------------------

def _target_cliques(vocab: Vocabulary, targets: DataFrame) -> DataFrame:
    """(input_curie, clique_id, name): cliques the target heads UNION contains, each with its
    preferred name, which the serving tables hold beside the target."""
    name = F.col("preferred_name").alias("name")
    member = vocab.membership_wide.select(F.col("member_curie").alias("target_curie"), "clique_id", name)
    primary = vocab.cliques_wide.select(F.col("primary_curie").alias("target_curie"), "clique_id", name)
    columns = ["input_curie", "clique_id", "name"]
    return (targets.join(member, "target_curie").select(*columns)
            .unionByName(targets.join(primary, "target_curie").select(*columns))
            .distinct())


def other_names(vocab: Vocabulary) -> DataFrame:
    """(clique_id, name): non-blank labels of a clique's members that aren't its preferred name;
    labels alike may repeat."""
    label, preferred = F.col("member_label"), F.col("preferred_name")
    return (vocab.membership_wide.where(is_named("member_label") & ~label.eqNullSafe(preferred))
            .select("clique_id", label.alias("name")))


def all_names(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """Distinct non-blank (curie, name): own label, preferred names of
    its cliques, labels of every member of those cliques.

    Only what is beside the target is known without an exchange: the other members' labels
    are met by clique. Neither side moves where the other has nothing: cliques without a
    further name stay, and so do the names of cliques that no input is in."""
    targets = (_input(inputs, col, "input_curie").select("input_curie").distinct()
               .join(vocab.identifiers.select(F.col("curie").alias("input_curie"), "label"),
                     "input_curie"))
    tc = _target_cliques(vocab, targets.select("input_curie",
                                               F.col("input_curie").alias("target_curie")))
    own = targets.where(is_named("label")).select("input_curie", F.col("label").alias("name"))
    preferred = tc.where(is_named("name")).select("input_curie", "name")
    others = other_names(vocab)
    further = possibly_among(tc.select("input_curie", "clique_id"), "clique_id", others.select("clique_id").distinct())
    # a clique's names are made distinct before they meet its inputs
    names = others.join(further.select("clique_id").distinct(), "clique_id", "left_semi").distinct()
    via = further.join(names, "clique_id").select("input_curie", "name")
    return (own.unionByName(preferred).unionByName(via)
               .select(F.col("input_curie").alias("curie"), "name")
               .distinct())


def _clique_types(vocab: Vocabulary, targets: DataFrame) -> DataFrame:
    """(input_curie, category) over cliques each target heads or contains."""
    member = vocab.membership_wide.select(F.col("member_curie").alias("target_curie"),
                                          F.col("type_curie").alias("category"))
    primary = vocab.cliques_wide.select(F.col("primary_curie").alias("target_curie"),
                                        F.col("type_curie").alias("category"))
    return targets.join(member.unionByName(primary), "target_curie").select("input_curie", "category")


def cluster_categories(vocab: Vocabulary, clusters: DataFrame) -> DataFrame:
    """(cluster_id, category): distinct types of the cliques of every member
    of each wanted cluster (``cluster_id``, distinct) -- at most (#types) rows
    per cluster, so a huge cluster never expands into member pairs."""
    members = (vocab.conflation_wide.join(clusters, "cluster_id", "left_semi")
               .select(F.col("cluster_id").alias("input_curie"), F.col("member_curie").alias("target_curie")))
    return (_clique_types(vocab, members)
            .select(F.col("input_curie").alias("cluster_id"), "category").distinct())


def categories(vocab: Vocabulary, inputs: DataFrame, col: str = "curie") -> DataFrame:
    """Distinct (curie, category) over cliques of the CURIE and of every
    conflation-cluster mate (both conflation types).

    Mates' categories come per cluster (``cluster_categories``), so the
    result is linear in inputs x (own cliques + clusters), never in mates."""
    targets = (_input(inputs, col, "input_curie").select("input_curie").distinct()
               .join(vocab.identifiers.select(F.col("curie").alias("input_curie")),
                     "input_curie", "left_semi"))
    own = _clique_types(vocab, targets.select("input_curie",
                                              F.col("input_curie").alias("target_curie")))
    mine = targets.join(vocab.conflation_wide.select(F.col("member_curie").alias("input_curie"),
                                                     "cluster_id"), "input_curie")
    via = (mine.join(cluster_categories(vocab, mine.select("cluster_id").distinct()), "cluster_id")
               .select("input_curie", "category"))
    return (own.unionByName(via)
               .select(F.col("input_curie").alias("curie"), "category")
               .distinct())


# E13 / E14 ----------------------------------------------------------------

# hash prefixes are so long that a cell holds about this many identifiers, and
# have at most MAX_PREFIX hexadecimal digits (16.8 million cells)
CELL_ROWS, MAX_PREFIX = 10_000, 6


def sample_identifiers(vocab: Vocabulary, n: int, seed: int = 42) -> DataFrame:
    """N identifiers, uniformly without replacement (repeatable for a
    seed): the n least by md5(seed || curie).

    Exact for any n without sorting or collecting: identifiers are counted by
    the first digits of their hash; all cells below the one in which the n-th
    lies are taken whole by a filter, and only of that one cell, a few
    thousand rows, the least are picked."""
    if n <= 0:
        raise ValueError("n must be positive")
    top = check_sample_size(vocab, n)
    digits = 1
    while digits < MAX_PREFIX and 16 ** digits * CELL_ROWS < top:
        digits += 1
    key = F.md5(F.concat(F.lit(str(seed)), F.col("curie")))
    ids = vocab.identifiers.select("curie", key.alias("_k")).withColumn("_cell", F.left("_k", F.lit(digits)))
    cells = ids.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    # one row per cell, 16 ** MAX_PREFIX at most
    upto = cells.withColumn("_upto", F.sum("_n").over(Window.orderBy("_cell")))
    cut = upto.where(F.col("_upto") >= n).orderBy("_cell").select("_cell", (F.col("_upto") - F.col("_n")).alias("before")).first()
    if cut is None:               # ids have gaps, so there are fewer rows than the largest id
        return ids.select("curie")
    edge = ids.where(F.col("_cell") == cut["_cell"]).orderBy("_k", "curie").limit(n - cut["before"])
    return ids.where(F.col("_cell") < cut["_cell"]).select("curie").unionByName(edge.select("curie"))


def check_sample_size(vocab: Vocabulary, n: int) -> int:
    """E13 precondition: the table is non-empty and n <= max id, which is returned."""
    top = vocab.identifiers.agg(F.max("id").alias("m")).first()["m"]
    if top is None:
        raise ValueError("identifiers table is empty")
    if n > top:
        raise ValueError(f"n = {n} exceeds the number of identifiers ({top})")
    return top


def ids_to_curies(vocab: Vocabulary, ids: DataFrame, col: str = "id") -> DataFrame:
    """(id, curie) for the ids that exist (IN-list semantics)."""
    wanted = ids.select(F.col(col).cast("bigint").alias("id"))
    return vocab.identifiers.join(wanted, "id", "left_semi").select("id", "curie")
