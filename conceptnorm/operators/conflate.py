"""Conflation normalization and curation.

A conflation line is a list literal of CURIEs; element 0 is canonical. Lines
are parsed natively (``from_json`` into ``array<variant>``) so that a
non-string element is detected rather than silently coerced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conceptnorm.functions.scalars import has_duplicates, is_curie, stripped
from conceptnorm.operators.keys import dense_ids, dense_ids_by_split, stage
from conceptnorm.operators.skew import top_k_per_group
from conceptnorm.schema import COMPENDIA_COLUMNS, CONFLATION_TYPE_IDS, ORDER_KEY

# how many missing CURIEs a referential-audit row lists
MISSING_LISTED = 10


class ConflationError(ValueError):
    """Strict-mode conflation violation."""


def _as_json_list(value: Column) -> Column:
    """Python-literal tuples ``('a', 'b',)`` -> JSON-style lists."""
    v = stripped(value)
    v = F.regexp_replace(v, r"^\((.*)\)$", "[$1]")
    return F.regexp_replace(v, r",\s*\]$", "]")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Trim, skip blanks, parse and validate each line.

    Adds ``members`` (array<string>) and ``error`` (NULL when valid).
    """
    trimmed = lines.withColumn("value", stripped("value")).where(F.col("value") != "")
    as_list = _as_json_list(F.col("value"))
    variants = F.from_json(as_list, "array<variant>")
    parsed = trimmed.withColumn("_v", variants)
    non_string = F.exists("_v", lambda x: F.schema_of_variant(x) != F.lit("STRING"))
    error = (F.when(F.col("_v").isNull(), F.lit("not a list of CURIEs"))
              .when(F.size("_v") == 0, F.lit("empty"))
              .when(non_string, F.lit("not all strings"))
              .when(~F.col("conflation_type").isin(*CONFLATION_TYPE_IDS.values()),
                    F.lit("invalid conflation type")))
    return (parsed.withColumn("members", F.from_json(as_list, T.ArrayType(T.StringType())))
                  .withColumn("error", error)
                  .drop("_v"))


def conflation_type_of(file_name: Column) -> Column:
    """A5: type id from a file named ``<type>.txt`` (NULL when unknown)."""
    base = F.regexp_extract(file_name, r"^(.*)\.txt$", 1)
    mapping = F.create_map(*[x for k, v in CONFLATION_TYPE_IDS.items()
                             for x in (F.lit(k), F.lit(v))])
    return mapping[base]


def number_lines(parsed: DataFrame, scan_order: bool = False) -> DataFrame:
    """Valid lines with 1-based cluster ids in line order."""
    valid = parsed.where(F.col("error").isNull())
    if scan_order:
        return dense_ids_by_split(valid, "cluster_id")
    return dense_ids(valid, ORDER_KEY, "cluster_id")


def cluster_members(parsed: DataFrame, scan_order: bool = False) -> DataFrame:
    """Numbered clusters exploded to (cluster_id, pos, curie, is_canonical).

    Repeated members are dropped with the canonical kept first.
    """
    clusters = number_lines(parsed, scan_order)
    return (clusters.select("cluster_id", "conflation_type", "file_name", "row_in_split", "value",
                            F.posexplode(F.array_distinct("members")).alias("pos", "curie"))
                    .withColumn("is_canonical", (F.col("pos") == 0).cast("int")))


@dataclass
class ConflationTables:
    conflation_clusters: DataFrame
    conflation_members: DataFrame
    # serving view: (cluster_id, conflation_type, member_curie, member_id, pos, is_canonical)
    conflation_wide: DataFrame
    # C5 audit of clusters with members absent from identifiers
    missing: DataFrame
    # lines and clusters that a lenient load has left out
    rejected: DataFrame


def resolve(members: DataFrame, identifiers: DataFrame) -> DataFrame:
    """C4: members joined to identifier ids; misses keep a NULL id."""
    id_map = identifiers.select("curie", F.col("id").alias("member_id"))
    return members.join(id_map, "curie", "left")


def missing_report(resolved: DataFrame) -> DataFrame:
    """Per cluster with misses: canonical missing?, count, first 10 sorted."""
    miss = resolved.where(F.col("member_id").isNull())
    stats = miss.groupBy("cluster_id").agg(
        F.max(F.col("pos") == 0).alias("canonical_missing"),
        F.count(F.lit(1)).alias("n_missing"))
    first = (top_k_per_group(miss.select("cluster_id", "curie"), ["cluster_id"], ["curie"],
                             MISSING_LISTED, salt_on="curie")
             .groupBy("cluster_id")
             .agg(F.array_sort(F.collect_list("curie")).alias("first_missing")))
    return stats.join(first, "cluster_id")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """What a lenient load leaves out when it parses: (file_name, line_key, reason, value)."""
    return (parse_lines(lines).where(F.col("error").isNotNull())
            .select("file_name", F.col("row_in_split").alias("line_key"), F.col("error").alias("reason"), "value"))


def rejected_clusters(resolved: DataFrame, missing: DataFrame) -> DataFrame:
    """Clusters left out because of members absent from the identifiers."""
    first = resolved.where(F.col("pos") == 0).select("cluster_id", "file_name", "row_in_split", "value")
    reason = F.concat(F.when(F.col("canonical_missing"), F.lit("canonical CURIE missing; ")).otherwise(F.lit("")),
                      F.lit("missing: "), F.col("n_missing").cast("string"))
    return first.join(missing, "cluster_id").select(
        "file_name", F.col("row_in_split").alias("line_key"), reason.alias("reason"), "value")


def prepare_conflation(lines: DataFrame, strict: bool = True,
                       scan_order: bool = False) -> DataFrame:
    """C1-C3 without identifiers: parsed, numbered, exploded members, staged.
    Runs while the compendia are still being normalized."""
    parsed = parse_lines(lines)
    if strict:
        bad = parsed.where(F.col("error").isNotNull()).limit(1).collect()
        if bad:
            raise ConflationError(f"{bad[0]['error']}: {bad[0]['value'][:200]}")
    return stage(cluster_members(parsed, scan_order), "cluster-members")


def normalize_conflation(lines: DataFrame, identifiers: DataFrame,
                         strict: bool = True, scan_order: bool = False,
                         prepared: DataFrame | None = None) -> ConflationTables:
    members = prepared if prepared is not None else prepare_conflation(lines, strict, scan_order)
    resolved = stage(resolve(members, identifiers), "clusters")
    missing = missing_report(resolved)
    if strict:
        first = missing.orderBy("cluster_id").limit(1).collect()
        if first:
            row = first[0]
            raise ConflationError(
                "canonical CURIE missing from identifiers" if row["canonical_missing"]
                else f"missing CURIE(s) in identifiers: {row['first_missing']}")
    # lenient: a cluster with any miss is quarantined (reported in `missing`)
    good = resolved.join(missing.select("cluster_id"), "cluster_id", "left_anti")
    clusters = good.select(F.col("cluster_id").alias("id"),
                           F.col("conflation_type").alias("type")).distinct()
    members = good.select("cluster_id", F.col("member_id").alias("identifier_id"), "is_canonical")
    wide = good.select("cluster_id", "conflation_type", F.col("curie").alias("member_curie"),
                       "member_id", "pos", "is_canonical")
    rejected = rejected_lines(lines).unionByName(rejected_clusters(resolved, missing))
    return ConflationTables(clusters, members, wide, missing, rejected)


# --------------------------------------------------------------------------
# Curation: keep clusters whose every member is in a valid set
# --------------------------------------------------------------------------

def valid_curies(records: DataFrame) -> DataFrame:
    """Every member CURIE of the compendia records (distinct)."""
    return (records.select(F.explode("identifiers.i").alias("curie"))
                   .where(F.col("curie").isNotNull()).distinct())


def harvest_curies(records: DataFrame,
                   value_cols: tuple[str, ...] | None = COMPENDIA_COLUMNS) -> DataFrame:
    """Every distinct CURIE-shaped string value anywhere in records
    (values only, at any depth; ``value_cols=None`` walks every column)."""
    fields = [f for f in records.schema.fields
              if value_cols is None or f.name in value_cols]
    leaves: list[Column] = []
    for f in fields:
        leaves.extend(_leaves(f.dataType, F.col(f.name)))
    values = records.select(F.explode(F.flatten(F.array(*leaves))).alias("curie"))
    return values.where(is_curie("curie")).distinct()


def harvest_any(lines: DataFrame, col: str = "value", strict: bool = True) -> DataFrame:
    """C10/F11 over lines of any JSON: every distinct CURIE-shaped string value,
    under whatever keys and at any depth; keys themselves don't count.

    Each line is one VARIANT. Level by level, strings are tested and containers
    opened (``variant_explode``); a level is staged, so it is parsed and opened
    once. There are as many levels as the deepest line has. A blank line has
    no values; what isn't JSON raises, or has none if not ``strict``."""
    text = F.col(col)
    parse = F.parse_json if strict else F.try_parse_json
    nodes = lines.where(F.trim(text) != "").select(parse(text).alias("v"))
    found = None
    while True:
        holds = (F.try_variant_get("v", "$", "array<variant>").isNotNull()
                 | F.try_variant_get("v", "$", "map<string,variant>").isNotNull())
        level = nodes.where(F.col("v").isNotNull()).withColumn("_open", holds)
        level = stage(level.select(F.when(F.col("_open"), F.col("v")).alias("v"),
                                   F.when(~F.col("_open"), F.try_variant_get("v", "$", "string")).alias("curie")), "level")
        curies = level.where(F.col("curie").isNotNull() & is_curie("curie")).select("curie").distinct()
        found = curies if found is None else found.unionByName(curies)
        inner = level.where(F.col("v").isNotNull()).select("v")
        if not inner.head(1):
            return found.distinct()
        children = inner.sparkSession.tvf.variant_explode(F.col("v").outer())
        nodes = inner.lateralJoin(children).select(F.col("value").alias("v"))


def _leaves(dtype: T.DataType, c: Column) -> list[Column]:
    if isinstance(dtype, T.StringType):
        return [F.array(c)]
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f.dataType, c[f.name])]
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
        if isinstance(inner, T.StringType):
            return [F.coalesce(c, F.array().cast("array<string>"))]
        return [F.coalesce(F.flatten(F.transform(c, _element_leaves(inner))),
                           F.array().cast("array<string>"))]
    if isinstance(dtype, T.MapType):
        return (_leaves(T.ArrayType(dtype.keyType), F.map_keys(c))
                + _leaves(T.ArrayType(dtype.valueType), F.map_values(c)))
    return []


def _element_leaves(inner: T.DataType):
    def per_elem(x: Column) -> Column:
        parts = _leaves(inner, x)
        return F.flatten(F.array(*parts)) if parts else F.array().cast("array<string>")
    return per_elem


def filter_clusters(parsed: DataFrame, valid: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Clusters (one row per line) with a ``kept`` flag = every member valid.

    Relational division without collecting a cluster: explode distinct
    members, left join the valid set, AND-aggregate per cluster.
    ``keep_empty``: an empty list is kept (vacuously valid) instead of being
    dropped as a parse error.
    """
    if keep_empty:
        parsed = parsed.withColumn("error", F.when(F.col("error") == "empty", F.lit(None))
                                              .otherwise(F.col("error")))
    lines = number_lines(parsed)
    exploded = lines.select("cluster_id", F.explode(F.array_distinct("members")).alias("curie"))
    flags = (exploded.join(valid.select("curie", F.lit(True).alias("_ok")), "curie", "left")
                     .groupBy("cluster_id")
                     .agg(F.bool_and(F.col("_ok").isNotNull()).alias("kept")))
    return (lines.join(flags, "cluster_id", "left")
                 .withColumn("kept", F.coalesce("kept", F.lit(True)))
                 .withColumn("has_duplicates", has_duplicates("members")))


def filter_stats(flagged: DataFrame) -> DataFrame:
    """Total, kept, dropped, dropped %, kept clusters with duplicates."""
    total = F.count(F.lit(1))
    kept = F.count_if("kept")
    return flagged.agg(
        total.alias("total"),
        kept.alias("kept"),
        (total - kept).alias("dropped"),
        F.round((total - kept).cast("double") * 100 / total, 2).alias("dropped_pct"),
        F.count_if(F.col("kept") & F.col("has_duplicates")).alias("kept_with_duplicates"))


def require_kept(stats: DataFrame) -> DataFrame:
    """C7 guard: fail when the filter keeps no cluster at all."""
    row = stats.first()
    if not row or not row["kept"]:
        raise ValueError("no cluster kept by the filter")
    return stats
