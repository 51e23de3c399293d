"""Input and table schemas, and the fixed values the data format defines."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the release format (must stay exactly as written).
# ---------------------------------------------------------------------------
# Label given to a taxon CURIE that is referenced but never defined.
UNKNOWN_TAXON_LABEL = "unknown taxon"
# Conflation type names and their ids; a conflation file is named <type>.txt.
CONFLATION_TYPE_IDS = {"DrugChemical": 1, "GeneProtein": 2}
# Keys every compendia record must carry.
COMPENDIA_COLUMNS = ("type", "ic", "identifiers", "preferred_name", "taxa")
# The taxon compendium is loaded before every other compendia file.
TAXON_FILE = "OrganismTaxon.txt"
# Compendia and conflation file suffix; shards are <name>.txt.00, .01, ...
FILE_SUFFIX = ".txt"
FIRST_SHARD_SUFFIX = ".txt.00"

MEMBER = T.StructType([
    T.StructField("i", T.StringType()),
    T.StructField("l", T.StringType()),
    T.StructField("d", T.ArrayType(T.StringType())),
    T.StructField("t", T.ArrayType(T.StringType())),
])

# One compendia JSON-lines record (one synonym clique).
COMPENDIA_RECORD = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("ic", T.DoubleType()),
    T.StructField("identifiers", T.ArrayType(MEMBER)),
    T.StructField("preferred_name", T.StringType()),
    T.StructField("taxa", T.ArrayType(T.StringType())),
])

# Record order key: follows line order across a release (a release file may
# be a folder of part files, ordered by path; a split by its start offset).
ORDER_KEY = ["file_ord", "file_path", "split_start", "row_in_split"]

RECORDS = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_ord", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("split_start", T.LongType()),
    T.StructField("row_in_split", T.LongType()),
    *COMPENDIA_RECORD.fields,
])

CONFLATION_LINES = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("conflation_type", T.IntegerType()),
    T.StructField("file_ord", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("split_start", T.LongType()),
    T.StructField("row_in_split", T.LongType()),
    T.StructField("value", T.StringType()),
])

TABLE_NAMES = (
    "types", "identifiers", "cliques", "descriptions",
    "identifiers_descriptions", "identifiers_cliques", "identifiers_taxa",
    "conflation_clusters", "conflation_members",
)
