"""Release files: listing, selection, scans, checks.

A release folder holds ``compendia/`` (JSON lines, one clique per line) and
``conflation/`` (one list literal per line). An entry may be a single file
or a folder of part files, as Spark and Hadoop writers produce; an entry's
name is its first path component under the folder.

Scans keep line order as ``(file_ord, file_path, split_start, row)``: the
split start and ``monotonically_increasing_id()`` are taken directly on the
scan, before any shuffle, and one split is read whole by one task.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conceptnorm.functions.scalars import stripped
from conceptnorm.operators.conflate import conflation_type_of
from conceptnorm.operators.keys import stage
from conceptnorm.schema import (COMPENDIA_COLUMNS, COMPENDIA_RECORD, CONFLATION_TYPE_IDS, FILE_SUFFIX,
                                FIRST_SHARD_SUFFIX, TAXON_FILE)
from conceptnorm.session import jvm_context, scratch_path, session_key

# characters of a malformed line shown in its report
PREVIEW_CHARS = 200

_WRITTEN: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


# -- A3 / A4 / A5: listing and selection -------------------------------------

def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A3: (file_name, n_parts, size, modified) per entry of a folder.

    File contents are never read (the binary source prunes ``content``).
    """
    folder = folder.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(folder).select("path", "length", "modificationTime"))
    rel = F.regexp_replace("path", r"^.*?" + _escape(_strip_scheme(folder)) + "/", "")
    return (files.withColumn("file_name", F.regexp_extract(rel, r"^([^/]+)", 1))
                 .groupBy("file_name")
                 .agg(F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("size"),
                      F.max("modificationTime").alias("modified")))


def list_entries(spark: SparkSession, folder: str) -> DataFrame:
    """A3 as metadata only: the top-level entries of a folder (name, parts,
    bytes, modified) from one file-system listing on the driver -- no scan
    job. Falls back to ``manifest`` where the session has no JVM context."""
    sc = jvm_context(spark)
    if sc is None:
        return manifest(spark, folder)
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    rows = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if st.isDirectory():
            parts = [p for p in fs.listStatus(st.getPath())
                     if p.isFile() and not p.getPath().getName().startswith((".", "_"))]
            rows.append((name, len(parts), sum(p.getLen() for p in parts),
                         max((p.getModificationTime() for p in parts), default=0)))
        else:
            rows.append((name, 1, st.getLen(), st.getModificationTime()))
    listing = spark.createDataFrame(rows, "file_name string, n_parts bigint, size bigint, "
                                          "modified_ms bigint")
    return listing.select("file_name", "n_parts", "size",
                          F.timestamp_millis("modified_ms").alias("modified"))


def _strip_scheme(path: str) -> str:
    return path.split(":", 1)[1] if path.startswith("file:") else path


def _escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def selected_compendia(listing: DataFrame) -> DataFrame:
    """A4: keep names containing ``.txt``; drop ``X.txt`` when ``X.txt.00``
    exists; the taxon file first, then by name. Other names are flagged."""
    shards = (listing.where(F.col("file_name").endswith(FIRST_SHARD_SUFFIX))
              .select(F.regexp_replace("file_name", r"\.00$", "").alias("file_name"),
                      F.lit(True).alias("_sharded")))
    flagged = (listing.join(shards, "file_name", "left")
               .withColumn("selected", F.col("file_name").contains(FILE_SUFFIX)
                           & F.col("_sharded").isNull())
               .withColumn("note", F.when(~F.col("file_name").contains(FILE_SUFFIX),
                                          F.lit("unrecognized file name"))
                                    .when(F.col("_sharded").isNotNull(),
                                          F.lit("replaced by shards"))))
    # one row per release file: the global order is over file names only
    order = Window.orderBy((F.col("file_name") != TAXON_FILE), "file_name")
    chosen = (flagged.where("selected")
              .withColumn("file_ord", F.row_number().over(order).cast("int"))
              .select("file_name", "file_ord"))
    return (flagged.join(chosen, "file_name", "left")
                   .select("file_name", "selected", "file_ord", "note", "size", "n_parts"))


def selected_conflation(listing: DataFrame) -> DataFrame:
    """A5: ``.txt`` files sorted by name; type from the name (NULL if unknown)."""
    order = Window.orderBy("file_name")     # one row per file
    return (listing.where(F.col("file_name").endswith(FILE_SUFFIX))
                   .withColumn("file_ord", F.row_number().over(order).cast("int"))
                   .withColumn("conflation_type", conflation_type_of(F.col("file_name")))
                   .select("file_name", "file_ord", "conflation_type"))


def _paths(selection: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    # one row per release file: the listing is metadata, bounded by the
    # number of files, and the reader needs the paths on the driver anyway
    rows = selection.where(F.col("file_ord").isNotNull()).orderBy("file_ord").collect()
    return [(r["file_name"], r["file_ord"], f"{folder}/{r['file_name']}") for r in rows]


def compendia_paths(spark: SparkSession, root: str) -> list[tuple[str, int, str]]:
    folder = f"{root.rstrip('/')}/compendia"
    return _paths(selected_compendia(list_entries(spark, folder)), folder)


# -- A1 / A2: scans ----------------------------------------------------------

def _uri_path(spark: SparkSession, path: str) -> str:
    """The path part of a location as its file system qualifies it (no scheme
    or authority, ``.`` and doubled slashes resolved, nothing encoded)."""
    sc = jvm_context(spark)
    if sc is None:
        return _strip_scheme(path).rstrip("/")
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath().rstrip("/")


def _decoded_path(c):
    """The path part of ``_metadata.file_path``, percent-decoded."""
    path = F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _with_order(df: DataFrame, paths: list[tuple[str, int, str]]) -> DataFrame:
    """Attach file name/order by the entry each part file belongs to. A file
    of no known entry fails the read."""
    spark = df.sparkSession
    entries = [_uri_path(spark, path) for _, _, path in paths]
    names = spark.createDataFrame([(name, ord_, e) for (name, ord_, _), e in zip(paths, entries)],
                                  "file_name string, file_ord int, entry string")
    ordered = df.select("*", F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_block_start").alias("split_start"),
                        F.monotonically_increasing_id().alias("row_in_split"))
    # an entry is the file itself or the folder of its part files
    path = _decoded_path(F.col("file_path"))
    folder = F.regexp_replace(path, r"/[^/]*$", "")
    known = F.array(*[F.lit(e) for e in entries])       # one per release file
    entry = F.when(F.array_contains(known, path), path).otherwise(folder)
    out = ordered.withColumn("entry", entry).join(F.broadcast(names), "entry", "left")
    unknown = F.raise_error(F.concat(F.lit("file of no release entry: "), F.col("file_path")))
    return out.withColumn("file_ord", F.coalesce("file_ord", unknown.cast("int"))).drop("entry")


def read_compendia(spark: SparkSession, paths: list[tuple[str, int, str]],
                   mode: str = "FAILFAST") -> DataFrame:
    """A1: records with (file_name, file_ord, file_path, split_start, row_in_split)."""
    reader = spark.read.schema(COMPENDIA_RECORD).option("mode", mode)
    df = reader.json([p for _, _, p in paths])
    return _with_order(df, paths)


def read_conflation(spark: SparkSession, root: str, types: dict[str, str] | None = None) -> DataFrame:
    """A2/A5: conflation lines with their type from the file name, or from
    ``types`` (file name -> conflation type name) for files named otherwise."""
    types = {name: CONFLATION_TYPE_IDS[kind] for name, kind in (types or {}).items()}
    folder = f"{root.rstrip('/')}/conflation"
    rows = selected_conflation(list_entries(spark, folder)).orderBy("file_ord").collect()
    paths = [(r["file_name"], r["file_ord"], f"{folder}/{r['file_name']}") for r in rows]
    unknown = [r["file_name"] for r in rows if r["conflation_type"] is None and r["file_name"] not in types]
    if unknown:
        raise ValueError(f"unknown conflation file name(s): {unknown}")
    lines = spark.read.text([p for _, _, p in paths])
    out = _with_order(lines, paths)
    kind = conflation_type_of(F.col("file_name"))
    for name, type_id in types.items():          # one per file that the caller names
        kind = F.when(F.col("file_name") == name, F.lit(type_id)).otherwise(kind)
    return out.withColumn("conflation_type", kind)


# -- A7 / A8 / D8: checks and profiles ---------------------------------------

def _lines(spark: SparkSession, paths: list[tuple[str, int, str]]) -> DataFrame:
    text = spark.read.text([p for _, _, p in paths])
    return _with_order(text, paths).where(stripped("value") != "")


def required_columns(spark: SparkSession, paths: list[tuple[str, int, str]]) -> DataFrame:
    """Per file, required keys absent from every record, and the keys
    present (the union over the file's records)."""
    keys = (_lines(spark, paths)
            .select("file_name", F.explode(F.json_object_keys("value")).alias("key"))
            .distinct()
            # distinct keys per file: bounded by the record schema's width
            .groupBy("file_name").agg(F.array_sort(F.collect_list("key")).alias("present")))
    required = F.array(*[F.lit(c) for c in COMPENDIA_COLUMNS])
    return keys.select("file_name",
                       F.array_join(F.array_except(required, "present"), ",").alias("missing"),
                       F.array_join("present", ",").alias("present"))


def line_numbers(lines: DataFrame) -> DataFrame:
    """Unfiltered scan lines with ``line_number``, from 1 within each entry.
    The lines of a split are a contiguous run of row ids; a running sum over
    an entry's splits (one row each) gives the lines before."""
    split = ["file_name", "file_path", "split_start"]
    stats = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("row_in_split").alias("_first"))
    before = Window.partitionBy("file_name").orderBy("file_path", "split_start").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = stats.select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (lines.join(offsets, split)
                 .withColumn("line_number", F.col("_off") + F.col("row_in_split") - F.col("_first") + 1)
                 .drop("_off", "_first"))


def malformed_lines(spark: SparkSession, paths: list[tuple[str, int, str]]) -> DataFrame:
    """Lines that are not one valid record: (file_name, line_number,
    preview of 200 characters). A line is valid if it is one JSON value with
    nothing after it and fits the record's types."""
    lines = line_numbers(_with_order(spark.read.text([p for _, _, p in paths]), paths))
    lines = lines.where(stripped("value") != "")
    return (_checked(lines).where(~F.col("well_formed"))
                  .select("file_name", "line_number", F.substring("value", 1, PREVIEW_CHARS).alias("preview")))


def _checked(lines: DataFrame) -> DataFrame:
    """Lines with ``well_formed``: one JSON object, nothing after it, of the record's types."""
    record = T.StructType([*COMPENDIA_RECORD.fields, T.StructField("_corrupt", T.StringType())])
    parsed = (lines.withColumn("_one", F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<variant>"))
              .withColumn("_rec", F.from_json("value", record, {"mode": "PERMISSIVE",
                                                                "columnNameOfCorruptRecord": "_corrupt"})))
    single = F.coalesce(F.size("_one") == 1, F.lit(False))
    fits = F.col("_rec").isNotNull() & F.col("_rec._corrupt").isNull()
    is_object = F.ltrim("value").startswith("{")
    return parsed.withColumn("well_formed", single & fits & is_object).drop("_one", "_rec")


def profile(spark: SparkSession, paths: list[tuple[str, int, str]]) -> DataFrame:
    """A7, A8, D7 and D8 from one scan of the release. Per file: n_records
    (lines that aren't blank), n_malformed, first_type (of the first such line;
    NULL if it has none or is malformed), n_types, missing (required keys that no record has)
    and present keys. Only (file, key or type) counts are exchanged."""
    order = F.struct("file_path", "split_start", "row_in_split")
    lines = _checked(_lines(spark, paths))
    good = F.col("well_formed")

    def fact(kind: str, value) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    none = F.array().cast("array<struct<kind:string,value:string>>")
    facts = F.concat(
        F.array(fact("type", F.when(good, F.get_json_object("value", "$.type")))),
        F.when(good, none).otherwise(F.array(fact("malformed", F.lit(None)))),
        F.transform(F.when(good, F.json_object_keys("value")).otherwise(F.array().cast("array<string>")), lambda k: fact("key", k)))
    seen = (lines.select("file_name", order.alias("at"), F.explode(facts).alias("fact"))
            .groupBy("file_name", "fact.kind", "fact.value")
            .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at")))
    is_type, required = F.col("kind") == "type", F.array(*[F.lit(c) for c in COMPENDIA_COLUMNS])
    # distinct keys per file: bounded by the record schema's width
    files = seen.groupBy("file_name").agg(
        F.sum(F.when(is_type, F.col("n"))).alias("n_records"),
        F.coalesce(F.sum(F.when(F.col("kind") == "malformed", F.col("n"))), F.lit(0)).alias("n_malformed"),
        F.min_by("value", F.when(is_type, F.col("at"))).alias("first_type"),
        F.count(F.when(is_type, F.col("value"))).alias("n_types"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "key", F.col("value")))).alias("keys"))
    return files.select("file_name", "n_records", "n_malformed", "first_type", "n_types",
                        F.array_join(F.array_except(required, "keys"), ",").alias("missing"),
                        F.array_join("keys", ",").alias("present"))


def type_profile(spark: SparkSession, paths: list[tuple[str, int, str]],
                 vocabulary: DataFrame | None = None) -> DataFrame:
    """Per file, the type of its first non-empty line, how many types,
    and how many records; files whose first type is missing are flagged, and
    with a class ``vocabulary`` (column ``curie``) so are unknown types."""
    lines = _lines(spark, paths).withColumn("type", F.get_json_object("value", "$.type"))
    first = F.min_by("type", F.struct("file_path", "split_start", "row_in_split"))
    profile = (lines.groupBy("file_name")
                    .agg(first.alias("first_type"),
                         F.count_distinct("type").alias("n_types"),
                         F.count(F.lit(1)).alias("n_records"))
                    .withColumn("first_type_missing", F.col("first_type").isNull()))
    if vocabulary is None:
        return profile
    known = vocabulary.select(F.col("curie").alias("first_type"), F.lit(True).alias("_known"))
    return (profile.join(known, "first_type", "left")
                   .withColumn("first_type_known", F.coalesce("_known", F.lit(False)))
                   .drop("_known"))


# -- writing a release derived from the driver tables --------------------------

def write_release(records: DataFrame, lines: DataFrame, root: str) -> str:
    """Write records as JSON lines and cluster lines as text, one entry per
    release file, rows in line order (sorted write: part files in order)."""
    # the file names (one row per release file) drive one write per file
    for name in [r["file_name"] for r in records.select("file_name").distinct().collect()]:
        (records.where(F.col("file_name") == name)
                .orderBy("row_in_split")
                .select(*COMPENDIA_COLUMNS)
                .write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip")
                .json(f"{root}/compendia/{name}"))
    for name in [r["file_name"] for r in lines.select("file_name").distinct().collect()]:
        (lines.where(F.col("file_name") == name).orderBy("row_in_split").select("value")
              .write.mode("overwrite").text(f"{root}/conflation/{name}"))
    return root


def write_fixture_release(spark: SparkSession, sf_dir: str) -> str:
    """The driver tables' release written once per session and data folder."""
    from conceptnorm.sources import fixtures as fx
    key = (session_key(spark), sf_dir)
    with _LOCK:
        if key not in _WRITTEN:
            root = scratch_path(spark, "release")
            _WRITTEN[key] = write_release(fx.compendia_records(spark, sf_dir),
                                          fx.conflation_lines(spark, sf_dir), root)
        return _WRITTEN[key]


def load_release(spark: SparkSession, root: str, strict: bool = True,
                 types_vocab: DataFrame | None = None, materialize: bool = True):
    """A1-A5 + ingest: the store built from a written release folder. The
    type vocabulary defaults to the types the release uses."""
    from concurrent.futures import ThreadPoolExecutor

    from conceptnorm.plans.vocabulary import Vocabulary
    with ThreadPoolExecutor(max_workers=1) as pool:   # list both folders at once
        lines_future = pool.submit(read_conflation, spark, root)
        records = read_compendia(spark, compendia_paths(spark, root))
        lines = lines_future.result()
    if types_vocab is None:
        # staged: the files are parsed for it once, not for each use
        types_vocab = stage(records.select(F.col("type").alias("curie")).distinct(), "types")
    return Vocabulary.build(records, lines, types_vocab, strict=strict,
                            scan_order=True, materialize=materialize)


def write_lines(df: DataFrame, path: str, col: str = "value") -> None:
    """Write a column of lines verbatim, one per line."""
    df.select(col).write.mode("overwrite").text(path)
