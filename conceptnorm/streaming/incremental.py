"""Incremental ingest with Structured Streaming (A10 as a stream).

Compendia JSON-lines files landing in a folder are appended to a store
micro-batch by micro-batch: known identifiers keep id and label, new
identifiers, cliques and descriptions get ids after the store's largest; a
taxon link is written once; a taxon that an epoch defines after another one
only referenced it gets its label. What a batch can't take is written to
``rejected``, per epoch like the rest.

Layout: every table of a streamed store is partitioned by ``epoch`` (the
micro-batch id). A batch writes its new rows into ``<table>/epoch=<id>`` with
overwrite, and reads the store only from earlier epochs, so a batch that is
replayed after a failure rewrites exactly its own rows: the sink is
idempotent and the stream exactly-once end to end.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from conceptnorm.operators.append import APPENDED, new_rows
from conceptnorm.operators.keys import stage
from conceptnorm.operators.normalize import normalize_compendia
from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.schema import COMPENDIA_RECORD, TAXON_FILE, UNKNOWN_TAXON_LABEL
from conceptnorm.session import PARQUET_CODEC, configure

EPOCH = "epoch"
# labels of taxa that an earlier epoch only knew by reference
RELABELS = "relabels"
CONFLATION_SCHEMAS = {
    "conflation_clusters": "id bigint, type int",
    "conflation_members": "cluster_id bigint, identifier_id bigint, is_canonical int",
    "conflation_wide": "cluster_id bigint, conflation_type int, member_curie string, "
                       "member_id bigint, pos int, is_canonical int",
}


def _table(spark: SparkSession, store: str, name: str, before: int) -> DataFrame | None:
    try:
        df = spark.read.parquet(f"{store.rstrip('/')}/{name}")
    except AnalysisException:
        return None
    return df.where(F.col(EPOCH) < before).drop(EPOCH)


def load_streamed(spark: SparkSession, store: str, before: int | None = None) -> Vocabulary | None:
    """The store as of (not including) epoch ``before``; None if empty."""
    limit = before if before is not None else (1 << 62)
    frames = {}
    for f in fields(Vocabulary):
        df = _table(spark, store, f.name, limit)
        if df is None:
            return None
        frames[f.name] = df
    relabels = _table(spark, store, RELABELS, limit)
    if relabels is not None:        # few: taxa defined after they were first referenced
        frames["identifiers"] = (frames["identifiers"].join(relabels, "id", "left")
                                 .select("id", "curie", F.coalesce("new_label", "label").alias("label")))
    return Vocabulary(**frames)


def _late_definitions(records: DataFrame, existing: Vocabulary) -> DataFrame:
    """(id, new_label): unknown taxa of the store that the batch defines."""
    order = ["file_ord", "file_path", "split_start", "row_in_split", "pos"]
    members = records.select(*order[:-1], F.posexplode("identifiers").alias("pos", "m"))
    labels = members.groupBy(F.col("m.i").alias("curie")).agg(F.min_by("m.l", F.struct(*order)).alias("new_label"))
    unknown = existing.identifiers.where(F.col("label") == UNKNOWN_TAXON_LABEL)
    return unknown.join(labels, "curie").where(F.col("new_label").isNotNull()).select("id", "new_label")


def _empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)


def append_batch(records: DataFrame, epoch: int, store: str, types_vocab: DataFrame) -> None:
    """Append one micro-batch of records to the store (idempotent per epoch)."""
    spark = records.sparkSession
    configure(spark)
    existing = load_streamed(spark, store, before=epoch)
    if existing is not None and not existing.types.head(1):
        existing = None             # the first epoch again: the folders hold only its own rows
    if existing is None:
        new = normalize_compendia(records, types_vocab, strict=False, materialize=False)
        delta = {name: getattr(new, name) for name in APPENDED}
        relabels = spark.createDataFrame([], "id bigint, new_label string")
    else:
        relabels = stage(_late_definitions(records, existing), RELABELS)
        existing.identifiers = (existing.identifiers.join(relabels, "id", "left")
                                .select("id", "curie", F.coalesce("new_label", "label").alias("label")))
        delta, new = new_rows(existing, records, strict=False)
    delta[RELABELS] = relabels
    delta["rejected"] = new.rejected
    delta["types"] = new.types if existing is None else _empty_like(spark, new.types)
    # conflation tables are rebuilt in batch (A11), never streamed: an epoch
    # writes them empty so every table has the same partitions
    for name, schema in CONFLATION_SCHEMAS.items():
        delta[name] = spark.createDataFrame([], schema)
    for name, df in delta.items():
        df.write.mode("overwrite").option("compression", PARQUET_CODEC).parquet(f"{store.rstrip('/')}/{name}/{EPOCH}={epoch}")


def start_append_stream(spark: SparkSession, source_dir: str, store: str, checkpoint: str,
                        types_vocab: DataFrame, available_now: bool = True,
                        max_files_per_trigger: int | None = None,
                        recursive: bool = False) -> StreamingQuery:
    """Start the stream: new files in ``source_dir`` -> store at ``store``.

    Within a micro-batch, line order is (file path, split start, row); row ids
    are taken directly on the micro-batch scan, before any shuffle.
    """
    configure(spark)
    reader = spark.readStream.schema(COMPENDIA_RECORD).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if recursive:   # release files written as folders of part files
        reader = reader.option("recursiveFileLookup", "true")
    stream = reader.json(source_dir).select(
        "*", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"))

    def each_batch(batch: DataFrame, epoch: int) -> None:
        # the taxon compendium first, then by path (as a batch load orders files)
        taxon_first = F.when(F.col("file_path").contains(f"/{TAXON_FILE}"), 0).otherwise(1)
        records = (batch.withColumn("row_in_split", F.monotonically_increasing_id())
                        .withColumn("file_ord", taxon_first))
        append_batch(records, int(epoch), store, types_vocab)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
