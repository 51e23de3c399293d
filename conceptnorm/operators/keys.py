"""Surrogate keys and bounded broadcasts.

Dense 1-based ids that follow a sort order are assigned in two passes
without a single-partition window over the data: range-partition and sort
by the key, checkpoint (so both passes see the same rows in the same
partitions, and an executor loss cannot reshuffle them), count rows per
partition, then add each partition's running offset. Only the per-partition
counts -- one row per partition -- go through a global window.
"""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from conceptnorm.session import PARQUET_CODEC, configure, scratch_path

# monotonically_increasing_id() = partition index << 33 | row within partition
_ROW_BITS = 33


def dense_ids(df: DataFrame, order_cols: list[str | Column], id_col: str = "id",
              num_partitions: int | None = None, start_after: int = 0) -> DataFrame:
    """Return ``df`` with ``id_col`` = ``start_after`` + 1-based rank of the
    (unique) order key.

    The sorted rows are staged (written once to the shared checkpoint
    folder), so ids are stable for every later use and the range sampling
    never re-runs the input.
    """
    spark = df.sparkSession
    configure(spark)
    # without a number given, the planner sizes the ranges by their data
    parts = [num_partitions] if num_partitions else []
    ranged = stage(df.repartitionByRange(*parts, *order_cols)
                     .sortWithinPartitions(*order_cols)
                     .withColumn("_mid", F.monotonically_increasing_id()), "ids")
    pid = F.shiftright(F.col("_mid"), _ROW_BITS)
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: its running offset, staged so that no later use counts again
    offsets = stage(counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")), "offsets")
    return (ranged.join(F.broadcast(offsets), pid == F.col("_pid"))
                  .withColumn(id_col, (F.col("_off") + row + 1 + F.lit(start_after)).cast("bigint"))
                  .drop("_mid", "_pid", "_off"))


# the paths staged for whatever is being built in this context: builds in
# different threads don't see each other's
_SCOPE: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


@contextmanager
def staging_scope():
    """Collect the paths staged inside the block (for ``drop_paths`` once
    whatever reads them has been written out)."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)


def submit(pool, fn, *args, **kwargs):
    """``pool.submit`` that keeps the caller's staging scope."""
    return pool.submit(copy_context().run, fn, *args, **kwargs)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut, the rows are fixed (a lost executor recomputes
    nothing nondeterministic), and later reads prune columns, nested ones too."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", PARQUET_CODEC).parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return df.sparkSession.read.parquet(path)


def dense_ids_by_split(df: DataFrame, id_col: str = "id", start_after: int = 0,
                       whole_splits: bool = False) -> DataFrame:
    """Dense ids in scan order for rows read from files.

    Takes the ``ORDER_KEY`` columns as the release readers produce them. A
    row's id is its rank within its split plus the rows of all splits before.
    Ranks need the rows of a split together, a bounded group (a split is at
    most ``spark.sql.files.maxPartitionBytes`` of a file).

    ``whole_splits``: no row of the scan has been dropped, so the rows of a
    split are a contiguous run of ``monotonically_increasing_id()`` values
    and the rank is a difference, without a shuffle of the rows.
    """
    split = ["file_ord", "file_path", "split_start"]
    stats = (df.groupBy(*split)
               .agg(F.count(F.lit(1)).alias("_n"), F.min("row_in_split").alias("_first")))
    # one row per split, staged so that no later use counts again
    offsets = stage(stats.select(
        *split, "_first",
        F.coalesce(F.sum("_n").over(Window.orderBy(*split).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")), "offsets")
    if whole_splits:
        rank = F.col("row_in_split") - F.col("_first")
    else:
        rank = F.row_number().over(Window.partitionBy(*split).orderBy("row_in_split")) - 1
        df, rank = df.withColumn("_rank", rank), F.col("_rank")
    # without the hint the planner judges the offsets by the rows that they
    # are counted from, and exchanges all rows for each use
    return (df.join(F.broadcast(offsets), split)
              .withColumn(id_col, (F.col("_off") + rank + 1 + F.lit(start_after)).cast("bigint"))
              .drop("_off", "_first", "_rank"))


# a frame of more bytes isn't broadcast, however few its rows; a row takes so many besides its texts
MAX_BROADCAST_BYTES, ROW_BYTES = 256 << 20, 48


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` (of texts and numbers) only after proving that it has
    at most ``max_rows`` rows and ``max_bytes`` (MAX_BROADCAST_BYTES) bytes.

    The proof reads at most ``max_rows + 1`` rows. Above a bound the frame
    is returned unchanged and the planner keeps a shuffle join.
    """
    most = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    width = reduce(Column.__add__, texts, F.lit(ROW_BYTES)).cast("bigint")
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["bytes"] <= most else df


# a Bloom filter's bits per key and at most (8 MB)
BLOOM_BITS_PER_KEY, MAX_BLOOM_BITS = 16, 1 << 26


def _slots(col: str | Column, bits: int) -> list[Column]:
    h = F.xxhash64(col)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def bloom_filter(keys: DataFrame, col: str) -> tuple[DataFrame, int]:
    """A Bloom filter (two bits a key) over a column: one staged row with an
    array of 64-bit words, and its number of bits. Beyond MAX_BLOOM_BITS it
    only lets more through."""
    spark, n, bits = keys.sparkSession, keys.count(), 1 << 10
    while bits < min(MAX_BLOOM_BITS, BLOOM_BITS_PER_KEY * n):
        bits *= 2
    slots = keys.where(F.col(col).isNotNull()).select(F.explode(F.array(*_slots(col, bits))).alias("slot"))
    one = F.lit(1).cast("bigint")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", one, F.col("slot").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))).alias("w"))
    # bits / 64 rows at most, whatever the keys
    dense = spark.range(bits >> 6).withColumnRenamed("id", "word").join(words, "word", "left")
    row = dense.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")))).alias("x"))
    return stage(row.select(F.transform("x", lambda y: y["w"]).alias("bits")), "bloom"), bits


def maybe_among(col: str | Column, bloom: tuple[DataFrame, int]) -> Column:
    """Whether a value may be among the keys of a ``bloom_filter``: false is certain (null for null)."""
    row, bits = bloom
    words, found = row.scalar(), F.lit(True)
    for slot in _slots(col, bits):
        word = F.get(words, F.shiftright(slot, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
        found = found & (bit.bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return found


def possibly_among(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """The rows of ``df`` whose ``col`` is among the keys, and about one in
    sixty of the others: a filter on the scan, before any exchange."""
    return df.where(maybe_among(col, bloom_filter(keys, key_col or col)))


def max_id(df: DataFrame, col: str = "id") -> int:
    """Largest id of a table, 0 when empty (one scalar to the driver)."""
    top = df.agg(F.max(col).alias("m")).first()["m"]
    return int(top or 0)
