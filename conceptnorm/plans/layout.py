"""How a written store lies on disk.

The serving tables are hash-bucketed and sorted by the CURIE that lookups join
on, all of them into the same number of buckets. A bulk lookup then exchanges
its inputs only, never a table, and two serving tables meet without any
exchange; a literal CURIE reads one bucket, and in it the row groups that can
hold it (sorted, with Parquet Bloom filters).

A bucket can't be split, so the rows of a CURIE that has more than
``HEAVY_ROWS`` of them lie in a table of their own beside the bucketed one,
range-sorted by CURIE and a second key. There are at most rows / HEAVY_ROWS
such CURIEs; lookups join both parts.

Spark keeps the bucket specification with the table in the session's catalog,
so ``open_table`` declares the files as an external table each time a store is
opened; the store's ``layout`` table holds what it needs.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conceptnorm.session import PARQUET_CODEC

# serving table -> (bucket column, identifier id column, second sort key of heavy rows)
BUCKETED = {"identifiers": ("curie", "id", "id"),
            "membership_wide": ("member_curie", "member_id", "clique_id"),
            "conflation_wide": ("member_curie", "member_id", "cluster_id"),
            "cliques_wide": ("primary_curie", "primary_identifier_id", "clique_id")}
# texts by the identifier they describe: fetched last, by id
DESCRIPTIONS = "descriptions_wide"
_KEYS = BUCKETED | {DESCRIPTIONS: ("identifier_id", "identifier_id", "description_id")}
# identifiers in a bucket, about
ROWS_PER_BUCKET = 2_000_000
# a CURIE with more rows in a table is kept out of its buckets
HEAVY_ROWS = 1_000_000
LAYOUT = "layout"


def bucket_count(spark: SparkSession, n_identifiers: int) -> int:
    """Buckets for a store. Not fewer than the session's shuffle partitions:
    the planner would rather exchange both sides of a join then."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_identifiers / ROWS_PER_BUCKET))


def heavy_ids(ids: DataFrame, col: str, heavy_rows: int | None = None) -> DataFrame:
    """(id): those with more rows than a bucket should take at once."""
    most = HEAVY_ROWS if heavy_rows is None else heavy_rows
    return ids.groupBy(F.col(col).alias("heavy_id")).count().where(F.col("count") > most).select("heavy_id")


def _table_name(path: str, name: str) -> str:
    return f"store_{hashlib.md5(f'{path}/{name}'.encode()).hexdigest()}"


def write_table(df: DataFrame, path: str, name: str, buckets: int, heavy: DataFrame | None = None) -> None:
    """Write one serving table: its buckets, and beside them the heavy rows."""
    column, id_col, second = _KEYS[name]
    spark, folder, table = df.sparkSession, f"{path}/{name}", _table_name(path, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    bloom = f"parquet.bloom.filter.enabled#{column}"
    if heavy is not None:
        # bounded by rows / HEAVY_ROWS, so the planner may broadcast them
        few = heavy.withColumnRenamed("heavy_id", id_col)
        (df.join(few, id_col, "left_semi").repartitionByRange(column, second).sortWithinPartitions(column, second)
           .write.mode("overwrite").option("compression", PARQUET_CODEC).option(bloom, "true").parquet(f"{folder}_heavy"))
        df = df.join(few, id_col, "left_anti").select(*df.columns)
    (df.repartition(buckets, column).write.format("parquet").mode("overwrite")
       .option("path", folder).option("compression", PARQUET_CODEC).option(bloom, "true")
       .bucketBy(buckets, column).sortBy(column).saveAsTable(table))


def open_table(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """A bucketed table's files as a table that the planner knows the buckets of."""
    column, table = _KEYS[name][0], _table_name(path, name)
    if not spark.catalog.tableExists(table):
        schema = spark.read.parquet(f"{path}/{name}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        location = f"{path}/{name}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({column}) "
                  f"SORTED BY ({column}) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def append_rows(df: DataFrame, path: str, name: str) -> None:
    """Add rows to an open bucketed table, into its buckets."""
    table = _table_name(path, name)
    buckets = layout(df.sparkSession, path)[name][0]
    order = df.sparkSession.table(table).columns
    df.select(*order).repartition(buckets, _KEYS[name][0]).write.insertInto(table)


def write_layout(spark: SparkSession, path: str, rows: list[tuple[str, int, bool]]) -> None:
    """(name, buckets, has heavy rows) of each bucketed table: one small file."""
    spark.createDataFrame(rows, "name string, buckets int, heavy boolean").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/{LAYOUT}")


def layout(spark: SparkSession, path: str) -> dict[str, tuple[int, bool]]:
    """What ``write_layout`` wrote (a row per serving table), empty for a store without."""
    try:
        rows = spark.read.parquet(f"{path}/{LAYOUT}").collect()
    except AnalysisException:
        return {}
    return {r["name"]: (r["buckets"], r["heavy"]) for r in rows}
