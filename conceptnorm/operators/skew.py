"""Skew-safe grouping helpers.

A single group may hold a third of all rows, so no helper sends a whole
group to one task: per-group top-k runs first on (group, salt) sub-groups and
only the k survivors of each sub-group meet in the final step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 64


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                    k: int, salt_on: Column | str | None = None,
                    buckets: int = SALT_BUCKETS) -> DataFrame:
    """Rows ranked 1..k within each group by ``order_cols`` (ties broken by
    the order columns, which should be unique within a group)."""
    salt_src = F.col(salt_on) if isinstance(salt_on, str) else salt_on
    if salt_src is None:
        salt_src = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_src), F.lit(buckets)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    local = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (local.drop("_r", "_salt")
                 .withColumn("rank", F.row_number().over(w2))
                 .where(F.col("rank") <= k))
