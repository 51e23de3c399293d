"""Dense ids, bounded broadcasts and the salted top-k."""

import random

from pyspark.sql import functions as F

from conceptnorm.operators.keys import bounded_broadcast, dense_ids
from conceptnorm.operators.skew import top_k_per_group


def test_dense_ids_follow_key_order_across_partitions(spark):
    keys = random.Random(7).sample(range(10**9), 5000)
    df = spark.createDataFrame([(k, f"k{k}") for k in keys], "k bigint, v string").repartition(13)
    rows = dense_ids(df, ["k"], "id", num_partitions=9).select("id", "k").collect()
    got = sorted((r.id, r.k) for r in rows)
    assert got == list(zip(range(1, 5001), sorted(keys)))
    again = dense_ids(df, ["k"], "id", num_partitions=4, start_after=100).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (again.lo, again.hi) == (101, 5100)


def test_bounded_broadcast_checks_the_bound(spark):
    small = spark.range(10)
    assert "broadcast" in bounded_broadcast(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert bounded_broadcast(small, 9) is small


def test_bounded_broadcast_checks_bytes(spark):
    # few rows, but of wide texts: bytes are counted in UTF-8, nulls have none
    wide = spark.createDataFrame([("\u00e9" * 500, 1), (None, 2)], "curie string, id bigint")
    assert bounded_broadcast(wide, 2, 1000) is wide
    assert "broadcast" in bounded_broadcast(wide, 2, 1100)._jdf.queryExecution().logical().toString().lower()
    assert bounded_broadcast(wide, 1, 1100) is wide


def test_top_k_on_a_hot_group(spark):
    # one group holds most rows; salting splits it before the final ranking
    rows = [("hot", f"m{i:05d}") for i in range(3000)] + [("cold", "b"), ("cold", "a")]
    df = spark.createDataFrame(rows, "g string, m string")
    top = top_k_per_group(df, ["g"], ["m"], 3, salt_on="m").orderBy("g", "rank").collect()
    assert [(r.g, r.m, r.rank) for r in top] == [
        ("cold", "a", 1), ("cold", "b", 2),
        ("hot", "m00000", 1), ("hot", "m00001", 2), ("hot", "m00002", 3)]
