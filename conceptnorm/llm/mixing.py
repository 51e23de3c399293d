"""Mixing sources to target weights by pivotal dependent rounding.

A source's target by its size is the number of copies that each of its documents should have: some
whole copies and a fraction. The fractions are rounded in pairs: of two documents with fractions,
words are moved from one to the other until one fraction is 0 or 1. Which way is drawn so that each
document's expected copies stay as they were, and as the same number of words leaves one and enters
the other, a source's total doesn't change. At last one document with a fraction is left in each
source, and only its rounding makes the total differ from the target: by less than its size.

Pairs are made in blocks of bounded size, dealt by a hash of the id, so a hot source is many blocks.
Each block leaves one document with a fraction; those are dealt into blocks again, level by level,
until each source has one (a reduction tree). Draws come from hashes of the ids, so reruns and
retries agree however rows are partitioned. Only ids, sources and sizes move, never a text.

Defined results: a null text has size 0; rows alike in id, source and size share one draw and are
taken equally often; a document of size 0 is taken as often as its source's whole copies; a null
source is a source, the last; a source of size 0 has target 0; an empty table gives no rows. Other
columns are ignored by ``mix`` and kept by ``mixed``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conceptnorm.llm.common import small, stage

WEIGHTS, SHARE, LIMIT, SEED = (3, 1, 2), 1.5, 2.0, 7
#: Documents in a block, about.
BLOCK = 20_000
#: Sources, or ids with their copies, are broadcast up to so many rows (under 100 bytes each).
BROADCAST_ROWS = 500_000
KEY = ["source", "doc_id", "size"]


def n_words(text: Column) -> Column:
    r"""Number of [^\x20\x09-\x0D]+ in a text; null has none."""
    found = F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+", -1)
    return F.when(F.length(found[0]) > 0, F.size(found)).otherwise(0).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """source, source_size, target: one row per source of ``sizes`` (source, source_size).

    Weights repeat along the sources by code point, null last. Targets share ``share`` of all sizes
    by weight and stop at ``limit`` times the source's size. With the sources sorted by size by
    weight, the first ones stop; the first of which the rest's share needs no stop gives the share
    for all after it. The frame has a row per source, so its windows are small."""
    places = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(places) - 1, F.lit(len(weights))))
    rows = sizes.withColumn("weight", weight).withColumn("most", limit * F.col("source_size"))
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    left = share * F.sum("source_size").over(all_) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rest = F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("unit", left / rest)
    rows = rows.withColumn("unit", F.min(F.when(F.col("unit") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "unit"))).over(all_)["unit"])
    return rows.select("source", "source_size", F.least("most", F.coalesce(F.col("unit") * F.col("weight"), "most")).alias("target"))


def _draw(a: int, b: int, seed: int) -> float:
    """A number from 0 to 1 made of two hashes."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9 + 1) & (2**64 - 1)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * by) & (2**64 - 1)
    return (x ^ (x >> 31)) / 2**64


def _pivot(seed: int):
    def run(block: pa.Table) -> pa.Table:
        """Round a block's fractions but for one."""
        block = block.sort_by([("hash", "ascending"), ("mass", "ascending")])
        fraction, mass = block["fraction"].to_numpy().copy(), block["mass"].to_numpy()
        hashes = block["hash"].to_numpy()
        rest = -1                                # the document that still has a fraction
        for i in range(len(fraction)):
            if not 0 < fraction[i] < 1:
                continue
            if rest < 0:
                rest = i
                continue
            give = min(fraction[rest] * mass[rest], (1 - fraction[i]) * mass[i])      # from rest to i
            take = min(fraction[i] * mass[i], (1 - fraction[rest]) * mass[rest])      # from i to rest
            moved = give if _draw(int(hashes[rest]), int(hashes[i]), seed) * (give + take) < take else -take
            full_rest = abs(moved) >= (fraction[rest] if moved > 0 else 1 - fraction[rest]) * mass[rest] * (1 - 1e-12)
            x, y = fraction[rest] - moved / mass[rest], fraction[i] + moved / mass[i]
            if full_rest:
                fraction[rest], fraction[i] = float(moved < 0), min(1.0, max(0.0, y))
                rest = i if 1e-12 < fraction[i] < 1 - 1e-12 else -1
                if rest < 0:
                    fraction[i] = round(fraction[i])
            else:
                fraction[i], fraction[rest] = float(moved > 0), min(1.0, max(0.0, x))
                if not 1e-12 < fraction[rest] < 1 - 1e-12:
                    fraction[rest], rest = round(fraction[rest]), -1
        return block.set_column(block.schema.get_field_index("fraction"), "fraction", pa.array(fraction))
    return run


def _rounded(docs: DataFrame, blocks: int, seed: int) -> DataFrame:
    """Whole fractions for all rows: level by level, those left over are dealt into fewer blocks."""
    done, level = None, 0
    while True:
        dealt = docs.withColumn("block", F.pmod(F.xxhash64("hash", F.lit(seed + level)), F.lit(blocks)))
        docs = stage(dealt.groupBy("source", "block").applyInArrow(_pivot(seed + level), dealt.schema), "rounding").drop("block")
        open_ = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        whole = docs.filter(~open_)
        done = whole if done is None else done.unionByName(whole)
        docs = docs.filter(open_)
        if blocks == 1:
            break
        blocks, level = -(-blocks // 64), level + 1
    last = (F.pmod(F.xxhash64("hash", F.lit(seed)), F.lit(1 << 30)) / (1 << 30) < F.col("fraction")).cast("double")
    return done.unionByName(docs.withColumn("fraction", last))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("doc_id"),
                       n_words(F.col(text_col).cast("string")).alias("size"))
    units = stage(rows.groupBy(*KEY).agg(F.count("*").alias("n_rows")), "sizes")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"))
    goals = stage(targets(sizes, weights, share, limit), "targets")
    share_ = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = small(goals.withColumnRenamed("source", "p_source"), BROADCAST_ROWS)
    units = units.join(goals, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("share", share_).drop("p_source")
    units = units.withColumn("whole", F.floor("share")).withColumn("hash", F.xxhash64(*KEY))
    part = units.filter((F.col("size") > 0) & (F.col("share") > F.col("whole")))
    blocks = max(1, -(-units.count() // BLOCK))
    part = _rounded(part.select("source", "doc_id", "size", "hash", (F.col("share") - F.col("whole")).alias("fraction"),
                                (F.col("size") * F.col("n_rows")).cast("double").alias("mass")), blocks, seed)
    part = part.select(*(F.col(c).alias(f"p_{c}") for c in KEY), F.col("fraction").cast("bigint").alias("more"))
    same = F.lit(True)
    for c in KEY:
        same = same & units[c].eqNullSafe(part[f"p_{c}"])
    out = units.join(part, same, "left").withColumn("copies", F.col("whole") + F.coalesce("more", F.lit(0)))
    return out.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n_rows"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, whole."""
    taken = mix(docs, id_col, text_col, source_col, **how).select(*(F.col(c).alias(f"__{c}") for c in KEY), "copies").distinct()
    taken = stage(taken.withColumnRenamed("copies", "__copies").filter("__copies > 0"), "copies")
    same = F.col(id_col).eqNullSafe(F.col("__doc_id")) & F.col(source_col).cast("string").eqNullSafe(F.col("__source")) \
        & (n_words(F.col(text_col).cast("string")) == F.col("__size"))
    return docs.join(small(taken, BROADCAST_ROWS), same).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies"))) \
        .select(*(docs[c] for c in docs.columns))
