"""Free-text name -> identifier.

For each name, its variants are tried in order; the first variant that is an
ASCII-case-insensitive literal prefix of some label wins, and among the labels
it prefixes the least (folded label, label, CURIE) is returned. CURIEs that
start with ``PMID:`` never match.

A ``startswith`` join between two columns would be a nested loop. In sorted
order, though, all texts with a prefix stand together right after the prefix
itself, so the first label at or after a variant is its only candidate. Variants
and labels are therefore sorted together once (range-partitioned, staged), a
running value carries the nearest following label to each variant, and the
first label of the next partition that has one serves those at a partition's
end. Work is linear in labels and variants; nothing is expanded by length.

A written store has its labels in that order already (``label_order``): a
lookup there reads only the files that its variants lead to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conceptnorm.functions.names import (clean_variants, paren_strips, remove_abbreviations,
                                         singular)
from conceptnorm.functions.scalars import ascii_lower
from conceptnorm.operators import label_order
from conceptnorm.operators.keys import stage
from conceptnorm.plans.vocabulary import Vocabulary

# monotonically_increasing_id() = partition index << 33 | row within partition
_ROW_BITS = 33


def variants(names: DataFrame, col: str = "name") -> DataFrame:
    """F5 exploded: (name, variant_ord, variant), ordinals from 0.

    Built in steps (strips, base variants, all variants) so that each
    expensive array expression is evaluated once per name."""
    df = names.select(F.col(col).alias("name")).distinct()
    df = df.withColumn("_strips", paren_strips(F.col("name")))
    df = df.withColumn("_base", clean_variants(F.concat(
        F.array("name"), F.col("_strips"), F.array(remove_abbreviations(F.col("name"))))))
    df = df.withColumn("_all", clean_variants(F.concat(F.col("_base"),
                                                       F.transform("_base", singular))))
    # posexplode_outer: a plain posexplode lets the optimizer infer
    # size(_all) > 0 and push that (the whole variant expression) below the
    # distinct, into every input row
    return (df.select("name", F.posexplode_outer("_all").alias("variant_ord", "variant"))
              .where(F.col("variant").isNotNull()))


def next_labels(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """(vkey, best): for each distinct ``vkey`` the first label (struct of
    lkey, label, curie) at or after it in binary order, NULL past the last."""
    label = F.struct("lkey", "label", "curie")
    both = (keys.select("vkey", F.lit(None).cast("struct<lkey:string,label:string,curie:string>").alias("best"))
            .unionByName(labels.select(F.col("lkey").alias("vkey"), label.alias("best"))))
    order = ["vkey", F.col("best").asc_nulls_first()]
    ranged = stage(both.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_mid", F.monotonically_increasing_id()), "sorted-names")
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", _ROW_BITS))
    # from a partition's end to its start: the label met last
    running = (Window.partitionBy("_pid").orderBy(F.col("_mid").desc())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # one row per partition: the first label of those after it
    firsts = ranged.groupBy("_pid").agg(F.min_by("best", F.when(F.col("best").isNotNull(), F.col("_mid"))).alias("_first"))
    later = Window.orderBy(F.col("_pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = firsts.select("_pid", F.last("_first", ignorenulls=True).over(later).alias("_after"))
    return (ranged.withColumn("_near", F.last("best", ignorenulls=True).over(running))
                  .where(F.col("best").isNull()).join(after, "_pid")
                  .select("vkey", F.coalesce("_near", "_after").alias("best")))


def name_to_curie(vocab: Vocabulary, names: DataFrame, col: str = "name") -> DataFrame:
    """(name, curie, label) per distinct input name; NULLs when no match."""
    var = stage(variants(names, col).withColumn("vkey", ascii_lower("variant")), "variants")
    keys, spark = var.select("vkey").distinct(), vocab.identifiers.sparkSession
    if label_order.files(spark, vocab.path) is not None:
        found = label_order.next_stored(spark, vocab.path, keys, next_labels)
    else:
        found = next_labels(keys, label_order.nameable(vocab.identifiers))
    winners = found.where(F.startswith(F.col("best.lkey"), F.col("vkey")))
    matched = (var.join(winners, "vkey")
                  .groupBy("name")
                  .agg(F.min_by("best", "variant_ord").alias("best")))
    return (names.select(F.col(col).alias("name")).distinct()
                 .join(matched, "name", "left")
                 .select("name", F.col("best.curie").alias("curie"),
                         F.col("best.label").alias("label")))
