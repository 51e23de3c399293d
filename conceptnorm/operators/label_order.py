"""The labels of a store in folded order, and lookups that read little of it.

``write`` stores every label that a name may match, range-sorted by (folded
text, text, CURIE), in files of at most ``LABELS_PER_FILE`` rows, and one row
per file: its last folded text. Rows that an append adds are one more sorted
run beside the first.

The first label at or after a text lies, in each run, in the first file whose
last label isn't before it. So texts are routed to one file a run by their
order among the files' last labels, and only those files are read. In a file,
a running value over its texts and labels carries the nearest following label
to each text. A file is a bounded group; nothing else is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conceptnorm.functions.scalars import ascii_lower, not_excluded_for_names
from conceptnorm.operators.keys import stage

LABELS_PER_FILE = 1_000_000
LABELS, FILES = "labels", "label_files"
# runs are numbered with so many digits, so that their order is that of the text
_RUN_DIGITS = 6


def nameable(identifiers: DataFrame) -> DataFrame:
    """(lkey, label, curie): the labels that a name may match, folded."""
    return (identifiers.where(F.col("label").isNotNull() & not_excluded_for_names("curie"))
            .select(ascii_lower("label").alias("lkey"), "label", "curie"))


def write(identifiers: DataFrame, path: str, run: int = 0) -> None:
    """One sorted run of the labels of ``identifiers``, and its files' last labels."""
    spark, order = identifiers.sparkSession, ["lkey", "label", "curie"]
    folder = f"{path}/{LABELS}/run={run}"
    (nameable(identifiers).repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("maxRecordsPerFile", LABELS_PER_FILE).parquet(folder))
    files = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.max("lkey").alias("last"), F.count(F.lit(1)).alias("n_labels"))
    files.select(F.lit(run).alias("run"), "file", "last", "n_labels").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/{FILES}/part={run}")


def files(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(run, file, last, n_labels) of a store's label files; None without an order."""
    if path is None:
        return None
    try:
        return spark.read.parquet(f"{path}/{FILES}").drop("part")
    except AnalysisException:
        return None


def append(identifiers: DataFrame, path: str) -> None:
    """The labels of new identifiers as one more run, where the store has an order."""
    old = files(identifiers.sparkSession, path)
    if old is not None:
        write(identifiers, path, (old.agg(F.max("run")).first()[0] or 0) + 1)


def _tagged(run, text):
    return F.concat(F.lpad(run.cast("string"), _RUN_DIGITS, "0"), F.lit(":"), text)


def routed(keys: DataFrame, fences: DataFrame, next_of) -> DataFrame:
    """(vkey, run, file): for each distinct ``vkey`` the file of each run that
    holds the first label at or after it. ``next_of`` finds the first of
    sorted rows at or after a text."""
    runs = [r["run"] for r in fences.select("run").distinct().collect()]     # one per append
    asked = keys.select("vkey", F.explode(F.array(*(F.lit(r) for r in runs))).alias("run"))
    asked = asked.select("vkey", "run", _tagged(F.col("run"), F.col("vkey")).alias("tagged"))
    ends = fences.select(_tagged(F.col("run"), F.col("last")).alias("lkey"), F.col("file").alias("label"),
                         F.col("run").cast("string").alias("curie"))
    found = next_of(asked.select(F.col("tagged").alias("vkey")).distinct(), ends)
    found = found.select(F.col("vkey").alias("tagged"), F.col("best.label").alias("file"), F.col("best.curie").cast("int").alias("of_run"))
    return asked.join(found, "tagged").where(F.col("of_run") == F.col("run")).select("vkey", "run", "file")


def read_files(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(file, lkey, label, curie) of the label files that texts were routed to."""
    names = [f"{path}/{LABELS}/run={r['run']}/{r['file']}" for r in wanted.select("run", "file").distinct().collect()]
    if not names:
        return spark.createDataFrame([], "file string, lkey string, label string, curie string")
    return spark.read.parquet(*names).select(F.col("_metadata.file_name").alias("file"), "lkey", "label", "curie")


def next_stored(spark: SparkSession, path: str, keys: DataFrame, next_of) -> DataFrame:
    """(vkey, best): the first label (struct of lkey, label, curie) at or after
    each distinct ``vkey``, from the stored order; none past the last."""
    wanted = stage(routed(keys, files(spark, path), next_of), "routed")
    labels = read_files(spark, path, wanted)
    best = F.struct("lkey", "label", "curie")
    both = (wanted.select("file", "vkey", F.lit(None).cast("struct<lkey:string,label:string,curie:string>").alias("best"))
            .unionByName(labels.select("file", F.col("lkey").alias("vkey"), best.alias("best"))))
    # from a file's end to its start: the label met last (a file has LABELS_PER_FILE labels at most)
    back = (Window.partitionBy("file").orderBy(F.col("vkey").desc(), F.col("best").desc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = both.withColumn("near", F.last("best", ignorenulls=True).over(back)).where(F.col("best").isNull())
    return near.groupBy("vkey").agg(F.min("near").alias("best"))
