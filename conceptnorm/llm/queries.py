"""The registered queries of this subpackage: each reads its whole table through its operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptnorm.llm import (
    chat,
    collocations,
    decontaminate,
    language,
    main_text,
    mixing,
    near_dup,
    quality,
    repeats,
    reshard,
    runs,
    secret_scan,
    toxicity,
)
from conceptnorm.llm.common import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


#: The law that shards follow: their bytes are near equal.
LAW = "bytes"


def sharded(docs: DataFrame) -> DataFrame:
    """From shards by source, which are as uneven as the sources, to near equal ones. The files of
    those that change are written to the shared folder; they are the result, so they stay."""
    path = f"{shared_folder(docs.sparkSession)}/llm/shards-{uuid.uuid4().hex}"
    placed = reshard.resharded(docs, "source", path)
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text.main_text(pages, extra=["url"])
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: Added to the conversations: control strings inside of texts.
PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return chat.read_back(*chat.formatted(rows.unionByName(probe)))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality.scores(table(spark, sf_dir, "documents"), trusted)


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def language_prototypes(docs: DataFrame):
    """Learned from the documents that aren't held out."""
    return language.prototypes(docs.filter(_remainder(4) != 2))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language_prototypes(docs))
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.scores(docs, toxicity.learn(docs, labels.filter(_remainder(5) != 0)))
    return found.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows", "n_toxic")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind_no"] < len(secret_scan.BASE))

    def shown(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(i, kind):
        return F.size(F.filter(spans, lambda s: s["kind_no"] == i)).cast("bigint").alias(f"n_{kind}")

    counts = [count(i, r.kind) for i, r in enumerate(secret_scan.BASE)]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(spans).alias("spans"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every tenth hash, the words from a on are made to repeat with period p."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    a = F.when((h % 10 == 0) & (n > 0), g % n)
    docs = docs.withColumn("a", a).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    found = runs.periodic_runs(docs, loop=("a", "p"))
    # the longest run, then least start and period: later rows of the sorted list only if longer
    first = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(y["length"] > x["length"], y).otherwise(x))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return found.withColumn("longest", first).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_chat_format, op3_mixing, op4_quality_rules, op5_resharding, op6_main_text,
    op7_near_dup, op8_language_id, op9_toxicity, op10_secret_scan, op11_suffix_dedup,
    op12_periodic_runs, op13_collocations)}
