"""Quality rules: a log-likelihood ratio of hashed n-grams, and counts on words and lines.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. Counts over the whole
corpus (with one added to each bucket) give a multinomial; counts over the trusted documents, with
``BUCKETS`` more spread as the corpus is, give another, so few trusted documents say little. A
document's ratio is the sum over its grams of log(trusted / corpus), divided by the number of
grams. A document is kept if it passes the base rules and its ratio is ``LEAST`` or more: the
threshold is fixed, there is no draw. Counting is one aggregation to ``BUCKETS`` rows, scoring a
projection without a shuffle; all of it is DataFrame functions.

Defined results: a null, empty or wordless text has no words, counts of 0, a ratio of 0 and fails
the base rules; each row, repeated or not, with or without an id, gets its own row; without trusted
documents (or without any) the ratio is 0 or there are no rows; a document with several labels is
trusted if one of them is good. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptnorm.llm.common import small, stage

BUCKETS = 1 << 14
LEAST = -0.08
#: Ids of trusted documents are broadcast up to so many (16 bytes each).
BROADCAST_IDS = 1_000_000
# fixed values of the base rules
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30


def _grams(docs: DataFrame) -> DataFrame:
    """With word hashes h1 and hashes h2 of neighbouring pairs; text null becomes empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.withColumn("text", text)
    docs = docs.withColumn("h1", F.transform(F.filter(F.split("text", SPACE, -1), lambda w: w != ""), lambda w: F.xxhash64(w)))
    return docs.withColumn("h2", _joined("h1", 1))


def _joined(col: str, step: int) -> Column:
    """Hashes of each element with the one ``step`` after it."""
    return F.transform(F.slice(col, 1, F.greatest(F.size(col) - step, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(F.col(col), i + step)))


def _bucket(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(BUCKETS))


def ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """log(trusted / corpus) of each bucket: BUCKETS numbers, whatever the size of the corpus."""
    good = small(trusted.select(F.col("doc_id"), F.lit(True).alias("good")).dropna().distinct(), BROADCAST_IDS)
    grams = _grams(docs.select("doc_id", "text").join(good, "doc_id", "left").select("text", "good"))
    counts = grams.select("good", F.explode(F.transform(F.concat("h1", "h2"), _bucket)).alias("bucket")) \
        .groupBy("bucket").agg(F.count("*").alias("corpus"), F.count("good").alias("trusted"))
    rows = counts.collect()                      # BUCKETS rows at most
    corpus, target = [1] * BUCKETS, [0] * BUCKETS
    for r in rows:
        corpus[r["bucket"]] += r["corpus"]
        target[r["bucket"]] = r["trusted"]
    all_, good = sum(corpus), sum(target)
    return [math.log((t * all_ / c + BUCKETS) / (good + BUCKETS)) for t, c in zip(target, corpus, strict=True)]


def scores(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    ratio, base_failed, kept. ``trusted`` holds the doc_id of the trusted documents."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = F.from_json(F.lit(json.dumps(ratios(docs, trusted))), "array<double>")
    text = F.col("text")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    total = [F.aggregate(c, F.lit(0.0), lambda s, h: s + F.get(table, _bucket(h))) for c in ("h1", "h2")]
    out = _grams(docs)
    out = out.select(
        "doc_id", F.size("h1").cast("bigint").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        ((total[0] + total[1]) / F.greatest(F.size("h1") + F.size("h2"), F.lit(1))).alias("ratio"),
        _joined("h2", 2).alias("h4"))
    out = out.withColumn("h8", _joined("h4", 4)).drop("h4")
    # windows that occur again: neighbours are equal when all are sorted by hash, then by place
    out = out.withColumn("sorted", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.array_sort(
        F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("h8")
    again = F.filter(F.transform("sorted", lambda x, k: F.when(
        (F.get("sorted", k - 1)["h"] == x["h"]) | (F.get("sorted", k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull())
    out = out.withColumn("again", F.array_sort(again)).drop("sorted")
    covered = F.aggregate(F.transform("again", lambda i, k: F.least(
        F.lit(REPEAT), F.coalesce(F.get("again", k + 1) - i, F.lit(REPEAT)))), F.lit(0), lambda s, n: s + n)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("again")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio",
                      failed.alias("base_failed"), (~failed & (F.col("ratio") >= least)).alias("kept"))
