"""Secret scans with an incremental ledger of blobs.

Every version of every file is addressed by its content (SHA-256). The ledger holds, for each blob,
which rule versions have been run on it and what they found, so only pairs of blob and rule version
that are not in it are scanned, each blob once however many paths hold it. Findings are joined back
to all paths. A rule's version is a digest of its definition: a changed rule is a new one.

All of it is DataFrame functions. Positions come from splitting the text at the matches: gaps and
matches alternate, and a running sum of their lengths, over the exploded matches of each blob, gives
the starts. So a text with very many matches costs memory in proportion.

Defined results: a null text is the empty one and has no findings; each row of the input, repeated
or not, with or without an id, gets its own row; positions count code points, ends are exclusive;
matches of one rule don't overlap, those of several may. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conceptnorm.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts and its least length, and strings of which a text
    with a match holds one (in lower case if ``fold``), which saves most texts the pattern."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    fold: bool = False

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]

    def possible(self, text: Column, folded: Column) -> Column:
        found = F.lit(not self.hints)
        for hint in self.hints:
            found = found | F.contains(folded if self.fold else text, F.lit(hint))
        return found & text.rlike(self.pattern)


# fixed values: the base kinds
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, ("password", "passwd", "secret", "token", "api"), True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),        # runs of [0-9a-f] are maximal: shorter ones never reach this
)
# fixed values: well-known forms of keys
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, ("eyJ",)),
    Rule("private", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1, ("PRIVATE KEY-----",)),
)
RULES = BASE + MORE
LEDGER = "blob binary, versions array<string>, findings array<struct<version: string, start: bigint, end: bigint>>"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings, new): findings has a row for each row of ``docs``: doc_id, blob, spans (start,
    kind_no, end, kind; sorted). new holds what to append to the ledger (schema LEDGER)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    paths = docs.select(F.col(id_col).alias("doc_id"), address(text).alias("blob"), text.alias("text"))
    blobs = paths.groupBy("blob").agg(F.first("text").alias("text"))
    current = F.array(*(F.lit(r.version) for r in rules))
    if ledger is None:
        blobs = blobs.withColumn("todo", current)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("versions"))).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))).filter(F.size("todo") > 0)
    new = stage(_scanned(blobs, rules), "ledger")
    all_ = new if ledger is None else ledger.unionByName(new)
    kinds = F.array(*(F.struct(F.lit(r.version).alias("version"), F.lit(i).alias("kind_no"), F.lit(r.kind).alias("kind"))
                      for i, r in enumerate(rules)))
    found = all_.select("blob", F.explode("findings").alias("f")).select(
        "blob", "f.*", F.filter(kinds, lambda k: k["version"] == F.col("f.version"))[0].alias("k")).filter("k IS NOT NULL")
    found = found.groupBy("blob").agg(F.array_sort(F.collect_set(
        F.struct("start", "k.kind_no", "end", "k.kind"))).alias("spans"))
    out = paths.select("doc_id", "blob").join(found, "blob", "left")
    none = F.array().cast(found.schema["spans"].dataType)
    return out.withColumn("spans", F.coalesce("spans", none)), new


def _scanned(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of the blobs: findings of the rules in ``todo``."""
    text, folded = F.col("text"), F.lower("text")
    hits = [F.when(F.array_contains("todo", r.version) & r.possible(text, folded), F.struct(
        F.lit(r.version).alias("version"), F.lit(i).alias("rule"),
        F.arrays_zip(F.transform(F.split("text", r.pattern, -1), F.length).alias("gap"),
                     F.regexp_extract_all("text", F.lit(r.pattern), 0).alias("hit")).alias("parts")))
        for i, r in enumerate(rules)]
    hits = blobs.select("blob", F.col("todo").alias("versions"), F.array_compact(F.array(*hits)).alias("hits"))
    hits = stage(hits, "matches")
    parts = hits.select("blob", F.explode("hits").alias("h")).select(
        "blob", "h.version", "h.rule", F.posexplode("h.parts").alias("place", "part"))
    before = F.sum(F.col("part.gap") + F.coalesce(F.length("part.hit"), F.lit(0))).over(
        Window.partitionBy("blob", "rule").orderBy("place"))
    hit = F.col("part.hit")
    enough = F.coalesce(*(F.when(F.col("rule") == i, F.length(F.regexp_extract("part.hit", r.pattern, r.group)) >= r.least)
                          for i, r in enumerate(rules)))
    spans = parts.withColumn("end", before).filter(hit.isNotNull()).filter(enough).groupBy("blob").agg(
        F.collect_list(F.struct("version", (F.col("end") - F.length(hit)).alias("start"), "end")).alias("findings"))
    none = F.array().cast(spans.schema["findings"].dataType)
    return hits.select("blob", "versions").join(spans, "blob", "left").select(
        "blob", "versions", F.coalesce("findings", none).alias("findings"))
