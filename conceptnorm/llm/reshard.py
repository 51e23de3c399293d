"""Resharding by minimum-cost flow.

Given the bytes of the old shards and the capacities of the new ones, the blocks that must move are
found as a flow from old to new shards: a byte that stays in the shard of its number costs nothing,
one that moves costs 1 (or what ``cost`` says). The flow is solved on the shards alone, by
augmenting along cheapest paths; documents come in only by their shards' totals. Old shards whose
number no new one has are all alike, as none of their bytes can stay, so they are one supply: the
flow is as large as the new shards are many, whatever the number of old ones. Each old shard, or
those together, is then a line of documents, in blocks by hash, and the flow cuts it at running sums of bytes: a
document goes to the new shard in whose piece of the line it begins. So new shards have their
capacities but for a document at each cut, and no more bytes move than must.

Running sums are taken within blocks of about ``BLOCK`` rows and over the blocks' totals, so a hot
old shard is many blocks and no task sees a whole shard. Only ids, sizes and checksums move until
``rewrite`` writes the new files of those shards that change; there a text moves once, to its block,
as a shard's slots follow the blocks. ``resharded`` does both and reads its rows from the files.

Defined results: a null text has 8 bytes and checksum 0; a null old shard is a shard, the last;
repeated rows are rows of their own, next to each other in the line; with no documents there are no
rows; a new shard may stay empty. Other columns are ignored, but kept by ``rewrite``.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conceptnorm.llm.common import small, stage

SHARDS, BLOCK, OVERHEAD = 24, 2_000, 8
_LINES = pa.schema([("line", pa.int32()), ("cuts", pa.list_(pa.struct([("at", pa.int64()), ("shard", pa.int32())]))),
                    ("n_blocks", pa.int64())])
#: The numbers of so many old shards are broadcast, those of more are joined by a shuffle.
BROADCAST = 2_000


def stay(old: int, new: int) -> int:
    return 0 if old == new else 1


def flow(supply: list[int], capacity: list[int], cost: Callable[[int, int], int] = stay) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, all of the supply at the least cost. Needs capacities
    that hold the supply. Costs are whole numbers from 0 up."""
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards can't hold the old ones")
    moved: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    # what is free to stay does so; a cheapest flow never needs to undo that where cost is `stay`,
    # and with other costs the paths below take it back
    for i in range(min(len(left), len(room))):
        if cost(i, i) == 0 and (x := min(left[i], room[i])):
            moved[i, i] = x
            left[i] -= x
            room[i] -= x
    far = float("inf")
    while any(left):
        # cheapest paths from the old shards with bytes left, forth along costs and back along flows
        back: dict[int, list[int]] = {}
        for (i, j), x in moved.items():
            if x:
                back.setdefault(j, []).append(i)
        at_old = [0 if x else far for x in left]
        at_new, from_old, from_new = [far] * len(room), [-1] * len(room), [-1] * len(left)
        changed = [i for i, x in enumerate(left) if x]
        while changed:
            news = set()
            for i in changed:
                for j in range(len(room)):
                    if (d := at_old[i] + cost(i, j)) < at_new[j]:
                        at_new[j], from_old[j] = d, i
                        news.add(j)
            olds = set()
            for j in news:
                for i in back.get(j, ()):
                    if (d := at_new[j] - cost(i, j)) < at_old[i]:
                        at_old[i], from_new[i] = d, j
                        olds.add(i)
            changed = list(olds)
        end = min((j for j in range(len(room)) if room[j]), key=lambda j: at_new[j])
        path, j = [], end
        while True:
            i = from_old[j]
            path.append((i, j))
            if left[i] and at_old[i] == 0 and from_new[i] < 0:
                break
            j = from_new[i]
            path.append((i, j))
        amount = min([room[end], left[path[-1][0]], *(moved[p] for p in path[1::2])])
        for k, p in enumerate(path):
            moved[p] = moved.get(p, 0) + (amount if k % 2 == 0 else -amount)
        left[path[-1][0]] -= amount
        room[end] -= amount
    return {p: x for p, x in moved.items() if x}


def _key() -> Column:
    return F.xxhash64("doc_id", "text_crc32", "size")


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD


def near_equal(total: int, shards: int) -> list[int]:
    """Capacities that differ by a byte at most."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def numbered(rows: DataFrame) -> DataFrame:
    """old, bytes, n, old_shard: the old shards by code point, null last, numbered from 0."""
    order = F.col("old").asc_nulls_last()
    olds = rows.groupBy("old").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    olds = stage(olds.repartitionByRange(order).sortWithinPartitions(order).withColumn("row", F.monotonically_increasing_id()), "olds")
    part = F.shiftright("row", 33)
    parts = olds.groupBy(part.alias("part")).agg(F.count("*").alias("in_part"))          # a row per partition
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return olds.withColumn("part", part).join(F.broadcast(parts), "part").select(
        "old", "bytes", "n", (F.col("before") + F.col("row") - F.shiftleft("part", 33)).cast("int").alias("old_shard"))


def reshard(docs: DataFrame, old_col: str, shards: int = SHARDS, capacity: list[int] | None = None, id_col: str = "doc_id",
            text_col: str = "text", cost: Callable[[int, int], int] = stay) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, old (its old shard), old_shard (the number of
    that by code point), shard, slot (its place in the shard, from 0), and its line, block and the line's n_blocks,
    by which ``rewrite`` finds its place. With a ``cost`` of one's own the totals of all
    old shards come to the driver; else only those of as many as there are new shards, and one sum."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(old_col).cast("string").alias("old"), size_of(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    rows = stage(rows, "rows")
    olds = stage(numbered(rows), "numbered")
    pool = len(capacity) if capacity else shards
    line_no = F.least("old_shard", F.lit(pool)) if cost is stay else F.col("old_shard")
    totals = sorted(olds.groupBy(line_no.alias("line")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect())
    supply = [r["bytes"] for r in totals]
    moved = flow(supply, capacity or near_equal(sum(supply), shards), cost)
    # a cut: from where in the line bytes go to which new shard
    to: dict[int, list[int]] = {}
    for i, j in moved:
        to.setdefault(i, []).append(j)
    lines = []
    for i, _, n in totals:
        at, own = 0, []
        for j in sorted(to.get(i, ()), key=lambda j: (j != i, j)):
            own.append((at, j))
            at += moved[i, j]
        lines.append({"line": i, "cuts": [{"at": a, "shard": j} for a, j in own], "n_blocks": 1 + n // BLOCK})
    # as an Arrow table: from a list of rows Spark makes it in Python workers, a second set beside those of earlier stages
    lines = docs.sparkSession.createDataFrame(pa.Table.from_pylist(lines, _LINES))
    numbers = small(olds.select(F.col("old").alias("p_old"), "old_shard"), BROADCAST)
    rows = rows.join(numbers, F.col("old").eqNullSafe(F.col("p_old"))).withColumn("line", line_no).join(F.broadcast(lines), "line")
    rows = rows.withColumn("key", _key()).withColumn("block", F.pmod("key", "n_blocks"))
    line = Window.partitionBy("line", "block").orderBy("key", "doc_id", "text_crc32", "size", "old_shard")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_block", F.coalesce(F.sum("size").over(before), F.lit(0)))
    blocks = rows.groupBy("line", "block").agg(F.sum("size").alias("bytes"))       # a row for BLOCK documents
    blocks = blocks.select("line", "block", F.coalesce(F.sum("bytes").over(
        Window.partitionBy("line").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    rows = rows.join(blocks, ["line", "block"])
    at = F.col("offset") + F.col("in_block")
    shard = F.element_at(F.filter("cuts", lambda c: c["at"] <= at), -1)["shard"]
    rows = rows.select("doc_id", "size", "text_crc32", "old", "old_shard", "line", shard.alias("shard"), "block", "n_blocks", "key")
    rows = rows.withColumn("in_piece", F.row_number().over(
        Window.partitionBy("line", "block", "shard").orderBy("key", "doc_id", "text_crc32", "size", "old_shard")) - 1)
    rows = stage(rows, "placed")
    pieces = rows.groupBy("shard", "line", "block").agg(F.count("*").alias("n"))
    pieces = pieces.select("shard", "line", "block", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("line", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return rows.join(pieces, ["shard", "line", "block"]).select(
        "doc_id", "size", "text_crc32", "old", "old_shard", "shard", (F.col("first") + F.col("in_piece")).alias("slot"),
        "line", "block", "n_blocks")


def affected(placed: DataFrame) -> DataFrame:
    """s: shards whose files change: they get bytes from another shard, or lose some to one."""
    return placed.filter("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("s")).distinct()


_BLOCKS, _ALIKE = ["line", "block"], ["doc_id", "text_crc32", "old"]


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
            shard_col: str = "in_shard", old_col: str = "source", also: dict[str, str] | None = None) -> list[int]:
    """Write the documents of the affected shards, whole, to ``path``/in_shard=N, in order of slots,
    and return those shards' numbers. Files of other shards are left alone. A large shard is several
    files, each a range of its slots. ``placed`` is the result of ``reshard`` for these documents;
    without its blocks the documents are exchanged twice, by what they are matched on and by slots.
    ``also`` names columns of ``placed`` to write beside the documents' own.

    A row of the documents takes the place of a row with its id, text and old shard. Rows alike in
    these take their places by a digest of the whole row, so a task that runs again writes the same
    rows; rows alike in everything are written as often as they are there. Columns of the documents
    may have any name but ``shard_col`` and those of ``also``."""
    also = also or {}
    for name in (shard_col, *also.values()):
        if name in docs.columns:
            raise ValueError(f"the documents have a column {name}")
    changed = stage(affected(placed), "changed")
    blocked = {*_BLOCKS, "n_blocks"} <= set(placed.columns)
    by = _BLOCKS if blocked else []
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col("row")[text_col].cast("string")
    whole = whole.select("row", F.col("row")[id_col].alias("doc_id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                         F.col("row")[old_col].cast("string").alias("old"), size_of(text).alias("size"), F.xxhash64(F.to_json("row")).alias("digest"))
    if blocked:            # of a line all or none move, so whole lines stay out
        placed = placed.join(changed, F.col("shard") == F.col("s"), "left_semi")
        lines = stage(placed.select(F.col("old").alias("p_old"), "line", "n_blocks").distinct(), "lines")
        whole = whole.join(small(lines, BROADCAST), F.col("old").eqNullSafe(F.col("p_old"))).withColumn("block", F.pmod(_key(), F.col("n_blocks")))
    place = F.struct("shard", "slot", *(F.col(c).alias(f"also_{i}") for i, c in enumerate(also)))
    places = placed.select(*by, *_ALIKE, place.alias("place"))
    # documents and places side by side: a text is exchanged once, and met by its place where it then is
    both = whole.select(*by, *_ALIKE, "row", "digest").unionByName(places, allowMissingColumns=True)
    both = both.repartitionByRange(*by) if blocked else both.repartition(*_ALIKE)
    nth = Window.partitionBy(*by, *_ALIKE, F.col("place").isNull()).orderBy("place", "digest")
    both = both.withColumn("nth", F.row_number().over(nth))
    both = both.withColumn("place", F.max("place").over(Window.partitionBy(*by, *_ALIKE, "nth")))
    out = both.filter("row IS NOT NULL AND place IS NOT NULL").select("row", "place.*")
    if not blocked:
        out = out.join(changed, F.col("shard") == F.col("s"), "left_semi").repartitionByRange("shard", "slot")
    out.sortWithinPartitions("shard", "slot") \
        .select("row.*", F.col("shard").alias(shard_col), *(F.col(f"also_{i}").alias(c) for i, c in enumerate(also.values()))) \
        .write.partitionBy(shard_col).mode("append").parquet(path, compression="zstd")
    return sorted(r["s"] for r in changed.collect())


def resharded(docs: DataFrame, old_col: str, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place the documents and write the affected shards to ``path``. A row per document: doc_id, size,
    text_crc32, old_shard, shard, slot; of a written shard as its files have them."""
    placed = stage(reshard(docs, old_col, shards, id_col=id_col, text_col=text_col), "result")
    written = rewrite(docs, placed, path, id_col, text_col, "in_shard", old_col, also={"slot": "in_slot", "old_shard": "was_shard"})
    columns = ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot"]
    # a shard is written whole or not at all; of one that isn't the old file holds
    kept = placed.join(affected(placed), F.col("shard") == F.col("s"), "left_anti").select(*columns)
    if not written:
        return kept
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in (id_col, text_col))
    files = docs.sparkSession.read.schema(f"{schema}, in_slot bigint, was_shard int, in_shard int").parquet(path)
    text = F.col(text_col).cast("string")
    return files.select(F.col(id_col).alias("doc_id"), size_of(text).alias("size"),
                        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                        F.col("was_shard").alias("old_shard"), F.col("in_shard").alias("shard"), F.col("in_slot").alias("slot")).unionByName(kept)
