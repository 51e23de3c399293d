"""Near-duplicate removal by MinHash with tensored banding.

Plain banding needs a separate set of minhashes for each of its tables. Here two small
collections of ``half`` bands, of ``rows`` minhashes each, are computed, and table (i, j) is keyed
by the pair of band i of the first collection and band j of the second: half * half tables from
2 * half * rows minhashes. Two sets of similarity s miss every table with a probability of at most
2 * (1 - s**rows) ** half, which is 2e-5 at 0.8 with the parameters below.

A pair key can only be shared if both of its bands are, so bands that one set alone holds are
dropped first. Equal sets are one class, so copies cost nothing further. Candidates are compared
on their full sets. Within a table's bucket no list of all pairs is made: each class is compared
with one hub first, the least that it meets, then with one other hub in a further round, and
linked ones fall into one component. What is left are buckets with members of several components,
mostly families of texts a little too different. A set of n shingles that is similar enough to
another shares with it one of its n - ceil(percent * n / 100) + 1 rarest shingles (counted over all
classes left, ties by hash): its prefix. So classes left are compared only where they share such a
shingle, where it may be the first that they share (what follows it in both sets must suffice), and
where they are in different components yet: with the first classes of a shingle, the next ones,
and so on, until each is settled. Every class left that is linked with another left is found, be it
in its bucket or not. Components come from pointer jumping and alternating star contraction on
staged edges; nothing of that is collected.

Defined results: the set of a text is its distinct n-word shingles; of a text with fewer words,
the whole sequence as one; of a null or wordless text, empty, and such a document is linked with
nothing. Shingles are compared as 64-bit hashes. Rows that share an id are one document of the
graph. Repeated rows get equal results. A row without an id lends its set no name: it gets the
component of its equals, or null. Other columns of the input don't matter and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conceptnorm.llm.common import small, stage, texts
from conceptnorm.llm.words import SLICE, Words, grams, mix, slices

HALF, ROWS, SEED = 16, 3, 20240607
#: A frame of ids is broadcast up to so many rows (16 bytes each).
BROADCAST_IDS = 1_000_000
#: Rounds in which each class is compared with one hub only. Then come rounds with the first eight
#: classes of a shingle of the prefix, the next 56, and so on.
SINGLE_ROUNDS, FIRST_HUBS, MORE_HUBS = 1, 8, 8


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """For each row its distinct shingles as sorted 64-bit hashes."""
    hashes = words.hashes()
    gram = grams(hashes, n)
    for a, count in zip(words.first.tolist(), words.counts.tolist(), strict=False):
        if count >= n:
            yield np.unique(gram[a:a + count - n + 1])
        elif count:
            yield grams(hashes[a:a + count], count)
        else:
            yield hashes[:0]


def _signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.uint64(2**64 - 1))
    for i in range(0, len(values), 4096):
        part = values[i:i + 4096]
        np.minimum(least, (part[None, :] * a[:, None] + b[:, None]).min(axis=1), out=least)
    return least


def _sketch(n: int, half: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        a = rng.integers(0, 2**63, 2 * half * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 2**63, 2 * half * rows, dtype=np.uint64)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                sizes, key1, key2, bands = [], [], [], []
                for values in shingle_sets(Words(batch.column("text")), n):
                    sizes.append(len(values))
                    key1.append(int(mix(values ^ a[0]).sum(dtype=np.uint64).view(np.int64)))
                    key2.append(int(mix(values ^ b[0]).sum(dtype=np.uint64).view(np.int64)))
                    band = grams(_signature(values, a, b), rows)[::rows] if len(values) else b[:0]
                    bands.append(band.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                     pa.array(key1, pa.int64()), pa.array(key2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "key1", "key2", "bands"])
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                sets = [x.view(np.int64) for x in shingle_sets(Words(batch.column("text")), n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])
    return run


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the least node of its component.
    Alternating large-star and small-star steps, staged after each pair of steps."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        step = large.join(least, "a")
        edges = stage(step.select("a", F.col("m").alias("b")).unionByName(
            step.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now


def forest_roots(parents: DataFrame) -> DataFrame:
    """(node, root) for a forest (a, b) in which each a has one parent b < a, by pointer jumping."""
    now = stage(parents.select("a", "b"), "forest")
    while True:
        up = now.select(F.col("a").alias("b"), F.col("b").alias("c"))
        now = stage(now.join(up, "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")), "forest")
        if not now.filter("moved").head(1):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = now.drop("moved")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    percent: int = 80, half: int = HALF, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64 of the text), n_shingles, component_id (the
    least id that links reach), kept (it is that one). Two documents are linked if
    100 * intersection >= percent * union of their sets."""
    docs = texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sketch = stage(docs.mapInArrow(
        _sketch(shingle, half, rows, seed),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, n_shingles bigint, "
        "key1 bigint, key2 bigint, bands array<bigint>"), "sketch")

    # classes of equal sets, named by their least id
    full = sketch.filter("n_shingles > 0").drop("bands")
    classes = stage(sketch.filter("n_shingles > 0").groupBy("key1", "key2", "n_shingles").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("least"),
        F.first("bands").alias("bands")).select(
        "key1", "key2", "n_shingles", F.col("least.doc_id").alias("node"), F.col("least.text_hash").alias("node_hash"),
        "bands"), "classes")
    found = _linked(docs, classes, _tables(classes, half), shingle, percent, _shared_ids(full, classes))
    names = classes.drop("bands", "node_hash").join(found, "node", "left").select(
        "key1", "key2", "n_shingles", F.coalesce("root", "node").alias("component_id"))
    out = full.join(names, ["key1", "key2", "n_shingles"]).select("doc_id", "text_hash", "n_shingles", "component_id")
    empty = sketch.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _shared_ids(full: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Edges between the classes of rows that share an id but not a set, if there are such rows."""
    own = full.filter("doc_id IS NOT NULL")
    if not own.groupBy("doc_id").count().filter("count > 1").head(1):
        return None
    own = own.join(classes.select("key1", "key2", "n_shingles", "node"), ["key1", "key2", "n_shingles"])
    return stage(own.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct(), "shared")


def _tables(classes: DataFrame, half: int) -> DataFrame:
    """(bucket, node, n_shingles): the pair keys of both bands that are not one class's alone."""
    band = classes.filter("node IS NOT NULL").select("node", "n_shingles", F.posexplode("bands").alias("i", "band"))
    shared = band.groupBy("i", "band").agg(F.count("*").alias("n")).filter("n > 1").select("i", "band")
    sides = band.join(shared, ["i", "band"], "left_semi").groupBy("node", "n_shingles").agg(
        F.collect_list(F.when(F.col("i") < half, F.struct("i", "band"))).alias("u"),      # half at most
        F.collect_list(F.when(F.col("i") >= half, F.struct("i", "band"))).alias("v"))
    return stage(sides.select("node", "n_shingles", F.explode("u").alias("x"), "v").select(
        F.explode("v").alias("y"), "x", "node", "n_shingles").select(
        F.xxhash64("x.i", "x.band", "y.i", "y.band").alias("bucket"), "node", "n_shingles"), "tables")


def _close(percent: int, a: str, b: str):
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    both = both.withColumn("same", same).filter(100 * F.col("same") >= percent * (F.size("x") + F.size("y") - F.col("same")))
    return both.select(*pairs.columns)


def _linked(docs: DataFrame, classes: DataFrame, tables: DataFrame, shingle: int, percent: int,
            more: DataFrame | None) -> DataFrame:
    """(node, root) of the components of all links between classes of a bucket, and the edges
    ``more``. Nodes that aren't there are roots of their own."""
    # first each class with one hub: the least that any of its buckets has
    hubs = tables.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last").drop("last")
    sizes = tables.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b")).distinct()
    first = tables.join(hubs, "bucket").filter("hub <= node").groupBy("node", "n_shingles").agg(F.min("hub").alias("b"))
    first = stage(first.join(sizes, "b").filter(_close(percent, "n_shingles", "n_b")).select(F.col("node").alias("a"), "b").distinct(), "first")
    named = small(tables.join(hubs, "bucket", "left_semi").select("node").distinct()
                  .join(classes.select("node", "node_hash"), "node")
                  .select(F.col("node").alias("doc_id"), F.col("node_hash").alias("text_hash")).distinct(), BROADCAST_IDS)
    sets = stage(docs.join(named, ["doc_id", "text_hash"], "left_semi").select("doc_id", "text").mapInArrow(
        _sets(shingle), f"node {docs.schema['doc_id'].dataType.simpleString()}, shingles array<bigint>"), "sets")
    roots = forest_roots(_verified(first.filter("a <> b"), sets, percent).distinct())
    if more is not None:
        roots = star_components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    # then, in buckets whose members aren't in one component yet, members of different ones: first
    # each with one other hub a round, which joins up what is densely linked
    live = stage(_unsettled(tables.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))), "live")
    links = None
    for r in range(SINGLE_ROUNDS):
        if not live.head(1):
            break
        draw = F.xxhash64("node", F.lit(r))
        hubs = live.groupBy("bucket").agg(F.min(F.struct(draw.alias("draw"), "node", "root", "n_shingles")).alias("hub"))
        pairs = live.join(hubs, "bucket").filter((F.col("root") != F.col("hub.root")) & _close(percent, "n_shingles", "hub.n_shingles"))
        pairs = pairs.groupBy(F.col("node").alias("a"), F.col("root").alias("root_a")).agg(F.min("hub").alias("hub"))
        pairs = pairs.select("a", F.col("hub.node").alias("b"), "root_a", F.col("hub.root").alias("root_b"))
        new = _new_links(pairs, sets, percent)
        links = new if links is None else links.unionByName(new)
        # each root under the least that it is linked with: a forest
        hooks = new.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).groupBy("a").agg(F.min("b").alias("b"))
        live = stage(_unsettled(_moved(live, forest_roots(hooks))), "live")
    if live.head(1):
        more = _exhausted(live, sets, percent)
        if more is not None:
            links = more if links is None else links.unionByName(more)
    if links is None:
        return roots
    return star_components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _new_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of roots of which members (a, b of ``pairs``) are linked."""
    return stage(_verified(pairs, sets, percent).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "links")


def _moved(live: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows under the roots that theirs have come to."""
    return live.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left") \
        .withColumn("root", F.coalesce("to", "root")).drop("to")


def _prefixes(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, root, n_shingles, at): of each class of ``live`` the shingles of its prefix
    that classes of other components have too, and their places in the order of the set, from 1.
    Shingles of one class alone come first in that order; they are counted, not moved on."""
    own = live.select("node", "root").distinct().join(sets, "node")
    # an id may have several sets: each is numbered, once and for all as the rows are staged
    own = own.withColumn("n_shingles", F.size("shingles").cast("bigint")).withColumn("set_no", F.monotonically_increasing_id())
    own = stage(own.select("node", "root", "n_shingles", "set_no", F.explode("shingles").alias("bucket")), "shingles")
    held = own.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("open")).filter("n > 1")
    of_set = Window.partitionBy("set_no")
    alone = F.col("n_shingles") - F.count("*").over(of_set)
    at = alone + F.row_number().over(of_set.orderBy("n", "bucket"))
    longest = F.col("n_shingles") - F.floor((percent * F.col("n_shingles") + 99) / 100) + 1
    found = own.join(held, "bucket").withColumn("at", at).filter((F.col("at") <= longest) & F.col("open"))
    return stage(found.select("bucket", "node", "root", "n_shingles", "at"), "prefixes")


def _exhausted(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between roots from all pairs that share a shingle of their prefixes and aren't in one
    component by then."""
    live = _unsettled(_prefixes(live, sets, percent))
    live = stage(live.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("at", "node"))), "ranked")
    links, low, high = None, 1, 1 + FIRST_HUBS
    while live.head(1):
        near = live.filter((F.col("place") >= low) & (F.col("place") < high)).select(
            "bucket", *(F.col(c).alias(f"hub_{c}") for c in ("node", "root", "place", "n_shingles", "at")))
        # as their first common shingle: itself, and of each set what comes after it
        most = 1 + F.least(F.col("n_shingles") - F.col("at"), F.col("hub_n_shingles") - F.col("hub_at"))
        pairs = live.join(near, "bucket").filter(
            (F.col("place") > F.col("hub_place")) & (F.col("root") != F.col("hub_root"))
            & ((100 + percent) * most >= percent * (F.col("n_shingles") + F.col("hub_n_shingles"))))
        pairs = pairs.select(F.col("node").alias("a"), F.col("hub_node").alias("b"), F.col("root").alias("root_a"),
                             F.col("hub_root").alias("root_b")).distinct()
        new = _new_links(pairs, sets, percent)
        if new.head(1):
            links = new if links is None else links.unionByName(new)
            live = _moved(live, star_components(new))
        low, high = high, high * MORE_HUBS
        live = stage(_unsettled(live, F.max("place") > low), "live")
    return links


def _unsettled(live: DataFrame, also=None) -> DataFrame:
    """Rows of the buckets whose members are in several components."""
    open_ = live.groupBy("bucket").agg((F.min("root") != F.max("root")).alias("open"), (F.lit(True) if also is None else also).alias("also"))
    return live.join(open_.filter("open AND also").select("bucket"), "bucket", "left_semi")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are kept, whole: one document of each component. Of rows that
    repeat an id one stays; rows without an id stay."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    found = near_duplicates(docs, **how).filter("kept AND doc_id IS NOT NULL")
    keep = stage(found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.min("text_hash").alias("__hash"), F.count("*").alias("__n")), "kept")
    repeated = bool(keep.filter("__n > 1").head(1))
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    out = docs.join(small(keep.drop("__n"), BROADCAST_IDS),
                    (F.col(id_col) == F.col("__id")) & (text_hash == F.col("__hash")), "left")
    out = out.filter(F.col("__id").isNotNull() | F.col(id_col).isNull())
    if repeated:
        out = out.filter(F.col("__id").isNotNull()).dropDuplicates(["__id"]).unionByName(out.filter("__id IS NULL"))
    return out.drop("__id", "__hash")
