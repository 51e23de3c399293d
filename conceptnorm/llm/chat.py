"""Chat formatting with a prefix tree.

Conversations that begin with the same turns share them: each different sequence of first turns is
a node of a tree. The nodes are written once, depth first, as one line of tokens. A node's position
ids go on from its parent's, so they are those of the conversation read alone; its attention is
causal within the node, and covers the intervals of the line in which its ancestors stand.

A turn is written by its role's template. Control strings that a text contains are escaped by a
backslash and a letter, and backslashes are doubled, so that no text can pass for a marker and
unescaping gives the text back. Tokens are the UTF-8 bytes of the written turn, or what ``tokenize``
makes of it; turns are tokenized one by one, so shared turns have shared tokens. Assistant texts
are under the loss mask.

A node is known by the sum of hashes of (place, role, text) of its turns, 2 x 64 bits, which a
running sum gives without collecting a conversation. Of a node's children the one that most
conversations go through carries its branch on, each other one begins a branch; so a conversation
of n is on 1 + log2(n) branches at most, however long it is. A branch is known by the beginnings
of branches on its path, later ones first where two leave the same branch. That list of
bounded length sorts the branches depth first, and branch and depth sort the nodes. Offsets in the
line are sums over blocks and within them. A conversation is read back as a stream of its sorted
turns, with running digests.

Defined results: rows of a conversation are sorted by turn, then role and text, null first; a null
text or role is the empty string; rows without a conversation id are one conversation with id null;
repeated rows are turns of their own; no conversations give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conceptnorm.llm.common import stage

# fixed values: the template's control strings and what stands for them in texts
ESCAPES = {"\\": "\\\\", "<s>": "\\b", "</s>": "\\e", "[INST]": "\\i", "[/INST]": "\\j", "<<SYS>>": "\\y",
           "<</SYS>>": "\\z", "<<ROLE:": "\\r", "<</ROLE>>": "\\q"}
TEMPLATES = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER = ("<<ROLE:", ">>\n", "\n<</ROLE>>\n")     # the role, escaped, stands between the first two
LOSS_ROLE = "assistant"
_IN_ROLE = "\\g"                                # for a '>' in the name of a role
_PLAIN = {v: k for k, v in ESCAPES.items()} | {_IN_ROLE: ">"}
_ESCAPED = re.compile(r"\\[\\a-z]")
#: A turn as it is written; what stands for texts holds no control string.
_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n|"
                   r"<<ROLE:(?P<role>.*?)>>\n(?P<other>.*?)\n<</ROLE>>\n| (?P<assistant>.*?) </s>", re.DOTALL)


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES.items():          # the backslash first
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[0]], text)


def written(role: Column, text: Column) -> Column:
    """A turn by its template. In other roles a '>' is escaped too, so the marker ends where it should."""
    out = F.concat(F.lit(OTHER[0]), F.replace(escaped(role), F.lit(">"), F.lit(_IN_ROLE)), F.lit(OTHER[1]), escaped(text), F.lit(OTHER[2]))
    for name, (before, after) in TEMPLATES.items():
        out = F.when(role == name, F.concat(F.lit(before), escaped(text), F.lit(after))).otherwise(out)
    return out


def parsed(line: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each written turn."""
    at = 0
    while at < len(line):
        m = _TURN.match(line, at)
        if m is None:
            raise ValueError(f"no turn at {at}: {line[at:at + 40]!r}")
        at = m.end()
        kind = m.lastgroup
        role = unescaped(m["role"]) if kind == "other" else kind
        yield role, unescaped(m[kind])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), role, text, node (key of the turns so far), parent (that of those before)."""
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    line = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("depth", F.row_number().over(line)).drop("turn")
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = [F.sum(F.xxhash64(F.lit(seed), "depth", "role", "text").cast("decimal(20,0)")).over(so_far).alias(f"k{seed}") for seed in (1, 2)]
    rows = rows.select("*", *own).withColumn("node", F.struct("depth", "k1", "k2")).drop("k1", "k2")
    return rows.withColumn("parent", F.lag("node").over(Window.partitionBy("conv_id").orderBy("depth")))


def _offsets(rows: DataFrame, order: list[str], size: str, out: str) -> DataFrame:
    """Running sum of ``size`` before each row in the order, over staged sorted blocks."""
    spark = rows.sparkSession
    ranged = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("__row", F.monotonically_increasing_id()), "ranged")
    block = F.shiftright("__row", 33)
    totals = ranged.groupBy(block.alias("__block")).agg(F.sum(size).alias("__n"))      # a row per partition
    totals = totals.select("__block", F.coalesce(F.sum("__n").over(
        Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = F.coalesce(F.sum(size).over(Window.partitionBy("__block").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = ranged.withColumn("__block", block).withColumn(out, within)
    return ranged.join(F.broadcast(totals), "__block").withColumn(out, F.col(out) + F.col("__before")).drop("__block", "__before", "__row")


def utf8(text: str) -> list[int]:
    return list(text.encode())


def branches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, owners): node, role, text and rank of its branch in depth-first order; for each
    branch (of, its rank) a conversation that ends it (owner)."""
    nodes = stage(rows.groupBy("node").agg(F.count("*").alias("n"), F.first("parent").alias("parent"), F.first("role").alias("role"),
                                           F.first("text").alias("text")), "counted")
    on = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.max(F.struct("n", "node"))["node"].alias("on"))
    first = nodes.join(on, F.col("node") == F.col("on"), "left").select("node", F.col("on").isNull().alias("first"))
    path = Window.partitionBy("conv_id").orderBy("node")
    so_far = path.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.select("conv_id", "node").join(first, "node")
    marked = stage(marked.withColumn("branch", F.last(F.when(F.col("first"), F.col("node")), ignorenulls=True).over(so_far)), "branches")
    key = F.struct((-F.col("node.depth")).alias("d"), F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"))
    keys = marked.filter("first").withColumn("key", F.collect_list(key).over(so_far)).groupBy("branch").agg(F.first("key").alias("key"))
    ranks = _offsets(keys.withColumn("one", F.lit(1)), ["key"], "one", "rank").select("branch", "rank")
    ends = marked.groupBy("branch").agg(F.max(F.struct("node", "conv_id"))["conv_id"].alias("owner"))
    ranks = stage(ranks.join(ends, "branch"), "ranks")
    at = marked.groupBy("node").agg(F.first("branch").alias("branch")).join(ranks.select("branch", "rank"), "branch").select("node", "rank")
    return nodes.select("node", "role", "text").join(at, "node"), ranks.select(F.col("rank").alias("of"), "owner")


def tree(rows: DataFrame, tokenize: Callable[[str], list[int]] = utf8) -> DataFrame:
    """The nodes, once each: node, depth, role, written, tokens, start (of its tokens in the line),
    position (id of its first token), attends (intervals of the line with its ancestors, end
    exclusive, before its own causal part), loss (whether its text is under the mask)."""
    nodes, owners = branches(rows)
    nodes = nodes.select("node", "node.depth", "rank", "role", written(F.col("role"), F.col("text")).alias("written"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [tokenize(x.as_py()) for x in batch.column("written")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.list_(pa.int32())),
                                              pa.array([len(x) for x in tokens], pa.int64())],
                                             names=[*batch.schema.names, "tokens", "n_tokens"])

    nodes = nodes.mapInArrow(run, f"{_ddl(nodes)}, tokens array<int>, n_tokens bigint")
    nodes = _offsets(nodes, ["rank", "depth"], "n_tokens", "start")
    nodes = stage(nodes, "nodes")
    # along the conversation that ends each branch: where the ancestors of its nodes stand
    line = rows.select("conv_id", "node").join(owners, F.col("conv_id").eqNullSafe(F.col("owner"))).select("of", "node") \
        .join(nodes.select("node", "depth", "rank", "start", "n_tokens"), "node")
    ancestors = line.repartition("of").sortWithinPartitions("of", "depth").select("of", "rank", "depth", "start", "n_tokens") \
        .mapInArrow(_ancestors, "rank bigint, depth int, position bigint, attends array<struct<start: bigint, end: bigint>>")
    return nodes.join(ancestors, ["rank", "depth"]).withColumn("loss", F.col("role") == LOSS_ROLE).drop("n_tokens", "rank")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _ancestors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by branch and depth; gives those that are on the branch itself. Neighbouring
    intervals are merged, so the list is no longer than the path has branches."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    now, spans, position = None, [], 0
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for of, rank, depth, start, n in zip(*(batch.column(c).to_pylist() for c in ("of", "rank", "depth", "start", "n_tokens")), strict=True):
            if of != now:
                now, spans, position = of, [], 0
            if rank == of:
                for x, y in zip(out, (rank, depth, position, [{"start": a, "end": b} for a, b in spans]), strict=True):
                    x.append(y)
            if spans and spans[-1][1] == start:
                spans[-1] = (spans[-1][0], start + n)
            elif n:
                spans.append((start, start + n))
            position += n
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), kind), strict=True)],
                                         names=["rank", "depth", "position", "attends"])


def formatted(conversations: DataFrame, tokenize: Callable[[str], list[int]] = utf8) -> tuple[DataFrame, DataFrame]:
    """(tree, leaves): the nodes, and conv_id with each node on its path and its depth."""
    rows = stage(turns(conversations), "turns")
    return stage(tree(rows, tokenize), "tree"), rows.select("conv_id", "node")


def read_back(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens: each
    conversation put together from the tree and parsed again."""
    rows = leaves.join(nodes.select("node", "depth", "written", "loss", F.size("tokens").alias("n_tokens")), "node")
    kind = leaves.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", "depth", "written", "loss", "n_tokens").repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return rows.mapInArrow(_digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                     "loss_sha256 string, formatted_chars bigint, n_tokens bigint")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and depth. One conversation's running digests are held."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    now, open_ = None, None

    def row() -> tuple:
        n, all_, chars, loss, total, tokens = open_
        return now, n, all_.hexdigest(), chars, loss.hexdigest(), total, tokens

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(columns, kinds, strict=True)], names=names)

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        rows = []
        for conv, line, in_loss, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "written", "loss", "n_tokens")), strict=True):
            if open_ is None or conv != now:
                if open_ is not None:
                    rows.append(row())
                now, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parsed(line):
                open_[0] += 1
                open_[1].update(f"{role}\n{text}\n".encode())
                if in_loss:
                    open_[2] += len(text)
                    open_[3].update(text.encode())
            open_[4] += len(line)
            open_[5] += tokens
        yield batch_of(rows, kind)
    if open_ is not None:
        yield batch_of([row()], kind)
