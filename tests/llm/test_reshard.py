import random
import zlib

from conceptnorm.llm import queries as Q
from conceptnorm.llm import reshard as R


def least_cost(supply, capacity, cost):
    """By trying all ways, for tiny cases."""
    best = [10**9]

    def go(i, left, room, total):
        if total >= best[0]:
            return
        if i == len(supply):
            best[0] = total
            return
        if not left:
            return go(i + 1, supply[i + 1] if i + 1 < len(supply) else 0, room, total)
        for j in range(len(room)):
            if room[j]:
                go(i, left - 1, room[:j] + [room[j] - 1] + room[j + 1:], total + cost(i, j))

    go(0, supply[0], list(capacity), 0)
    return best[0]


def test_flow_is_cheapest():
    rng = random.Random(12)
    for case in range(60):
        supply = [rng.randrange(4) for _ in range(rng.randrange(1, 4))]
        capacity = [rng.randrange(4) for _ in range(rng.randrange(1, 4))]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        table = [[rng.randrange(5) for _ in capacity] for _ in supply]
        cost = R.stay if case % 2 else (lambda i, j, t=table: t[i][j])
        moved = R.flow(supply, capacity, cost)
        assert [sum(x for (i, _), x in moved.items() if i == k) for k in range(len(supply))] == supply
        assert all(sum(x for (_, j), x in moved.items() if j == k) <= capacity[k] for k in range(len(capacity)))
        assert sum(x * cost(i, j) for (i, j), x in moved.items()) == least_cost(supply, capacity, cost)


def test_moves_no_more_than_the_surplus():
    supply, capacity = [500, 20, 30, 0], [110] * 5
    moved = R.flow(supply, capacity)
    assert sum(x for (i, j), x in moved.items() if i != j) == 390


def corpus():
    rng = random.Random(13)
    rows = [(i, rng.choice(["hot"] * 8 + ["b", "ä", None]), rng.choice(["", "é", "text "]) * rng.randrange(60), 1) for i in range(3000)]
    return rows + [(7, "hot", "same", 1)] * 40 + [(None, "b", None, 1)]


def test_shards_and_slots(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 100)
    rows = corpus()
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int")
    got = R.reshard(d, "source", 7).collect()
    total = sum(len((t or "").encode()) + 8 for _, _, t, _ in rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == \
        sorted((i or -1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, _, t, _ in rows) or len(got) == len(rows)
    sizes, slots, stayed, old = [0] * 7, [[] for _ in range(7)], 0, {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        stayed += r["size"] * (r["shard"] == r["old_shard"])
        old[r["old_shard"]] = old.get(r["old_shard"], 0) + r["size"]
    largest = max(r["size"] for r in got)
    assert all(abs(s - total / 7) <= 8 * largest for s in sizes)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert stayed >= sum(min(x, total // 7) for k, x in old.items() if k < 7) - 8 * largest
    again = R.reshard(d.repartition(5), "source", 7).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_rewrite_only_affected_files(spark, tmp_path):
    rows = [(i, s, "x" * 92, i) for i, s in enumerate("aaaaaaabbbcccccee")]      # b, c, e; 4 new shards
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    placed = R.reshard(d, "source", 4, capacity=[400, 600, 500, 200]).cache()
    changed = R.rewrite(d, placed, str(tmp_path / "out"))
    assert changed == [0, 1]
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    want = {r["doc_id"]: r["shard"] for r in placed.collect() if r["shard"] in changed}
    assert {r["doc_id"]: r["in_shard"] for r in out} == want


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, source string, text string")
    assert R.reshard(d, "source").collect() == []


def test_cuts_need_no_python_workers(spark, monkeypatch):
    plans, stage = [], R.stage
    monkeypatch.setattr(R, "stage", lambda df, *a: plans.append(df._jdf.queryExecution().toString()) or stage(df, *a))
    d = spark.range(300).selectExpr("id doc_id", "concat('s', id % 5) source", "repeat('x', int(id % 40)) text")
    assert R.reshard(d, "source", 7).count() == 300
    assert any("cuts" in p for p in plans) and not any("ExistingRDD" in p for p in plans)


def test_more_old_shards_than_any_bound(spark):
    rng = random.Random(14)
    rows = [(i, f"s{i % 2300:05}", "x" * rng.randrange(40), i) for i in range(4600)] + [(9000 + i, None, "y" * 500, i) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    got = R.reshard(d, "source", 7).collect()
    number = {f"s{i:05}": i for i in range(2300)} | {None: 2300}
    assert sorted((r["doc_id"], r["size"], r["old_shard"]) for r in got) == sorted((i, len(t) + 8, number[s]) for i, s, t, _ in rows)
    total, sizes, slots, stayed = sum(r["size"] for r in got), [0] * 7, [[] for _ in range(7)], 0
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        stayed += r["size"] * (r["shard"] == r["old_shard"])
    assert all(abs(s - total / 7) <= 2 * 508 for s in sizes)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert stayed == sum(r["size"] for r in got if r["old_shard"] < 7)


def test_more_affected_shards_than_any_bound(spark):
    placed = spark.range(2100).selectExpr("id doc_id", "cast(id AS int) shard", "cast((id + 1) % 2100 AS int) old_shard")
    assert sorted(r["s"] for r in R.affected(placed).collect()) == list(range(2100))


def test_rewrite_of_equal_rows_of_several_old_shards(spark, tmp_path):
    # twins in an unaffected shard (a) and in one that moves; columns named like the operator's own
    rows = [(1, "a", "same text", 0), (2, "a", "q" * 83, 1), (1, "b", "same text", 2), (1, "b", "same text", 2), (1, "b", "same text", 3), (None, "b", None, 4)]
    schema = "doc_id long, source string, text string, slot int"
    got = []
    for n, order in enumerate((rows, rows[::-1])):
        d = spark.createDataFrame(order, schema).selectExpr("*", "slot AS shard", "source AS old", "1 AS nth", "2 AS __id", "3 AS digest").repartition(3)
        placed = spark.createDataFrame(
            [(1, 8, R_CRC, "a", 0, 0, 0), (2, 91, zlib.crc32(b"q" * 83), "a", 0, 0, 1), (1, 8, R_CRC, "b", 1, 2, 0), (1, 8, R_CRC, "b", 1, 1, 0),
             (1, 8, R_CRC, "b", 1, 2, 1), (None, 8, 0, "b", 1, 1, 1)],
            "doc_id long, size long, text_crc32 long, old string, old_shard int, shard int, slot long")
        assert R.rewrite(d, placed, str(tmp_path / f"out{n}")) == [1, 2]
        out = spark.read.parquet(str(tmp_path / f"out{n}"))
        assert out.columns == [*d.columns, "in_shard"]
        got.append(sorted(map(str, out.collect())))
        assert sorted((r["doc_id"] or 0, r["source"], r["slot"]) for r in out.collect()) == [(0, "b", 4), (1, "b", 2), (1, "b", 2), (1, "b", 3)]
    assert got[0] == got[1]


R_CRC = zlib.crc32(b"same text")


def test_query_writes_the_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 100)
    monkeypatch.setattr(Q, "shared_folder", lambda spark: str(tmp_path))
    rows = corpus() + [(i, "hot", "same", i % 2) for i in range(200) for _ in range(2)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int").repartition(7)
    got = Q.sharded(d).collect()
    paths = list(tmp_path.glob("llm/shards-*"))
    assert len(paths) == 1
    files = spark.read.parquet(str(paths[0]))
    # each document once, whole, in the shard and slot that the query gives for it
    assert sorted(map(str, files.select("doc_id", "source", "text", "shard").collect())) == sorted(map(str, d.collect()))
    assert sorted((r["doc_id"] or -1, zlib.crc32((r["text"] or "").encode()), r["in_shard"], r["in_slot"]) for r in files.collect()) == \
        sorted((r["doc_id"] or -1, r["text_crc32"], r["shard"], r["slot"]) for r in got)
    number = {"b": 0, "hot": 1, "ä": 2, None: 3}
    assert all(r["was_shard"] == number[r["source"]] for r in files.collect())
    # a file is a range of its shard's slots, in their order
    slots = [r["in_slot"] for f in sorted(paths[0].glob("in_shard=5/*.parquet")) for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    assert slots == list(range(len(slots))) and slots
    columns = ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot"]
    want = R.reshard(d, "source").collect()
    assert sorted(str([r[c] for c in columns]) for r in want) == sorted(str([r[c] for c in columns]) for r in got)


def test_unaffected_shards_are_not_written(spark, tmp_path):
    rows = [(i, s, "x" * 92) for i, s in enumerate("aabbccdd")]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = R.resharded(d, "source", str(tmp_path / "same"), 4)
    assert not (tmp_path / "same").exists() or not list((tmp_path / "same").glob("in_shard=*"))
    assert sorted((r["doc_id"], r["shard"], r["old_shard"]) for r in got.collect()) == [(i, i // 2, i // 2) for i in range(8)]
    # c and d are as they should be, a's surplus goes to b
    rows = [(i, s, "x" * 92) for i, s in enumerate("aaabccdd")]
    got = R.resharded(spark.createDataFrame(rows, "doc_id long, source string, text string"), "source", str(tmp_path / "some"), 4).collect()
    assert sorted(p.name for p in (tmp_path / "some").glob("in_shard=*")) == ["in_shard=0", "in_shard=1"]
    assert sorted((r["doc_id"], r["shard"] >= 2) for r in got) == [(i, i >= 4) for i in range(8)]
