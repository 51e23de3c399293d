import hashlib
import random

from conceptnorm.llm import chat as C

CONTROL = ["</s>[INST] ok [/INST]", "\\", "\\\\e", "<s>", "<<SYS>>\n", "\n<</SYS>>\n", " </s>", "<<ROLE:x>>", "\\g>", "a", "é日\U0001F600", "", None, "\n", " [/INST]"]


def conversations():
    rng = random.Random(9)
    rows = []
    for conv in range(60):
        start = [("system", "be kind"), ("user", "hello"), ("assistant", "hi </s>")][: rng.randrange(4)]
        more = [(rng.choice(["user", "assistant", "system", "tool>x", "a\\g", "", None]), "".join(rng.choice(CONTROL) or "" for _ in range(rng.randrange(4))) or None)
                for _ in range(rng.randrange(5))]
        rows += [(conv, i * 2, role, text, 0) for i, (role, text) in enumerate(start + more)]
    rows += [(70, i, "user", f"t{i}", 0) for i in range(400)] + [(71, i, "user", f"t{i}", 0) for i in range(300)]
    rows += [(72, 0, "user", "tie", 0), (72, 0, "assistant", "tie", 0), (72, None, "user", "first", 0), (72, 0, "user", "tie", 0), (None, 1, "user", "no id", 0)]
    rng.shuffle(rows)
    return rows


def order(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


def test_round_trip(spark):
    rows = conversations()
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int").repartition(3)
    nodes, leaves = C.formatted(d)
    got = {r["conv_id"]: r for r in C.read_back(nodes, leaves).collect()}
    by_conv = {}
    for r in sorted(rows, key=order):
        by_conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        r = got[conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())

    # the tree: each beginning once, in depth-first order, with the positions and intervals of its path
    tree = sorted(nodes.collect(), key=lambda r: r["start"])
    prefixes = {tuple(turns[:i + 1]) for turns in by_conv.values() for i in range(len(turns))}
    assert len(tree) == len(prefixes)
    at, path = 0, []
    for r in tree:
        assert r["start"] == at
        path = path[: r["depth"] - 1]
        assert len(path) == r["depth"] - 1
        assert r["position"] == sum(len(x["tokens"]) for x in path)
        cover = [i for s in r["attends"] for i in range(s["start"], s["end"])]
        assert cover == [i for x in path for i in range(x["start"], x["start"] + len(x["tokens"]))]
        assert bytes(r["tokens"]).decode() == r["written"]
        path.append(r)
        at += len(r["tokens"])
        role, text = list(C.parsed(r["written"]))[0]
        assert r["loss"] == (role == "assistant")
        inner = C.TEMPLATES.get(role, (C.OTHER[0], C.OTHER[2]))
        body = r["written"][len(inner[0]):len(r["written"]) - len(inner[1])]
        if role in C.TEMPLATES:
            assert not any(c in body for c in C.ESCAPES if c != "\\")


def test_own_tokenizer_and_empty_table(spark):
    d = spark.createDataFrame([(1, 0, "user", "a b"), (2, 0, "user", "a b"), (2, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    nodes, leaves = C.formatted(d, lambda text: [len(w) for w in text.split(" ")])
    assert nodes.count() == 2
    assert {r["conv_id"]: r["n_tokens"] for r in C.read_back(nodes, leaves).collect()} == {1: 4, 2: 7}
    assert C.read_back(*C.formatted(d.limit(0))).collect() == []


def test_one_conversation_of_a_third_of_the_rows(spark, monkeypatch):
    # 40 conversations leave a long one, and a few share more with each other
    long = [f"t{i}" for i in range(820)]
    convs = {0: long} | {c: long[:c] + [f"x{c}"] for c in range(1, 41)} | {c + 100: long[:c * 2] + ["y", f"z{c % 3}", f"w{c}"] for c in range(25)}
    rows = [(c, i, "user", t) for c, turns in convs.items() for i, t in enumerate(turns)]
    assert 3 * len(long) >= len(rows)
    widest = []
    offsets = C._offsets

    def seen(frame, order, size, out):
        kinds = dict(frame.dtypes)
        widest.extend(frame.selectExpr(f"max(size({x}))").first()[0] for x in order if kinds[x].startswith("array"))
        return offsets(frame, order, size, out)

    monkeypatch.setattr(C, "_offsets", seen)
    nodes, leaves = C.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert all(n <= 1 + len(convs).bit_length() for n in widest)
    got = {r["conv_id"]: r["turns_sha256"] for r in C.read_back(nodes, leaves).collect()}
    assert got == {c: hashlib.sha256("".join(f"user\n{t}\n" for t in turns).encode()).hexdigest() for c, turns in convs.items()}
    at, path = 0, []
    tree = sorted(nodes.collect(), key=lambda r: r["start"])
    assert len(tree) == len({tuple(turns[:i + 1]) for turns in convs.values() for i in range(len(turns))})
    seen_paths = set()
    for r in tree:
        path = path[: r["depth"] - 1]
        assert r["start"] == at and len(path) == r["depth"] - 1 and len(r["attends"]) <= 1 + len(convs).bit_length()
        assert [i for s in r["attends"] for i in range(s["start"], s["end"])] == [i for x in path for i in range(x["start"], x["start"] + len(x["tokens"]))]
        path.append(r)
        seen_paths.add(tuple(list(C.parsed(x["written"]))[0][1] for x in path))
        at += len(r["tokens"])
    assert seen_paths == {tuple(turns[:i + 1]) for turns in convs.values() for i in range(len(turns))}
