import random
import re
import zlib

import pyarrow as pa
import pytest
from test_decontaminate import brute as contamination_of
from test_mixing import brute_targets, size
from test_near_dup import brute as components_of

import corpus_pipeline as P
from conceptnorm.llm.common import BATCH_BYTES, stage
from conceptnorm.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(21)
    some = lambda n: [f"w{rng.randrange(3000)}x" for _ in range(n)]
    passage = some(40)
    texts = [some(rng.randrange(20, 90)) for _ in range(80)]
    texts += [t[:5] + ["edited"] + t[6:] for t in texts[:15]] + [texts[1]] * 4 + [texts[0][:10] + passage[:30] + texts[3]]
    texts += [["zz"] * 3 + passage]
    rows = [(i, " ".join(t), rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "c", None]), 1) for i, t in enumerate(texts)]
    rows += [(500, None, "en", "a", 0), (501, "", "en", "b", 0), (502, "12 - 34", "en", "c", 7), (503, "été", None, "b", 3)]
    return rows, [("1", " ".join(passage)), ("2", " ".join(some(30)))]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, items = documents()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_against_brute_force(spark, sf_dir):
    docs, rows = spark.read.parquet(f"{sf_dir}/documents.parquet"), documents()[0]
    by_id = {r[0]: r for r in rows}
    want = {i for i, t, *_ in rows if re.search(r"[^\W\d_]", t or "")}
    for name, of in P.STAGES:
        out = stage(of(spark, docs, sf_dir), f"test-{name}")
        if name != "sharding":
            assert out.columns == docs.columns
            assert all(tuple(r) == by_id[r["doc_id"]] for r in out.collect())
        got = [r["doc_id"] for r in out.collect()]
        if name == "near_duplicates":
            want = {i for i, (_, root) in components_of([(i, by_id[i][1]) for i in want]).items() if i == root}
        elif name == "decontamination":
            want = {i for i, (n, hit, _) in contamination_of([(i, by_id[i][1]) for i in want], documents()[1]).items()
                    if not (hit and 20 * hit >= n)}
        elif name == "mixing":
            sizes = {}
            for i in want:
                sizes[by_id[i][3]] = sizes.get(by_id[i][3], 0) + size(by_id[i][1])
            target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
            for i in got:
                taken[by_id[i][3]] += size(by_id[i][1])
            assert set(got) <= want and max(map(got.count, got)) <= 2
            assert all(abs(taken[s] - target[s]) <= 90 for s in sizes)
            mix = sorted(got)
        if name == "sharding":
            assert sorted(got) == mix
            for r in out.collect():
                text = by_id[r["doc_id"]][1].encode()
                assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "bytes")
            slots = {}
            for r in out.collect():
                slots.setdefault(r["shard"], []).append(r["slot"])
            assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
        elif name != "mixing":
            assert sorted(got) == sorted(want), name
        docs = out


def test_python_stages_get_batches_bound_by_bytes(spark, sf_dir):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "n"])

    other = spark.newSession()                   # what the stage sets is the session's
    P.language_id(other, other.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    texts = other.range(4100).coalesce(1).selectExpr("id", "repeat('x', if(id = 7, 9000000, 2000)) text")
    got = texts.mapInArrow(sizes, "size long, n long").collect()
    assert sum(r["n"] for r in got) == 4100 and sum(r["size"] for r in got) > 17_000_000
    assert sorted(r["size"] for r in got)[-2] <= 1.1 * BATCH_BYTES


def test_run_gives_the_last_stage(spark, sf_dir):
    out = P.run(spark, sf_dir)
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= set(out.columns) and out.count() > 0


CONTRACT = {
    "op1": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3": "doc_id size source_size target taken",
    "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5": "doc_id size text_crc32 law shard slot grown_shard",
    "op6": "page_id url text n_chars",
    "op7": "doc_id n_shingles component_id kept",
    "op8": "doc_id held_out lang_pred score",
    "op9": "doc_id held_out score predicted",
    "op10": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op11": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13": "lang rank phrase a l r n score",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_give_whole_tables(spark, name):
    d = "/root/testdata/sf0.001"
    out = QUERIES[name](spark, d)
    assert set(CONTRACT[name.split("_")[0]].split()) <= set(out.columns)
    if name.startswith("op13_"):                 # a row per rank and lang, not per document
        ranks = {}
        for r in out.collect():
            ranks.setdefault(r["lang"], []).append(r["rank"])
        assert ranks and all(sorted(x) == list(range(1, len(x) + 1)) and len(x) <= 2000 for x in ranks.values())
        return
    source = {"op2": "conversations", "op6": "pages"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{d}/{source}.parquet")
    n = rows.select("conv_id").distinct().count() + 1 if source == "conversations" else rows.count()
    assert out.count() == n
