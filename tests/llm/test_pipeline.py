"""The corpus pipeline against a brute-force version of its stages."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as C
from conftest import DOCS, sentences, words
from terrace.llm import mixing, packing
from test_decontamination import brute
from test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(31)
    item = words(rng, "en", 20)
    rows = [(i, sentences(rng, ("en", "de", "fr")[i % 3], rng.randint(2, 9)), ("en", "de", "fr")[i % 3], f"s{i % 4}") for i in range(120)]
    rows += [(200 + i, rows[i][1], rows[i][2], "s9") for i in range(6)]  # exact copies
    rows += [(300 + i, words(rng, "en", 300) + " zzz", "en", "s1") for i in range(2)]
    rows += [(310, rows[-1][1].replace(" zzz", " yyy"), "en", "s2")]  # a near copy
    rows += [(400, item, "en", "s0"), (401, words(rng, "en", 60) + " " + item, "en", "s0"), (402, words(rng, "en", 900) + " " + item, "en", "s0")]
    rows += [(500, None, "en", "s0"), (501, "", "de", "s0"), (502, "1 2 3 !", "fr", None), (503, words(rng, "de", 40), None, None), (None, words(rng, "fr", 40), "fr", "s1")]
    rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, item


def test_stage_list():
    assert [name for name, _ in C.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "packing"]


def test_every_stage_against_brute_force(spark, tables):
    folder, rows, item = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(C.STAGES)

    kept = stages["language_id"](spark, docs, folder).cache()
    assert kept.columns == docs.columns
    lettered = {r[0] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])}
    assert {r["doc_id"] for r in kept.collect()} == lettered

    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    unique = stages["near_dedup"](spark, kept, folder).cache()
    groups = brute_components([brute_fingerprint(t) for _, t in texts])
    least = {}
    for (doc_id, _), group in zip(texts, groups):
        key = (doc_id is None, doc_id)
        least[group] = min(least.get(group, key), key)
    assert unique.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in unique.collect()) == sorted(least.values())
    assert len(least) <= len(texts) - 7

    clean = stages["decontamination"](spark, unique, folder).cache()
    before = [tuple(r) for r in unique.collect()]
    dirty = {r[0] for r, (n, hit, _) in zip(before, brute([r[1] for r in before], [(1, item)])) if hit and 20 * hit >= n}
    assert dirty == {400, 401}
    assert Counter(map(tuple, clean.collect())) == Counter(r for r in before if r[0] not in dirty)

    mixed = stages["mixing"](spark, clean, folder).cache()
    assert mixed.columns == docs.columns
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    size, got = Counter(), Counter()
    for r in clean.collect():
        size[r["source"]] += count(r["text"])
    for r in mixed.collect():
        got[r["source"]] += count(r["text"])
        assert r["n_chars"] == len(r["text"])
    names = sorted(size, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([size[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    for name, target in zip(names, goal):
        assert abs(got[name] - target) <= mixing.BLOCK_WORDS

    packed = stages["packing"](spark, mixed, folder).collect()
    ranks = packing.read_ranks(packing.VOCABULARY)
    coder = packing.encoding(ranks)
    tokens = sum(len(coder.encode_ordinary(r["text"])) + 1 for r in mixed.collect())
    assert sum(r["n_tokens"] for r in packed) == tokens
    assert sum(s["part"] == 0 for r in packed for s in r["segments"]) == mixed.count()


def test_run_equals_its_stages_and_takes_empty_tables(spark, tables, no_docs, tmp_path):
    folder, rows, _ = tables
    out = C.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, folder)
    segments = [Counter((s["doc_id"], s["part"]) for r in d.collect() for s in r["segments"]) for d in (out, docs)]
    assert segments[0] == segments[1]
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_pass(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "'x' AS fp", "1 AS row", "2.5 AS score", "doc_id AS shard")
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-4:] == ["fp", "row", "score", "shard"]
    assert docs.where("fp = 'x' AND row = 1 AND score = 2.5 AND shard <=> doc_id").count() == docs.count() > 0
