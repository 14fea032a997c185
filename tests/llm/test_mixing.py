import random
import re
from collections import Counter, defaultdict

import numpy as np

from conftest import DOCS
from terrace.llm import mixing as M


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_apportion(entitled, caps, seats):
    """Seat by seat to the highest quotient."""
    quota = [0] * len(entitled)
    for _ in range(seats):
        open_ = [i for i in range(len(quota)) if quota[i] < caps[i] and entitled[i] > 0]
        if not open_:
            break
        best = max(open_, key=lambda i: (entitled[i] / (2 * quota[i] + 1), -i))
        quota[best] += 1
    return quota


def test_apportion_equals_highest_quotients():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 9)
        entitled = [rng.choice([0, 1, 5, 5, rng.random() * 30]) for _ in range(n)]
        caps = [rng.randint(0, 12) for _ in range(n)]
        seats = rng.randint(0, 40)
        assert M.apportion(np.array(entitled), np.array(caps), seats).tolist() == brute_apportion(entitled, caps, seats)


def test_targets():
    assert M.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    # 5/8 of 320 is above 3 x 10; what is over goes to the others by weight
    got = M.targets([10, 10, 300], [5, 2, 1])
    assert got == [30.0, 30.0, 260.0]
    assert M.targets([], []) == [] and M.targets([0, 0], [5, 2]) == [0.0, 0.0]


def _expected(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += _size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = M.targets([sizes[s] for s in names], [M.WEIGHTS[i % 3] for i in range(len(names))])
    return sizes, dict(zip(names, goal))


def test_query(spark, docs, rows):
    got = M.mixture(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    first, again = ([tuple(r) for r in M.mixture(d).collect()] for d in (docs, docs.repartition(7)))
    assert Counter(first) == Counter(again) and len(first) == len(rows)
    sizes, goal = _expected(rows)
    want = Counter((r[0], _size(r[1]), sizes[r[3]]) for r in rows)
    assert Counter(r[:3] for r in first) == want
    taken = defaultdict(int)
    for doc_id, size, source_size, target, got_words in first:
        assert 0 <= got_words <= 3 * size
        taken[source_size] += got_words
        assert any(abs(target - g) < 1e-6 for s, g in goal.items() if sizes[s] == source_size)
    for source, target in goal.items():
        assert abs(taken[sizes[source]] - target) <= M.BLOCK_WORDS


def test_many_shards_and_levels(spark, docs, rows, monkeypatch):
    """Small shards and a narrow tree: quotas still add up to the targets."""
    monkeypatch.setattr(M, "FAN", 3)
    plan = M.Mix(docs, block_words=4, shard_words=40)
    assert plan.quotas.count() > 9
    sizes, goal = _expected(rows)
    taken = Counter()
    source_of = {sizes[s]: s for s in sizes}
    for r in plan.taken().collect():
        taken[source_of[r["source_size"]]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    for source, target in goal.items():
        assert abs(taken[source] - target) <= 4 + 0.02 * target


def test_texts_hold_the_words_taken(spark, docs):
    wide = docs.withColumnRenamed("lang", "size")
    mixed = M.mixed_texts(wide)
    assert mixed.columns == wide.columns
    want, got = Counter(), Counter()
    for r in M.mixture(docs).collect():
        want[r["doc_id"]] += r["taken"]
    whole = {(r["doc_id"]): r["text"] for r in docs.collect()}
    for r in mixed.collect():
        got[r["doc_id"]] += _size(r["text"])
        assert r["n_chars"] == len(r["text"])
        assert set(r["text"].split()) <= set(whole[r["doc_id"]].split())
    assert got == +want


def test_empty_and_wordless(spark, no_docs):
    assert M.mixture(no_docs).count() == 0 and M.mixed_texts(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, "  ", "en", None, 2)], no_docs.schema)
    assert sorted(map(tuple, M.mixture(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mixed_texts(blank).count() == 0


def test_rows_without_words_are_not_brought_together(spark):
    from pyspark.sql import functions as F

    rows = [(i, None if i % 3 else " ", "en", "empty", 0) for i in range(4000)] + [(9000 + i, "some words here", "en", "full", 15) for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    taken = M.Mix(docs).taken()
    for out in (taken, M.mixed_texts(docs)):  # what goes to the shards has words
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"CoGroupsInArrow(?s:.)*Filter .*size#\d+L? > 0|CoGroupsInArrow(?s:.)*Filter .*regexp.* > 0", plan, re.I), plan
    assert taken.where((F.col("size") == 0) & (F.col("taken") == 0)).count() == 4000
    assert taken.agg(F.sum("taken")).first()[0] == 150
    assert M.mixed_texts(docs).count() >= 50


def test_equal_rows_spread_over_shards(spark, monkeypatch):
    """Rows equal in id and text, of two sources, fill no shard, and their texts are taken as the plan says."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(M, "RUN_BITS", 3)
    rows = [(None, "five words in each copy", "en", "hot" if i % 5 else None, 23) for i in range(3000)] + [(i, f"text number {i} stands alone", "en", "b", 20) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = M.Mix(docs, shard_words=500)
    largest = {r[0]: r[1] for r in plan.quotas.groupBy("src").agg(F.max("words")).collect()}
    assert len(largest) == 3 and max(largest.values()) < 2 * 500
    assert plan.rows.groupBy("h").count().where("count > 1").isEmpty()
    first, again = (Counter(map(tuple, M.mixture(d).collect())) for d in (docs.repartition(3), docs.repartition(7)))
    assert first == again and sum(first.values()) == len(rows)
    want, got = Counter(), Counter()
    for row, times in first.items():
        want[row[0]] += row[4] * times
    for r in M.mixed_texts(docs).collect():
        got[r["doc_id"]] += _size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got == +want
