import random
import re
from itertools import combinations

import pyarrow as pa
import pytest
import xxhash

from terrace.llm import simhash as S


def brute_fingerprint(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(shingle, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fingerprints, distance=2):
    """Position -> smallest position reachable, comparing all pairs."""
    parent = list(range(len(fingerprints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(fingerprints)), 2):
        if (fingerprints[a] ^ fingerprints[b]).bit_count() <= distance:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [root(i) for i in range(len(fingerprints))]


def test_fingerprints_equal_brute_force(rows):
    texts = [r[1] for r in rows]
    got = S._text_fingerprints(pa.array(texts, pa.string()), 3)
    assert [int(x) % 2**64 for x in got] == [brute_fingerprint(t) for t in texts]


def test_query_equals_brute_force(spark, docs, rows):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in S.near_duplicates(docs).collect())
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps)
    least = {}
    for i, r in zip(root, rows):
        if r[0] is not None:
            least[i] = min(least.get(i, r[0]), r[0])
    want = [(r[0] is None, r[0] or 0, f"{f:016x}", least.get(i)) for r, f, i in zip(rows, fps, root)]
    assert got == sorted(want)


@pytest.mark.parametrize("crowd", [0, 3, 1000])
def test_links_of_close_and_crowded_fingerprints(spark, crowd):
    """Chains, balls of close fingerprints and lone ones; a low crowd sends all through the variants."""
    rng = random.Random(crowd)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fps.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) * rng.randint(0, 1))
    chain = rng.getrandbits(64)
    for b in range(0, 40, 2):
        chain ^= 3 << b
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(30)} | {0, 2**64 - 1, 1}
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    frame = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in S.component_of(frame, 2, crowd).collect()}
    assert [got[f] for f in signed] == brute_components(fps)


def test_other_distances(spark):
    fps = [0, 1, 3, 7, 15, 2**40, 2**40 + 2**50 + 2**51 + 2**52 + 2**53]
    frame = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long")
    for distance in (0, 4):
        got = {r["fp"]: r["component_id"] for r in S.component_of(frame, distance).collect()}
        assert [got[f] for f in fps] == brute_components(fps, distance)
    with pytest.raises(ValueError, match="even"):
        S.links(frame.select("fp"), 3)


def test_long_paths_become_stars(spark):
    n = 70
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (200, 201), (201, 200)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n)}, 201: 200}


def test_keep_one(spark, docs, rows):
    extra = docs.withColumnRenamed("lang", "fp").withColumnRenamed("n_chars", "row")
    kept = S.keep_one(extra)
    assert kept.columns == extra.columns
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps)
    want = {}
    for i, r in zip(root, rows):
        key = (r[0] is None, r[0])
        if i not in want or key < want[i]:
            want[i] = key
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted(want.values())


def test_empty(spark, no_docs):
    assert S.near_duplicates(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0
