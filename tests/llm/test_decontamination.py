import hashlib
import random
import re

import pytest

from terrace.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    """doc rows -> (n_words, n_hit, item ids) by comparing every window with every place."""
    out = []
    for text in docs:
        w, hit, ids = _words(text), set(), set()
        for item_id, item in items:
            iw = _words(item)
            size = min(window, len(iw))
            for win in {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if size else ():
                for i in range(len(w) - size + 1):
                    if tuple(w[i : i + size]) == win:
                        hit.update(range(i, i + size))
                        if item_id is not None:
                            ids.add(str(item_id))
        out.append((len(w), len(hit), sorted(ids)))
    return out


def _items(rng, texts):
    items = [(i, " ".join(rng.choices("a b c d".split(), k=rng.randint(1, 20)))) for i in range(12)]
    items += [(20, " ".join(_words(texts[0])[:15])), (21, "Rare, single"), (22, None), (23, " .. "), (None, "z z z"), (20, "q r s t u v w x y q r s t u v w")]
    return items


def _random_docs(rng):
    out = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 60))) for _ in range(80)]
    return [*out, "x RARE single y", None, "", "z z z z", "q r s t u v w x y q r s t u v w " * 3]


@pytest.mark.parametrize("block_words", [500_000, 5])
def test_spans_equal_brute_force(spark, block_words):
    rng = random.Random(5)
    texts = _random_docs(rng)
    items = _items(rng, texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["found"] for r in D.find_spans(docs, benchmark, block_words=block_words).collect()}
    for i, (n, hit, ids) in enumerate(brute(texts, items)):
        f = got[i]
        assert (f["n_words"], sum(s["end"] - s["begin"] for s in f["spans"]), f["items"]) == (n, hit, ids)


def test_a_worker_holds_one_automaton_and_builds_it_once(monkeypatch):
    built = []
    monkeypatch.setattr(D, "Matcher", lambda items, window: built.append(items) or object())

    class Shared:
        def __init__(self, value):
            self.value = value

    first = D._matcher("a", Shared(["a"]), 13)
    assert D._matcher("a", Shared(["a"]), 13) is first
    D._matcher("b", Shared(["b"]), 13)
    assert built == [["a"], ["b"]] and list(D._held) == ["b"]
    D._held.clear()


def test_blocks_are_separate_passes(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    items = [(i, f"{w} {v}") for i, (w, v) in enumerate(["ab", "cd", "de", "xy"])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def passes(block_words):
        found = D.find_spans(docs, benchmark, block_words=block_words)
        plan = found._jdf.queryExecution().executedPlan().toString()
        return plan.count("MapInArrow"), found.collect()[0]["found"]["items"]

    assert passes(2) == (1, ["0", "1", "2"])
    assert passes(100) == (1, ["0", "1", "2"])


def test_contract_columns(spark, docs, rows):
    item = " ".join(_words(rows[0][1])[:13])
    benchmark = spark.createDataFrame([(5, item), (40, item), (7, None)], "item_id long, text string")
    got = sorted(map(tuple, D.contamination(docs, benchmark).collect()), key=str)
    want = []
    for r, (n, hit, ids) in zip(rows, brute([r[1] for r in rows], [(5, item), (40, item)])):
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want.append((r[0], n, hit, len(ids), digest, hit > 0 and 20 * hit >= n))
    assert got == sorted(want, key=str)


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(no_docs, none).count() == 0
    got = D.contamination(docs, none).collect()
    assert len(got) == docs.count() and not any(r["contaminated"] or r["n_hit"] for r in got)
    assert D.remove_spans(docs, none).count() == docs.count()


def test_remove_spans(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    body = "Clean words here. " * 100
    docs = spark.createDataFrame([(1, item, "x"), (2, body + item.upper() + "! End.", "y"), (3, body, None), (4, None, None)], "doc_id long, text string, found string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {r["doc_id"]: r for r in D.remove_spans(docs, benchmark).collect()}
    assert set(kept) == {2, 3, 4} and kept[2]["text"] == body + item.upper() + "! End." and kept[2]["found"] == "y"
    cut = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, benchmark, coverage=None, min_span=13).collect()}
    assert cut == {1: "", 2: body + "! End.", 3: body, 4: None}


def test_remove_spans_judges_all_blocks_together(spark):
    items = [" ".join(f"{name}{i}" for i in range(15)) for name in ("first", "second")]
    clean = "Clean words here. "
    texts = [f"{items[0]} {clean * 150}{items[1]}", f"{items[0]} {clean * 300}", f"{items[0]} {items[1]} {clean * 300}"]  # 6.25, 1.6 and 3.2% hit
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block_words in (500_000, 5):
        verdict = {r["doc_id"]: r["contaminated"] for r in D.contamination(docs, benchmark, block_words=block_words).collect()}
        kept = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, benchmark, block_words=block_words).collect()}
        assert verdict == {0: True, 1: False, 2: False} and kept == {1: texts[1], 2: texts[2]}
        # The two items stand side by side: only together are they a span of 30 words.
        cut = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, benchmark, coverage=None, min_span=30, block_words=block_words).collect()}
        assert cut == {0: texts[0], 1: texts[1], 2: " " + clean * 300}


def test_many_overlapping_items_in_the_automaton():
    rng = random.Random(9)
    items = [(str(i), rng.choices([b"a", b"b"], k=rng.randint(1, 9))) for i in range(30)]
    automaton = D.ItemAutomaton(items, 4)
    for _ in range(50):
        text = rng.choices([b"a", b"b", b"c"], k=40)
        spans, found, _ = automaton.walk(text)
        want = brute([b" ".join(text).decode()], [(i, b" ".join(w).decode()) for i, w in items], 4)[0]
        assert (sum(e - b for b, e in spans), sorted(found)) == want[1:]
