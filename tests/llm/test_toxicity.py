import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import DOCS, words
from terrace.llm import toxicity as X

INSULTS = "zorgle blatfink krumpet".split()


def _text(rng, toxic, n=None):
    body = words(rng, "en", n or rng.randint(15, 120)).split()
    if toxic:
        for _ in range(max(2, len(body) // 15)):
            body.insert(rng.randrange(len(body)), rng.choice(INSULTS))
    return " ".join(body)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(500):
        toxic = i % 4 == 0
        rows.append((i, _text(rng, toxic), "en", "s", 0))
        if i % 10:
            labels.append((i, 1, int(toxic)))
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "?!", "en", "s", 0), (903, _text(rng, True, 3000), "en", "s", 0), (904, _text(rng, False, 3000), "en", "s", 0), (None, _text(rng, True), None, None, None)]
    labels += [(5, 1, None), (None, 1, 1), (77777, 1, 1), (8, 1, 0), (8, 1, 1)]
    return rows, spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_query_has_held_out_accuracy(corpus):
    rows, docs, labels = corpus
    out = X.toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 500]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert len(held) > 60 and right >= 0.95 * len(held)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[903]["predicted"] == 1 and by_id[904]["predicted"] == 0 and by_id[None]["predicted"] == 1
    assert by_id[900]["score"] == by_id[901]["score"] == by_id[902]["score"] < 0.5


def test_typical_words_count_contexts_not_copies():
    rng = random.Random(4)
    ordinary = [(" " + _text(rng, False) + " ").encode() for _ in range(60)]
    copied = (" " + _text(rng, False) + " onlyhere ").encode()
    toxic = [(" " + _text(rng, True) + " ").encode() for _ in range(30)] + [copied] * 30
    strong, _, common = X._typical(toxic, ordinary)
    assert set(strong) == {w.encode() for w in INSULTS} and len(common) > 20


def test_rare_insults_are_learned_too():
    rng = random.Random(8)
    insults = [f"zorg{a}{b}lefink" for a in "abcdefghij" for b in "klmnopqrst"]
    often = [400] * 3 + [24] * 97  # times in the sample: most are far less frequent than the commonest
    ordinary = [_text(rng, False, 60) for _ in range(1200)]
    bodies = [_text(rng, False, 60).split() for _ in range(1200)]
    for insult, n in zip(insults, often):
        for body in rng.sample(bodies, n):
            body.insert(rng.randrange(len(body)), insult)
    toxic = [" ".join(body) for body in bodies]
    strong, _, _ = X._typical([f" {t} ".encode() for t in toxic], [f" {t} ".encode() for t in ordinary])
    assert {w.encode() for w in insults} <= set(strong)
    model = X.train(toxic, ordinary)
    assert all(f" {w} ".encode() in model.toxic for w in insults)
    words = [_text(rng, False, 30).split() for _ in insults]
    assert (model.scores(pa.array([" ".join([*w[:15], insult, *w[15:]]) for w, insult in zip(words, insults)])) >= 0.5).mean() > 0.95
    assert (model.scores(pa.array([" ".join(w) for w in words])) >= 0.5).mean() < 0.05


def test_few_insults_in_long_texts_count():
    rng = random.Random(13)
    model = X.train([_text(rng, True) for _ in range(300)], [_text(rng, False) for _ in range(900)])
    long = [words(rng, "en", 20_000).split() for _ in range(10)]
    assert (model.scores(pa.array([" ".join(t) for t in long])) < 0.5).all()
    for text in long:
        for insult in INSULTS:
            text.insert(rng.randrange(len(text)), insult)
    assert (model.scores(pa.array([" ".join(t) for t in long])) >= 0.5).all()


def test_windows_cover_whole_texts():
    text = b" " + b"word " * 500 + b"x" * 400 + b" end "
    windows = X._windows(text)
    assert b"".join(w[:-1] if w.endswith(b" ") else w for w in windows).replace(b" ", b"") == text.replace(b" ", b"")
    assert X._windows(b"  ") and X._windows(b" ") == []


def test_one_class_or_no_label(spark, no_docs, corpus):
    rows, docs, labels = corpus
    empty = labels.limit(0)
    assert X.toxicity(no_docs, empty).count() == 0
    assert {r["score"] for r in X.toxicity(docs, empty).collect()} == {0.0}
    assert X.train(["a"], []).scores(pa.array(["x", None])).tolist() == [1.0, 1.0]
    same = X.train(["a b c"] * 3, ["a b c"] * 3).scores(pa.array(["a b c"]))
    assert np.isfinite(same).all()
