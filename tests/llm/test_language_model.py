import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DOCS
from terrace.llm import language_model as M
from terrace.llm.words import HashIndex


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def _held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def brute_base(rows):
    counts = Counter(t for r in rows if not _held(r[0]) for t in _tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        tokens = _tokens(r[1])
        base = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in tokens)
        out.append((r[0], _held(r[0]), len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out


def test_base_equals_brute_force(docs, rows, monkeypatch):
    for dictionary in (1 << 17, 50):  # with the small one most tokens meet their counts in the join
        monkeypatch.setattr(M, "DICTIONARY", dictionary)
        got = sorted((tuple(r) for r in M.score_documents(docs).collect()), key=str)
        want = sorted(brute_base(rows), key=str)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
        assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)


@pytest.fixture(scope="module")
def grammar(spark):
    """Texts whose words follow from the ones before: the model has something to learn."""
    rng = random.Random(5)
    nouns, verbs = [f"n{i}" for i in range(20)], [f"v{i}" for i in range(20)]

    def text():
        out = []
        for _ in range(rng.randint(5, 40)):
            i = rng.randrange(20)
            out += ["the", nouns[i], verbs[i], rng.choice(["rare%d" % rng.randrange(10**6), "."])]
        return " ".join(out)

    return spark.createDataFrame([(i, text(), "en", "s", 0) for i in range(300)], DOCS)


def test_model_beats_the_base_on_held_out_texts(grammar):
    got = M.score_documents(grammar).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens"), F.count("*")).first()
    assert got[3] > 20 and got[1] / got[2] > got[0] / got[2] + 0.3


def test_distribution_sums_to_one(grammar):
    """After any context, known tokens and one unknown token in each tail class have probability 1 together."""
    model, counts = M.fit(grammar, F.lit(True))
    words = [bytes(r["word"]) for r in counts.collect()]
    c = {bytes(r["word"]): r["c"] for r in counts.collect()}
    frequent = set(sorted((w for w in words if w != M.END), key=lambda w: (-c[w], w))[: M.HEADS - 1]) | {M.END}
    for before in ("the", "the n3", "rare5 ."):
        total = 0.0
        tails = [bytes([b]) for b in range(97, 97 + M.TAILS)]  # a last byte for each tail class
        for word in [*words, *(b"never seen".replace(b" ", b"") + t for t in tails)]:
            text = before if word == M.END else f"{before} {word.decode('latin1')}"
            raw = np.frombuffer(text.encode("latin1"), np.uint8)
            t = M.tokens(raw, np.array([0, len(raw)]), model.index)
            log_p = model.log_probabilities(t)[len(before.split())]
            total += 10**log_p * (1 if word in frequent else c.get(word, 0) + 1)
        assert total == pytest.approx(1, rel=1e-4)


def test_gradient_steps_raise_the_likelihood(grammar):
    zero, _ = M.fit(grammar, F.lit(True), rounds=0)
    one, _ = M.fit(grammar, F.lit(True), rounds=1)
    texts = [r["text"] for r in grammar.limit(40).collect()]
    raw = "".join(texts).encode()
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    t = M.tokens(np.frombuffer(raw, np.uint8), offsets, zero.index)
    assert one.log_probabilities(t).sum() > zero.log_probabilities(t).sum()


def test_least_count_keeps_the_bound(spark, monkeypatch):
    counts = spark.createDataFrame([(bytes([65 + i]), c) for i, c in enumerate([1, 1, 1, 2, 2, 3000, 3001, 5])], "word binary, c long")
    for bound, kept in ((9, 8), (8, 5), (5, 3), (3, 2), (2, 0)):
        monkeypatch.setattr(M, "DICTIONARY", bound)
        assert counts.where(F.col("c") >= M._least_count(counts)).count() == kept


def test_no_training_rows(spark, no_docs):
    assert M.score_documents(no_docs).count() == 0
    held = next(i for i in range(100) if _held(i))
    only = spark.createDataFrame([(held, "a b", "en", "s", 3), (held, None, "en", "s", 0)], DOCS)
    got = sorted(tuple(r) for r in M.score_documents(only).collect())
    assert got == [(held, True, 1, 0, 0, 0.0, 0.0), (held, True, 3, 0, 0, 0.0, 0.0)]


def test_features_and_index_are_deterministic():
    one = M._feature(1 << 14, 3, np.array([1, 2, 1]), np.array([5, 5, 5]))
    assert one[0] == one[2] != one[1]
    assert HashIndex(np.array([0], np.uint64)).find(np.array([0], np.uint64)).tolist() == [0]


class _PlainTrainer(M._Trainer):
    """Each step in whole matrices, with one sum per feature row by ``reduceat``."""

    def _step(self, table, bias, rows, features, label, which=None):
        slope = rows[features[0]] + (bias if which is None else bias[which])
        for f in features[1:]:
            slope += rows[f]
        slope = np.exp(slope - slope.max(axis=1, keepdims=True))
        slope /= slope.sum(axis=1, keepdims=True)
        slope[np.arange(len(label)), label] -= 1
        for feature in features:
            order = np.argsort(feature.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(feature[order]) != 0])
            row = feature[order][first]
            sums = np.add.reduceat(slope[order], first, axis=0)
            self.squares[table][row] += sums * sums
            rows[row] -= M.RATE * sums / np.sqrt(self.squares[table][row])
            self.met[table][row] += np.diff(np.r_[first, len(order)])


def _zipf_model(texts):
    rng = np.random.default_rng(2)
    words = [b"w%d" % i for i in range(5000)]
    raw = [b" ".join(words[i] for i in np.minimum(rng.zipf(1.2, 400), 5000) - 1) for _ in range(texts)]
    count = 1_000_000 // np.arange(1, 5002)
    heads = count[: M.HEADS].reshape(-1, M.CLASS)
    bias = np.log(np.r_[heads.sum(axis=1), np.full(M.TAILS, 1000)])
    model = M.Model(
        HashIndex(np.array([0, *M._hash_all(words)], np.uint64)), count, int(count.sum()), 5001, np.ones(M.TAILS), bias.astype(np.float32), np.log(heads).astype(np.float32),
        np.zeros((M.CLASS_ROWS, M.CLASSES), np.float32), np.zeros((M.TOKEN_ROWS, M.CLASS), np.float32),
    )
    return model, M.tokens(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])], model.index)


def test_steps_equal_the_plain_ones_in_less_time():
    model, t = _zipf_model(600)
    took = {M._Trainer: math.inf, _PlainTrainer: math.inf}
    for _ in range(3):
        made = []
        for kind in took:
            trainer, began = kind(model), time.process_time()
            trainer.learn(t)
            took[kind] = min(took[kind], time.process_time() - began)
            made.append(list(trainer.changes()))
        assert made[0] == made[1] and made[0]
    assert took[M._Trainer] < 0.85 * took[_PlainTrainer]


@pytest.mark.parametrize("groups", [1, 7, 300, 4000, 30000])
def test_row_sums(groups):
    rng = np.random.default_rng(groups)
    values, group = rng.normal(size=(5000, 32)).astype(np.float32), rng.integers(0, groups, 5000)
    row, times, sums = M._row_sums(values, group)
    want = np.zeros((groups, 32))
    np.add.at(want, group, values)
    assert sorted(row.tolist()) == np.unique(group).tolist() and times.tolist() == np.bincount(group)[row].tolist()
    assert np.allclose(sums, want[row], atol=1e-3)
    for limit in (1, 8191):  # equal bits, in whatever order the groups come
        one = M._row_sums(values[:limit], group[:limit])
        order = np.argsort(group[:limit], kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
        assert np.array_equal(one[2][np.argsort(one[0])], np.add.reduceat(values[order], first, axis=0))


def test_log_probabilities_equal_whole_softmaxes():
    model, t = _zipf_model(60)
    trainer = M._Trainer(model)
    trainer.learn(t)
    model = trainer.model
    klass, inside, one, two = model.contexts(t)

    def whole(bias, rows, features):
        out = rows[features[0]] + bias
        for f in features[1:]:
            out += rows[f]
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))

    want = whole(model.class_bias, model.class_rows, model.class_features(one, two))[np.arange(len(klass)), klass] / np.log(10)
    head = np.flatnonzero(inside >= 0)
    k = klass[head]
    want[head] += whole(model.token_bias[k], model.token_rows, model.token_features(k, one[head], two[head]))[np.arange(len(k)), inside[head]] / np.log(10)
    rare = np.flatnonzero(inside < 0)
    want[rare] -= model.tail_log[klass[rare] - M.HEADS // M.CLASS]
    assert len(head) and len(rare) and np.array_equal(model.log_probabilities(t), want)
    assert len(model.log_probabilities(M.tokens(np.empty(0, np.uint8), np.zeros(1, np.int64), model.index))) == 0
