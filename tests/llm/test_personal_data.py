import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from conftest import DOCS, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from terrace.llm import personal_data as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    """The contract's expressions as they stand."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


CASES = [
    "mail jane.doe+x@mail.example.com, or a@b and c@d.e@f.g now",
    "hosts 1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9999",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 1 2",
    "call +1 (415) 555-2671 or +49 30 1234567-8. +1 2 +123",
    "é😀 x@y.zz 😀 +1 415 555 2671",
    "1 @ . + -",
    "a@b.c" * 3,
    "9" * 5_000 + "." + "7" * 5_000,
]


@settings(max_examples=1500, deadline=None)
@given(st.text("a@.1+5 -()é4", max_size=40) | st.lists(st.sampled_from(["a@b.co", "1.2.3.4", "+1 (415) 555-2671", "4111 1111 1111 1111", " ", ".", "-", "7", "@", "é"]), max_size=8).map("".join))
def test_patterns_equal_the_expressions(text):
    assert P.base(text) == brute_base(text)


@pytest.mark.parametrize("text", CASES)
def test_pattern_cases(text):
    assert P.base(text) == brute_base(text)


def test_long_texts_take_linear_time():
    assert P.base("a" * 2_000_000 + "@") == [] and P.base("1" * 2_000_000 + ".") == [] and P.base("+1" + "-" * 2_000_000) == []


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    model = P.Tagger(*[w.astype(np.float64) + 0.1 * draw.standard_normal(w.shape) for w in P.untrained()])
    x, y = draw.integers(0, P.CHARACTERS, (3, 7)), draw.integers(0, P.TAGS, (3, 7))
    _, grads = P.gradients(model, x, y)
    for k, weights in enumerate(model):
        # Characters that don't occur have no gradient: look where there is one.
        for at in np.argsort(-np.abs(grads[k]).ravel())[[0, weights.size // 9]]:
            place, step = np.unravel_index(at, weights.shape), 1e-5
            sides = []
            for sign in (1, -1):
                moved = [w.copy() for w in model]
                moved[k][place] += sign * step
                sides.append(P.gradients(P.Tagger(*moved), x, y)[0])
            assert abs((sides[0] - sides[1]) / (2 * step) - grads[k][place]) < 1e-4


def test_viterbi_equals_all_sequences():
    draw = np.random.default_rng(1)
    model = P.untrained()._replace(moves=draw.standard_normal((P.TAGS, P.TAGS)), first=draw.standard_normal(P.TAGS))
    scores, lengths = draw.standard_normal((5, 4, P.TAGS)), np.array([4, 1, 3, 2, 4])
    got = P.viterbi(model, scores, lengths)
    for row, n in enumerate(lengths):
        value = lambda tags: model.first[tags[0]] + sum(scores[row, t, k] for t, k in enumerate(tags)) + sum(model.moves[a, b] for a, b in zip(tags, tags[1:]))
        assert tuple(got[row, :n]) == max(itertools.product(range(P.TAGS), repeat=int(n)), key=value)


def test_tags_and_spans():
    spans = [(2, 0, 6), (6, 0, 9), (9, 3, 10)]
    assert P.spans_of(P.tags(12, spans)) == spans
    # The inside of a span without its beginning is a span of its own.
    assert P.spans_of(np.array([2, 2, 0, 4])) == [(0, 0, 2), (3, 1, 4)]


def _plain(n, seed):
    rng = random.Random(seed)
    return [words(rng, rng.choice(["en", "de", "fr"]), 16)[: P.WINDOW] for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    x, y = P.labelled_windows([], _plain(300, 1))
    return P.train(x, y)


def test_held_out_spans(model):
    plain = _plain(300, 2)
    x, y = P.labelled_windows([], plain, seed=5)
    x, y = x[len(plain) :], y[len(plain) :]
    got = P.viterbi(model, P.emissions(model, x), np.full(len(x), P.WINDOW))
    same = np.array([P.spans_of(a) == P.spans_of(b) for a, b in zip(got, y)])
    assert same.mean() > 0.8 and all(same[k :: len(P.KINDS) + 2].mean() > 0.65 for k in range(len(P.KINDS) + 2))


def test_adds_what_patterns_miss(model):
    card, phone = "4111111111111111", "+1 (843) 555-7672"
    texts = [
        "onthe reing write to karl.meier (at) posthaus (dot) com erther on",
        "therer 7536784127813 " + card + " ingon er",  # one match of 29 digits: dropped by the pattern
        "erdth on " + phone + " 170.106.47.218 er",
        "ering on the thed 415-555-2671 ing on ed",
    ]
    found = P.added(texts, [P.base(t) for t in texts], model)
    got = [[(P.KINDS[k], t[s:e]) for s, k, e in row] for t, row in zip(texts, found)]
    assert got[0] == [("email", "karl.meier (at) posthaus (dot) com")]
    assert ("card", card) in got[1] and ("phone", phone) in got[2] and got[3] == [("phone", "415-555-2671")]


def test_clean_texts_are_left_alone(model):
    texts = _plain(300, 3) + ["Licensed under the Apache License, Version 2.0.", "The token = '1beb58b8af68854f0e01b4ad40cdbb6' is out.", "on 2024-01-15 at noon"]
    assert not any(P.added(texts, [P.base(t) for t in texts], model))


def test_windows_are_reconciled(model):
    # A span anywhere in a long stretch is found whole, across window borders too.
    span = "karl.meier (at) posthaus (dot) com"
    for before in range(0, 70, 9):
        text = "on 12, 7 er " * 8 + "on ing er th ing ed is er on the ing on er the ing th er on ed is"[:before] + " " + span + " " + "on 12, 7 er " * 8
        assert any(text[s:e].startswith(span) for s, k, e in P.added([text], [P.base(text)], model)[0])
    # Stretches are decoded alike, however they are grouped.
    many = [P.codes("call 415-555-2671 " * n) for n in (1, 30, 2, 30, 300)]
    for a, b in zip(P.decode(model, many), many):
        assert np.array_equal(a, P.decode(model, [b])[0])


def test_documents(spark, docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(P, "EPOCHS", 1)
    monkeypatch.setattr(P.train, "__defaults__", (1, 1))
    every = [(i, t, "en", "s", None) for i, t in enumerate(CASES)] + [(900, "one " * 30_000 + CASES[3], "en", "s", 0), (None, CASES[0], None, None, None)] + rows
    found = P.documents_spans(spark.createDataFrame(every, DOCS).repartition(3))
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def want(row):
        spans = brute_base(row[1] or "")
        listed = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        return (row[0], *[sum(k == kind for _, k, _ in spans) for kind in range(4)], hashlib.sha256(listed.encode()).hexdigest())

    got = found.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(map(want, every), key=str)
    for r in got:
        listed = [s.split(":") for s in r["spans"].split(",") if s]
        assert len(listed) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] + r["n_added"]
        assert [int(s[1]) for s in listed] == sorted(int(s[1]) for s in listed)
    assert P.documents_spans(no_docs).count() == 0
    clashing = docs.withColumns({c: F.lit(1) for c in ("kind", "piece", "spans", "key", "pattern_spans", "added_spans")})
    assert P.documents_spans(clashing).count() == docs.count()


def test_sample_is_of_distinct_windows(spark):
    copies = spark.createDataFrame([(i, "one +1 (415) 555-2671 two" if i % 2 else f"three {i % 3} four", None, None, 0) for i in range(400)], DOCS)
    found, plain = P.sample(copies)
    assert len(found) == 1 and len(plain) == 3 and found[0][1] == [(4, 3, 21)]
