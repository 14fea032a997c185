import hashlib
import random
import re
import zlib

import numpy as np
from conftest import DOCS
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from terrace.llm import periodic_runs as R


def brute_runs(words, least=6, exponent=4):
    """All runs by trying every period at every word."""
    out = {}
    n = len(words)
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                out.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((start, length, q) for (start, length), q in out.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2], sha(lines), sha(collapsed))


def batch_runs(words, **given):
    known = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    return [tuple(r) for r in R.runs_of_batch(numbers, np.zeros(len(words), np.int64), **given).tolist()]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_two_letters(words):
    assert batch_runs(words) == brute_runs(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=4), st.integers(1, 9)), max_size=6), st.integers(2, 7), st.integers(2, 5))
def test_repeated_pieces(pieces, least, exponent):
    words = list("".join(piece * times for piece, times in pieces))
    assert batch_runs(words, least=least, exponent=exponent) == brute_runs(words, least, exponent)


def test_texts_of_a_batch_are_apart():
    text = np.repeat([0, 1], 6)
    assert R.runs_of_batch(np.array([0] * 6 + [1] * 6), text).tolist() == [[0, 6, 1], [6, 6, 1]]
    # Texts number their words separately, so a run never goes on in the next text.
    assert R.runs_of_batch(np.array([0] * 3 + [1] * 3), np.repeat([0, 1], 3)).tolist() == []


def test_nested_and_crossing_runs():
    words = ("a " * 8 + "b ").strip().split() * 6
    assert batch_runs(words) == brute_runs(words)
    assert (0, 54, 9) in batch_runs(words) and (0, 8, 1) in batch_runs(words)
    crossing = list("abababab") + list("bcbcbcbc")
    assert batch_runs(crossing) == brute_runs(crossing)


def _rows():
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one", "a " * 5, "a " * 6, "x y " * 4, "é ü " * 9, "the  same\tline\n" * 50, "\x85a \x85b " * 5]
    texts += [" ".join(rng.choices(["go", "on", "to", "it"], k=rng.randint(1, 200))) for _ in range(150)]
    texts += [("one two three\n" * 7 + "four " * 9 + "five six " * 12) * 5]
    texts += ["w " * 300 + "v " * 300]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    return rows + [(None, "b " * 9, None, None, 1), (5, "a " * 6, "en", "s", None), (5, "a " * 6, "en", "s", None)]


def test_documents_equal_brute_force(spark, docs, rows):
    every = _rows() + [r for r in rows if (r[4] or 0) < 2_000]
    got = R.documents_runs(spark.createDataFrame(every, DOCS).repartition(3))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((brute_row(r[0], r[1]) for r in every), key=str)


def test_long_texts(spark):
    # A million equal words, a long period, and a line repeated between different words.
    line = "a line of six words here"
    texts = ["w " * 1_000_000, " ".join(f"n{i % 50_000}" for i in range(250_000)), " ".join(f"{line} {i}" for i in range(60_000))]
    got = R.find_runs(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")).orderBy("id").collect()
    assert [[tuple(run) for run in r["runs"]] for r in got] == [[(0, 1_000_000, 1)], [(0, 250_000, 50_000)], []]
    assert got[0]["collapsed"] == "w" and len(got[1]["collapsed"].split()) == 50_000 and got[2]["collapsed"] == texts[2]


def test_other_columns_and_empty_tables(spark, docs, no_docs):
    assert R.documents_runs(no_docs).count() == 0
    clashing = docs.withColumns({c: F.lit("x") for c in ("runs", "collapsed", "best", "w", "a", "p")})
    assert sorted(map(tuple, R.documents_runs(clashing).collect()), key=str) == sorted(map(tuple, R.documents_runs(docs).collect()), key=str)
    kept = R.find_runs(docs, runs="lang", collapsed="text")
    assert set(kept.columns) == set(docs.columns) and kept.count() == docs.count()
