import hashlib
import random
import re

from pyspark.sql import functions as F

from terrace.llm import multiset_hash as H


def _edited(rows):
    """(doc_id, n_chars, sha256) by the contract: descending ids, nulls last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, r in enumerate(order):
        text, following = r[1] or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_query(docs, rows):
    out = H.edited_fingerprints(docs)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = out.collect()
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, _edited(rows)))
    by_text = {}
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) <= (r["near_edited"] == 1.0)
    assert len(set(by_text.values())) == len(by_text)
    long = [r for r in got if r["n_chars"] > 150 and r["doc_id"] != 205]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.95 * len(long)
    assert 0.5 < sum(r["near_edited"] for r in long) / len(long) < 0.8
    # The repeated rows follow each other: two have their like as next document.
    again = sorted(r["near_next"] for r in got if r["doc_id"] == 300)
    assert again[1:] == [1.0, 1.0] and again[0] < 1


def test_small_tables(spark, no_docs):
    assert H.edited_fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(7, "abcdef", "en", "s", 6)], no_docs.schema)
    row = H.edited_fingerprints(one).first()
    assert (row["doc_id"], row["n_chars"], row["near_next"]) == (7, 6, 1.0)
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    empty = spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, None)], no_docs.schema)
    got = H.edited_fingerprints(empty).collect()
    assert {(r["near_edited"], r["near_next"], r["n_chars"]) for r in got} == {(1.0, 1.0, 0)}


def _vectors(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return frame, H.fingerprints(frame, ["doc_id"])


def test_order_of_paragraphs_does_not_matter(spark):
    rng = random.Random(1)
    paragraphs = [" ".join(rng.choices("a b c d e f".split(), k=9)) for _ in range(6)]
    turned = paragraphs[::-1]
    _, v = _vectors(spark, ["\n".join(paragraphs), "\n".join(turned), "\n".join(paragraphs + paragraphs[:1]), "\n".join(paragraphs[1:])])
    fp = [r[1] for r in sorted(v.select("doc_id", H.hexadecimal(F.col("vector"))).collect())]
    assert fp[0] == fp[1] and len({fp[0], fp[2], fp[3]}) == 3


def test_insertion_and_deletion(spark):
    _, v = _vectors(spark, ["one two\nthree", "four five six seven eight", "one two\nthree\nfour five six seven eight"])
    whole = {r["doc_id"]: r["vector"] for r in v.collect()}
    pair = v.alias("a").join(v.alias("b"), F.expr("a.doc_id = 0 AND b.doc_id = 1"))
    added = pair.select(H.insert(F.col("a.vector"), F.col("b.vector")).alias("v"))
    assert added.first()["v"] == whole[2]
    back = v.alias("a").join(v.alias("b"), F.expr("a.doc_id = 2 AND b.doc_id = 1"))
    assert back.select(H.delete(F.col("a.vector"), F.col("b.vector")).alias("v")).first()["v"] == whole[0]


def _likeness(spark, a, b):
    _, v = _vectors(spark, [a, b])
    pair = v.alias("a").join(v.alias("b"), F.expr("a.doc_id = 0 AND b.doc_id = 1"))
    return pair.select(H.likeness(F.col("a.vector"), F.col("b.vector")).alias("l")).first()["l"]


def test_repetitive_and_unspaced_texts(spark):
    assert _likeness(spark, "a\n" * 100_000, "a\n" * 99_000) > 0.99
    assert _likeness(spark, "a " * 400_000, "a " * 300_000 + "b " * 100_000) > 0.8
    rng = random.Random(3)
    run = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9000))
    other = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9000))
    assert 0.55 < _likeness(spark, run, run[:6000] + other[:3000]) < 0.8
    assert _likeness(spark, run, other) < 0.35


def test_an_inserted_word_changes_few_phrases(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghilmnoprstuy", k=rng.randint(2, 9))) for _ in range(1500)]
    assert _likeness(spark, " ".join(words), " ".join([*words[:100], "inserted", *words[100:]])) > 0.95


def _phrases(paragraph):
    """The phrases of a paragraph, unit by unit."""
    units = [(m.start() + i, min(m.start() + i + H.UNIT, m.end()), m.start() + i + H.UNIT >= m.end()) for m in re.finditer(r"[^ \t\n\r\f\v]+", paragraph) for i in range(0, m.end() - m.start(), H.UNIT)]
    out, i = [], 0
    while i < len(units):
        last = next((j for j in range(i, min(i + H.UNITS, len(units))) if units[j][2] and paragraph[units[j][1] - 1] in H.ENDS), min(i + H.UNITS, len(units)) - 1)
        out.append(paragraph[units[i][0] : units[last][1]])
        i = last + 1
    return out


def test_phrases_equal_brute_force(spark):
    rng = random.Random(8)
    texts = ["", " ", "\n", "one", "a" * 100, " x  y\tz \n\n last word. "] + ["".join(rng.choices("abdot. \n\té字😀", k=rng.randint(1, 300))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in frame.select("text", H.pieces("text").alias("pieces")).collect():
        paragraphs = row["text"].split("\n")
        assert row["pieces"] == paragraphs + [p for q in paragraphs for p in _phrases(q)]


def test_no_python_in_the_plan(docs):
    plan = H.edited_fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_and_vectors_are_moved_once(spark, rows, no_docs, monkeypatch):
    """Disk: a text, its beginning and its vector go through one shuffle each; only ids are written between stages."""
    written = []
    plain = H.materialize
    monkeypatch.setattr(H, "materialize", lambda spark, df, name: written.append(df.schema) or plain(spark, df, name))
    set_back = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(set_back, ("false", "-1")):
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, no_docs.schema)
        plan = H.edited_fingerprints(docs)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        for k, v in set_back.items():
            spark.conf.set(k, v)
    assert {f.dataType.simpleString() for schema in written for f in schema.fields} <= {"bigint", "int"}
    moved = [re.findall(r"(\w+)#", m[1]) for m in re.finditer(r"^\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\n]*)\]\n", plan, re.M)]
    wide = sorted(set(columns) & {"text", "ending", "next", "vector", "own", "other"} for columns in moved)
    assert sorted(next(iter(w)) for w in wide if w) == ["ending", "next", "text"], moved


def test_many_equal_rows(spark, no_docs):
    """Equal rows are followed by their like, the last of them by the next text."""
    rows = [(5, "one two three four five six\nseven eight nine ten", "en", "s", 0)] * 500 + [(4, "eleven twelve thirteen", "en", "s", 0), (None, "null id", "en", "s", 0), (None, "null id", "en", "s", 0)]
    got = H.edited_fingerprints(spark.createDataFrame(rows, no_docs.schema)).collect()
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, _edited(rows)))
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] == 5) == 499
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] is None) == 1
