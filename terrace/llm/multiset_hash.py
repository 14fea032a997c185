"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector, and a document's fingerprint is
the sum of its paragraphs' vectors modulo powers of two. The order of
paragraphs therefore doesn't matter, and adding or removing a paragraph adds
or subtracts its vector (:func:`insert`, :func:`delete`). The vector has

* a count, and 16 lanes of 32 bits from eight seeded hashes, which tell
  different multisets apart, and
* 128 lanes of 32 bits that hold sums of +1 and -1, whose inner products
  estimate how much two multisets share (:func:`likeness`).

So that likeness also sees changes inside a paragraph, a paragraph's vector is
the sum of those of the paragraph itself and of its phrases. A phrase has up to
``UNITS`` words and ends early at a word with one of the last characters
``ENDS``; as the words themselves decide, phrases after an inserted word are
soon the same again. A long word counts as several units of ``UNIT`` characters, so a
text without spaces has phrases too.

All of it is DataFrame functions: the pieces of a text are exploded and summed
per document inside whole-stage code, in the partitions the texts already have.

Defined results: a null text is the empty text, which has one empty paragraph.
Repeated rows each get a row; equal rows are neighbours in the order of ids.
Null ids come after all others. A single row is its own next document. Empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import materialize

STRONG = 8  # hashes of two 32-bit lanes each
SIGNS = 2  # hashes of 64 sign lanes each
UNIT = 6
UNITS = 8
ENDS = "adglory.,;:!?"
# Units are possessive, so a text is cut in one way only and in linear time.
_UNIT = r"[^\s]{1,%d}+" % UNIT
_BEFORE = rf"(?:{_UNIT}[^\S\n]*+){{0,{UNITS - 1}}}"
_PHRASE = rf"{_BEFORE}?{_UNIT}(?<=[{ENDS}])(?![^\s])|{_BEFORE}{_UNIT}"
_LOW = (1 << 32) - 1


def pieces(text: str) -> Column:
    """The paragraphs of a text and their phrases, in one array."""
    return F.concat(F.split(F.col(text), "\n", -1), F.regexp_extract_all(F.col(text), F.lit(_PHRASE), F.lit(0)))


def _sums(piece: str) -> tuple[list[Column], list[Column]]:
    """Hash columns of a piece, and the sums over pieces that make the vector."""
    hashed = [F.xxhash64(F.lit(i), F.col(piece)).alias(f"h{i}") for i in range(STRONG + SIGNS)]
    sums = [F.count("*").alias("n")]
    for i in range(STRONG):
        sums.append(F.sum(F.col(f"h{i}").bitwiseAND(F.lit(_LOW))).alias(f"l{i}"))
        sums.append(F.sum(F.shiftrightunsigned(f"h{i}", 32)).alias(f"u{i}"))
    for i in range(SIGNS):
        for bit in range(32):  # two counters of ones in one sum, 32 bits apart
            ones = F.shiftright(f"h{STRONG + i}", bit).bitwiseAND(F.lit((1 << 32) + 1))
            sums.append(F.sum(ones).alias(f"s{i}_{bit}"))
    return hashed, sums


def _signed(value: Column) -> Column:
    """``value`` modulo 2^32, as a signed 32-bit number."""
    return (F.pmod(value + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)).cast("int")


def _vector() -> Column:
    """struct(strong, signs) from the sums."""
    strong = [F.col("n").bitwiseAND(F.lit(_LOW))]
    for i in range(STRONG):
        strong += [F.col(f"l{i}").bitwiseAND(F.lit(_LOW)), F.col(f"u{i}").bitwiseAND(F.lit(_LOW))]
    signs = []
    for i in range(SIGNS):
        for half in (0, 32):
            for bit in range(32):
                ones = F.shiftrightunsigned(f"s{i}_{bit}", half).bitwiseAND(F.lit(_LOW))
                signs.append(_signed(ones * F.lit(2) - F.col("n")))
    return F.struct(F.array(*strong).alias("strong"), F.array(*signs).alias("signs"))


def summed(exploded: DataFrame, by: list[str], piece: str = "piece") -> DataFrame:
    """``by`` and ``vector`` of each group of pieces (a row each)."""
    hashed, sums = _sums(piece)
    return exploded.select(*by, *hashed).groupBy(*by).agg(*sums).select(*by, _vector().alias("vector"))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``vector`` of each document; the keys tell the rows apart."""
    whole = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return summed(whole.select(*keys, F.explode(pieces("__text")).alias("piece")), keys)


def _combined(a: Column, b: Column, sign: int) -> Column:
    strong = F.zip_with(a["strong"], b["strong"], lambda x, y: (x + y * F.lit(sign)).bitwiseAND(F.lit(_LOW)))
    signs = F.zip_with(a["signs"], b["signs"], lambda x, y: _signed(x.cast("long") + y.cast("long") * F.lit(sign)))
    return F.struct(strong.alias("strong"), signs.alias("signs"))


def insert(vector: Column, paragraphs: Column) -> Column:
    """The vector of a document with the paragraphs of another vector added."""
    return _combined(vector, paragraphs, 1)


def delete(vector: Column, paragraphs: Column) -> Column:
    """The vector of a document without the paragraphs of another vector."""
    return _combined(vector, paragraphs, -1)


def hexadecimal(vector: Column) -> Column:
    """The whole vector as text: count, strong lanes and sign lanes with 8 digits each."""
    strong = F.transform(vector["strong"], lambda x: F.lpad(F.hex(x), 8, "0"))
    signs = F.transform(vector["signs"], lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(_LOW))), 8, "0"))
    return F.lower(F.concat(F.array_join(strong, ""), F.array_join(signs, "")))


def _inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, x: t + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two multisets as the sign lanes estimate it; 1 for equal fingerprints."""
    norm = F.sqrt(_inner(a["signs"], a["signs"]) * _inner(b["signs"], b["signs"]))
    cosine = F.when(norm > 0, _inner(a["signs"], b["signs"]) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def _next_rows(docs: DataFrame) -> DataFrame:
    """Every different row's key, its copies, and the key of the different row after it in descending doc_id order (after the last: the first).

    Ids are dealt out by ranges and numbered in place; only the first row of
    each range meets the others.
    """
    spark = docs.sparkSession
    ids = materialize(spark, docs.groupBy("doc_id", "id", "th", "n_chars").agg(F.count("*").alias("copies")), "fingerprint-ids")
    order = [F.col("doc_id").desc_nulls_last(), F.col("th")]
    placed = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    placed = materialize(spark, placed, "fingerprint-order")
    key = F.struct("id", "th")
    firsts = placed.groupBy("part").agg(F.min_by(key, "row").alias("first"))
    parts = Window.orderBy("part")  # one row for each range
    everything = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(everything)).alias("after"))
    following = F.lead(key).over(Window.partitionBy("part").orderBy("row"))
    linked = placed.withColumn("following", following).join(after, "part")
    target = F.coalesce("following", "after")
    return materialize(spark, linked.select("doc_id", "id", "th", "n_chars", "copies", target["id"].alias("next_id"), target["th"].alias("next_th")), "fingerprint-links")


def _marked(found: Column, mark: int) -> Column:
    return F.transform(found, lambda piece: F.struct(F.lit(mark).alias("e"), piece.alias("piece")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and that of its text with the last third replaced from the next document.

    A text is moved once, to the partition of its key, and from there its
    beginning and its vector, to the document before it. That document's own
    vectors are made where its text is and are not moved, so a text's vector is
    made twice. All but the last of equal rows are followed by their like, which
    is at hand.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    # A null id is told from id 0 by the hash.
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), whole).alias("th"), F.char_length(whole).cast("long").alias("n_chars"), whole.alias("text"))
    links = _next_rows(keyed)
    key = ["id", "th"]
    once = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
    texts = keyed.select(*key, "text").withColumn("copy", once).where("copy = 1").drop("copy")
    wanted = links.select(F.col("next_id").alias("id"), F.col("next_th").alias("th"), F.col("id").alias("to_id"), F.col("th").alias("to_th"), "doc_id", "n_chars", "copies")
    to = [F.col("to_id").alias("id"), F.col("to_th").alias("th")]
    third = F.floor(F.col("n_chars") / F.lit(3)).cast("int").alias("third")
    ends = texts.join(wanted, key).withColumn("third", third).select(*to, "n_chars", "third", "copies", F.expr("substring(text, 1, third)").alias("ending"))
    nexts = fingerprints(texts, key).join(wanted, key).select(*to, "doc_id", "n_chars", "copies", F.col("vector").alias("next"))
    begin = "substring(text, 1, int(n_chars - third))"
    edited = texts.join(ends, key).withColumn("edited", F.expr(f"concat({begin}, ending)"))
    edited = edited.withColumn("again", F.expr(f"if(copies > 1, concat({begin}, substring(text, 1, third)), null)"))
    by = [*key, "edited_sha256", "again_sha256"]
    edited = edited.withColumns({"edited_sha256": F.sha2("edited", 256), "again_sha256": F.sha2("again", 256)})
    marked = F.concat(_marked(pieces("text"), 0), _marked(pieces("edited"), 1))
    marked = F.when(F.col("copies") > 1, F.concat(marked, _marked(pieces("again"), 2))).otherwise(marked)
    exploded = edited.select(*by, F.explode(marked).alias("p")).select(*by, "p.e", "p.piece")
    vectors = summed(exploded, [*by, "e"]).groupBy(*by).agg(*(F.max(F.when(F.col("e") == e, F.col("vector"))).alias(name) for e, name in enumerate(("own", "other", "like"))))
    last = F.struct(F.lit(1).cast("long").alias("times"), F.col("edited_sha256").alias("sha"), F.col("other"), F.col("next"))
    before = F.struct((F.col("copies") - F.lit(1)).alias("times"), F.col("again_sha256").alias("sha"), F.col("like").alias("other"), F.col("own").alias("next"))
    cases = F.when(F.col("copies") > 1, F.array(last, before)).otherwise(F.array(last))
    rows = vectors.join(nexts, key).select("doc_id", "n_chars", "own", F.explode(cases).alias("r"))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.col("r.sha").alias("edited_sha256"),
        hexadecimal(F.col("own")).alias("fingerprint"),
        hexadecimal(F.col("r.other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("r.other")).alias("near_edited"),
        likeness(F.col("own"), F.col("r.next")).alias("near_next"),
        F.col("r.times").alias("times"),
    )
    return rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times", "col")
