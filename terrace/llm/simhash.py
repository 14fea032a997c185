"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit where more than half of the text's shingle hashes have
it. Two fingerprints that differ in at most ``distance`` bits agree on
``BLOCKS - distance`` of ``BLOCKS`` blocks, so each fingerprint is filed under
every such choice of blocks, filed pairs are joined, and their Hamming
distance is verified inside the join. Linked fingerprints form components.

Scale: documents with equal fingerprints are one row before any join, so a
group of copies costs one row whatever its size. With two blocks of sixteen
bits shared (distance 2) a join key has 32 bits. A key that holds more than
``crowd`` different fingerprints would need too many comparisons; those
fingerprints are instead filed under all their variants with
``distance / 2`` bits flipped, where every pair within the distance meets at
a variant between the two, so the same links hold and nothing is compared
pairwise. Components are found by label propagation over stars with the edges
written to the shared folder each round; only counts reach the driver.

Defined results: a null or empty text and one without words has fingerprint
zero and is linked like any other. Repeated rows and equal texts share a
component. A component's id is its smallest non-null doc_id (null if it has
none). An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import fresh, materialize, text_chunks
from terrace.llm.words import NOT_SPACE, cut

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 128  # beyond it, pairs would outnumber the 65 variants of each fingerprint


def _text_fingerprints(array: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint of each text, as int64."""
    out = np.zeros(len(array), np.uint64)
    digest = xxhash.xxh64_intdigest
    for at, data, offsets in text_chunks(array):
        words = cut(data, offsets, NOT_SPACE)
        # The words joined by single spaces, so that every shingle is one slice.
        size = words.end - words.start
        start = np.zeros(len(size), np.int64)
        np.cumsum(size[:-1] + 1, out=start[1:])
        joined = np.full(int(start[-1] + size[-1]) if len(size) else 0, 0x20, np.uint8)
        inside = np.zeros(len(words.low) + 1, np.int8)
        inside[words.start] = 1
        inside[words.end] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        joined[np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))] = words.low[inside]
        body, end = joined.tobytes(), start + size
        for row in range(len(offsets) - 1):
            first, last = int(words.first[row]), int(words.first[row + 1])
            if first == last:
                continue
            span = min(shingle, last - first)
            begins, ends = start[first : last - span + 1].tolist(), end[first + span - 1 : last].tolist()
            hashes = np.array([digest(body[b:e], SEED) for b, e in zip(begins, ends)], "<u8")
            ones = np.zeros(64, np.int64)
            for part in range(0, len(hashes), 1 << 16):
                bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            out[at + row] = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` and the 64-bit fingerprint of each document (``fp``, a long)."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    schema = kept.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            fp = _text_fingerprints(batch.column(batch.num_columns - 1), shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)], names=schema.fieldNames())

    return kept.mapInArrow(run, schema)


def _masks(distance: int) -> list[int]:
    """Bit masks of every choice of blocks on which close fingerprints may agree."""
    blocks = 2 * distance
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(block, blocks - distance)]


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def _flips(distance: int) -> list[int]:
    """Masks of up to half of ``distance`` bits."""
    return [sum(1 << b for b in bits) for k in range(distance // 2 + 1) for bits in combinations(range(64), k)]


def links(distinct: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fp`` within ``distance`` bits.

    ``distinct`` has each fingerprint once; ``distance`` is even. Block keys
    of at most ``crowd`` fingerprints give the verified pairs; the fingerprints
    of larger keys are tied to their variants, of which some are fingerprints
    that no text has.
    """
    if distance % 2 or distance < 0:
        raise ValueError("distance must be even, so that close fingerprints meet at a variant half-way")
    if distance == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    choices = [F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(_long(m)).alias("key")) for i, m in enumerate(_masks(distance))]
    filed = distinct.select("fp", F.explode(F.array(*choices)).alias("at")).select("fp", "at.*")
    keys = filed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    placed = filed.join(materialize(distinct.sparkSession, keys, "simhash-keys"), ["choice", "key"])
    placed = materialize(distinct.sparkSession, placed, "simhash-blocks")
    small = placed.where(F.col("n") <= crowd)
    left = small.select("choice", "key", F.col("fp").alias("a"))
    right = small.select("choice", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["choice", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    flips = F.array(*[_long(m) for m in _flips(distance)])
    tied = placed.where(F.col("n") > crowd).select(F.col("fp").alias("a")).distinct()
    tied = tied.select("a", F.explode(flips).alias("flip")).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("b")).where("a != b")
    return pairs.unionByName(tied)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternates large stars (each node's larger neighbours move to its smallest
    neighbour) and small stars (its smaller neighbours do) until nothing moves.
    """
    spark = edges.sparkSession
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    mark = None
    while True:
        stars = materialize(spark, stars, "stars")
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark or not state[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = state
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = materialize(spark, large.distinct(), "stars")
        least = _smallest(large)
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour. The sum keeps the join's exchange separate, so that a hot node's rows can be split."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select((F.col("a") + F.lit(0)).alias("a"), "m")


def component_of(fps: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """(fp, root, component_id) for each different fingerprint of ``fps`` (doc_id, fp)."""
    spark = fps.sparkSession
    distinct = materialize(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    root = components(links(distinct.select("fp"), distance, crowd)).withColumnRenamed("node", "fp")
    rooted = distinct.join(root, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(spark, rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id")).select((F.col("root") + F.lit(0)).alias("root"), "component_id")
    return materialize(spark, rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """One row per document: its fingerprint in hexadecimal and the smallest doc_id reachable by links."""
    fps = materialize(docs.sparkSession, fingerprints(docs, shingle=shingle), "simhash-fp")
    joined = fps.join(component_of(fps, distance, crowd), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """The documents (all columns) with one of each component: the smallest id; of equal ids, any one row."""
    spark = docs.sparkSession
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    names = [*docs.columns, fp]
    schema = docs.withColumn(fp, F.lit(0).cast("long")).schema
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            values = _text_fingerprints(batch.column(place), shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=names)

    marked = materialize(spark, docs.mapInArrow(run, schema).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    fps = marked.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    joined = fps.join(component_of(fps.drop("row"), distance, crowd), "fp")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = joined.groupBy("root").agg(F.min(order).getField("row").alias(row)).select(row)
    return marked.join(kept, row, "left_semi").select(*docs.columns)
