"""Mixing sources to target weights by Sainte-Lague apportionment of word blocks.

Every source is cut into blocks of about ``block_words`` words. Blocks of the
mix are allocated to sources by highest quotients (entitlement / (2k + 1)),
then in the same way to the shards of each source, so every shard has an
integer quota. In a shard the whole rounds of the quota take every block and
the rest is taken from the blocks in a seeded order.

Scale: a shard holds about ``shard_words`` words of one source, chosen by a
seeded hash of the row and, among rows equal in id and text, their number, so
neither a source with a third of the corpus nor any number of equal rows falls
into one shard; rows without words stay where they are. Quotas go down a tree of at most ``FAN`` children
a node, so no task holds all shards of a source either. Only the table of
sources (one row per source: name, words, blocks) reaches the driver.

Defined results: a null source is a source of its own, ordered last. A null or
empty text has size 0 and nothing is taken from it. Equal rows are numbered
from 0 by source and size, so what they give together is the same in every run for the
same rows, in whatever files they lie. A source
whose target is below half a block may get nothing. An empty table gives no
rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fresh, materialize
from terrace.llm.words import NOT_SPACE, cut, mix

WEIGHTS = (5.0, 2.0, 1.0)  # by source in code point order, repeating
MOST = 3  # a source gives at most so many times its size
BLOCK_WORDS = 64
SHARD_WORDS = 32_768
SEED = 20260403
FAN = 512
RUN_BITS = 12  # equal rows are numbered in runs of at most 2^12 neighbours


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of all words by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    open_, rest = list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        rest -= sum(out[i] for i in over)
        full = set(over)
        open_ = [i for i in open_ if i not in full]
    return out


def apportion(entitled: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Lague: seats go one by one to the highest entitled / (2k + 1), none beyond its cap; ties to the first.

    The seats are found from a common divisor, and only those at its edge are
    handed out singly.
    """
    entitled, caps = np.asarray(entitled, float), np.where(np.asarray(entitled) > 0, caps, 0).astype(np.int64)
    if seats >= caps.sum():
        return caps
    if seats <= 0:
        return np.zeros_like(caps)

    def at(divisor: float) -> np.ndarray:
        return np.minimum(caps, np.floor(entitled / divisor + 0.5)).astype(np.int64)

    low, high = 0.0, 2 * entitled.max() + 1  # more and fewer seats than wanted
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    quota = at(high)
    queue = [(-entitled[i] / (2 * quota[i] + 1), i) for i in range(len(quota)) if quota[i] < caps[i]]
    heapq.heapify(queue)
    for _ in range(seats - int(quota.sum())):
        _, i = heapq.heappop(queue)
        quota[i] += 1
        if quota[i] < caps[i]:
            heapq.heappush(queue, (-entitled[i] / (2 * quota[i] + 1), i))
    return quota


_QUOTAS = "src int, node long, quota long"


def _down(shards: DataFrame, quotas: DataFrame, levels: int) -> DataFrame:
    """Quotas of sources (src, node 0, quota) to quotas of shards, level by level."""

    def share(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        quota = apportion(group["words"].to_numpy(), MOST * group["blocks"].to_numpy(), group["quota"][0].as_py())
        return pa.table({"src": group["src"], "node": group["node"], "quota": pa.array(quota, pa.int64())})

    for level in range(1, levels + 1):
        node = F.floor(F.col("shard") / F.lit(FAN ** (levels - level))).cast("long")
        children = shards.groupBy("src", node.alias("node")).agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks"))
        children = children.withColumn("parent", F.floor(F.col("node") / F.lit(FAN)).cast("long"))
        parents = quotas.select("src", F.col("node").alias("parent"), "quota")
        quotas = children.join(parents, ["src", "parent"]).groupBy("src", "parent").applyInArrow(share, _QUOTAS)
    return quotas.withColumnRenamed("node", "shard")


def _selection(blocks: int, quota: int, words: int, src: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each block and the end, times each block is taken)."""
    bounds = np.arange(blocks + 1, dtype=np.int64) * words // max(blocks, 1)
    if not blocks:
        return np.zeros(1, np.int64), np.zeros(0, np.int64)
    times = np.full(blocks, quota // blocks, np.int64)
    salt = mix(np.array([seed], np.uint64)) ^ mix(np.array([src + 1], np.uint64)) * np.uint64(3) ^ mix(np.array([shard + 1], np.uint64)) * np.uint64(5)
    order = np.argsort(mix(np.arange(1, blocks + 1, dtype=np.uint64) ^ salt), kind="stable")
    times[order[: quota % blocks]] += 1
    return bounds, times


def _run() -> Column:
    """The run of neighbouring rows that a row is in."""
    return F.shiftright(F.monotonically_increasing_id(), RUN_BITS)


def _numbered_runs(runs: DataFrame) -> DataFrame:
    """Groups of equal rows of one run (h, source, size, run, n) with the number of their first row among all rows of ``h``.

    However many rows are equal, a run has one line of them here.
    """
    before = Window.partitionBy("h").orderBy("source", "size", "run").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _salted(number: Column) -> Column:
    """The hash that places a row: ``h``, or for the further ones of equal rows a hash of it with their number."""
    return F.when(number > 0, F.xxhash64(F.col("h"), number)).otherwise(F.col("h"))


class Mix:
    """The plan of a mix over ``docs``: targets and quotas, ready to be applied to the rows."""

    def __init__(self, docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS):
        self.spark, self.text, self.seed = docs.sparkSession, text, seed
        row = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
        sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"), row.alias("h"))
        runs = sized.withColumn("run", _run()).groupBy("doc_id", "source", "size", "h", "run").agg(F.count(F.lit(1)).alias("n"))
        number = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
        each = _numbered_runs(runs).select("doc_id", "source", "size", "h", number.alias("number"))
        rows = materialize(self.spark, each.withColumn("h", _salted(F.col("number"))), "mix-sizes")
        self.rows = rows
        sized = sorted(((r[0], r[1]) for r in rows.groupBy("source").agg(F.sum("size")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
        self.names, sizes = [r[0] for r in sized], [int(r[1]) for r in sized]
        goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
        shards = [max(1, -(-s // shard_words)) for s in sizes]
        schema = T.StructType([T.StructField("source", rows.schema["source"].dataType), T.StructField("src", T.IntegerType()), T.StructField("shards", T.LongType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
        self.sources = self.spark.createDataFrame(list(zip(self.names, range(len(sizes)), shards, sizes, goal)), schema)
        placed = self.place(rows.select("source", "size", "h"), "source", F.col("h"))
        table = placed.groupBy("src", "shard").agg(F.sum("size").alias("words"))
        blocks = F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / F.lit(block_words)))).otherwise(0).cast("long")
        table = materialize(self.spark, table.withColumn("blocks", blocks), "mix-shards")
        counted = {r[0]: int(r[1]) for r in table.groupBy("src").agg(F.sum("blocks")).collect()}
        n_blocks = np.array([counted.get(i, 0) for i in range(len(sizes))], np.int64)
        # Blocks differ a little in size; an entitlement counts the source's own.
        entitled = np.array([g * n / s if s else 0.0 for g, n, s in zip(goal, n_blocks, sizes)])
        quota = apportion(entitled, MOST * n_blocks, round(float(entitled.sum())))
        top = self.spark.createDataFrame([(i, 0, int(q)) for i, q in enumerate(quota)], _QUOTAS)
        levels = 1
        while FAN**levels < max(shards, default=1):
            levels += 1
        quotas = _down(table, top, levels)
        self.quotas = materialize(self.spark, table.join(quotas, ["src", "shard"]).select("src", "shard", "words", "blocks", "quota"), "mix-quotas")

    def place(self, rows: DataFrame, source: str, h: Column) -> DataFrame:
        """``rows`` with src, shard, source_size and target."""
        sources = self.sources.withColumnRenamed("source", "__name")
        joined = rows.join(sources, F.col(source).eqNullSafe(F.col("__name")))
        return joined.withColumn("shard", F.pmod(h, F.col("shards"))).drop("__name", "shards")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target and taken of every row."""
        seed = self.seed

        def run(rows: pa.Table, quota: pa.Table) -> pa.Table:
            rows = rows.sort_by([("h", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
            return rows.select(["doc_id", "size", "source_size", "target"]).append_column("taken", pa.array(_taken(rows, quota, seed)[0], pa.int64()))

        placed = self.place(self.rows, "source", F.col("h")).select("doc_id", "size", "source_size", "target", "h", "src", "shard")
        schema = T.StructType([self.rows.schema["doc_id"], *[T.StructField(n, t) for n, t in (("size", T.LongType()), ("source_size", T.LongType()), ("target", T.DoubleType()), ("taken", T.LongType()))]])
        # Rows without words, of which a shard may have any number, need no quota.
        empty = placed.where(F.col("size") == 0).select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
        return placed.where(F.col("size") > 0).groupBy("src", "shard").cogroup(self.quotas.groupBy("src", "shard")).applyInArrow(run, schema).unionAll(empty)


def _taken(rows: pa.Table, quota: pa.Table, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words taken of each row of a shard; with the rows' first words and the shard's blocks."""
    size = rows["size"].to_numpy()
    begin = np.cumsum(size) - size
    if not len(rows):
        return size, begin, np.zeros(1, np.int64), np.zeros(0, np.int64)
    one = {c: quota[c][0].as_py() for c in quota.column_names}
    bounds, times = _selection(one["blocks"], one["quota"], one["words"], one["src"], one["shard"], seed)
    if not len(times):
        return np.zeros_like(size), begin, bounds, times
    sums = np.r_[0, np.cumsum(times * np.diff(bounds))]

    def until(word: np.ndarray) -> np.ndarray:
        block = np.minimum(np.searchsorted(bounds, word, "right") - 1, len(times) - 1)
        return sums[block] + times[block] * (word - bounds[block])

    return until(begin + size) - until(begin), begin, bounds, times


def mixture(docs: DataFrame) -> DataFrame:
    """One row per document: its words, its source's words and target, and the words the mix takes."""
    return Mix(docs).taken()


def mixed_texts(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", n_chars: str = "n_chars", seed: int = SEED) -> DataFrame:
    """The mix itself, in the columns of ``docs``: one row for each time a document is taken.

    Whole rounds repeat the document; a round that takes some of its blocks
    gives a row with their words, in order. ``n_chars``, where present,
    follows the text.
    """
    plan = Mix(docs, text, source, doc_id, seed=seed)
    names = [fresh(docs, n) for n in ("size", "h")]
    rows = docs.withColumn(names[0], n_words(text)).withColumn(names[1], F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)))
    packed = rows.select(F.struct(*docs.columns).alias("row"), F.col(names[0]).alias("size"), F.col(names[1]).alias("h"), F.col(source).alias("source"))
    packed = packed.where(F.col("size") > 0)
    if not plan.rows.where((F.col("size") > 0) & (F.col("number") > 0)).isEmpty():
        packed = _numbered(packed)
    placed = plan.place(packed, "source", F.col("h")).select("row", "size", "h", "src", "shard")
    schema, place = docs.schema, docs.columns.index(text)
    counted = docs.columns.index(n_chars) if n_chars in docs.columns else -1

    def run(table: pa.Table, quota: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        _, begin, bounds, times = _taken(table, quota, seed)
        fields = table["row"].combine_chunks().flatten() if table.num_rows else [pa.array([], f.type) for f in table.schema.field("row").type]
        size, texts = table["size"].to_numpy(), fields[place]
        pick, out = [], []
        for i in range(table.num_rows):
            if not size[i] or not len(times):
                continue
            first = min(int(np.searchsorted(bounds, begin[i], "right")) - 1, len(times) - 1)
            last = min(int(np.searchsorted(bounds, begin[i] + size[i] - 1, "right")) - 1, len(times) - 1)
            own, whole = times[first : last + 1], texts[i].as_py()
            for round_ in range(1, int(own.max(initial=0)) + 1):
                pick.append(i)
                if own.min() >= round_:
                    out.append(whole)
                else:
                    ranges = [(max(0, bounds[first + b] - begin[i]), min(size[i], bounds[first + b + 1] - begin[i])) for b in np.flatnonzero(own >= round_)]
                    out.append(_words_of(whole, ranges))
        columns = [f.take(pa.array(pick, pa.int64())) for f in fields]
        columns[place] = pa.array(out, columns[place].type)
        if counted >= 0:
            columns[counted] = pa.array([len(t) for t in out], pa.int64()).cast(columns[counted].type)
        return pa.Table.from_arrays(columns, names=schema.fieldNames())

    return placed.groupBy("src", "shard").cogroup(plan.quotas.groupBy("src", "shard")).applyInArrow(run, schema)


def _numbered(packed: DataFrame) -> DataFrame:
    """Whole rows with the hashes that place them, where some are equal: numbered as in the plan.

    Rows are numbered inside a run, whose place among the others comes from the
    counts of runs. The rows are written first, so that both see the same runs.
    """
    packed = materialize(packed.sparkSession, packed.withColumn("at", F.monotonically_increasing_id()), "mix-rows")
    packed = packed.withColumn("run", F.shiftright("at", RUN_BITS))
    same = ["h", "source", "size", "run"]
    firsts = _numbered_runs(packed.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))).drop("n")
    firsts = firsts.select(*[F.col(c).alias(f"_{c}") for c in same], "first")
    inside = packed.withColumn("inside", F.row_number().over(Window.partitionBy(*same).orderBy("at")) - 1)
    matched = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "source" else F.col(c) == F.col(f"_{c}") for c in same]
    joined = inside.join(firsts, matched)
    return joined.select("row", "size", _salted(F.col("first") + F.col("inside")).alias("h"), "source")


def _words_of(text: str, ranges: list[tuple[int, int]]) -> str:
    """The words of ``text`` at the given places with what stands between neighbours; pieces are joined by a space."""
    raw = text.encode()
    words = cut(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), NOT_SPACE)
    merged: list[list[int]] = []
    for begin, end in ranges:
        if end <= begin:
            continue
        if merged and merged[-1][1] == begin:
            merged[-1][1] = int(end)
        else:
            merged.append([int(begin), int(end)])
    return b" ".join(raw[int(words.start[b]) : int(words.end[e - 1])] for b, e in merged).decode()
