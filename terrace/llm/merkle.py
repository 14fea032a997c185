"""Merkle manifest of a dataset: a hash tree over the rows of every group, and one over the groups.

Rows are leaves in the order of their keys. On every level each run of
``arity`` consecutive nodes becomes one parent, the digest of its children
(the last run may be shorter, even a single node), until one node remains.
Groups' last nodes are the leaves of a second tree in the order of the groups,
whose last node is the root of the dataset. A row's proof lists, level by
level, the siblings before and after its node, so that anyone with the row and
the root can tell whether the row is unchanged (:func:`fold`).

The tree is built with lag and lead windows. A node sits on the row of its
first leaf, so on level ``j`` nodes are ``arity**j`` rows apart: siblings are
lag and lead columns of fixed offsets, masked by the node's slot in its run and
by the run's length, and the rows of first children hash the parents. Proofs
come down the same way: a node's path is its siblings, then the path of its
parent, which lies on the row of the run's first child.

Scale: a window never spans a group. ``arity**levels`` rows (``BLOCK_ROWS`` at
most) are a block, whose levels are built in one pass; the blocks' last nodes
are the rows of the next tier, a ``BLOCK_ROWS``-th as many. Places in a group
come from a range partitioning of slim rows (digests, not texts), ties dealt
out by row, so a group that holds a third of all rows, or one repeated row,
is spread over all tasks. Only the size of the largest group is collected, to know the
number of tiers.

Defined results: a null field is ``-``, which no value's encoding is. Null keys
come first, as does the null group; equal keys are ordered by leaf digest, so
repeated rows are leaves of their own with proofs of their own. A single row is
its group's last node, with no siblings on its levels there. Empty tables give
no rows. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import materialize

ARITY = 2
BLOCK_ROWS = 64
TAMPERED = 7  # of the query: rows whose id's crc32 this divides
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK = ["grp", "block"]


def digest(*inputs: Column) -> Column:
    """Lowercase hex sha256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row's fields, which tells different rows apart."""
    return digest(*[field(v) for v in values])


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, run: digest(run["before"], node, run["after"]))


def siblings(proof: Column) -> Column:
    """Digest of a proof's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda run: F.concat(run["before"], run["after"])), ""))


def _levels(arity: int) -> int:
    levels = 1
    while arity ** (levels + 1) <= BLOCK_ROWS:
        levels += 1
    return levels


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``grp``) and their ``place`` in their group, from 0, and the group's ``size``.

    Rows are dealt out by ranges and numbered in place; only the counts of
    groups in ranges meet. ``order`` must end in a column that tells rows apart.
    """
    by = [F.col("grp").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    placed = materialize(rows.sparkSession, placed, "merkle-order")
    counts = placed.groupBy("grp", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("grp")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    return placed.join(counts, ["grp", "part"]).withColumn("place", F.col("row") + F.col("shift")).drop("part", "row", "shift")


class _Level:
    """Masks of the rows that carry nodes of level ``j`` of a block."""

    def __init__(self, j: int, arity: int):
        self.step = arity**j
        self.owner = F.col("place") % self.step == 0
        self.slot = F.floor(F.col("place") / self.step) % arity
        self.runs_on = F.col("size") > self.step  # more than one node remains

    def lag(self, name: str, by: int) -> Column:
        at = Window.partitionBy(*_BLOCK).orderBy("place")
        return F.when(self.owner & (self.slot >= by), F.lag(name, by * self.step).over(at))

    def lead(self, name: str, by: int, arity: int) -> Column:
        at = Window.partitionBy(*_BLOCK).orderBy("place")
        inside = (self.slot + by < arity) & (F.col("place") + by * self.step < F.col("size"))
        return F.when(self.owner & inside, F.lead(name, by * self.step).over(at))


def _climbed(nodes: DataFrame, arity: int) -> DataFrame:
    """The levels of each block: ``before_j`` and ``after_j`` on the rows of level ``j``, and ``top`` on a block's first row."""
    levels = _levels(arity)
    out = nodes.withColumn("block", F.floor(F.col("place") / arity**levels)).withColumn("top", F.col("node"))
    for j in range(levels):
        level = _Level(j, arity)
        before = F.concat_ws("", *[level.lag("top", i) for i in range(arity - 1, 0, -1)])
        after = F.concat_ws("", *[level.lead("top", i, arity) for i in range(1, arity)])
        parent = F.when(level.runs_on, digest(F.col("top"), after)).otherwise(F.col("top"))
        first = level.owner & (level.slot == 0)
        out = out.withColumns({f"before_{j}": before, f"after_{j}": after, "top": F.when(first, parent)})
    return out


def tiers(nodes: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """The nodes at the bottom of each tier of blocks; the last has each group's last node.

    ``nodes`` has grp, place, size and node.
    """
    spark, span = nodes.sparkSession, arity ** _levels(arity)
    largest = nodes.agg(F.max("size")).first()[0] or 0
    out = [nodes]
    while largest > 1:
        tops = _climbed(out[-1].select("grp", "place", "size", "node"), arity).where(F.col("place") % span == 0)
        size = F.ceil(F.col("size") / span)
        out.append(materialize(spark, tops.select("grp", F.col("block").alias("place"), size.alias("size"), F.col("top").alias("node")), "merkle-tier"))
        largest = -(-largest // span)
    return out


def _proved(below: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """``below`` with the columns of its blocks' rows in ``above`` and the proof carried down."""
    levels = _levels(arity)
    carried = [c for c in above.columns if c not in ("grp", "place", "size", "node", "proof")]
    parents = above.select("grp", F.col("place").alias("block"), F.col("proof").alias("path"), *carried)
    out = _climbed(below, arity).join(parents, _BLOCK)
    out = out.withColumn("proof", F.when(F.col("place") % arity**levels == 0, F.col("path")))
    for j in reversed(range(levels)):
        level = _Level(j, arity)
        path = F.when(level.owner & (level.slot == 0), F.col("proof"))
        for slot in range(1, arity):
            path = F.when(level.owner & (level.slot == slot), level.lag("proof", slot)).otherwise(path)
        run = F.struct(F.col(f"before_{j}").alias("before"), F.col(f"after_{j}").alias("after"))
        longer = F.when(level.runs_on, F.concat(F.array(run), path)).otherwise(path)
        out = out.withColumn("proof", F.when(level.owner, longer))
    return out.select(*below.columns, *carried, "proof")


def prove(built: list[DataFrame], last: DataFrame, arity: int = ARITY) -> DataFrame:
    """The nodes of the first tier, with the columns of their groups in ``last`` and ``proof``.

    ``last`` has grp, the proof of each group's last node, and any columns to carry.
    """
    out = built[-1].join(last, "grp")
    for k in reversed(range(len(built) - 1)):
        out = _proved(built[k], out, arity)
        if k:  # a tier above the first is small, and written out it keeps the plan below small
            out = materialize(out.sparkSession, out, "merkle-proofs")
    return out


def manifest(leaves: DataFrame, group: str, order: Sequence[str], node: str, arity: int = ARITY) -> DataFrame:
    """``leaves`` and their ``subroot``, ``root`` and ``proof``.

    ``group`` names the column whose values have trees of their own, ``order``
    the columns that leaves ascend by, and ``node`` the leaves' digests (hex).
    ``proof`` is an array of the runs from leaf to root, with the digests
    before and after the path's own node, each concatenated.
    """
    spark, keep = leaves.sparkSession, list(leaves.columns)
    # A null group comes first, and differs from an empty one.
    grp = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))
    kept = F.struct(*[F.col(c) for c in keep]).alias("kept")
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    rows = leaves.select(grp.alias("grp"), *keys, F.col(node).alias("node"), kept, F.monotonically_increasing_id().alias("tie"))
    rows = materialize(spark, rows, "merkle-leaves")
    names = [f"k{i}" for i in range(len(keys))]
    placed = numbered(rows, [*names, "node", "tie"]).drop(*names, "tie")
    built = tiers(placed, arity)
    subroots = built[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    above = tiers(numbered(subroots, ["name"]), arity)
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    last = above[-1].select("grp", F.col("node").alias("root"), nothing.alias("proof"))
    tops = prove(above, last, arity).select(F.col("name").alias("grp"), F.col("node").alias("subroot"), "root", "proof")
    out = prove(built, tops, arity)
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], "subroot", "root", "proof")


def documents_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, tree and proof of each document, and whether each still verifies after some were tampered with."""
    more = (F.col("n_chars").cast("decimal(20,0)") + F.lit(1)).cast("string")
    changed = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    values = [F.col(name) for name in FIELDS]
    tampered = [more if name == "n_chars" else F.col(name) for name in FIELDS]
    leaves = docs.select("doc_id", "lang", leaf(values).alias("leaf"), F.when(changed, leaf(tampered)).alias("tampered"))
    proved = manifest(leaves, "lang", ["doc_id"], "leaf")
    folded = proved.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", siblings(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
