"""Secret scans with corpus-wide ownership frequency.

Candidates are found in every text by their form (:data:`KINDS`). The hash of
each candidate's value is counted over the whole corpus by the repositories
(documents) and owners (sources) it appears in: a value that several owners
have is a widely copied example, one that a single owner has looks live. Every
base candidate stays and is told apart by that; a long random-looking token
outside them becomes a finding only if a single owner has it.

All of it is DataFrame functions. A match's place comes from the lengths of
what lies between the matches. Only candidates are shuffled, never texts; a
value that a third of all rows share is counted by partial sums, and its rows
are spread by the adaptive skew join.

Defined results: a null or empty text has no candidates. Rows with a null
source have one owner together, rows with a null id are repositories of their
own, as is each repeated row. Empty tables give no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import materialize

OWNERS_OF_EXAMPLE = 2  # from so many owners on, a value is an example


class Kind(NamedTuple):
    name: str
    pattern: str
    group: int  # that holds the value
    least: int  # code points of the value
    base: bool
    also: str | None = None  # what the value must hold besides


# In the order in which kinds at one place are listed. A run of one class of
# at least n characters is what is left of all its runs when shorter ones are
# dropped; an assignment that is too short still hides what it overlaps, so
# its length is looked at afterwards.
KINDS = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, True),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, True),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Kind("random", r"[A-Za-z0-9+/_-]{20,}", 0, 20, False, r"^(?=.*[0-9].*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
)


def _found(text: Column, kind: Kind) -> Column:
    """array<struct<gap, size, value, width>>: code points before a match and in it, the value's hash and width."""
    between = F.transform(F.split(text, kind.pattern, -1), lambda p: F.char_length(p).cast("long"))
    whole = F.transform(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda m: F.char_length(m).cast("long"))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))

    def told(value: Column) -> Column:
        fits = F.char_length(value) >= kind.least
        if kind.also:
            fits = fits & value.rlike(kind.also)
        return F.struct(F.left(F.sha2(value, 256), F.lit(32)).alias("value"), fits.alias("fits"))

    zipped = F.arrays_zip(between.alias("gap"), whole.alias("size"), F.transform(values, told).alias("told"))
    # What follows the last match has no match of its own.
    return F.when(text.rlike(kind.pattern), F.filter(zipped, lambda m: m["size"].isNotNull()))


def candidates(docs: DataFrame, text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(rows, candidates): ``row`` numbers of the documents, and all candidates with their places.

    A candidate has row, owner, rank (of its kind), begin, end, value (a hash)
    and base; those of other kinds that overlap a base candidate are left out.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    kinds = F.array(*[F.struct(F.lit(rank).alias("rank"), _found(whole, kind).alias("found")) for rank, kind in enumerate(KINDS)])
    rows = docs.select("doc_id", F.col(source).alias("owner"), F.filter(kinds, lambda k: k["found"].isNotNull()).alias("kinds"))
    rows = materialize(spark, rows.withColumn("row", F.monotonically_increasing_id()), "secret-rows")
    each = rows.select("row", "owner", F.explode("kinds").alias("k")).select("row", "owner", "k.rank", F.posexplode("k.found").alias("place", "m"))
    each = each.select("row", "owner", "rank", "place", "m.gap", "m.size", "m.told.value", "m.told.fits")
    so_far = Window.partitionBy("row", "rank").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    placed = each.repartition("row").withColumn("end", end).withColumn("begin", F.col("end") - F.col("size")).where("fits")
    base = F.col("rank").isin([rank for rank, kind in enumerate(KINDS) if kind.base])
    placed = placed.select("row", "owner", "rank", "begin", "end", "value", base.alias("base"))
    order = Window.partitionBy("row").orderBy("begin", "rank")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("begin"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = placed.withColumn("clear", ~((F.coalesce(before, F.lit(-1)) > F.col("begin")) | (F.coalesce(after, F.col("end")) < F.col("end"))))
    return rows, materialize(spark, placed.where("base OR clear").drop("clear"), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """value, n_owners and n_repositories of each candidate value, over the whole corpus."""
    once = found.select("value", "owner", "row").distinct()
    owners = once.groupBy("value", "owner").agg(F.count("*").alias("rows"))
    return owners.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("rows").alias("n_repositories"))


def findings(docs: DataFrame, text: str = "text", source: str = "source", owners_of_example: int = OWNERS_OF_EXAMPLE) -> tuple[DataFrame, DataFrame]:
    """(rows, findings): candidates with how many own them and whether they look live."""
    rows, found = candidates(docs, text, source)
    counted = materialize(docs.sparkSession, ownership(found), "secret-owners")
    told = found.join(counted, "value").withColumn("live", F.col("n_owners") < owners_of_example)
    return rows, told.where("base OR live")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base candidates by kind, their places, and all findings with those that look live."""
    rows, found = findings(docs)
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    label = F.concat_ws(":", F.element_at(names, F.col("rank") + 1), F.col("begin"), F.col("end"))
    spans = found.groupBy("row").agg(
        *[F.count_if(F.col("rank") == rank).alias(f"n_{kind.name}") for rank, kind in enumerate(KINDS)],
        F.count_if("live").alias("n_live"),
        F.array_sort(F.collect_list(F.struct("begin", "rank", label.alias("label"), "base"))).alias("spans"),
    )
    joined = rows.select("row", "doc_id").join(spans, "row", "left")
    every = F.coalesce(F.col("spans"), F.array().cast("array<struct<begin:bigint,rank:int,label:string,base:boolean>>"))
    based = F.array_join(F.transform(F.filter(every, lambda s: s["base"]), lambda s: s["label"]), ",")
    counts = [F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in ("assign", "access", "hex", "random", "live")]
    return joined.select("doc_id", *counts[:3], F.sha2(based, 256).alias("base_sha256"), F.array_join(F.transform(every, lambda s: s["label"]), ",").alias("spans"), *counts[3:])
