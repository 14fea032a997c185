"""Tables published in versions: data is written once to its place, then becomes visible.

A publish writes its rows below ``<root>/_versions/data/version=<id>/`` (with
Hive-style partition folders; the one day of a numeric layout goes straight to
``<root>/2026/4/3/version=<id>``) and then a manifest, one row for each live
partition with the folder that holds it. The manifest with the highest number
that has Spark's ``_SUCCESS`` mark is the table: before that one small file
exists readers see the old state, after it the new one, and no data is moved.
A publish that dies leaves folders that no manifest lists; :func:`vacuum`
removes those and superseded ones.

Publishers of one table take turns: the next manifest's number is claimed by creating a file
that must not exist yet, so each manifest is built on the one before it and two
publishers never write the same. A claim whose publisher died is taken over
after ``CLAIM_SECONDS``. (Create-exclusive is a guarantee of HDFS and of local
file systems; on a store without it, one publisher at a time.)
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import session as S

FOLDER = "_versions"
SCHEMA = "partition string, location string"
CLAIM_SECONDS = 600
POLL_SECONDS = 0.5


def data_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/data/version={version}"


def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/manifests/{number:012d}"


def _manifests(spark: SparkSession, root: str) -> list[str]:
    """Manifest folders, the oldest first."""
    return sorted(p for p, is_dir in S.list_dir(spark, f"{root.rstrip('/')}/{FOLDER}/manifests") if is_dir)


def latest(spark: SparkSession, root: str) -> int:
    """Number of the newest complete manifest (0 without one); the marks of older ones aren't looked at."""
    for path in reversed(_manifests(spark, root)):
        if S.path_exists(spark, f"{path}/_SUCCESS"):
            return int(path.rsplit("/", 1)[-1])
    return 0


def manifest(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """partition (folder names below the version, empty if there are none) and location of each live partition.

    ``number`` asks for an older state, which is None if it has been vacuumed.
    """
    number = latest(spark, root) if number is None else number
    if not number or not S.path_exists(spark, f"{_manifest_path(root, number)}/_SUCCESS"):
        return None
    return spark.read.schema(SCHEMA).parquet(_manifest_path(root, number))


def current_locations(spark: SparkSession, root: str) -> list[str]:
    """Folders of the published state: one for each partition, as any file index lists them."""
    live = manifest(spark, root)
    return [] if live is None else sorted(r["location"] for r in live.collect())


def written(spark: SparkSession, root: str, version: str, partition_by: Iterable[str]) -> DataFrame:
    """partition and location of the folders that a version wrote."""
    place = S.qualified(spark, data_path(root, version))
    depth = len(list(partition_by))
    if not depth:
        return spark.createDataFrame([("", place)], SCHEMA)
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    rows = spark.read.option("basePath", place).parquet(place).select(folder.alias("location")).distinct()
    return rows.select(F.substring_index("location", "/", -depth).alias("partition"), "location")


def numeric(written_: DataFrame) -> DataFrame:
    """The same folders under their numeric names: ``year=2026/month=4/day=3`` is ``2026/4/3``."""
    return written_.select(F.regexp_replace("partition", r"(^|/)[^/=]+=", "$1").alias("partition"), "location")


def _claim(spark: SparkSession, root: str) -> tuple[int, str]:
    """The number of the next manifest, for this publisher alone, and the file that says so."""
    while True:
        number = latest(spark, root) + 1
        claim = f"{_manifest_path(root, number)}.claim"
        if S.create_new(spark, claim):
            if latest(spark, root) + 1 == number:
                return number, claim
            S.delete_path(spark, claim)  # published meanwhile
        else:
            age = S.age_seconds(spark, claim)
            if age is not None and age > CLAIM_SECONDS:
                S.delete_path(spark, claim)
            else:
                time.sleep(POLL_SECONDS)


def publish(
    spark: SparkSession,
    root: str,
    version: str,
    partition_by: Iterable[str] = (),
    *,
    replace_all: bool = False,
    new: DataFrame | None = None,
) -> int:
    """Make a written version visible: its partitions replace those of the same names (or all). Returns the manifest's number.

    ``new`` gives the partitions and locations if they aren't the version's own folders.
    """
    new = written(spark, root, version, partition_by) if new is None else new
    number, claim = _claim(spark, root)
    try:
        old = manifest(spark, root, number - 1)
        if old is not None and not replace_all:
            new = old.join(new, "partition", "left_anti").unionByName(new)
        new.select("partition", "location").write.mode("overwrite").parquet(_manifest_path(root, number))
    finally:
        S.delete_path(spark, claim)
    return number


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete versions that the published state doesn't use, and older manifests. Not while others read an older state."""
    root, now = root.rstrip("/"), latest(spark, root)
    used = {S.qualified(spark, p) for p in current_locations(spark, root)}
    versions = [p for p, is_dir in S.list_dir(spark, f"{root}/{FOLDER}/data") if is_dir]
    gone = [p for p in versions if not any(u.startswith(S.qualified(spark, p)) for u in used)]
    for path in _manifests(spark, root):  # folders of numeric days that an older state listed
        number = int(path.rsplit("/", 1)[-1])
        old = manifest(spark, root, number) if number < now else None
        if old is not None:
            inside = old.where(~F.col("location").contains(f"/{FOLDER}/data/")).collect()
            gone += [r["location"] for r in inside if S.qualified(spark, r["location"]) not in used]
    gone = sorted(set(gone)) + [p for p in _manifests(spark, root) if int(p.rsplit("/", 1)[-1]) < now]
    for path in gone:
        S.delete_path(spark, path)
    return gone
