"""Session defaults and shared-storage helpers.

Everything a job writes outside its declared targets (staging folders, stream
checkpoints, scratch tables used by examples) lives under the folder the cluster
names in ``spark.checkpoint.dir``. That folder is on shared storage, so work
survives the loss of any executor. A local temporary folder is only created
when the setting is absent, which is the case in unit tests.
"""

from __future__ import annotations

import fnmatch
import os
import re
import tempfile
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MOVES_AT_ONCE = 16
JOIN_BYTES = 64 * 2**20  # of a file that one task copies into a joined one, at most

# Session settings the library relies on. Timestamps are naive UTC text in the
# contracts, so the session zone is pinned; Parquet timestamps are written as
# micros so other engines read them without loss.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lets a small stage (e.g. a history write to thousands of day folders)
    # keep several writer tasks instead of being coalesced into one; at large
    # sizes the per-task share is far above this floor, so it has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "terrace", conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.parquet.outputTimestampType",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize",
    ):
        spark.conf.set(key, DEFAULT_CONF[key])


def shared_root(spark: SparkSession) -> str:
    """Folder on shared storage for staging and stream checkpoints.

    Read from the session (``spark.checkpoint.dir``); set a local one only
    when the session has none, as in tests.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"Set spark.checkpoint.dir to a folder that all executors of {master} share.")
        configured = tempfile.mkdtemp(prefix="terrace-checkpoints-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root."""
    return f"{shared_root(spark)}/terrace/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------------
# Hadoop FileSystem access. These are metadata operations (list, rename,
# delete) that work for any scheme the cluster is configured for; no data
# passes through the driver.
# ---------------------------------------------------------------------------


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def delete_all(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete many paths, several at a time; those already gone are fine."""
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(lambda p: delete_path(spark, p), paths))


def delete_if_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder without any file below it; one that has a file, or gets one meanwhile, stays."""
    fs, hpath = _fs_and_path(spark, path)
    for child, is_dir in list_dir(spark, path):
        if is_dir:
            delete_if_empty(spark, child)
    if fs.exists(hpath) and not list_dir(spark, path):
        try:
            fs.delete(hpath, False)
        except Py4JJavaError:
            if not list_dir(spark, path):
                raise


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; False if it does."""
    fs, hpath = _fs_and_path(spark, path)
    fs.mkdirs(hpath.getParent())
    try:
        return bool(fs.createNewFile(hpath))
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise


def _mounted(fs) -> bool:
    """Paths are files of the operating system: a local disk, or one that all nodes mount."""
    return fs.getUri().getScheme() == "file"


def can_concat(spark: SparkSession, path: str) -> bool:
    """Files below ``path`` can be joined without passing through one process: by tasks where it is mounted,
    else by a file system that offers it, as HDFS does by linking their blocks."""
    fs, hpath = _fs_and_path(spark, path)
    return _mounted(fs) or bool(fs.hasPathCapability(hpath, "fs.capability.paths.concat"))


def concat(spark: SparkSession, target: str, parts: Iterable[str]) -> None:
    """Join files of the target's folder, in order, into ``target``, which is new; they may be gone afterwards. Empty ones are left out."""
    fs, hpath = _fs_and_path(spark, target)
    statuses = [fs.getFileStatus(_fs_and_path(spark, p)[1]) for p in parts]
    filled = [st for st in statuses if st.getLen() > 0]
    if not filled:
        fs.create(hpath).close()
    elif _mounted(fs):
        _copy_joined(spark, hpath.toUri().getPath(), [(st.getPath().toUri().getPath(), st.getLen()) for st in filled])
    else:
        # HDFS links no blocks into a file whose block size is below that of a part.
        fs.create(hpath, True, 4096, fs.getDefaultReplication(hpath), max(st.getBlockSize() for st in filled)).close()
        array = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(filled))
        for i, st in enumerate(filled):
            array[i] = st.getPath()
        fs.concat(hpath, array)
    expected, length = sum(st.getLen() for st in filled), fs.getFileStatus(hpath).getLen()
    if length != expected:
        raise OSError(f"{target} has {length} bytes after joining {expected}.")


def _copy_joined(spark: SparkSession, target: str, parts: list[tuple[str, int]]) -> None:
    """Copy (file, length) one behind the other into ``target``: each task writes a range of bytes at its own place.

    A task that runs twice writes the same bytes to the same place.
    """
    ranges, end = [], 0
    for source, length in parts:
        ranges += [(source, at, end + at, min(JOIN_BYTES, length - at)) for at in range(0, length, JOIN_BYTES)]
        end += length

    def copy(piece: tuple[str, int, int, int]) -> None:
        source, start, place, left = piece
        with open(source, "rb") as given, open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as joined:
            given.seek(start)
            joined.seek(place)
            while left:
                block = given.read(min(left, 2**20))
                if not block:
                    raise OSError(f"{source} ends {left} bytes too early.")
                joined.write(block)
                left -= len(block)

    spark.sparkContext.parallelize(ranges, len(ranges)).foreach(copy)


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since the file was last written, None if there is none."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    return time.time() - fs.getFileStatus(hpath).getModificationTime() / 1000


def relation_paths(df: DataFrame) -> set[str]:
    """Root paths of the file relations that a frame's plan reads; files aren't listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out: set[str] = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            continue
        roots = leaf.relation().location().rootPaths()
        out.update(str(roots.apply(k).toString()) for k in range(roots.size()))
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority of its file system, so that two spellings of a place are equal."""
    fs, hpath = _fs_and_path(spark, path)
    return str(fs.makeQualified(hpath).toString()).rstrip("/")


def matching_files(spark: SparkSession, path: str, glob: str | None = None) -> list[str]:
    """Visible files that ``path`` (a file, a folder or a pattern) names, in name order."""
    fs, hpath = _fs_and_path(spark, path)
    found = fs.globStatus(hpath)
    out = []
    for status in found or []:
        if status.isDirectory():
            out += [p for p, is_dir in list_dir(spark, str(status.getPath().toString())) if not is_dir]
        else:
            out.append(str(status.getPath().toString()))
    names = [p.rsplit("/", 1)[-1] for p in out]
    return sorted(p for p, n in zip(out, names) if not n.startswith(("_", ".")) and (glob is None or fnmatch.fnmatchcase(n, glob)))


def move_all(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Rename many paths (replacing what is there), several at a time."""

    def move(pair: tuple[str, str]) -> None:
        delete_path(spark, pair[1])
        rename_path(spark, *pair)

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(move, moves))


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs_and_path(spark, source)
    jvm = spark.sparkContext._jvm
    dst = jvm.org.apache.hadoop.fs.Path(target)
    parent = dst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(src, dst):
        raise OSError(f"Could not move {source} to {target}")


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(full path, is_directory) of the direct children of ``path``."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [(str(status.getPath().toString()), bool(status.isDirectory())) for status in fs.listStatus(hpath)]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of all files below ``path`` (recursive), in name order."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    found = []
    iterator = fs.listFiles(hpath, True)
    while iterator.hasNext():
        found.append(str(iterator.next().getPath().toString()))
    return sorted(found)


def data_files(spark: SparkSession, path: str, extension: str) -> list[str]:
    """Visible data files (no ``_``/``.`` prefix) with the given extension."""
    root = path.rstrip("/").rsplit("/", 1)[-1]
    result = []
    for full in list_files(spark, path):
        relative = full.split(f"/{root}/", 1)[-1]
        if any(part.startswith(("_", ".")) for part in relative.split("/")):
            continue
        if full.endswith(f".{extension}"):
            result.append(full)
    return result
