import os

import pytest

from terrace import session as S
from terrace.plans import chain
from terrace.sinks import versions


def _audit(spark, run_id, rows, pipeline="p"):
    return spark.createDataFrame([(pipeline, run_id, n) for n in rows], "pipeline string, run_id string, n bigint")


SCHEMA_RUNS = ["a:b c/d%", "7", "007", *[f"run-{i}" for i in range(9)]]


def _rows(spark, path, schema):
    return sorted(map(tuple, chain.read_audit(spark, path, schema).collect()))


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_run_folders_are_merged_and_files_bounded(spark, workdir):
    path, want, most = f"{workdir}/audit", [], 0
    for i, run_id in enumerate(SCHEMA_RUNS):
        df = _audit(spark, run_id, [i, i + 1])
        chain.append_audit(df.coalesce(1), path, compact_after=4)
        want += [("p", run_id, i), ("p", run_id, i + 1)]
        assert _rows(spark, path, df.schema) == sorted(want)
        most = max(most, len(chain._run_folders(spark, path)))
    assert most < 4 and versions.latest(spark, path) == 3
    # Two versions with a file or two each, the last manifests, and the folders since.
    assert len(_files(path)) <= 12
    assert not os.path.exists(f"{path}/_versions/merging")


def test_a_replay_after_the_merge_replaces_its_rows(spark, workdir):
    path = f"{workdir}/audit"
    for run_id, pipeline in (("a", "p"), ("a", "q"), ("b", "p")):
        df = _audit(spark, run_id, [1, 2], pipeline)
        chain.append_audit(df, path)
    assert chain.compact_audit(spark, path, df.schema)
    assert chain._run_folders(spark, path) == []
    chain.append_audit(_audit(spark, "a", [9]), path)
    want = [("p", "a", 9), ("p", "b", 1), ("p", "b", 2), ("q", "a", 1), ("q", "a", 2)]
    assert _rows(spark, path, df.schema) == want
    assert chain.compact_audit(spark, path, df.schema)
    assert _rows(spark, path, df.schema) == want


def test_a_merge_that_dies_loses_and_doubles_nothing(spark, workdir, monkeypatch):
    path, df = f"{workdir}/audit", _audit(spark, "a", [1, 2])
    chain.append_audit(df, path)
    with monkeypatch.context() as m:
        m.setattr(S, "delete_all", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            chain.compact_audit(spark, path, df.schema)  # visible, but the run folder is still there
    assert _rows(spark, path, df.schema) == [("p", "a", 1), ("p", "a", 2)]
    assert chain.compact_audit(spark, path, df.schema)
    assert _rows(spark, path, df.schema) == [("p", "a", 1), ("p", "a", 2)]


def test_a_run_replayed_during_the_merge_keeps_its_new_rows(spark, workdir, monkeypatch):
    path, df = f"{workdir}/audit", _audit(spark, "a", [1, 2])
    chain.append_audit(df, path)
    real = S.delete_all

    def replayed_first(session, files):
        chain.append_audit(_audit(spark, "a", [5]), path)
        real(session, files)

    monkeypatch.setattr(S, "delete_all", replayed_first)
    assert chain.compact_audit(spark, path, df.schema)
    assert _rows(spark, path, df.schema) == [("p", "a", 5)]


def test_one_merge_at_a_time(spark, workdir):
    path, df = f"{workdir}/audit", _audit(spark, "a", [1])
    chain.append_audit(df, path)
    lock = f"{path}/_versions/merging"
    assert S.create_new(spark, lock)
    assert not chain.compact_audit(spark, path, df.schema)
    os.utime(lock, (0, 0))  # its owner died long ago
    assert not chain.compact_audit(spark, path, df.schema)
    assert chain.compact_audit(spark, path, df.schema)
    assert _rows(spark, path, df.schema) == [("p", "a", 1)]
