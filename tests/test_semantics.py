"""Table-driven checks of the decided semantics."""

import os

import pytest
from pyspark.errors import AnalysisException

import hr_fixture
from terrace import sources
from terrace.plans import chain, hr
from terrace.plans.jobs import TableSpec, sql_transform
from terrace.run import RunContext


def test_sql_parameters_are_typed_and_unbound_names_fail(spark):
    run = RunContext.create("2026-04-03", run_id="r'1", processed_at_utc="2026-04-03 10:00:00")
    t = sql_transform("SELECT id, :run_id AS run_id, :year + 1 AS next_year FROM {source}")
    row = t(spark.range(1), run).first()
    # A quote in a value is data, not SQL.
    assert row.run_id == "r'1" and row.next_year == 2027
    with pytest.raises(AnalysisException):
        sql_transform("SELECT id, :not_a_run_value AS x FROM {source}")(spark.range(1), run).collect()


def test_prefix_means_every_matching_file(spark, workdir):
    data = hr_fixture.rows(10)
    hr_fixture.write(f"{workdir}/landing/a.csv", data[:6])
    hr_fixture.write(f"{workdir}/landing/b.csv", data[6:])
    hr_fixture.write(f"{workdir}/landing/notes.txt", data)
    path = sources.resolve_landing_source(f"{workdir}/landing/", "*.csv")
    df = sources.read_csv_strings(spark, path, with_file_name=True)
    assert df.count() == 10
    assert {r._source_file for r in df.select("_source_file").distinct().collect()} == {"a.csv", "b.csv"}


def test_rerun_is_idempotent(spark, workdir):
    landing = hr_fixture.write(f"{workdir}/landing/hr.csv", hr_fixture.rows(30))
    p = chain.MedallionPaths(landing, f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/bi/snap.csv")
    run = RunContext.create("2026-04-03", run_id="same", processed_at_utc="2026-04-03 10:00:00")
    chain.run_chain(spark, hr.plan(), p, run)
    first = sorted(map(tuple, sources.read_partitioned(spark, p.gold).collect()))
    snap = sorted(map(tuple, spark.read.csv(p.bi, header=True).collect()))
    chain.run_chain(spark, hr.plan(), p, run)
    assert sorted(map(tuple, sources.read_partitioned(spark, p.gold).collect())) == first
    assert sorted(map(tuple, spark.read.csv(p.bi, header=True).collect())) == snap


def test_spec_validation():
    with pytest.raises(ValueError):
        TableSpec(contract=hr.GOLD, path="/x", layout="file", partition_by=("year",))
    with pytest.raises(ValueError):
        TableSpec(contract=hr.GOLD, path="/x", write_mode="overwrite_partition")
    with pytest.raises(ValueError):
        TableSpec(contract=hr.GOLD, path="/x", write_mode="append")


def test_self_overwrite_is_refused(spark, workdir):
    from terrace.sinks import SelfOverwriteError

    landing = hr_fixture.write(f"{workdir}/landing/hr.csv", hr_fixture.rows(5))
    p = chain.MedallionPaths(landing, f"{workdir}/landing", f"{workdir}/gold")
    with pytest.raises(SelfOverwriteError):
        chain.run_silver(spark, hr.plan(), p, RunContext.create("2026-04-03", source_file="hr.csv"))
    assert os.path.isfile(landing)


def test_multiline_fields_are_opt_in(spark, workdir):
    path = f"{workdir}/ml.csv"
    with open(path, "w", encoding="utf-8") as handle:
        handle.write('id,note\n1,"line one\nline two"\n2,plain\n')
    rows = sources.read_csv_strings(spark, path, multiline=True).orderBy("id").collect()
    assert [r.note for r in rows] == ["line one\nline two", "plain"]


def test_malformed_rows_stop_the_read_or_are_kept(spark, workdir):
    path = f"{workdir}/bad.csv"
    with open(path, "w", encoding="utf-8") as handle:
        handle.write("x,y\n1,2\n5,6,7\n3\n")
    with pytest.raises(Exception, match="malformed_row in bad.csv"):
        sources.read_csv_strings(spark, path, ["x"]).collect()
    kept = sources.read_csv_strings(spark, path, ["x"], malformed="bad").collect()
    assert sorted((r.x, r.bad) for r in kept if r.bad) == [("3", "3"), ("5", "5,6,7")]
    assert [r.x for r in kept if r.bad is None] == ["1"]
