"""End-to-end HR medallion on a generated landing file (FIXTURES.md scenarios)."""

import csv
import datetime as dt
import decimal
import os

import pytest

import hr_fixture
from terrace import sinks, sources
from terrace.operators.quality import QualityError
from terrace.plans import chain, hr
from terrace.plans.jobs import publish, read_published
from terrace.run import RunContext

PLAN = hr.plan()


def snapshot_rows(folder):
    """Rows of all part files of a CSV snapshot."""
    out = []
    for name in sorted(os.listdir(folder)):
        if name.endswith(".csv"):
            with open(f"{folder}/{name}", newline="", encoding="utf-8") as handle:
                out += list(csv.DictReader(handle))
    return out


def paths(workdir, landing):
    return chain.MedallionPaths(
        landing=landing,
        silver=f"{workdir}/silver/hr_employees",
        gold=f"{workdir}/gold/hr_attrition",
        bi=f"{workdir}/bi/hr_attrition_snapshot.csv",
    )


def run_for(day, run_id="run-1"):
    return RunContext.create(day, run_id=run_id, processed_at_utc="2026-04-03 10:00:00")


@pytest.fixture()
def landing(workdir):
    return hr_fixture.write(f"{workdir}/landing/hr_attrition.csv", hr_fixture.rows())


def test_silver_shape_and_values(spark, workdir, landing):
    p = paths(workdir, landing)
    result = chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_attrition.csv"))
    silver = sources.read_parquet(spark, p.silver)
    assert result.columns == hr.SILVER.names
    assert silver.columns == hr.SILVER.names
    assert silver.count() == 200
    first = silver.where("employee_number = 1000").first()
    assert first.department == "sales"
    assert first.job_role == "sales executive"
    assert isinstance(first.over_time, bool) and isinstance(first.attrition, bool)
    assert first.source_file == "hr_attrition.csv"
    assert first.monthly_income == decimal.Decimal("2000.00")
    # ' Research & Development ' is trimmed.
    assert silver.where("department = 'research & development'").count() > 0


def test_full_chain_writes_gold_partition_and_snapshot(spark, workdir, landing):
    p = paths(workdir, landing)
    summary = chain.run_chain(spark, PLAN, p, run_for("2025-12-15"))
    assert summary["silver"]["columns"] == hr.SILVER.names
    assert summary["gold"]["columns"] == hr.GOLD.names
    assert summary["bi_export"]["columns"] == hr.BI.names
    assert os.path.isdir(f"{p.gold}/year=2025/month=12/day=15")
    silver = sources.read_parquet(spark, p.silver)
    gold = sources.read_partitioned(spark, p.gold)
    assert {r.run_id for r in gold.select("run_id").distinct().collect()} == {r.run_id for r in silver.select("run_id").distinct().collect()}
    rows = snapshot_rows(p.bi)
    assert list(rows[0].keys()) == hr.BI.names
    assert {r["ingestion_date"] for r in rows} == {"2025-12-15"}
    assert {r["job_satisfaction_label"] for r in rows} <= {"low", "medium", "high", "very_high"}
    assert rows[0]["processed_at_utc"] == "2026-04-03 10:00:00"


def test_snapshot_filters_to_the_business_date_when_gold_has_history(spark, workdir, landing):
    p = paths(workdir, landing)
    chain.run_chain(spark, PLAN, p, run_for("2026-04-02", "a"))
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03", "b"))
    rows = snapshot_rows(p.bi)
    ids = [int(r["employee_id"]) for r in rows]
    assert {r["ingestion_date"] for r in rows} == {"2026-04-03"}
    assert len(ids) == len(set(ids)) == 200


def test_rerun_replaces_only_the_current_day(spark, workdir, landing):
    p = paths(workdir, landing)
    chain.run_chain(spark, PLAN, p, run_for("2026-04-02", "a"))
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03", "b"))
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03", "c"))
    gold = sources.read_partitioned(spark, p.gold)
    runs = {(r.day, r.run_id) for r in gold.select("day", "run_id").distinct().collect()}
    assert runs == {(2, "a"), (3, "c")}
    assert gold.count() == 400


def test_default_business_date_is_today_utc(spark, workdir, landing):
    p = chain.MedallionPaths(landing, f"{workdir}/silver", f"{workdir}/gold")
    summary = chain.run_chain(spark, PLAN, p, RunContext.create(None))
    today = dt.datetime.now(dt.timezone.utc).date()
    assert summary["gold"]["business_date"] == today.isoformat()
    assert os.path.isdir(f"{p.gold}/year={today.year}/month={today.month}/day={today.day}")


def test_backfill_changes_only_that_day(spark, workdir, landing):
    p = paths(workdir, landing)
    chain.run_chain(spark, PLAN, p, run_for("2026-04-02", "a"))
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03", "b"))
    chain.backfill(spark, PLAN, chain.MedallionPaths(p.landing, p.silver, p.gold), "2026-04-02T08:00:00Z", run_id="retry")
    gold = sources.read_partitioned(spark, p.gold)
    runs = {(r.day, r.run_id) for r in gold.select("day", "run_id").distinct().collect()}
    assert runs == {(2, "retry"), (3, "b")}


def test_duplicate_key_is_rejected_and_silver_untouched(spark, workdir):
    data = hr_fixture.rows(20)
    data[5]["EmployeeNumber"] = data[4]["EmployeeNumber"]
    p = paths(workdir, hr_fixture.write(f"{workdir}/landing/hr_dup_key.csv", data))
    with pytest.raises(QualityError, match="primary_key"):
        chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_dup_key.csv"))
    assert not os.path.exists(p.silver)


def test_bad_number_and_empty_income_are_named(spark, workdir):
    data = hr_fixture.rows(20)
    data[3]["MonthlyIncome"] = ""
    p = paths(workdir, hr_fixture.write(f"{workdir}/landing/hr_null.csv", data))
    with pytest.raises(QualityError, match="monthly_income"):
        chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_null.csv"))
    data = hr_fixture.rows(20)
    data[3]["JobLevel"] = "senior"
    p = paths(workdir, hr_fixture.write(f"{workdir}/landing2/hr_null.csv", data))
    with pytest.raises(QualityError, match="job_level"):
        chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_null.csv"))


def test_score_out_of_range_is_rejected(spark, workdir):
    data = hr_fixture.rows(20)
    data[2]["JobSatisfaction"] = "5"
    p = paths(workdir, hr_fixture.write(f"{workdir}/landing/hr_range.csv", data))
    with pytest.raises(QualityError, match="job_satisfaction"):
        chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_range.csv"))


def test_gold_domain_and_date_coherence(spark, workdir, landing):
    from pyspark.sql import functions as F

    p = paths(workdir, landing)
    run = run_for("2026-04-03").with_source("hr_attrition.csv")
    chain.run_silver(spark, PLAN, p, run)
    gold = hr.to_gold(sources.read_parquet(spark, p.silver), run)
    upper = gold.withColumn("job_satisfaction_label", F.upper("job_satisfaction_label"))
    with pytest.raises(QualityError, match="domain on job_satisfaction_label"):
        publish(upper, hr.gold_spec(p.gold), run)
    shifted = gold.withColumn("day", F.lit(2))
    with pytest.raises(QualityError, match="partition on day"):
        publish(shifted, hr.gold_spec(p.gold), run)
    other_date = gold.withColumn("ingestion_date", F.lit("2026-04-02").cast("date"))
    with pytest.raises(QualityError, match="ingestion_date"):
        publish(other_date, hr.gold_spec(p.gold), run)
    assert not os.path.exists(p.gold)


def test_reordered_columns_are_refused(spark, workdir, landing):
    from terrace.operators.quality import ContractError

    p = paths(workdir, landing)
    run = run_for("2026-04-03").with_source("hr_attrition.csv")
    silver = hr.to_silver(hr.read_bronze(spark, landing), run)
    names = silver.columns
    names[1], names[2] = names[2], names[1]
    with pytest.raises(ContractError):
        publish(silver.select(*names), hr.silver_spec(p.silver), run)


def test_flags(spark, workdir):
    data = hr_fixture.rows(4)
    for row, text in zip(data, [" YES ", "True", "1", ""]):
        row["OverTime"] = text
    p = paths(workdir, hr_fixture.write(f"{workdir}/landing/hr_flags.csv", data))
    chain.run_silver(spark, PLAN, p, run_for("2026-04-03").with_source("hr_flags.csv"))
    got = [r.over_time for r in sources.read_parquet(spark, p.silver).orderBy("employee_number").collect()]
    assert got == [True, True, False, False]


def test_header_only_file_is_refused_and_gold_kept(spark, workdir, landing):
    p = paths(workdir, landing)
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03", "a"))
    empty = hr_fixture.write(f"{workdir}/landing/hr_header_only.csv", [])
    with pytest.raises(sinks.EmptyResultError):
        chain.run_chain(spark, PLAN, chain.MedallionPaths(empty, p.silver, p.gold), run_for("2026-04-03", "b"))
    gold = sources.read_partitioned(spark, p.gold)
    assert gold.count() == 200 and gold.select("run_id").distinct().first().run_id == "a"


def test_observe_gate_publishes_same_result(spark, workdir, landing):
    p = paths(workdir, landing)
    run = run_for("2026-04-03").with_source("hr_attrition.csv")
    silver = hr.to_silver(hr.read_bronze(spark, landing), run)
    publish(silver, hr.silver_spec(f"{workdir}/cached"), run)
    publish(silver, hr.silver_spec(f"{workdir}/observed", gate="observe"), run)
    a = sources.read_parquet(spark, f"{workdir}/cached")
    b = read_published(spark, hr.silver_spec(f"{workdir}/observed", gate="observe"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    gold = hr.to_gold(a, run)
    publish(gold, hr.gold_spec(f"{workdir}/gold_obs", gate="observe"), run)
    assert read_published(spark, hr.gold_spec(f"{workdir}/gold_obs", gate="observe")).exceptAll(gold).count() == 0
    dup = silver.union(silver.limit(1))
    for gate in ("cache", "observe"):
        spec = hr.silver_spec(f"{workdir}/{'cached' if gate == 'cache' else 'observed'}", gate=gate)
        with pytest.raises(QualityError, match="primary_key"):
            publish(dup, spec, run)
        assert read_published(spark, spec).count() == 200
    assert len(os.listdir(f"{workdir}/observed/_versions/data")) == 1


def test_chain_with_observed_gates(spark, workdir, landing):
    """Silver and gold are published as versions; the snapshot reads the published state."""
    from dataclasses import replace

    p = paths(workdir, landing)
    plan = replace(PLAN, silver_spec=lambda path: hr.silver_spec(path, gate="observe"), gold_spec=lambda path: hr.gold_spec(path, gate="observe"))
    chain.run_chain(spark, plan, p, run_for("2026-04-02", "a"))
    chain.run_chain(spark, plan, p, run_for("2026-04-03", "b"), audit_root=f"{workdir}/audit")
    gold = read_published(spark, plan.gold_spec(p.gold))
    assert {(r.day, r.run_id) for r in gold.select("day", "run_id").distinct().collect()} == {(2, "a"), (3, "b")}
    rows = snapshot_rows(p.bi)
    assert len(rows) == 200 and list(rows[0].keys()) == hr.BI.names
    audit = spark.read.parquet(f"{workdir}/audit/partitions").collect()
    assert [(r.pipeline, r.run_id, r.day, r.rows_written) for r in audit] == [("hr_attrition_gold", "b", 3, 200)]
    rules = spark.read.parquet(f"{workdir}/audit/quality")
    assert rules.where("violations > 0 AND rule <> 'rows'").count() == 0
    assert rules.select("pipeline").distinct().count() == 3


def test_numeric_gold_layout(spark, workdir, landing):
    p = paths(workdir, landing)
    run = run_for("2026-04-03").with_source("hr_attrition.csv")
    chain.run_silver(spark, PLAN, p, run)
    gold = hr.to_gold(sources.read_parquet(spark, p.silver), run)
    publish(gold, hr.gold_spec(p.gold, partition_style="numeric"), run)
    assert os.path.isdir(f"{p.gold}/2026/4/3")
    back = sources.read_numeric_partitions(spark, p.gold, ("year", "month", "day"))
    assert back.count() == 200 and back.select("day").distinct().first().day == 3


def test_observed_gate_refuses_empty_result(spark, workdir, landing):
    from pyspark.sql import functions as F

    p = paths(workdir, landing)
    run = run_for("2026-04-03").with_source("hr_attrition.csv")
    chain.run_silver(spark, PLAN, p, run)
    gold = hr.to_gold(sources.read_parquet(spark, p.silver), run)
    publish(gold, hr.gold_spec(p.gold, gate="observe"), run)
    with pytest.raises(sinks.EmptyResultError):
        publish(gold.where(F.lit(False)), hr.gold_spec(p.gold, gate="observe"), run)
    assert read_published(spark, hr.gold_spec(p.gold, gate="observe")).count() == 200


def test_replayed_run_does_not_duplicate_audit_rows(spark, workdir, landing):
    p = paths(workdir, landing)
    run = run_for("2026-04-03", "replayed")
    chain.run_chain(spark, PLAN, p, run, audit_root=f"{workdir}/audit")
    once = spark.read.parquet(f"{workdir}/audit/quality").count()
    chain.run_chain(spark, PLAN, p, run, audit_root=f"{workdir}/audit")
    assert spark.read.parquet(f"{workdir}/audit/quality").count() == once
    assert spark.read.parquet(f"{workdir}/audit/partitions").count() == 1


def test_quotes_and_commas_survive_landing_to_snapshot(spark, workdir):
    """hr_quotes: a department with a comma and double quotes, written the RFC 4180 way."""
    data = hr_fixture.rows(3)
    data[1]["Department"] = 'Sales, "EMEA"'
    data[2]["Department"] = "back\\slash"
    landing = hr_fixture.write(f"{workdir}/landing/hr_quotes.csv", data)
    p = paths(workdir, landing)
    chain.run_chain(spark, PLAN, p, run_for("2026-04-03"))
    departments = sorted(r["department"] for r in snapshot_rows(p.bi))
    assert departments == ["back\\slash", "sales", 'sales, "emea"']


def test_reordered_and_extra_columns_are_bound_by_name(spark, workdir):
    """Two files of one landing folder: the second with swapped and extra columns."""
    data = hr_fixture.rows(10)
    for row in data:
        row["YearsAtCompany"], row["TotalWorkingYears"] = "3", "30"
    hr_fixture.write(f"{workdir}/landing/a.csv", data[:5])
    header = list(reversed(hr.BRONZE_COLUMNS)) + ["Remark"]
    with open(f"{workdir}/landing/b.csv", "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, fieldnames=header, extrasaction="ignore")
        writer.writeheader()
        writer.writerows({**r, "Remark": "x, y"} for r in data[5:])
    chain.run_silver(spark, PLAN, chain.MedallionPaths(f"{workdir}/landing", f"{workdir}/silver", f"{workdir}/gold"), run_for("2026-04-03"))
    silver = sources.read_parquet(spark, f"{workdir}/silver")
    assert {(r.years_at_company, r.total_working_years) for r in silver.collect()} == {(3, 30)}
    assert {r.source_file: r["count"] for r in silver.groupBy("source_file").count().collect()} == {"a.csv": 5, "b.csv": 5}


def test_missing_column_names_the_file(spark, workdir):
    with open(f"{workdir}/c.csv", "w", encoding="utf-8") as handle:
        handle.write("EmployeeNumber,Department\n1,x\n")
    with pytest.raises(ValueError, match="c.csv lacks the column"):
        hr.read_bronze(spark, f"{workdir}/c.csv")


def test_single_file_snapshot_is_opt_in(spark, workdir, landing):
    from dataclasses import replace

    p = paths(workdir, landing)
    plan = replace(PLAN, bi_spec=lambda path: hr.bi_spec(path, layout="file"))
    chain.run_chain(spark, plan, p, run_for("2026-04-03"))
    assert os.path.isfile(p.bi)


def test_backfill_from_an_arrival(spark, workdir, landing):
    from terrace.run import Arrival

    arrival = Arrival.at(f"file://{landing}", business_date="2026-04-02", run_id="again")
    p = chain.MedallionPaths("", f"{workdir}/silver", f"{workdir}/gold")
    done = chain.backfill(spark, PLAN, p, arrival=arrival)
    gold = sources.read_partitioned(spark, p.gold)
    assert (done["run_id"], done["business_date"]) == ("again", "2026-04-02")
    assert {(r.day, r.run_id, r.source_file) for r in gold.collect()} == {(2, "again", "hr_attrition.csv")}
