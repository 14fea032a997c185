"""Landing ingest: one micro-batch per file, non-CSV ignored, nothing reprocessed."""

import os
import time

from terrace import sources
from terrace.plans import events
from terrace.streaming import batch_run_id

HEADER = ",".join(events.BRONZE_COLUMNS)


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write("\n".join([HEADER, *lines]) + "\n")


def test_landing_ingest_runs_once_per_file(spark, workdir):
    landing, silver, ckpt = f"{workdir}/landing", f"{workdir}/silver", f"{workdir}/_checkpoint"
    _write(f"{landing}/a.csv", ["1,2024-01-01 00:00:01.5,7,click,1.5,", "2,2024-01-01 10:00:00,8,VIEW ,2.0,{}"])
    time.sleep(0.05)
    _write(f"{landing}/c.csv", ["3,2024-01-02 00:00:00,9,purchase,3.25,x"])
    _write(f"{landing}/b.txt", ["99,2024-01-03 00:00:00,9,purchase,3.25,x"])

    assert events.ingest_landing(spark, landing, silver, ckpt, max_files_per_trigger=1) == 2
    df = sources.read_table(spark, silver, events.SILVER.schema)
    assert sorted(r.event_id for r in df.collect()) == [1, 2, 3]
    # One run per file here, and a folder for each date and run.
    assert {(r.source_file, r.event_date.day) for r in df.collect()} == {("a.csv", 1), ("c.csv", 2)}
    assert df.select("run_id").distinct().count() == 2
    assert df.where("event_id = 2").first().event_type == "view"

    # A rerun on the same checkpoint finds nothing new.
    assert events.ingest_landing(spark, landing, silver, ckpt) == 0

    # Later files are one batch; the header-only file adds nothing.
    _write(f"{landing}/d.csv", ["4,2024-01-02 05:00:00,1,signup,0,"])
    _write(f"{landing}/e.csv", [])
    assert events.ingest_landing(spark, landing, silver, ckpt) == 1
    df = sources.read_table(spark, silver, events.SILVER.schema)
    assert sorted((r.event_id, r.event_date.day) for r in df.collect()) == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_replayed_batch_gets_the_same_run_id():
    assert batch_run_id("/ckpt", 3) == batch_run_id("/ckpt/", 3)
    assert batch_run_id("/ckpt", 3) != batch_run_id("/ckpt", 4)


def test_each_arrival_runs_the_whole_chain(spark, workdir):
    import datetime as dt

    from terrace.plans import chain, orders
    from terrace.streaming import ingest

    landing = f"{workdir}/landing"
    header = ",".join(orders.BRONZE_COLUMNS)

    def land(name, keys):
        os.makedirs(landing, exist_ok=True)
        lines = [f"{k},{k % 7},F,{100 + k}.50,1998-10-0{1 + k % 5}T00:00:00,{1 + k % 5}-X" for k in keys]
        with open(f"{landing}/{name}", "w", encoding="utf-8") as handle:
            handle.write("\n".join([header, *lines]) + "\n")

    land("orders-a.csv", range(10))
    time.sleep(0.05)
    land("orders-b.csv", range(100, 104))
    land("orders-empty.csv", [])
    summaries = []
    handler = chain.arrival_handler(
        orders.plan(), f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/bi/orders",
        bronze_columns=orders.BRONZE_COLUMNS, audit_root=f"{workdir}/audit",
    )
    ingest(spark, landing, orders.BRONZE_COLUMNS, f"{workdir}/_ck", lambda df, run: summaries.append(handler(df, run)))
    done = [s for s in summaries if s]
    assert [s["silver"]["rows"] for s in done] == [10, 4]
    assert len(summaries) == 3 and summaries.count(None) == 1
    today = dt.datetime.now(dt.timezone.utc).date()
    gold = sources.read_partitioned(spark, f"{workdir}/gold")
    # Both arrivals fall on today's business date; the later file replaced the day.
    assert gold.count() == 4 and {r.source_file for r in gold.collect()} == {"orders-b.csv"}
    assert done[-1]["gold"]["business_date"] == today.isoformat()
    assert spark.read.parquet(f"{workdir}/audit/quality").select("run_id").distinct().count() == 2
    partitions = spark.read.parquet(f"{workdir}/audit/partitions").collect()
    assert sorted((r.pipeline, r.day, r.rows_written) for r in partitions) == [("orders_gold", today.day, 4), ("orders_gold", today.day, 10)]


def test_given_date_and_run_hold_for_the_stream(spark, workdir):
    from terrace.plans import chain, orders
    from terrace.streaming import ingest

    landing = f"{workdir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/orders-a.csv", "w", encoding="utf-8") as handle:
        handle.write(",".join(orders.BRONZE_COLUMNS) + "\n1,2,F,3.5,1998-10-01,1-X\n")
    handler = chain.arrival_handler(orders.plan(), f"{workdir}/silver", f"{workdir}/gold", bronze_columns=orders.BRONZE_COLUMNS)
    assert ingest(spark, landing, orders.BRONZE_COLUMNS, f"{workdir}/_ck", handler, business_date="2020-01-02", run_id="retry") == 1
    row = sources.read_partitioned(spark, f"{workdir}/gold").first()
    assert (row.year, row.month, row.day, row.run_id, row.source_file) == (2020, 1, 2, "retry", "orders-a.csv")


def test_hr_files_arriving_run_the_sql_chain(spark, workdir):
    import hr_fixture
    from terrace.plans import chain, hr
    from terrace.streaming import ingest

    landing = f"{workdir}/landing"
    hr_fixture.write(f"{landing}/HR-1.csv", hr_fixture.rows(50))
    handler = chain.arrival_handler(hr.plan(), f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/bi/hr")
    out = []
    ingest(spark, landing, None, f"{workdir}/_ck", lambda df, run: out.append(handler(df, run)))
    assert out[0]["silver"]["rows"] == 50 and out[0]["bi_export"]["rows"] == 50
    silver = sources.read_parquet(spark, f"{workdir}/silver")
    assert silver.columns == hr.SILVER.names and silver.select("source_file").distinct().first().source_file == "HR-1.csv"


def test_numeric_looking_file_names_stay_strings(spark, workdir):
    landing, silver = f"{workdir}/landing", f"{workdir}/silver"
    _write(f"{landing}/20240103", ["7,2024-01-03 00:00:00,1,view,1.0,"])
    events.ingest_landing(spark, landing, silver, f"{workdir}/_ck", glob="*")
    df = sources.read_table(spark, silver, events.SILVER.schema)
    assert dict(df.dtypes)["source_file"] == "string"
    assert df.first().source_file == "20240103"
    assert df.columns == events.SILVER.names


def _chain(workdir, **given):
    from terrace.plans import chain, orders

    return chain.arrival_handler(orders.plan(), f"{workdir}/silver", f"{workdir}/gold", bronze_columns=orders.BRONZE_COLUMNS, audit_root=f"{workdir}/audit", **given)


def _land_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)


def test_files_are_bound_by_their_own_headers(spark, workdir):
    landing, silver = f"{workdir}/land ing", f"{workdir}/silver"
    _land_text(f"{landing}/a b.csv", "event_id,ts,user_id,event_type,value,props\n1,2024-01-01 00:00:01,7,click,1.5,p\n")
    _land_text(f"{landing}/c%20d.csv", '﻿note,props,value,event_type,user_id,ts,event_id\n"x, ""y""",q,2.5,view,8,2024-01-01 00:00:02,2\n')
    _land_text(f"{landing}/e.csv", "event_id,ts,user_id,event_type,value,props\n")
    _land_text(f"{landing}/f.csv", "")
    assert events.ingest_landing(spark, landing, silver, f"{workdir}/_ck") == 1
    rows = sources.read_table(spark, silver, events.SILVER.schema).orderBy("event_id").collect()
    assert [(r.event_id, r.user_id, r.event_type, r.value, r.props) for r in rows] == [(1, 7, "click", 1.5, "p"), (2, 8, "view", 2.5, "q")]


def test_stream_refuses_what_the_batch_refuses(spark, workdir):
    import pytest
    from pyspark.errors import PySparkException

    header = "event_id,ts,user_id,event_type,value,props\n"
    for n, row in enumerate(("1,2024-01-01 00:00:01,7,click,1.5,p,surplus", "1,2024-01-01 00:00:01,7,click,1.5")):
        landing = f"{workdir}/landing{n}"
        _land_text(f"{landing}/bad.csv", f"{header}9,2024-01-01 00:00:00,1,view,1,p\n{row}\n")
        with pytest.raises(PySparkException, match="malformed_row in bad.csv"):
            sources.read_csv_strings(spark, f"{landing}/*.csv", events.BRONZE_COLUMNS).collect()
        with pytest.raises(PySparkException, match="malformed_row in bad.csv"):
            events.ingest_landing(spark, landing, f"{workdir}/silver{n}", f"{workdir}/_ck{n}")
        assert not os.path.exists(f"{workdir}/silver{n}") or not sources.S.data_files(spark, f"{workdir}/silver{n}", "parquet")
        from terrace.streaming import landing_stream

        stream = landing_stream(spark, landing, events.BRONZE_COLUMNS).writeStream.format("parquet").option("checkpointLocation", f"{workdir}/_cks{n}").trigger(availableNow=True)
        with pytest.raises(PySparkException, match="malformed_row in bad.csv"):
            stream.start(f"{workdir}/out{n}").awaitTermination()
    _land_text(f"{workdir}/lost/a.csv", "event_id,ts\n1,2024-01-01\n")
    with pytest.raises(PySparkException, match="lacks the column"):
        events.ingest_landing(spark, f"{workdir}/lost", f"{workdir}/silver", f"{workdir}/_ck")


def test_a_batch_of_several_days_has_a_run_for_each(spark, workdir):
    import datetime as dt

    from terrace.plans import orders
    from terrace.streaming import ingest

    landing = f"{workdir}/landing"
    header = ",".join(orders.BRONZE_COLUMNS)
    for n, (name, day) in enumerate((("a", 2), ("b", 3), ("c", 3), ("d", 5))):
        _land_text(f"{landing}/orders-{name}.csv", "\n".join([header, *(f"{100 * n + k},7,F,1.50,1998-10-01,1-X" for k in range(n + 1))]) + "\n")
        at = dt.datetime(2026, 4, day, 12, tzinfo=dt.timezone.utc).timestamp()
        os.utime(f"{landing}/orders-{name}.csv", (at, at))
    out = []
    handler = _chain(workdir, bi=f"{workdir}/bi")
    ingest(spark, landing, orders.BRONZE_COLUMNS, f"{workdir}/_ck", lambda df, run: out.append(handler(df, run)), max_files_per_trigger=10)
    assert len(out) == 1 and out[0]["business_dates"] == ["2026-04-02", "2026-04-03", "2026-04-05"]
    gold = sources.read_partitioned(spark, f"{workdir}/gold")
    assert {(r.day, r.source_file): r["count"] for r in gold.groupBy("day", "source_file").count().collect()} == {
        (2, "orders-a.csv"): 1, (3, "orders-b.csv"): 2, (3, "orders-c.csv"): 3, (5, "orders-d.csv"): 4,
    }
    # Dates, partitions and runs agree row by row, and the audit has a row for each day's run.
    assert gold.where("day(ingestion_date) <> day").count() == 0 and gold.select("day", "run_id").distinct().count() == 3
    audit = spark.read.parquet(f"{workdir}/audit/partitions").collect()
    assert sorted((r.day, r.rows_written) for r in audit) == [(2, 1), (3, 5), (5, 4)]
    # The snapshot is of the last day.
    assert out[0]["bi_export"]["rows"] == 4


def test_many_files_without_opening_one_on_the_driver(spark, workdir, monkeypatch):
    from terrace import session as S

    landing = f"{workdir}/landing"
    os.makedirs(landing)
    for n in range(2_000):
        with open(f"{landing}/f{n:05d}.csv", "w") as handle:
            handle.write(f"a,b\n{n},x\n" if n % 2 else f"b,a\nx,{n}\n")
    opened = []
    jvm = spark.sparkContext._jvm
    assert not hasattr(S, "read_first_line") and jvm is not None
    monkeypatch.setattr(S, "_fs_and_path", lambda s, p, real=S._fs_and_path: opened.append(p) or real(s, p))
    df = sources.read_csv_strings(spark, f"{landing}/*.csv", ["a"])
    assert len(opened) == 1  # the listing
    assert df.selectExpr("sum(a)").first()[0] == 1_999_000
