import uuid

from terrace import catalog
from terrace.plans import orders
from terrace.plans.jobs import publish
from terrace.queries import _orders_as_text, _run

SF = "/root/testdata/sf0.001"


def test_partitioned_external_table_sees_registered_days(spark, workdir):
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, SF), run)
    gold = f"{workdir}/gold"
    for day in ("2026-04-02", "2026-04-03", "2036-01-01"):
        r = _run(day)
        publish(orders.to_gold(silver, r), orders.gold_spec(gold), r)
    db = f"terrace_test_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=f"{workdir}/warehouse/{db}.db")
    table = catalog.register_external_table(spark, f"{db}.gold_orders", orders.GOLD, gold)
    # Declared schema, partition columns last.
    assert spark.table(table).columns[-3:] == ["year", "month", "day"]
    assert catalog.row_count(spark, table).first().row_count == 0
    catalog.add_partition(spark, table, _run("2026-04-03").partition_values)
    assert catalog.row_count(spark, table).first().row_count == 1500
    catalog.repair(spark, table)
    assert catalog.row_count(spark, table).first().row_count == 4500
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    view = catalog.projected_view(spark, f"{db}_projected", table, {"year": (2024, 2035)})
    assert view.count() == 3000
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()


def test_unpartitioned_external_table(spark, workdir):
    run = _run()
    publish(orders.to_silver(_orders_as_text(spark, SF), run), orders.silver_spec(f"{workdir}/silver"), run)
    db = f"terrace_test_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=f"{workdir}/warehouse/{db}.db")
    table = catalog.register_external_table(spark, f"{db}.silver_orders", orders.SILVER, f"{workdir}/silver")
    assert spark.table(table).columns == orders.SILVER.names
    assert spark.table(table).count() == 1500


def test_jobs_register_their_tables(spark, workdir):
    db = f"terrace_test_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=f"{workdir}/warehouse/{db}.db")
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, SF), run)
    publish(silver, orders.silver_spec(f"{workdir}/silver", catalog_table=f"{db}.silver_orders"), run)
    assert spark.table(f"{db}.silver_orders").count() == 1500
    gold_spec = lambda: orders.gold_spec(f"{workdir}/gold", catalog_table=f"{db}.gold_orders")
    for day in ("2026-04-02", "2026-04-03"):
        r = _run(day)
        publish(orders.to_gold(silver, r), gold_spec(), r)
    assert catalog.row_count(spark, f"{db}.gold_orders").first().row_count == 3000
    assert spark.sql(f"SELECT count(*) AS n FROM {db}.gold_orders WHERE day = 3").first().n == 1500


def test_versions_are_registered_with_their_folders(spark, workdir):
    """A table of the observe gate: a day that is published again points to its new version."""
    db = f"terrace_test_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=f"{workdir}/ware'house/{db}.db")
    table = f"{db}.gold_orders"
    silver = orders.to_silver(_orders_as_text(spark, SF), _run())
    for day, run_id in (("2026-04-02", "a"), ("2026-04-03", "b"), ("2026-04-03", "c")):
        r = _run(day, run_id)
        publish(orders.to_gold(silver, r), orders.gold_spec(f"{workdir}/gold", gate="observe", catalog_table=table), r)
    runs = {(r.day, r.run_id): r["count"] for r in spark.table(table).groupBy("day", "run_id").count().collect()}
    assert runs == {(2, "a"): 1500, (3, "c"): 1500}
    r = _run("2026-04-05", "d")
    publish(orders.to_gold(silver, r), orders.gold_spec(f"{workdir}/gold", write_mode="overwrite_full", gate="observe", catalog_table=table), r)
    assert [p[0] for p in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["year=2026/month=4/day=5"]
    assert catalog.row_count(spark, table).first().row_count == 1500
