"""Plan-shape checks for the large-data behaviour: hot keys, hot days, size checks."""

import os

import pytest

from pyspark.sql import functions as F

from terrace import sinks
from terrace.contract import Contract
from terrace.operators import quality as Q
from terrace.plans import jobs, orders
from terrace.queries import _orders_as_text, _run


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    # A third of the rows share one key.
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    dup = Q.duplicate_key_groups(df, ["k"])
    plan = dup._jdf.queryExecution().executedPlan().toString()
    # Partial count on the map side, then the exchange on the key, then the final count.
    assert plan.rindex("partial_count") > plan.index("Exchange hashpartitioning(k")
    assert dup.first().violations == 1


def test_scalar_rules_shuffle_one_row_per_task(spark):
    contract = Contract.from_dict("c", {"columns": [{"name": "id", "type": "bigint", "nullable": False, "min_value": 0}]})
    rules = Q.compile_rules(contract, ["id"])
    plan = Q._scalar_aggregate(spark.range(1000).repartition(8), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" in plan and "partial_count" in plan


def test_hot_day_is_split_across_writers(spark, workdir):
    """A rebalanced multi-day write splits a day holding a third of the rows into several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        n = 60000
        df = spark.range(n).select(
            "id",
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 30) + 1).cast("int").alias("day"),
            F.lit("x" * 20).alias("pad"),
        ).repartition(8)
        sinks.overwrite_full(df, f"{workdir}/t", partition_by=("day",), rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(f"{workdir}/t/day=1") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(f"{workdir}/t").count() == n


def test_one_day_gold_write_has_no_shuffle(spark, workdir):
    """A single business date has constant partition values: tasks write straight into the day folder."""
    run = _run()
    gold = orders.to_gold(orders.to_silver(_orders_as_text(spark, "/root/testdata/sf0.001"), run), run)
    captured = {}

    def capture(df, path, partition_by, **kw):
        captured["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return path

    original = sinks.overwrite_partitions
    jobs.sinks.overwrite_partitions = capture
    try:
        jobs._write_in_place(gold, orders.gold_spec(f"{workdir}/g"), run)
    finally:
        jobs.sinks.overwrite_partitions = original
    assert "Exchange" not in captured["plan"]


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from terrace import session as S

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_root(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: None)))


def _versioned(spark, workdir):
    run = _run()
    gold = orders.to_gold(orders.to_silver(_orders_as_text(spark, "/root/testdata/sf0.001"), run), run)
    return gold, orders.gold_spec(f"{workdir}/gold", gate="observe"), run


def test_publish_that_dies_half_way_leaves_the_old_days(spark, workdir, monkeypatch):
    gold, spec, run = _versioned(spark, workdir)
    jobs.publish(gold, spec, run)
    before = jobs.read_published(spark, spec).agg(F.sum("total_price")).first()[0]
    dearer = gold.withColumn("total_price", (F.col("total_price") + 1).cast("decimal(12,2)"))

    def die(*args, **kw):
        raise ConnectionError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks.versions, "publish", die)
        with pytest.raises(ConnectionError):
            jobs.publish(dearer, spec, run)
    assert jobs.read_published(spark, spec).agg(F.sum("total_price")).first()[0] == before
    # A manifest that was begun but not completed isn't the table either.
    os.makedirs(f"{workdir}/gold/_versions/manifests/000000000009")
    assert jobs.read_published(spark, spec).agg(F.sum("total_price")).first()[0] == before
    os.rmdir(f"{workdir}/gold/_versions/manifests/000000000009")
    jobs.publish(dearer, spec, run)
    assert jobs.read_published(spark, spec).agg(F.sum("total_price")).first()[0] == before + 1500
    assert len(os.listdir(f"{workdir}/gold/_versions/data")) == 3
    sinks.versions.vacuum(spark, spec.path)
    assert len(os.listdir(f"{workdir}/gold/_versions/data")) == 1
    assert jobs.read_published(spark, spec).count() == 1500


def test_versioned_publish_moves_nothing(spark, workdir, monkeypatch):
    gold, spec, run = _versioned(spark, workdir)
    moved = []
    monkeypatch.setattr(jobs.S, "rename_path", lambda *a: moved.append(a))
    jobs.publish(gold, spec, run)
    assert not moved and jobs.read_published(spark, spec).count() == 1500


def test_read_back_names_the_partition_that_is_short(spark, workdir, monkeypatch):
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, "/root/testdata/sf0.001"), run)
    spec = orders.gold_spec(f"{workdir}/gold", write_mode="overwrite_full", check_run_date=False, partition_by=("year",))
    original = sinks.overwrite_full
    monkeypatch.setattr(sinks, "overwrite_full", lambda df, *a, **k: original(df.where("year <> 1998"), *a, **k))
    with pytest.raises(sinks.ReadBackError, match="1998"):
        jobs.publish(orders.to_gold_history(silver, run), spec, run)
    day = orders.bi_spec(f"{workdir}/snapshot")
    monkeypatch.setattr(sinks, "overwrite_full", lambda df, *a, **k: original(df.limit(3), *a, **k))
    with pytest.raises(sinks.ReadBackError, match="1500 written, 3 found"):
        jobs.publish(orders.to_bi(orders.to_gold(silver, run), run), day, run)


def test_short_write_leaves_the_old_table(spark, workdir, monkeypatch):
    """The staged copy is counted before it is swapped in."""
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, "/root/testdata/sf0.001"), run)
    spec = orders.silver_spec(f"{workdir}/silver")
    jobs.publish(silver, spec, run)
    original = sinks.files._writer
    monkeypatch.setattr(sinks.files, "_writer", lambda df, *a: original(df.limit(3), *a))
    with pytest.raises(sinks.ReadBackError, match="1500 written, 3 found"):
        jobs.publish(silver, spec, run)
    assert jobs.read_published(spark, spec).count() == 1500 and os.listdir(workdir) == ["silver"]
