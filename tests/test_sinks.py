import csv
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terrace import sinks, sources
from terrace import session as S
from terrace.contract import Contract
from terrace.plans.jobs import TableSpec, publish
from terrace.run import RunContext


def _days(spark, day, n=5, price=1.0):
    return spark.range(n).select(
        F.col("id"), (F.lit(price) * F.col("id")).alias("price"),
        F.lit(2026).alias("year"), F.lit(4).alias("month"), F.lit(day).alias("day"),
    )


def test_full_overwrite_replaces_content(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_full(spark.range(10), path)
    sinks.overwrite_full(spark.range(3), path)
    assert sources.read_parquet(spark, path).count() == 3


def test_static_partitioned_overwrite_drops_stale_partitions(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_full(_days(spark, 2).union(_days(spark, 3)), path, partition_by=("year", "month", "day"))
    sinks.overwrite_full(_days(spark, 3), path, partition_by=("year", "month", "day"))
    assert not os.path.exists(f"{path}/year=2026/month=4/day=2")
    assert sources.read_partitioned(spark, path).count() == 5


def test_dynamic_overwrite_replaces_only_touched_day(spark, workdir):
    path = f"{workdir}/t"
    parts = ("year", "month", "day")
    sinks.overwrite_partitions(_days(spark, 2), path, parts)
    sinks.overwrite_partitions(_days(spark, 3), path, parts)
    sinks.overwrite_partitions(_days(spark, 3, n=2, price=10.0), path, parts)
    df = sources.read_partitioned(spark, path)
    assert df.where("day = 2").count() == 5
    assert sorted(r.price for r in df.where("day = 3").collect()) == [0.0, 10.0]
    # Partition columns come back last, typed int.
    assert df.columns[-3:] == ["year", "month", "day"]
    assert dict(df.dtypes)["day"] == "int"


def test_session_mode_is_not_changed_by_a_dynamic_write(spark, workdir):
    sinks.overwrite_partitions(_days(spark, 2), f"{workdir}/t", ("year", "month", "day"))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_empty_result_is_refused_before_touching_target(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_partitions(_days(spark, 3), path, ("year", "month", "day"))
    with pytest.raises(sinks.EmptyResultError):
        sinks.overwrite_partitions(_days(spark, 3, n=0), path, ("year", "month", "day"), rows=0)
    assert sources.read_partitioned(spark, path).count() == 5


def test_single_csv_file_round_trips_quotes_and_commas(spark, workdir):
    df = spark.createDataFrame(
        [(1, 'Sales, "EMEA"', "2026-04-03 10:00:00"), (2, "R&D", "2026-04-03 10:00:00")],
        "id int, department string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    target = f"{workdir}/bi/snapshot.csv"
    sinks.write_single_file(df, target)
    assert os.path.isfile(target)
    # Only the snapshot is left (the local file system keeps a hidden checksum next to it).
    assert [p for p in os.listdir(f"{workdir}/bi") if not p.startswith(".")] == ["snapshot.csv"]
    with open(target, newline="", encoding="utf-8") as handle:
        rows = list(csv.DictReader(handle))
    assert rows[0] == {"id": "1", "department": 'Sales, "EMEA"', "ts": "2026-04-03 10:00:00"}
    with open(target, encoding="utf-8") as handle:
        assert '"Sales, ""EMEA"""' in handle.read()


@pytest.fixture()
def raw_local_files(spark):
    """Paths of the local file system, which joins files; the default one keeps checksums and doesn't."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    given = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    for key, value in given.items():
        conf.set(key, value)
    yield
    for key in given:
        conf.unset(key)


def test_single_csv_file_is_joined_from_parallel_parts(spark, workdir, raw_local_files, monkeypatch):
    parts = []
    real = S.concat
    monkeypatch.setattr(S, "concat", lambda spark, target, files: parts.extend(files) or real(spark, target, files))
    df = spark.range(0, 1000, 1, 6).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "b", '), "id")).alias('odd, "name"'))
    target = f"{workdir}/bi/snapshot.csv"
    for _ in range(2):  # the second replaces the first
        sinks.write_single_file(df, target)
    assert len(parts) == 2 * (1 + 6)
    assert os.listdir(f"{workdir}/bi") == ["snapshot.csv"]
    with open(target, newline="", encoding="utf-8") as handle:
        rows = list(csv.reader(handle))
    assert rows[0] == ["id", 'odd, "name"']
    assert rows[1:] == [[str(i), f'a "b", {i}' if i % 3 else ""] for i in range(1000)]


def test_joined_csv_without_rows_has_its_header(spark, workdir, raw_local_files):
    sinks.write_single_file(spark.range(0).select("id"), f"{workdir}/snapshot.csv")
    with open(f"{workdir}/snapshot.csv", encoding="utf-8") as handle:
        assert handle.read() == "id\n"


def test_single_parquet_file(spark, workdir):
    target = f"{workdir}/bi/snapshot.parquet"
    sinks.write_single_file(spark.range(100).repartition(4), target, fmt="parquet")
    assert os.path.isfile(target)
    assert spark.read.parquet(target).count() == 100


@pytest.fixture()
def unjoined_writes(monkeypatch):
    """Partitions of the frames that were written, in the order of the writes."""
    seen = []
    real = sinks.files._writer
    monkeypatch.setattr(sinks.files, "_writer", lambda df, *rest: seen.append(df.rdd.getNumPartitions()) or real(df, *rest))
    return seen


ODD_NAMES = ["id", 'odd, "name"', " a ", "é", "#x", "it's", "a\tb", "a\\b"]


def _odd(spark, n=1000):
    value = F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "b", é\n'), "id"))
    return spark.range(0, n, 1, 6).select("id", *[value.alias(c) for c in ODD_NAMES[1:]])


def _one_task(monkeypatch, write):
    """What one writer task makes of the same frame."""
    with monkeypatch.context() as patched:
        patched.setattr(S, "can_concat", lambda spark, path: False)
        write()


def test_mounted_single_csv_is_copied_from_parallel_parts(spark, workdir, monkeypatch, unjoined_writes):
    """every task writes, each copies at most JOIN_BYTES, and the bytes are those of one writer task."""
    monkeypatch.setattr(S, "JOIN_BYTES", 1000)
    joined, one = f"{workdir}/parts/a b/joined.csv", f"{workdir}/one.csv"
    for _ in range(2):  # the second replaces the first
        sinks.write_single_file(_odd(spark), joined)
    assert max(unjoined_writes) == 6
    _one_task(monkeypatch, lambda: sinks.write_single_file(_odd(spark).coalesce(1), one))
    with open(joined, "rb") as a, open(one, "rb") as b:
        assert a.read() == b.read()
    assert [p for p in os.listdir(f"{workdir}/parts/a b") if not p.startswith(".")] == ["joined.csv"]
    back = spark.read.options(**sinks.CSV_OPTIONS).option("multiLine", "true").csv(joined)
    assert back.count() == 1000


def test_mounted_single_csv_without_rows_has_its_header(spark, workdir):
    sinks.write_single_file(spark.range(0).select("id"), f"{workdir}/snapshot.csv")
    with open(f"{workdir}/snapshot.csv", encoding="utf-8") as handle:
        assert handle.read() == "id\n"


@pytest.mark.parametrize("rows", [0, 1, 50_000])
def test_single_parquet_file_is_joined_from_parallel_parts(spark, workdir, unjoined_writes, rows):
    """every task writes row groups, and the joined file reads as any Parquet file."""
    df = spark.range(0, rows, 1, 6).select(
        "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("é "), "id")).alias("name"), (F.col("id") % 7).cast("decimal(10,2)").alias("d"),
        F.array(F.col("id"), F.lit(None)).alias("list"), F.lit(None).cast("string").alias("none"), F.timestamp_seconds("id").alias("ts"),
    )
    target = f"{workdir}/bi/snapshot.parquet"
    for _ in range(2):
        sinks.write_single_file(df, target, fmt="parquet")
    assert unjoined_writes == ([6, 6] if rows else [0, 0])
    assert [p for p in os.listdir(f"{workdir}/bi") if not p.startswith(".")] == ["snapshot.parquet"]
    back = spark.read.parquet(target)
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    stored = pq.ParquetFile(target)
    assert stored.metadata.num_rows == rows
    assert stored.read(["id"]).column(0).to_pylist() == list(range(rows))
    assert stored.metadata.num_row_groups == (6 if rows > 6 else rows)


def test_joined_parquet_is_read_in_splits_and_filtered(spark, workdir):
    target = f"{workdir}/snapshot.parquet"
    df = spark.range(0, 200_000, 1, 5).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    bloom = {"parquet.bloom.filter.enabled#text": "true", "parquet.bloom.filter.expected.ndv#text": "100"}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in bloom.items():
        conf.set(key, value)
    try:
        sinks.write_single_file(df, target, fmt="parquet")
    finally:
        for key in bloom:
            conf.unset(key)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        back = spark.read.parquet(target)
        assert back.rdd.getNumPartitions() > 5
        assert back.agg(F.count("text"), F.sum("id")).first() == (200_000, 199_999 * 100_000)
        assert [r.id for r in back.where("id between 149999 and 150001").orderBy("id").collect()] == [149_999, 150_000, 150_001]
        wanted = df.where("id = 177777").first().text
        assert [r.id for r in back.where(F.col("text") == wanted).collect()] == [177_777]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_single_file_is_joined_by_a_file_system_that_offers_it(spark, workdir, raw_local_files, monkeypatch, fmt):
    monkeypatch.setattr(S, "_mounted", lambda fs: False)
    monkeypatch.setattr(S, "_copy_joined", None)
    target = f"{workdir}/snapshot.{fmt}"
    sinks.write_single_file(spark.range(0, 1000, 1, 6), target, fmt=fmt)
    back = spark.read.schema("id bigint").options(**sinks.CSV_OPTIONS).format(fmt).load(target)
    assert back.agg(F.count("id"), F.sum("id")).first() == (1000, 499_500)


def test_parquet_is_written_by_one_task_where_it_cannot_be_joined(spark, workdir, monkeypatch, unjoined_writes):
    monkeypatch.setattr(sinks.row_groups, "encrypted", lambda spark: True)
    sinks.write_single_file(spark.range(0, 100, 1, 4), f"{workdir}/snapshot.parquet", fmt="parquet")
    assert unjoined_writes == [1]
    assert spark.read.parquet(f"{workdir}/snapshot.parquet").count() == 100


def test_numeric_partition_layout(spark, workdir):
    root = f"{workdir}/events"
    sinks.overwrite_numeric_partitions(_days(spark, 2).union(_days(spark, 3)), root, ("year", "month", "day"))
    assert os.path.isdir(f"{root}/2026/4/3")
    assert sinks.partition_location(root, {"year": 2026, "month": 4, "day": 3}, ("year", "month", "day"), "numeric") == f"{root}/2026/4/3"
    sinks.overwrite_numeric_partitions(_days(spark, 3, n=1), root, ("year", "month", "day"))
    back = sources.read_numeric_partitions(spark, root, ("year", "month", "day"))
    counts = {r.day: r["count"] for r in back.groupBy("day").count().collect()}
    assert counts == {2: 5, 3: 1}


@pytest.mark.parametrize("source", ["/lake/silver", "/lake/silver/part-1.parquet", "file:/lake/silver", "file:///lake/silver/", "/lake", "/lake/silver/*.csv"])
def test_guard_refuses_overlapping_target(spark, source):
    with pytest.raises(sinks.SelfOverwriteError):
        sinks.guard_not_input(spark, [source], "/lake/silver")
    with pytest.raises(sinks.SelfOverwriteError):
        sinks.guard_not_input(spark, [source], "file:///lake/silver")


def test_guard_lets_other_folders_pass(spark):
    sinks.guard_not_input(spark, ["/lake/silver", "file:/lake/silver/x.csv"], "/lake/silver_v2")


def test_publish_refuses_its_own_input_unasked(spark, workdir):
    """The plan's own files are looked at; nothing has to be passed in."""
    contract = Contract.from_dict("ids", {"columns": [{"name": "id", "type": "bigint"}]})
    spark.range(5).write.parquet(f"{workdir}/t")
    with pytest.raises(sinks.SelfOverwriteError):
        publish(spark.read.parquet(f"file:{workdir}/t"), TableSpec(contract=contract, path=f"{workdir}/t", check_run_date=False), RunContext.create())
    assert spark.read.parquet(f"{workdir}/t").count() == 5


def test_readback_counts(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_full(_days(spark, 2).union(_days(spark, 3, n=2)), path, partition_by=("year", "month", "day"))
    counts = {r.day: r.rows_read for r in sinks.readback_counts(spark, path, ("year", "month", "day")).collect()}
    assert counts == {2: 5, 3: 2}


def _content(spark, rows, **given):
    df = spark.createDataFrame(rows, "a int, b int, t string, p int")
    return sorted(map(tuple, sinks.content_sums(df, **given).collect()))


def test_content_sums_tell_values_and_not_order(spark):
    rows = [(1, None, "x", 1), (None, 2, "y", 1), (1, None, "x", 1), (3, 4, None, 2)]
    sums = _content(spark, rows, partition_by=["p"])
    assert sums == _content(spark, rows[::-1], partition_by=["p"])
    assert [(p, n) for p, n, _ in sums] == [(1, 3), (2, 1)]
    moved = [(None, 1, "x", 1), *rows[1:]]  # the value is in the other column
    assert _content(spark, rows) != _content(spark, moved)
    assert _content(spark, rows) != _content(spark, [rows[0], rows[0], *rows[2:]])  # another row repeated
    assert _content(spark, [(1, 1, "", 1)]) != _content(spark, [(1, 1, None, 1)])
    assert _content(spark, [(1, 1, " x ", 1), (1, 1, "", 1)], fmt="csv") == _content(spark, [(1, 1, "x", 1), (1, 1, None, 1)], fmt="csv")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_readback_by_content_finds_altered_cells(spark, workdir, fmt, monkeypatch):
    contract = Contract.from_dict(
        "rows",
        {"columns": [{"name": n, "type": t} for n, t in (("id", "bigint"), ("name", "string"), ("at", "timestamp"), ("day", "int"))]},
    )
    df = spark.range(40).selectExpr(
        "id", "case when id % 5 = 0 then null when id % 5 = 1 then ' \"a\", b ' else concat('n', id) end AS name",
        "timestamp_micros(1700000000123456 + id * 1000000) AS at", "cast(id % 3 as int) AS day",
    )
    altered = df.withColumn("name", F.when(F.col("id") == 7, "other").otherwise(F.col("name")))
    real = sinks.overwrite_full

    def publish_to(path, readback, parts=()):
        spec = TableSpec(contract=contract, path=f"{workdir}/{path}", fmt=fmt, partition_by=parts, check_run_date=False, readback=readback)
        return publish(df, spec, RunContext.create("2026-04-03"))

    assert publish_to("whole", "content").rows == 40
    assert publish_to("days", "content", ("day",)).rows == 40
    monkeypatch.setattr(sinks, "overwrite_full", lambda _, *a, **k: real(altered, *a, **k))
    assert publish_to("counted", "rows").rows == 40
    for name, parts in (("x", ()), ("y", ("day",))):
        with pytest.raises(sinks.ReadBackError, match="other values"):
            publish_to(name, "content", parts)
        assert not os.path.exists(f"{workdir}/{name}")  # the staged copy isn't swapped in


@pytest.mark.parametrize("mode", ["overwrite_full", "overwrite_partition"])
@pytest.mark.parametrize("style", ["hive", "numeric"])
def test_readback_by_content_of_days(spark, workdir, mode, style):
    contract = Contract.from_dict("days", {"columns": [{"name": n, "type": t} for n, t in (("id", "bigint"), ("year", "int"), ("month", "int"), ("day", "int"))]})
    spec = TableSpec(contract=contract, path=f"{workdir}/t", write_mode=mode, partition_by=("year", "month", "day"), partition_style=style, readback="content")
    for day in (2, 3):
        run = RunContext.create(f"2026-04-0{day}")
        cells = [F.lit(v).cast("int").alias(k) for k, v in run.partition_values.items()]
        assert publish(spark.range(9).select("id", *cells), spec, run).rows == 9


def test_parquet_scan_of_empty_folder_is_an_error(spark, workdir):
    os.makedirs(f"{workdir}/empty")
    with pytest.raises(FileNotFoundError):
        sources.read_parquet(spark, f"{workdir}/empty")


def test_landing_prefix_resolution():
    assert sources.resolve_landing_source("s3://b/landing/", "HR-3.csv") == "s3://b/landing/HR-3.csv"
    assert sources.resolve_landing_source("s3://b/landing/HR-3.csv", "HR-3.csv") == "s3://b/landing/HR-3.csv"
    assert sources.resolve_landing_source("s3://b/landing/", None) == "s3://b/landing/"


def test_shared_root_comes_from_session(spark):
    root = S.shared_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert S.scratch_path(spark, "x").startswith(root)


def test_failed_full_overwrite_keeps_previous_table(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_full(spark.range(7), path)
    failing = spark.range(5).selectExpr("id", "CAST(IF(id = 3, raise_error('boom'), id) AS BIGINT) AS v")
    with pytest.raises(Exception):
        sinks.overwrite_full(failing, path)
    assert sources.read_parquet(spark, path).count() == 7
    assert [d for d in os.listdir(workdir) if "_stage_" in d] == []
