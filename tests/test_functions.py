import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace import functions as TF
from terrace.run import RunContext, file_name_of, parse_business_date


def _one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_normalize_text_trims_spaces_and_lowers(spark):
    assert _one(spark, ["  Sales Executive ", "\tHR", None], TF.normalize_text("s")) == ["sales executive", "\thr", None]


@pytest.mark.parametrize(
    "text,expected",
    [(" YES ", True), ("True", True), ("1", False), ("", False), (None, False), ("no", False)],
)
def test_yes_no_flag(spark, text, expected):
    assert _one(spark, [text], TF.yes_no("s")) == [expected]


def test_int_cast_gives_null_for_bad_text(spark):
    # M1 bad text and M2 fractional text become NULL instead of failing the job.
    assert _one(spark, ["12", " 7 ", "abc", "3.7", ""], TF.to_int("s")) == [12, 7, None, None, None]


def test_decimal_cast_rounds_half_up_and_nulls_overflow(spark):
    import decimal

    got = _one(spark, ["5993.005", "10", "1e20", "x"], TF.to_decimal("s"))
    assert got == [decimal.Decimal("5993.01"), decimal.Decimal("10.00"), None, None]


def test_score_label_is_null_outside_the_scale(spark):
    got = _one(spark, [1, 2, 3, 4, 5, None], TF.score_label("s"), "s int")
    assert got == ["low", "medium", "high", "very_high", None, None]


def test_iso_date_text_cuts_at_t_or_space(spark):
    got = _one(spark, ["2026-04-03", "2026-04-03T10:00:00Z", "2026-04-03 10:00:00", " 2026-04-03", "nope"], TF.iso_date_text("s"))
    assert got == [dt.date(2026, 4, 3)] * 4 + [None]


def test_file_name_takes_last_segment(spark):
    got = _one(spark, ["s3://b/landing/a.csv", "s3://b/landing/", "/x/y/z.csv", "plain"], TF.file_name("s"))
    assert got == ["a.csv", "landing", "z.csv", "plain"]


def test_lineage_has_one_value_per_run(spark):
    run = RunContext.create("2026-04-03", run_id="r1", processed_at_utc="2026-04-03 10:00:00", source_file="f.csv")
    cols = TF.lineage_columns(run)
    rows = spark.range(5).select(*[v.alias(k) for k, v in cols.items()]).distinct().collect()
    assert len(rows) == 1
    assert rows[0]["processed_at_utc"] == dt.datetime(2026, 4, 3, 10, 0, 0)


def test_business_date_columns_from_literal_and_column(spark):
    lit_cols = TF.business_date_columns("2026-04-03")
    row = spark.range(1).select(*[v.alias(k) for k, v in lit_cols.items()]).first()
    assert (row.ingestion_date, row.year, row.month, row.day) == (dt.date(2026, 4, 3), 2026, 4, 3)
    col_cols = TF.business_date_columns(F.col("ts"))
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 23, 59),)], "ts timestamp")
    row = df.select(*[v.alias(k) for k, v in col_cols.items()]).first()
    assert (row.year, row.month, row.day) == (2024, 1, 30)


def test_parse_business_date_forms():
    assert parse_business_date("2026-04-03T10:00:00Z") == dt.date(2026, 4, 3)
    assert parse_business_date("2026-04-03 10:00:00") == dt.date(2026, 4, 3)
    assert parse_business_date(" 2026-04-03 ") == dt.date(2026, 4, 3)
    assert parse_business_date("") == dt.datetime.now(dt.timezone.utc).date()
    assert parse_business_date(None) == dt.datetime.now(dt.timezone.utc).date()


def test_file_name_of_uri():
    assert file_name_of("s3://lake/bronze/landing/HR-3.csv") == "HR-3.csv"
    assert file_name_of("s3://lake/bronze/landing/") == "landing"


def test_arrival_from_uri_or_bucket_and_key():
    from terrace.run import Arrival

    a = Arrival.at("s3a://lake/bronze/landing/HR-3.csv", business_date="2026-04-03T09:00:00Z", run_id="r")
    assert (a.bucket_name, a.object_key, a.source_filename) == ("lake", "bronze/landing/HR-3.csv", "HR-3.csv")
    assert a.business_date == dt.date(2026, 4, 3)
    b = Arrival.in_bucket("lake", "/bronze/landing/HR-3.csv")
    assert b == Arrival.in_bucket("lake", "bronze/landing/HR-3.csv", business_date=b.business_date, run_id=b.run_id, event_time=b.event_time)
    assert b.source_uri == "s3a://lake/bronze/landing/HR-3.csv" and b.run_id and b.event_time.endswith("Z")
    assert b.run().source_file == "HR-3.csv"
    assert b.run().date_given


def test_empty_date_text_takes_the_default(spark):
    from pyspark.sql import functions as F

    from terrace.functions import iso_date_text

    df = spark.createDataFrame([("2026-04-03T10:00:00Z",), ("",), ("  ",), (None,), ("soon",)], "t string")
    day = dt.date(2020, 1, 2)
    got = df.select(iso_date_text("t").alias("plain"), iso_date_text("t", F.lit(day)).alias("given"), (iso_date_text("t", F.current_date()) == F.current_date()).alias("today"))
    assert [tuple(r) for r in got.collect()] == [
        (dt.date(2026, 4, 3), dt.date(2026, 4, 3), False), (None, day, True), (None, day, True), (None, day, True), (None, None, None),
    ]


def test_parse_business_date_of_values():
    assert parse_business_date(dt.datetime(2026, 4, 3, 23, 59)) == dt.date(2026, 4, 3)
    assert parse_business_date(dt.date(2026, 4, 3)) == dt.date(2026, 4, 3)
    with pytest.raises(ValueError):
        parse_business_date("soon")
