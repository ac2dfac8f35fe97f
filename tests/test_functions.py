import datetime

import pytest
from pyspark.sql import functions as F

from meterflow.functions import keys, text, timeparts
from meterflow.operators import clean, enrich, filters, series


def one(spark, value, column, name="x"):
    return spark.createDataFrame([(value,)], f"{name} string").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("device, expected", [
    ("household-HCMC-Q1-261", "hcmc-q1-261"),
    ("household-HCMC-Q1", None),
    ("area-HCMC-Q1", None),
    (None, None),
])
def test_household_key(spark, device, expected):
    assert one(spark, device, keys.household_key("x")) == expected


@pytest.mark.parametrize("device, expected", [
    ("area-HCMC-Q1", "hcmc-q1"),
    ("area-HCMC-Q1-more", "hcmc-q1"),
    ("household-HCMC-Q1-261", None),
    ("area-HCMC", None),
])
def test_area_key(spark, device, expected):
    assert one(spark, device, keys.area_key("x")) == expected


def test_location_and_month_keys(spark):
    df = spark.createDataFrame(
        [("Quan 10", "Phuong 14", "268 A", 2024, 9), ("Quan 10", None, "1", 2024, 9)],
        "district string, ward string, house_number string, year int, month int",
    )
    rows = df.select(keys.location_key().alias("a"), keys.month_key().alias("b")).collect()
    assert rows[0] == ("quan-10-phuong-14-268-a", "quan-10-phuong-14-2024-9")
    assert rows[1] == (None, None)


def test_paths(spark):
    assert one(spark, "s3a://store/a/b.json", keys.key_of_path("x", "s3a://store/")) == "a/b.json"
    assert one(spark, "s3a://other/a/b.json", keys.key_of_path("x", "s3a://store/")) is None
    assert one(spark, "2024-09-29 10:05:00", timeparts.path_safe("x")) == "2024-09-29-10-05-00"
    assert one(spark, "2024-09-29 10-05-00", timeparts.day_of_stamp("x")) == "2024-09-29"


@pytest.mark.parametrize("value, expected", [
    ("03-01-1985", datetime.date(1985, 3, 1)), ("13-01-1985", None), ("x", None), (None, None),
])
def test_parse_date(spark, value, expected):
    assert one(spark, value, timeparts.parse_date("x")) == expected


def test_delimited_line_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    assert df.select(text.delimited_line(["a", "b", "c"])).first()[0] == "a,3"


def test_flat_columns():
    from meterflow.schemas import HOUSEHOLD

    names = text.flat_columns(HOUSEHOLD)
    assert "location.ward" in names and "location" not in names


def test_time_parts_at_month_end(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-12-31 23:59:59.9' AS timestamp")
    row = enrich.add_time_parts(df).first()
    assert (row.year, row.month, row.hour, row.minute, row.date_part, row.formatted_timestamp) == (
        2024, 12, 23, 59, "2024-12-31", "2024-12-31 23-59-59"
    )


@pytest.mark.parametrize("zone, hour, day", [("UTC", 18, "2024-01-01"), ("Asia/Ho_Chi_Minh", 1, "2024-01-02")])
def test_zoned_time_follows_the_session(spark, zone, hour, day):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-01-01T18:30:00Z",)], "t string")
        df = df.select(F.to_timestamp("t").alias("timestamp"), F.lit(1).alias("k"))
        row = enrich.add_time_parts(df).first()
        assert (row.hour, row.date_part) == (hour, day)
        free = spark.sql("SELECT timestamp_ntz'2024-01-01 18:30:00' AS timestamp")
        assert enrich.add_time_parts(free).first().hour == 18
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_column_fails_early(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="missing columns"):
        enrich.add_time_parts(df)
    with pytest.raises(ValueError, match="kind"):
        enrich.project_for(df, "city")
    with pytest.raises(ValueError):
        filters.by_keys(df, nothing=1)


def test_to_numeric_then_drop(spark):
    df = spark.createDataFrame([("1.5", "2"), ("?", "3"), ("4", None)], "a string, b string")
    rows = clean.drop_incomplete(clean.to_numeric(df, ["a", "b"]))
    assert [tuple(r) for r in rows.collect()] == [(1.5, 2.0)]
    assert clean.drop_incomplete(clean.to_numeric(df, ["a", "b"]), ["b"]).count() == 2


def test_by_keys_ands_all(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, n int")
    assert filters.by_keys(df, k="a", n=1).count() == 1


def test_series_sorted_by_date(spark):
    df = spark.createDataFrame([("02-01-1985", 70.7), ("01-01-1985", 72.5), ("bad", 1.0)], "d string, v double")
    rows = series.date_indexed(df, "d", "v").collect()
    assert [r["Date"] and r["Date"].month for r in rows] == [None, 1, 2]
