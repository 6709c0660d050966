import datetime as dt
import math

import duckdb
from pyspark.sql import functions as F

from reelhouse.functions import (
    bucketize, first_item, first_word, holiday_name, is_weekend, rating_band, season, surrogate_key,
    weekday_name,
)
from reelhouse.plans.reports import RUNTIME_EDGES, RUNTIME_ELSE, RUNTIME_LABELS


def test_first_item(spark):
    df = spark.createDataFrame([("Drama, Comedy",), ("",), (None,), (" , Horror",), ("Solo",)], "g string")
    got = [r[0] for r in df.select(first_item("g")).collect()]
    assert got == ["Drama", "", None, "", "Solo"]


def test_md5_60_is_portable(spark):
    words = ["Drama", "", "Agnès Varda", "2000-01-01"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(surrogate_key("w", "md5_60")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT CAST(('0x' || substr(md5(?), 1, 15)) AS BIGINT)", [w]).fetchone()[0] for w in words]
    assert got == want
    assert all(0 <= k < 2**60 for k in got)


def test_surrogate_key_nulls_and_dates(spark):
    df = spark.createDataFrame([(None, dt.date(2000, 1, 1))], "s string, d date")
    r = df.select(surrogate_key("s", "xxhash64").alias("a"), surrogate_key("s", "md5_60").alias("b"),
                  surrogate_key("d", "md5_60").alias("c"),
                  surrogate_key(F.lit("2000-01-01"), "md5_60").alias("e")).first()
    assert r.a is None and r.b is None and r.c == r.e


def test_runtime_bucket_edges(spark):
    vals = [60, 61, 90, 120, 150, 151, None]
    df = spark.createDataFrame([(v,) for v in vals], "r int")
    got = [x[0] for x in df.select(bucketize("r", RUNTIME_EDGES, RUNTIME_LABELS, RUNTIME_ELSE)).collect()]
    assert got == ["0-60 min", "61-90 min", "61-90 min", "91-120 min", "121-150 min", "151+ min", "151+ min"]


def test_rating_band_edges(spark):
    vals = [None, float("nan"), 5.999, 6.0, 7.999, 8.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [x[0] for x in df.select(rating_band("v")).collect()]
    assert got == ["UNKNOWN", "UNKNOWN", "LOW", "MID", "MID", "HIGH"]


def test_first_word_names(spark):
    df = spark.createDataFrame([(None,), ("Cher",), ("Agnès Varda",), ("A B C",)], "n string")
    got = [x[0] for x in df.select(first_word("n")).collect()]
    assert got == [None, "Cher", "Agnès", "A"]


CAL = {
    dt.date(2023, 11, 23): ("Thanksgiving", "Thanksgiving"),  # 4th Thursday, ISO week 47
    dt.date(2023, 11, 30): ("Thanksgiving", None),  # 5th Thursday, ISO week 48: literal rule only
    dt.date(2024, 9, 2): ("Labor Day (US)", "Labor Day (US)"),
    dt.date(2024, 9, 9): (None, None),
    dt.date(2024, 12, 30): (None, None),
    dt.date(2000, 2, 29): (None, None),
    dt.date(2024, 1, 1): ("New Years Day", "New Years Day"),
    dt.date(2024, 2, 14): ("Valentines Day", "Valentines Day"),
    dt.date(2024, 3, 17): ("St. Patricks Day", "St. Patricks Day"),
    dt.date(2024, 4, 1): ("April Fools Day", "April Fools Day"),
    dt.date(2024, 4, 22): ("Earth Day", "Earth Day"),
    dt.date(2024, 5, 1): ("May Day", "May Day"),
    dt.date(2024, 5, 5): ("Cinco de Mayo", "Cinco de Mayo"),
    dt.date(2024, 6, 19): ("Midsummer", "Midsummer"),
    dt.date(2024, 6, 26): ("Midsummer", "Midsummer"),
    dt.date(2024, 6, 27): (None, None),
    dt.date(2024, 7, 4): ("Independence Day", "Independence Day"),
    dt.date(2024, 10, 31): ("Halloween", "Halloween"),
    dt.date(2024, 12, 24): ("Christmas Eve", "Christmas Eve"),
    dt.date(2024, 12, 25): ("Christmas Day", "Christmas Day"),
    dt.date(2024, 12, 31): ("New Years Eve", "New Years Eve"),
}


def test_holidays_and_calendar(spark):
    df = spark.createDataFrame([(d,) for d in CAL], "d date")
    rows = df.select("d", holiday_name("d").alias("h"), holiday_name("d", strict_thanksgiving=True).alias("s"),
                     F.weekofyear("d").alias("w")).collect()
    for r in rows:
        assert (r.h, r.s) == CAL[r.d], r
    assert {r.d: r.w for r in rows}[dt.date(2024, 12, 30)] == 1  # ISO week 1 in December


def test_weekend_weekday_season(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 1),), (dt.date(2024, 6, 2),), (dt.date(2024, 6, 3),),
                                (dt.date(2024, 12, 1),), (dt.date(2024, 3, 1),), (dt.date(2024, 9, 1),)], "d date")
    rows = df.select(is_weekend("d"), weekday_name("d"), season("d")).collect()
    assert [r[0] for r in rows] == [1, 1, 0, 1, 0, 1]
    assert [r[1] for r in rows][:3] == ["Sat", "Sun", "Mon"]
    assert [r[2] for r in rows][3:] == ["Winter", "Spring", "Autumn"]
    assert not math.isnan(0.0)


def test_weekday_tests_by_number_and_literal_by_name(spark):
    import datetime as dt

    from reelhouse.plans.dims import calendar

    days = [(dt.date(2001, 9, 1),), (dt.date(2001, 9, 3),), (dt.date(2001, 11, 22),)]  # Sat, Labor Day, Thanksgiving
    df = spark.createDataFrame(days, "full_date date")
    intent = {r.full_date.day: (r.is_weekend, r.holiday_name) for r in calendar(df).collect()}
    assert intent == {1: (1, None), 3: (0, "Labor Day (US)"), 22: (0, "Thanksgiving")}
    literal = {r.full_date.day: (r.is_weekend, r.holiday_name) for r in calendar(df, weekday_by_name=True).collect()}
    assert literal == {1: (0, None), 3: (0, None), 22: (0, None)}


def test_sizing_for_a_large_input():
    from reelhouse.session import sizing

    tb, mb = 1024 ** 4, 1024 ** 2
    small = sizing(10 * tb, total_cores=8000)
    n = int(small["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and 10 * tb / n <= 256 * mb  # whole waves, partitions of at most 256 MB
    big = sizing(100 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 20 * 8000  # capped at 20 waves
    scan_tasks = 100 * tb / int(big["spark.sql.files.maxPartitionBytes"])
    assert scan_tasks <= 20 * 8000 + 1  # the scan is capped too: splits grow past 128 MB
    assert int(sizing(10 * mb, total_cores=8)["spark.sql.shuffle.partitions"]) == 16  # two waves minimum
    assert int(sizing(10 * mb, total_cores=8)["spark.sql.files.maxPartitionBytes"]) == 128 * mb
