"""Column helpers against literals and plain Python."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farespan.functions import bands, keys, labels, timefn as tf, windows


def values(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_us_week_for_every_day(spark):
    start = date(1999, 12, 20)
    days = [(start + timedelta(days=i),) for i in range(6000)]

    def expected(d):
        first = date(d.year, 1, 1)
        return ((d - first).days + (first.weekday() + 1) % 7) // 7 + 1

    assert values(spark, tf.us_week("d"), days, "d date") == [expected(d) for (d,) in days]


def test_week_of_month(spark):
    days = [(date(2015, 5, n),) for n in (1, 5, 6, 12, 13, 31)]
    assert values(spark, tf.week_of_month("d"), days, "d date") == [1, 1, 2, 2, 3, 5]


def test_boundaries_are_counted_not_elapsed_time(spark):
    rows = [(datetime(2015, 12, 31, 23, 59), datetime(2016, 1, 1, 0, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(tf.hours_between("a", "b"), tf.days_between("a", "b"), tf.years_between("a", "b"), tf.minutes_between("a", "b")).first()
    assert tuple(got) == (1, 1, 1, 2)


def test_lead_labels(spark):
    leads = [(-5,), (-10,), (-15,), (0,), (10,), (11,), (1000,), (1001,)]
    assert values(spark, bands.lead_arith("n"), leads, "n int") == [
        "1-10", "-19--10", "-9-0", "0-10", "0-10", "11-20", "991-1000", "1001-1010",
    ]
    assert values(spark, bands.lead_list("n"), leads, "n int") == ["Unknown"] * 3 + ["0-10", "0-10", "11-20", "991-1000", "Unknown"]
    assert values(spark, bands.lead_to400("n"), [(400,), (401,), (-1,)], "n int") == ["391-400", ">400", ">400"]
    assert values(spark, bands.lead_coarse("n"), [(-3,), (1,), (7,), (30,), (90,), (91,), (None,)], "n int") == ["0", "1", ">1-7", ">7-30", ">30-90", ">90", None]


def test_list_and_arithmetic_leads_agree(spark):
    df = spark.range(0, 1001).select(F.col("id").cast("int").alias("n"))
    assert df.where(bands.lead_list("n") != bands.lead_arith("n")).count() == 0


@pytest.mark.parametrize("name, ages, expected", [
    ("analysis", [12, 18, 70], ["6-12", "13-18", ">70"]),
    ("fly_thru", [60, 61, 101], ["MatureAffluent", ">60", "Unknown"]),
    ("journey", [-1, 11, 76], [None, "<12", ">75"]),
    ("china", [12, 50, -1], ["Under 12 years old", "Senior Citizens", "Unknown"]),
])
def test_age_bands(spark, name, ages, expected):
    assert values(spark, bands.age_band("a", name), [(a,) for a in ages], "a int") == expected


def test_transit(spark):
    assert values(spark, bands.transit_band("h"), [(None,), (0,), (-4,), (2,), (3,), (49,)], "h int") == ["0", "0", "0", "0-2", "2-4", ">48"]


def test_keys(spark):
    rows = [("KUL", "BKI"), ("BKI", "KUL"), ("KUL", "KUL"), (None, "KUL")]
    assert values(spark, keys.route_key("a", "b"), rows, "a string, b string") == ["BKIKUL", "BKIKUL", "KULKUL", None]
    assert values(spark, keys.pair_key("a", "b", "-"), [("TH", "MY")], "a string, b string") == ["MY-TH"]
    assert values(spark, keys.home_currency("c"), [("AK",), ("FD",), ("??",), (None,)], "c string") == ["MYR", "THB", "MYR", "MYR"]
    assert values(spark, keys.home_currency_strict("c"), [("JW",), ("??",)], "c string") == ["JPY", None]
    assert values(spark, keys.alias_route("r"), [("KULSTN",), ("AAABBB",)], "r string") == ["KULLGW", "AAABBB"]


def test_channel_labels(spark):
    rows = [("Corporate", "A1", None), ("Corporate", "12", None), ("Corporate", None, None), ("Call Centre", None, "DEL"), ("Web", None, None), (None, None, None)]
    schema = "c string, o string, l string"
    assert values(spark, labels.channel_label("c", "o", "l"), rows, schema) == [
        "Corporate - Direct", "Corporate - TMC", "Corporate", "Call Centre - Sutherland", "Web", None,
    ]
    assert values(spark, labels.channel_label("c", "o", None, "UnknownRoleCode"), rows, schema)[3:] == ["Call Centre", "Web", "UnknownRoleCode"]


NOW = datetime(2015, 10, 22, 12, 30)


def test_windows():
    d = datetime
    assert windows.yesterday(NOW) == windows.Window(d(2015, 10, 21), d(2015, 10, 22))
    assert windows.month_of_yesterday_to_date(d(2015, 10, 1, 9)) == windows.Window(d(2015, 9, 1), d(2015, 10, 1))
    assert windows.previous_month(d(2015, 1, 3)) == windows.Window(d(2014, 12, 1), d(2015, 1, 1))
    assert windows.trailing_week(NOW, 1) == windows.Window(d(2015, 10, 14), d(2015, 10, 21))
    assert windows.yesterday_or_month_on_day_five(d(2015, 3, 5, 1)) == windows.Window(d(2015, 2, 1), d(2015, 3, 5))
    assert windows.trailing_31_days(d(2015, 1, 10)) == (windows.Window(d(2014, 12, 10), d(2015, 1, 11)), windows.Window(d(2014, 12, 10), None))
    assert windows.previous_month_plus_six(d(2015, 5, 1)) == windows.Window(d(2015, 3, 1), d(2015, 10, 1))
    assert windows.previous_month_to_year_end(NOW) == windows.Window(d(2015, 9, 1), d(2015, 12, 31))
    assert windows.two_back_five_ahead(NOW) == windows.Window(d(2015, 8, 1), d(2016, 3, 1), False, True)
    assert windows.season(NOW, 2) == windows.Window(d(2015, 1, 1), d(2016, 9, 30, 23, 59), True, True)
    assert windows.season(d(2016, 1, 2), 3).start == d(2015, 1, 1)
    assert windows.five_months_back(d(2015, 3, 9)) == windows.Window(d(2014, 10, 1), d(2015, 3, 9))
    assert windows.month_before_to_date(d(2015, 3, 9)) == windows.Window(d(2015, 2, 1), d(2015, 3, 9))


def test_cash_window_switches_at_eleven():
    window, morning = windows.month_to_date_with_cutoff(datetime(2015, 10, 22, 10, 59))
    assert morning and window == windows.Window(datetime(2015, 10, 1), datetime(2015, 10, 22))
    window, morning = windows.month_to_date_with_cutoff(datetime(2015, 10, 22, 11, 0))
    assert not morning and window.end == datetime(2015, 10, 23)


def test_year_on_year_windows():
    y = windows.year_on_year(NOW)
    assert y.booked_last_year.end == datetime(2014, 10, 22)
    assert y.booked_year_end.end == datetime(2014, 12, 31) and y.booked_year_end.end_closed
    assert (y.departs.start, y.departs.end) == (datetime(2015, 1, 1), datetime(2016, 12, 31))
    assert (y.departs_last_year.start, y.departs_last_year.end) == (datetime(2014, 1, 1), datetime(2015, 12, 31))


def test_fly_thru_window_ends_on_monday_of_the_sunday_week():
    for day in range(18, 25):  # Sunday 18 to Saturday 24 October 2015
        bought, departs = windows.fly_thru(datetime(2015, 10, day, 5))
        assert bought.end == datetime(2015, 10, 19)
        assert departs.end == datetime(2016, 10, 19)


def test_local_time_round_trip():
    assert windows.to_local(NOW, windows.MALAYSIA) == datetime(2015, 10, 22, 20, 30)
    assert windows.to_utc(windows.to_local(NOW, windows.MALAYSIA), windows.MALAYSIA) == NOW
