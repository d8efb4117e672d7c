"""Staged frames, result tables, and what a window keeps out of the charge and fee scans."""

import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.reports import NOW, report_queries
from farespan.functions.windows import Window
from farespan.plans import channels, journeys, routes, sales, year_on_year
from farespan.sources import sinks
from farespan.sources.standin import airline

SF = "/root/testdata/sf0.001"
DAY = Window(datetime(1996, 3, 4), datetime(1996, 3, 5))
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver data not present")


def staged(spark):
    return sorted(p.name for p in Path(sinks.staging_dir(spark).removeprefix("file:")).glob("farespan-stage/*"))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_scope_deletes_what_was_staged_in_it(spark):
    before = staged(spark)
    with sinks.staging_scope():
        kept = sinks.stage(spark.range(3), "inside")
        assert kept.count() == 3 and len(staged(spark)) == len(before) + 1
    assert staged(spark) == before
    with pytest.raises(ZeroDivisionError):
        with sinks.staging_scope():
            sinks.stage(spark.range(3), "inside")
            1 / 0
    assert staged(spark) == before


def test_a_scoped_function_keeps_what_its_result_reads(spark):
    @sinks.scoped
    def operator(fails=False):
        a, b = sinks.stage(spark.range(3), "read"), sinks.stage(spark.range(4), "dropped")
        assert b.count() == 4
        if fails:
            raise KeyError
        return a.withColumn("x", F.col("id") + 1)

    before = staged(spark)
    with sinks.staging_scope():
        out = operator()
        left = set(staged(spark)) - set(before)
        assert len(left) == 1 and left.pop().startswith("read-") and out.count() == 3
        with pytest.raises(KeyError):
            operator(True)
        assert len(set(staged(spark)) - set(before)) == 1
    assert staged(spark) == before


def test_dropping_early(spark):
    with sinks.staging_scope():
        before = staged(spark)
        df = sinks.stage(spark.range(3), "early")
        sinks.drop_staged(df)
        assert staged(spark) == before


@needs_data
@pytest.mark.parametrize("name", ["report_currency_sales", "report_route_revenue_d7", "report_route_performance_d7", "report_nationality"])
def test_no_report_leaves_a_staged_frame(spark, name):
    before = staged(spark)
    with sinks.staging_scope():
        report_queries()[name](spark, SF).collect()
    assert staged(spark) == before


# ---------------------------------------------------------------- result tables

def test_a_failed_save_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "result")
    sinks.save(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        sinks.save(spark.range(9).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["result"]
    sinks.save(spark.read.parquet(path).where("id > 1"), path)  # a report may read what it replaces
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["result"]


def test_a_swap_that_was_cut_off_is_mended(spark, tmp_path):
    path = tmp_path / "result"
    sinks.save(spark.range(5), str(path))
    path.rename(tmp_path / "result._old")
    with pytest.raises(Exception, match="boom"):
        sinks.save(spark.range(1).select(F.raise_error(F.lit("boom")).alias("id")), str(path))
    assert spark.read.parquet(str(path)).count() == 5


def test_a_rerun_replaces_its_days_alone(spark, tmp_path):
    path = str(tmp_path / "daily")
    row = "BookingDate date, n int"
    first = [(date(2015, 4, d), d) for d in (1, 2, 3, 4)]
    sinks.save(spark.createDataFrame(first, row), path, "BookingDate")
    again = spark.createDataFrame([(date(2015, 4, 2), 20), (date(2015, 4, 5), 50)], row)
    sinks.refresh_days(again, path, "BookingDate", date(2015, 4, 2), date(2015, 4, 5))
    got = sorted((str(r.BookingDate), r.n) for r in spark.read.parquet(path).collect())
    assert got == [("2015-04-01", 1), ("2015-04-02", 20), ("2015-04-05", 50)]
    with pytest.raises(ValueError, match="outside"):
        sinks.refresh_days(again, path, "BookingDate", date(2015, 4, 2), date(2015, 4, 4))
    assert spark.read.parquet(path).count() == 3


@needs_data
def test_route_steps_are_published_midway(spark, tmp_path):
    t = airline(spark, SF)
    paths = {n: str(tmp_path / n) for n in ("passengers", "fare_class_revenue")}
    with sinks.staging_scope():
        out = routes.route_revenue(t, NOW, routes.ROUTE_D7, publish_to=paths)
        published = {n: spark.read.parquet(p) for n, p in paths.items()}
        alone = {n: routes.route_revenue(t, NOW, routes.ROUTE_D7, wanted=(n,)) for n in paths}
        for n, df in published.items():
            assert sorted(df.columns) == sorted(alone[n][n].columns) and list(alone[n]) == [n]
            assert sorted(map(str, df.collect())) == sorted(map(str, alone[n][n].select(*df.columns).collect())) != []
        assert any(paths["fare_class_revenue"] in f for f in out["inventory_revenue"].inputFiles())


# ---------------------------------------------------------------- bounded by the window

REPORTS = {
    "daily_sales": lambda t: sales.daily_sales(t, NOW, DAY),
    "cash_flow": lambda t: sales.cash_flow(t, NOW, DAY),
    "currency_sales": lambda t: sales.currency_sales(t, NOW, DAY, DAY),
    "ancillary_revenue": lambda t: sales.ancillary_revenue(t, NOW, DAY),
    "premium_flex": lambda t: channels.premium_flex_monthly(t, NOW, DAY),
    "channel_daily": lambda t: channels.channel_daily(t, NOW, DAY),
    "older_channel_daily": lambda t: channels.older_channel_daily(t, NOW, DAY),
    "booking_date_analysis": lambda t: channels.booking_date_analysis(t, NOW, DAY),
    "china_market": lambda t: channels.china_market(t, NOW, NOW, Window(datetime(1996, 1, 1), datetime(1997, 1, 1))),
    "finance_by_flight": lambda t: routes.finance_by_flight(t, NOW, DAY),
    "nationality": lambda t: journeys.nationality_monthly(t, NOW, DAY)["detail"],
}


@pytest.fixture
def plans(monkeypatch):
    """Optimised plans of all frames that a report stages, in order."""
    seen = []

    def recorded(df, name):
        seen.append(plan_of(df))
        return sinks.stage(df, name)

    for module in (sales, channels, journeys, routes, year_on_year):
        monkeypatch.setattr(module, "stage", recorded)
    return seen


def relations(plans, *columns):
    """(plan lines, place) of each scan that reads all of the columns."""
    found = []
    for plan in plans:
        lines = plan.splitlines()
        found += [(lines, i) for i, line in enumerate(lines) if "Relation" in line and all(c in line for c in columns)]
    return found


@needs_data
@pytest.mark.parametrize("name", REPORTS)
def test_a_day_bounds_the_charges_below_their_sum(spark, plans, name):
    """The least node over each scan of charges that isn't a projection or filter is a
    semi-join with the window's segments, and the scan has literal bounds on the id."""
    with sinks.staging_scope():
        last = plan_of(REPORTS[name](airline(spark, SF)))
        [(lines, at)] = relations([*plans, last], "ChargeNumber", "ChargeAmount")
        over = [line.lstrip(" :+-") for line in lines[:at]][::-1]
        own = next(x for x in over if not x.startswith(("Filter", "Project")))
        assert own.startswith("Join LeftSemi"), own
        assert any(x.startswith("Filter") and re.search(r"PassengerID#\d+L? >= \d+", x) for x in over[:3])


@needs_data
@pytest.mark.parametrize("name", ["cash_flow", "currency_sales", "ancillary_revenue", "booking_date_analysis"])
def test_fees_are_read_once(spark, plans, name):
    with sinks.staging_scope():
        last = plan_of(REPORTS[name](airline(spark, SF)))
        every = [*plans, last]
        assert len(relations(every, "FeeNumber", "ChargeAmount")) == 1
        assert len(relations(every, "FeeCode", "InventoryLegID")) == 1


@needs_data
def test_channel_reports_read_segments_once(spark, plans):
    with sinks.staging_scope():
        last = plan_of(REPORTS["channel_daily"](airline(spark, SF)))
        assert len(relations([*plans, last], "FareJourneyType", "JourneyNumber")) == 1


@needs_data
def test_nothing_in_the_window(spark):
    none = Window(datetime(1900, 1, 1), datetime(1900, 1, 2))
    with sinks.staging_scope():
        t = airline(spark, SF)
        assert sales.cash_flow(t, NOW, none).collect() == [] == sales.daily_sales(t, NOW, none).collect()
        assert channels.channel_daily(t, NOW, none).collect() == []
        assert year_on_year.route_performance(t, datetime(1901, 6, 1), year_on_year.COMPARE_D7).collect() == []
